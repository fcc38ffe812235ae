"""Tables with like headers: candidates by shared characters, then the greedy choice on the few that are left.

Headers are alike by position (:func:`tessella.functions.similarity.header_similarity`), so lists of other lengths never
are. Each distinct header list of a document is compared once. Of ``n`` positions more than a share must be
alike, so at least one of the first few is, and two alike texts share one of the rarer characters of either: a Jaccard
similarity above ``POSITION_LIKE`` leaves at most the rest of its characters outside the other's, and a
contained text has all of its in the other. So every list posts those characters of its first positions and meets
the lists that have them there. No document gives all pairs; the greedy choice sees linked lists only.

Defined cases: null or empty lists are like none; a blank text is contained in every text that is not empty, so it meets
all lists of its length; null texts are like none; empty tables give no links.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.similarity import POSITION_LIKE, header_similarity
from tessella.functions.text import trimmed


def _letters(text: Column) -> Column:
    """A text's distinct characters as it is compared, the higher code points, mostly the rarer ones, first."""
    return F.reverse(F.array_sort(F.array_distinct(F.filter(F.split(trimmed(F.lower(text)), ""), lambda c: c != ""))))


def header_links(heads: DataFrame, alike: float, doc: str = "doc", node: str = "node") -> DataFrame:
    """``doc, node, other``: pairs of header lists (``headers``) that are more alike than ``alike``, ``node > other``."""
    lists = heads.filter(F.size("headers") > 0).select(doc, node, "headers", F.size("headers").alias("_n"))
    # Of n positions n - floor(alike * n) at most are unlike, less one, as the share must be exceeded.
    first = F.greatest(F.col("_n") - F.floor(F.col("_n") * F.lit(alike)), F.lit(1)).cast("int")
    places = lists.select(doc, node, "_n", F.posexplode(F.slice("headers", 1, first)).alias("_i", "_text")).filter("_text <> ''")
    places = places.select(doc, node, "_n", "_i", _letters(F.col("_text")).alias("_l"))
    rarer = F.when(F.size("_l") == 0, F.array(F.lit(""))).otherwise(F.slice("_l", 1, F.floor(F.size("_l") * F.lit(1 - POSITION_LIKE) + 1e-9).cast("int") + 1))
    seeking = places.select(doc, "_n", "_i", F.col(node).alias("_a"), F.explode(rarer).alias("_c"))
    having = places.select(doc, "_n", "_i", F.col(node).alias("_b"), F.explode(F.concat("_l", F.array(F.lit("")))).alias("_c"))
    pair = seeking.join(having, [doc, "_n", "_i", "_c"]).filter("_a <> _b").select(doc, F.greatest("_a", "_b").alias(node), F.least("_a", "_b").alias("other")).distinct()
    side = lambda name, column: lists.select(doc, F.col(node).alias(name), F.col("headers").alias(column))
    return pair.join(side(node, "_h"), [doc, node]).join(side("other", "_g"), [doc, "other"]).filter(header_similarity(F.col("_g"), F.col("_h")) > alike).select(doc, node, "other")


def _linked(table: pa.Table) -> tuple[list[int], dict[int, list[int]]]:
    """The nodes in order, and the earlier ones that each is linked to."""
    links: dict[int, list[int]] = {}
    for node, other in zip(table.column("node").to_pylist(), table.column("other").to_pylist()):
        links.setdefault(node, [])
        if other is not None:
            links[node].append(other)
    return sorted(links), links


def known_nodes(links: DataFrame, doc: str = "doc") -> DataFrame:
    """``doc, node``: in order, the nodes that are linked to an earlier one which is not known itself."""

    def choose(table: pa.Table) -> pa.Table:
        nodes, earlier = _linked(table)
        known: set[int] = set()
        for node in nodes:
            if any(other not in known for other in earlier[node]):
                known.add(node)
        return pa.table({doc: table.column(doc).slice(0, 1).take(pa.array([0] * len(known))), "node": pa.array(sorted(known), pa.int64())})

    return links.groupBy(doc).applyInArrow(choose, f"{doc} {links.schema[doc].dataType.simpleString()}, node long")


def joined_nodes(nodes: DataFrame, links: DataFrame, doc: str = "doc") -> DataFrame:
    """``doc, node, first``: the first earlier node that each joins, itself if none.

    In order, a node (``node, title``) joins the first one that stands for itself and is linked to it or has its title; of
    a title only one can stand for itself, so titles need no pairs. An empty title is none.
    """

    def choose(table: pa.Table) -> pa.Table:
        order, earlier = _linked(table)
        titles, named = dict(zip(table.column("node").to_pylist(), table.column("title").to_pylist())), {}
        firsts: dict[int, int] = {}
        for node in order:
            found = [other for other in earlier[node] if firsts[other] == other]
            found += [named[titles[node]]] if titles[node] in named else []
            firsts[node] = min(found, default=node)
            if not found and titles[node]:
                named[titles[node]] = node
        return pa.table({doc: table.column(doc).slice(0, 1).take(pa.array([0] * len(order))), "node": pa.array(order, pa.int64()), "first": pa.array([firsts[n] for n in order], pa.int64())})

    rows = nodes.select(doc, "node", "title").join(links, [doc, "node"], "left")
    return rows.groupBy(doc).applyInArrow(choose, f"{doc} {rows.schema[doc].dataType.simpleString()}, node long, first long")


def like_itself(headers: Column, alike: float) -> Column:
    """Whether a header list is alike to its own copy; one with many empty texts is not."""
    return header_similarity(headers, headers) > alike
