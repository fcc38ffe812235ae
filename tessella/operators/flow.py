"""Flow-chart operators over segments: node and edge merge, stitching, degrees, Mermaid text.

Nodes have ``doc, seg, seq, node_id, text``, edges ``doc, seg, seq, from_id, to_id, condition``. Ids
hold within a segment; order is (seg, seq).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.text import merge_key

#: The bracket pair of each node type in Mermaid.
SHAPES = {"start": ("([", "])"), "end": ("([", "])"), "process": ("[", "]"), "decision": ("{", "}"), "subflow": ("[[", "]]"), "io": ("[/", "/]")}


def merged_nodes(nodes: DataFrame, doc: str = "doc") -> tuple[DataFrame, DataFrame]:
    """(nodes, ids): nodes of equal normalised text are one, named n1, n2 ... by first appearance;
    ``ids`` maps ``doc, seg, node_id`` to ``merged``."""
    keyed = nodes.withColumn("_key", merge_key(F.col("text")))
    first = keyed.groupBy(doc, "_key").agg(F.min(F.struct("seg", "seq")).alias("at"), F.min_by("text", F.struct("seg", "seq")).alias("text"))
    number = F.row_number().over(Window.partitionBy(doc).orderBy("at"))
    named = first.withColumn("merged", F.concat(F.lit("n"), number.cast("string")))
    ids = keyed.join(named.select(doc, "_key", "merged"), [doc, "_key"]).select(doc, "seg", "seq", "node_id", "merged")
    return named.select(doc, "merged", "text", F.col("at.seg").alias("seg"), F.col("at.seq").alias("seq")), ids


def merged_edges(edges: DataFrame, ids: DataFrame, doc: str = "doc") -> DataFrame:
    """Edges between merged nodes, the first of each (from, to, normalised condition); an end that is
    no node keeps its id."""
    last = ids.groupBy(doc, "seg", "node_id").agg(F.max_by("merged", "seq").alias("merged"))
    end = lambda name: last.select(F.col(doc).alias(f"_{name}_d"), F.col("seg").alias(f"_{name}_s"), F.col("node_id").alias(f"_{name}_n"), F.col("merged").alias(f"_{name}"))
    on = lambda name, col: (F.col(doc) == F.col(f"_{name}_d")) & (F.col("seg") == F.col(f"_{name}_s")) & (F.col(col) == F.col(f"_{name}_n"))
    mapped = edges.join(end("f"), on("f", "from_id"), "left").join(end("t"), on("t", "to_id"), "left")
    mapped = mapped.select(doc, "seg", "seq", F.coalesce("_f", "from_id").alias("from"), F.coalesce("_t", "to_id").alias("to"), F.coalesce("condition", F.lit("")).alias("condition"))
    best = mapped.groupBy(doc, "from", "to", merge_key(F.col("condition")).alias("_c")).agg(F.min(F.struct("seg", "seq", "condition")).alias("b"))
    return best.select(doc, F.col("b.seg").alias("seg"), F.col("b.seq").alias("seq"), "from", "to", F.col("b.condition").alias("condition"))


def stitched_edges(ids: DataFrame, edges: DataFrame, doc: str = "doc") -> DataFrame:
    """Edges from a segment's last node to the next segment's first, unless they are one node or the
    former already has an edge; of several the first stays."""
    ends = ids.groupBy(doc, "seg").agg(F.min_by("merged", "seq").alias("head"), F.max_by("merged", "seq").alias("tail"))
    order = Window.partitionBy(doc).orderBy("seg")
    pairs = ends.select(doc, "seg", F.col("tail").alias("from"), F.lead("head").over(order).alias("to")).filter("to IS NOT NULL AND from <> to")
    open_ends = pairs.join(edges.select(doc, "from").distinct(), [doc, "from"], "left_anti")
    return open_ends.groupBy(doc, "from").agg(F.min(F.struct("seg", "to")).alias("b")).select(doc, F.col("b.seg").alias("seg"), "from", F.col("b.to").alias("to"))


def degrees(nodes: DataFrame, edges: DataFrame, doc: str = "doc") -> DataFrame:
    """``doc, merged, in_degree, out_degree, type``: no way in is a start, no way out an end."""
    ends = edges.select(doc, F.col("from").alias("merged"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(edges.select(doc, F.col("to").alias("merged"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    counts = ends.groupBy(doc, "merged").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))
    out = nodes.select(doc, "merged").join(counts, [doc, "merged"], "left").fillna(0, ["in_degree", "out_degree"])
    kind = F.when(F.col("in_degree") == 0, "start").when(F.col("out_degree") == 0, "end").otherwise("process")
    return out.withColumn("type", kind)


def _node_line(node_id: Column, kind: Column, text: Column) -> Column:
    label = F.replace(F.replace(text, F.lit('"'), F.lit("'")), F.lit("\n"), F.lit(" "))
    out = F.concat(F.lit("["), label, F.lit("]"))
    for name, (left, right) in SHAPES.items():
        out = F.when(kind == name, F.concat(F.lit(left), label, F.lit(right))).otherwise(out)
    return F.concat(F.lit("    "), node_id, out)


def mermaid(nodes: DataFrame, edges: DataFrame, doc: str = "doc") -> DataFrame:
    """``doc, mermaid``: a flow chart's text; nodes (``merged, text, type, seg, seq``) by order, then edges."""
    lines = nodes.select(doc, F.lit(0).alias("part"), "seg", "seq", _node_line(F.col("merged"), F.col("type"), F.col("text")).alias("line"))
    arrow = F.concat(F.lit("    "), "from", F.lit(" -->"), F.when(F.col("condition") != "", F.concat(F.lit("|"), "condition", F.lit("|"))).otherwise(F.lit("")), F.lit(" "), "to")
    lines = lines.unionByName(edges.select(doc, F.lit(1).alias("part"), "seg", "seq", arrow.alias("line")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "seg", "seq", "line"))), lambda s: s["line"]), "\n")
    return lines.groupBy(doc).agg(F.concat(F.lit("```mermaid\nflowchart TD\n"), text, F.lit("\n```")).alias("mermaid"))


def _mapped(rows: DataFrame, column: str, ids: DataFrame, out: str, doc: str) -> DataFrame:
    """``rows`` with ``out``, the merged id of the segment's node in ``column``; an id that is no node keeps itself."""
    last = ids.groupBy(doc, "seg", "node_id").agg(F.max_by("merged", "seq").alias("_m"))
    last = last.select(F.col(doc).alias("_d"), F.col("seg").alias("_s"), F.col("node_id").alias("_n"), "_m")
    joined = rows.join(last, (F.col(doc) == F.col("_d")) & (F.col("seg") == F.col("_s")) & (F.col(column) == F.col("_n")), "left")
    return joined.withColumn(out, F.coalesce("_m", column)).drop("_d", "_s", "_n", "_m")


def merged_main_flow(steps: DataFrame, ids: DataFrame, doc: str = "doc") -> DataFrame:
    """``doc, merged, seg, k``: the nodes of the segments' main flows (``seg, k, node_id``), each where it comes first."""
    mapped = _mapped(steps, "node_id", ids, "merged", doc)
    return mapped.groupBy(doc, "merged").agg(F.min(F.struct("seg", "k")).alias("at")).select(doc, "merged", "at.seg", "at.k")


def merged_branches(branches: DataFrame, ids: DataFrame, doc: str = "doc") -> DataFrame:
    """``doc, node, conditions, targets`` of branches (``seg, seq, node_id, conditions, targets``).

    Branches of one merged node are one; of its conditions, equal ones up to white space, case and
    punctuation count once, with the target of the first; a missing target is empty. A branch
    without conditions is there with none.
    """
    placed = _mapped(branches, "node_id", ids, "node", doc)
    each = placed.select(doc, "seg", "seq", "node", "targets", F.posexplode_outer("conditions").alias("k", "condition"))
    each = each.withColumn("target_id", F.get("targets", F.col("k"))).drop("targets")
    aimed = _mapped(each, "target_id", ids, "target", doc)
    key = merge_key(F.col("condition"))
    first = aimed.filter("condition IS NOT NULL").groupBy(doc, "node", key.alias("_c")).agg(F.min(F.struct("seg", "seq", "k", "condition", F.coalesce("target", F.lit("")).alias("target"))).alias("b"))
    listed = first.groupBy(doc, "node").agg(F.array_sort(F.collect_list("b")).alias("b"))
    nodes = placed.select(doc, "node").distinct().join(listed, [doc, "node"], "left")
    part = lambda c: F.coalesce(F.transform("b", lambda x: x[c]), F.array().cast("array<string>")).alias(f"{c}s")
    return nodes.select(doc, "node", part("condition"), part("target"))


def merged_exceptions(texts: DataFrame, doc: str = "doc") -> DataFrame:
    """``doc, seg, seq, text``: exceptional flows (``seg, seq, text``), equal ones up to normalisation once."""
    first = texts.groupBy(doc, merge_key(F.col("text")).alias("_k")).agg(F.min(F.struct("seg", "seq", "text")).alias("f"))
    return first.select(doc, "f.seg", "f.seq", "f.text")
