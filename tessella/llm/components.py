"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import small, written


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with ``m``, the least of u and its neighbours.

    The least neighbour is a pre-aggregated row per node. It is written before it is joined back, so the
    join has a shuffle of its own, which Spark splits where a node has very many neighbours.
    """
    least = written(edges.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")), "components-least")
    return edges.join(small(least), F.col("u") == F.col("k")).select("u", "v", F.least("u", "m").alias("m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node that has an edge; ``root`` is the least node of its component.

    ``edges`` has two columns of one orderable type. Self-loops and repeated edges are allowed,
    nulls are dropped, no edges give no rows. Each round is written to the shared folder; it ends
    when a round changes nothing, after a number of rounds logarithmic in the component size.
    """
    a, b = edges.columns[:2]
    plain = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    current, mark = written(plain, "components"), None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == mark:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        mark = tuple(state)
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        near = _with_least(large)
        linked = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v")))
        current = written(linked.filter("u <> v").distinct(), "components")
