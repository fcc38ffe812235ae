"""Ordered operators that hold on keys of any size.

A plain window puts a whole key into one task. The operators here cut a key's positions into
blocks: a block is worked off on its own, one small row a block carries totals or edge values on to
the next. Positions are numbers; where they repeat within a key, ``ties`` names the columns that order equal
ones. Keys must not be null (rows with a null key or position are dropped, as a join on them would).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of a block in positions.
BLOCK = 100_000


def _blocked(rows: DataFrame, keys: Sequence[str], pos: str, block: int) -> DataFrame:
    known = F.col(pos).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    return rows.filter(known).withColumn("_block", F.floor(F.col(pos) / F.lit(block)))


def running_sum(rows: DataFrame, value: Column, keys: Sequence[str], pos: str, out: str, block: int = BLOCK, ties: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``out``, the sum of ``value`` over a key's rows up to and including this one."""
    keys = list(keys)
    dealt = _blocked(rows.withColumn("_value", value), keys, pos, block)
    totals = dealt.groupBy(*keys, "_block").agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, "_block", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_block").orderBy(pos, *ties).rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return summed.join(carried, [*keys, "_block"]).withColumn(out, F.col("_before") + F.col("_inside")).drop("_block", "_value", "_inside", "_before")


def neighbour(rows: DataFrame, value: Column, keys: Sequence[str], pos: str, out: str, ahead: bool = False, block: int = BLOCK, ties: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``out``, the value of the row before (or ``ahead``) within the key; null at its edge."""
    keys = list(keys)
    dealt = _blocked(rows.withColumn("_value", F.struct(value.alias("v"))), keys, pos, block)
    place = F.struct(pos, *ties)
    edge = F.min_by("_value", place) if ahead else F.max_by("_value", place)
    edges = dealt.groupBy(*keys, "_block").agg(edge.alias("_edge"))
    step = F.lead if ahead else F.lag
    carried = edges.select(*keys, "_block", step("_edge").over(Window.partitionBy(*keys).orderBy("_block")).alias("_other"))
    inside = step("_value").over(Window.partitionBy(*keys, "_block").orderBy(pos, *ties))
    found = dealt.withColumn("_inside", inside).join(carried, [*keys, "_block"])
    return found.withColumn(out, F.coalesce("_inside", "_other")["v"]).drop("_block", "_value", "_inside", "_other")


def filled(rows: DataFrame, value: Column, keys: Sequence[str], pos: str, out: str, backward: bool = False, block: int = BLOCK) -> DataFrame:
    """``rows`` with ``out``, the last non-null value up to this row, or the next one if ``backward``."""
    keys = list(keys)
    dealt = _blocked(rows.withColumn("_value", value), keys, pos, block)
    present = F.when(F.col("_value").isNotNull(), F.col("_value"))
    at = F.when(F.col("_value").isNotNull(), F.col(pos))
    edge = F.min_by(present, at) if backward else F.max_by(present, at)
    edges = dealt.groupBy(*keys, "_block").agg(edge.alias("_edge"))
    blocks, inside = Window.partitionBy(*keys).orderBy("_block"), Window.partitionBy(*keys, "_block").orderBy(pos)
    if backward:
        carried = F.first("_edge", ignorenulls=True).over(blocks.rowsBetween(1, Window.unboundedFollowing))
        within = F.first("_value", ignorenulls=True).over(inside.rowsBetween(0, Window.unboundedFollowing))
    else:
        carried = F.last("_edge", ignorenulls=True).over(blocks.rowsBetween(Window.unboundedPreceding, -1))
        within = F.last("_value", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    found = dealt.withColumn("_inside", within).join(edges.select(*keys, "_block", carried.alias("_other")), [*keys, "_block"])
    return found.withColumn(out, F.coalesce("_inside", "_other")).drop("_block", "_value", "_inside", "_other")


def islands(rows: DataFrame, value: Column, keys: Sequence[str], pos: str, out: str = "island", block: int = BLOCK, ties: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``out``, a number from 1 for each run of adjacent rows of one value."""
    rows = neighbour(rows.withColumn("_same", value), F.col("_same"), keys, pos, "_before_it", block=block, ties=ties)
    change = F.when(F.col("_before_it").eqNullSafe(F.col("_same")) & F.col("_before_it").isNotNull(), 0).otherwise(1)
    return running_sum(rows, change, keys, pos, out, block, ties).drop("_same", "_before_it")


def collapsed(rows: DataFrame, value: str, keys: Sequence[str], pos: str, block: int = BLOCK) -> DataFrame:
    """Adjacent equal values as one row: keys, first position, ``value``, ``times``."""
    runs = islands(rows, F.col(value), keys, pos, "_island", block)
    out = runs.groupBy(*keys, "_island").agg(F.min(pos).alias(f"first_{pos}"), F.first(value).alias(value), F.count("*").alias("times"))
    return out.drop("_island")


def blank_cut(rows: DataFrame, blank: Column, keys: Sequence[str], pos: str, stop: int = 50, block: int = BLOCK) -> DataFrame:
    """Keys with ``cut``: the position of the ``stop``-th blank in a row, where reading ends, or null.

    Positions count from 1 without gaps. Only the filled rows' distances are looked at.
    """
    keys = list(keys)
    ends = rows.groupBy(*keys).agg(F.max(pos).alias("_end"))
    full = rows.filter(~blank).select(*keys, pos)
    gaps = neighbour(full, F.col(pos), keys, pos, "_prior", block=block)
    inner = gaps.filter(F.col(pos) - F.coalesce("_prior", F.lit(0)) > stop).groupBy(*keys).agg(F.min(F.coalesce("_prior", F.lit(0))).alias("_gap"))
    last = full.groupBy(*keys).agg(F.max(pos).alias("_last"))
    found = ends.join(last, keys, "left").join(inner, keys, "left")
    begin = F.coalesce("_gap", F.when(F.col("_end") - F.coalesce("_last", F.lit(0)) >= stop, F.coalesce("_last", F.lit(0))))
    return found.select(*keys, (begin + stop).alias("cut"))


def numbered(rows: DataFrame, key: str, out: str, block: int = BLOCK) -> DataFrame:
    """``rows`` with ``out``, their number from 1 in the order of the unique integer column ``key``."""
    one = rows.withColumn("_all", F.lit(0))
    return running_sum(one, F.lit(1), ["_all"], key, out, block).drop("_all")


def keep_first(rows: DataFrame, keys: Sequence[Column], seq: Sequence[str]) -> DataFrame:
    """Of the rows that agree in ``keys`` the first by ``seq``; pre-aggregated, so hot keys are no matter."""
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    best = F.min_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), F.struct(*seq))
    return rows.groupBy(*named).agg(best.alias("_row")).select("_row.*")


def keep_preferred_last(rows: DataFrame, keys: Sequence[Column], preferred: Column, seq: Sequence[str]) -> DataFrame:
    """Of the rows that agree in ``keys`` the last by ``seq``, but a preferred one if there is any."""
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), F.struct(F.coalesce(preferred, F.lit(False)).alias("_p"), *seq))
    return rows.groupBy(*named).agg(best.alias("_row"), F.count("*").alias("_group")).select("_row.*", F.col("_group").alias("group_size"))


def anchored_clusters(values: Column, tolerance: float) -> Column:
    """Anchors of one-dimensional clusters of an array: a value opens a new cluster if it lies more
    than ``tolerance`` beyond the anchor (not the last member) of the current one. Null: none."""
    grow = lambda out, v: F.when((F.size(out) == 0) | (v - F.element_at(out, -1) > tolerance), F.concat(out, F.array(v))).otherwise(out)
    kind = F.array_sort(values)
    return F.aggregate(kind, F.slice(kind, 1, 0), grow)


def nearest_of(keys: Column, value: Column) -> Column:
    """0-based place of the key nearest to ``value``, the first on ties."""
    return F.array_min(F.transform(keys, lambda k, i: F.struct(F.abs(value - k).alias("d"), i.alias("i"))))["i"]
