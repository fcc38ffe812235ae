"""A page's canvas as lines in reading order, by the containers that hold its items.

Items have ``doc, seq, x, y, w, h``, ``lines`` (array of texts) and ``panel`` (rows of cells, null for what is no form
panel). An item belongs to the smallest container that holds its centre; items in none are the free
region. In a region, items by top and left form bands: a band's tops lie within ``BAND`` of its first one's,
and a panel ends the band before it and stands alone. In a band equal items count once, the others stand
side by side by their left; items of several lines are set row by row. Adjacent equal lines become one with its count.

A region is never gathered: panels before an item and runs of equal lines are running sums in blocks, and only a
band is one row's list. The result has a row a line, so a canvas of any length can be written in order.

Defined cases: items without a place or document are left out; null and empty texts are no lines, and an item
with none gives none, yet its container is there; ties in place go by ``seq``; of repeated rows one counts;
without containers all is free; further columns are not carried on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.operators.geometry import banded, smallest_container
from tessella.operators.sequence import islands, running_sum
from tessella.session import shared_checkpoint

BAND = 12
# Texts of the report.
CANVAS_TITLE = "**画布内容**（界面容器按画布位置分组，元素按阅读序排版）："
GROUP_TITLE = "##### 内容组 %d（x %d~%d，y %d~%d，界面容器）"
FREE_TITLE = "**容器外元素**（按阅读序）："
PANEL_MARK, BESIDE, FIELD = "【表单】", " ｜ ", "："
_REGION = ["doc", "_held", "_c"]


def _some(texts: Column) -> Column:
    """The texts that are neither null nor empty."""
    return F.filter(F.coalesce(texts, F.array().cast("array<string>")), lambda t: t.isNotNull() & (t != ""))


def region_lines(items: DataFrame) -> DataFrame:
    """``doc, _held, _c, n, line, times``: the lines of each region in order, adjacent equal ones as one.

    ``items`` have their region's key ``_held, _c`` beside what the module names.
    """
    # Both running sums read their input twice, so what leads to it is cut off first.
    rows = shared_checkpoint(running_sum(items, F.when(F.col("panel").isNotNull(), 1).otherwise(0), _REGION, "y", "_panels", ties=["x", "seq"]))
    shown = rows.filter(F.col("panel").isNull()).withColumn("_t", _some(F.col("lines"))).filter(F.size("_t") > 0)
    keys = [*_REGION, "_panels"]
    once = banded(shown, keys, BAND, "_band").groupBy(*keys, "_band", "_t").agg(F.min(F.struct("y", "x", "seq")).alias("_at"))
    cells = once.select(*keys, "_band", "_at", F.posexplode("_t").alias("_r", "_cell"))
    beside = F.array_sort(F.collect_list(F.struct("_at.x", "_at.y", "_at.seq", "_cell")))
    texts = cells.groupBy(*keys, F.lit(1).alias("_late"), F.col("_band").cast("double").alias("_band"), "_r").agg(F.array_join(F.transform(beside, lambda c: c["_cell"]), BESIDE).alias("line"))
    form = F.array_join(F.transform("panel", lambda row: F.array_join(_some(row), FIELD)), BESIDE)
    forms = rows.filter(F.col("panel").isNotNull()).select(*keys, F.lit(0).alias("_late"), F.lit(0.0).alias("_band"), F.lit(0).alias("_r"), F.concat(F.lit(PANEL_MARK), form).alias("line"))
    runs = islands(shared_checkpoint(texts.unionByName(forms)), F.col("line"), _REGION, "_panels", "n", ties=["_late", "_band", "_r"])
    return runs.groupBy(*_REGION, "n").agg(F.first("line").alias("line"), F.count("*").alias("times"))


def rendered_regions(items: DataFrame, containers: DataFrame) -> DataFrame:
    """``doc, part, group, line_no, line``: the report's lines of each canvas.

    Part 0 is the title, part 1 the containers that hold items, numbered from the top, part 2 the free region;
    line 0 is a region's heading.
    """
    placed = items.dropna(subset=["doc", "x", "y", "w", "h"]).dropDuplicates(["doc", "seq"])
    held = smallest_container(placed, containers, crowded=True)
    keyed = placed.select("doc", "seq", "x", "y", "lines", "panel").join(held, ["doc", "seq"])
    keyed = shared_checkpoint(keyed.withColumns({"_held": F.col("container").isNotNull(), "_c": F.coalesce("container", F.lit(-1))}))
    boxes = containers.select("doc", F.col("seq").alias("_c"), F.lit(True).alias("_held"), *[F.col(c).alias(f"_{c}") for c in ("x", "y", "w", "h")])
    found = keyed.select(*_REGION).distinct().join(boxes, _REGION, "left")
    number = F.row_number().over(Window.partitionBy("doc", "_held").orderBy("_y", "_x", "_c"))
    found = found.withColumn("part", F.when(F.col("_held"), 1).otherwise(2)).withColumn("group", F.when(F.col("_held"), number).otherwise(0))
    title = F.when(F.col("_held"), F.format_string(GROUP_TITLE, "group", "_x", F.col("_x") + F.col("_w"), "_y", F.col("_y") + F.col("_h"))).otherwise(F.lit(FREE_TITLE))
    heads = found.select("doc", "part", "group", F.lit(0).cast("bigint").alias("line_no"), title.alias("line"))
    top = found.select("doc").distinct().select("doc", F.lit(0).alias("part"), F.lit(0).alias("group"), F.lit(0).cast("bigint").alias("line_no"), F.lit(CANVAS_TITLE).alias("line"))
    count = F.when(F.col("times") > 1, F.concat(F.lit(" ×"), F.col("times").cast("string"))).otherwise(F.lit(""))
    lines = region_lines(keyed).join(found.select(*_REGION, "part", "group"), _REGION)
    lines = lines.select("doc", "part", "group", F.col("n").cast("bigint").alias("line_no"), F.concat(F.lit("- "), "line", count).alias("line"))
    return top.unionByName(heads).unionByName(lines)
