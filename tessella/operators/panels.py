"""Form panels: fields and contents found in loose widgets, as tables of two columns.

Widgets have ``doc, seq`` (unique in the document), ``x, y, w, h`` and ``lines`` (array of texts; null or empty: none);
those of tables are left out by the caller. A panel is a declared group or a column of at least ``LEAST`` empty
boxes whose lefts agree within ``ALIGNED``; its members are the widgets with text in the group, or whose centre lies
in the window around the column. Panels claim in order, groups first, then columns from the left: a member belongs to
the first panel that claims it, and a panel counts only with ``LEAST`` members and rows left to it.

Only columns whose windows meet can compete, so a document's columns are cut into runs of meeting windows, and one
pass in order over a run's candidate members settles them; its task holds the ids that the run has claimed.
Everything before and after is joins and aggregates.

Defined cases: widgets without a place take no part; of members at one place the one of the smaller ``seq`` comes
first; a group inside a group that counts gets nothing, as the outer one claims all; without boxes or groups
there are no panels; further columns are not read, but names that begin with an underscore are the operator's own.
"""

from __future__ import annotations

from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.text import js_round
from tessella.operators.geometry import banded
from tessella.operators.sequence import anchored_clusters
from tessella.operators.spatial import points_in_boxes
from tessella.session import shared_table

LEAST, ALIGNED, ROW_TOLERANCE = 4, 6, 14
BOX_WIDTHS, BOX_HEIGHTS = (60, 200), (14, 80)
#: How far the window around a column reaches beyond it: left, right, up, down.
LEFT, RIGHT, UP, DOWN = 110, 220, 30, 70
#: Headers of a panel's table.
HEADERS = ("字段", "内容")
FIELD_JOINT = " / "


def _text(lines: Column, between: str) -> Column:
    return F.array_join(F.coalesce(lines, F.array().cast("array<string>")), between)


def input_columns(widgets: DataFrame) -> DataFrame:
    """``doc, col, x0, y0, x1, y1``: the window of each column of empty boxes, ``col`` its first left.

    Of the sorted lefts one opens a column if it lies more than ``ALIGNED`` beyond the left before it; boxes
    beyond ``ALIGNED`` of the column's first belong to none.
    """
    boxes = widgets.filter((_text(F.col("lines"), "") == "") & F.col("w").between(*BOX_WIDTHS) & F.col("h").between(*BOX_HEIGHTS) & F.col("y").isNotNull())
    # A row for each left, so the window by document holds a canvas's distinct positions, not its boxes.
    lefts = boxes.filter("doc IS NOT NULL AND x IS NOT NULL").groupBy("doc", "x").agg(F.count("*").alias("_n"), F.min("y").alias("_y0"), F.max(F.col("x") + F.col("w")).alias("_x1"), F.max(F.col("y") + F.col("h")).alias("_y1"))
    order = Window.partitionBy("doc").orderBy("x")
    prior = F.lag("x").over(order)
    lefts = lefts.withColumn("_opens", F.when(prior.isNull() | (F.col("x") - prior > ALIGNED), F.col("x")))
    lefts = lefts.withColumn("col", F.last("_opens", ignorenulls=True).over(order)).filter(F.col("x") - F.col("col") <= ALIGNED)
    ends = lefts.groupBy("doc", "col").agg(
        F.sum("_n").alias("_n"), (F.min("x") - LEFT).alias("x0"), (F.min("_y0") - UP).alias("y0"), (F.max("_x1") + RIGHT).alias("x1"), (F.max("_y1") + DOWN).alias("y1")
    )
    return ends.filter(F.col("_n") >= LEAST).drop("_n")


def _runs(columns: DataFrame) -> DataFrame:
    """Columns with ``_run``, a number for each stretch of windows that meet: the windows start ``LEFT`` beyond their
    order, so a new run begins where a column's window starts beyond all earlier ones' ends."""
    # A box is at most BOX_WIDTHS[1] wide and ALIGNED off, so a window ends at most this far behind its column's left.
    reach = BOX_WIDTHS[1] + ALIGNED + RIGHT
    order = Window.partitionBy("doc").orderBy("col")
    prior = F.lag("col").over(order)
    apart = columns.withColumn("_apart", F.when(prior.isNull() | (F.col("x0") > prior + reach), 1).otherwise(0))
    return apart.withColumn("_run", F.sum("_apart").over(order)).drop("_apart")


def _claimed(found: pa.Table) -> pa.Table:
    """The rows of a run's candidates that columns claim, in the columns' order."""
    found = found.sort_by([("col", "ascending"), ("y", "ascending")])
    cols, tops, ids = (found.column(name).to_pylist() for name in ("col", "y", "seq"))
    taken: set[int] = set()
    kept: list[int] = []
    for _, places in groupby(range(len(cols)), cols.__getitem__):
        left = [i for i in places if ids[i] not in taken]
        rows, anchor = 0, float("-inf")
        for i in left:
            if tops[i] - anchor > ROW_TOLERANCE:
                rows, anchor = rows + 1, tops[i]
        if len(left) >= LEAST and rows >= LEAST:
            taken.update(ids[i] for i in left)
            kept += left
    return found.take(pa.array(kept, pa.int64())).select(["doc", "col", "seq"])


def panel_members(widgets: DataFrame, groups: DataFrame, columns: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(``doc, group, seq``; ``doc, col, seq``): the members of the group panels and of the column panels.

    ``groups`` (``doc, group, seq``) has a row for each widget below a group. Groups are settled without an
    order: an outer group comes before the ones inside it and has all their members, so members go to their
    outermost group, and where that one is too small, so are those inside. ``columns`` are the :func:`input_columns`, if
    the caller has them. Both results are written as Parquet, as what follows reads them several times and would else
    settle the candidates anew each time.
    """
    texts = widgets.filter(_text(F.col("lines"), "") != "").dropna(subset=["x", "y", "w", "h"]).select("doc", "seq", "x", "y", "w", "h")
    outer = groups.filter(F.col("seq") != F.col("group")).groupBy("doc", "seq").agg(F.min("group").alias("group"))
    grouped = texts.join(outer, ["doc", "seq"]).select("doc", "group", "seq", "y")
    size = grouped.groupBy("doc", "group").agg(F.count("*").alias("_n"), F.size(anchored_clusters(F.array_sort(F.collect_set("y")), ROW_TOLERANCE)).alias("_rows"))
    by_group = grouped.join(size.filter((F.col("_n") >= LEAST) & (F.col("_rows") >= LEAST)), ["doc", "group"]).select("doc", "group", "seq")
    by_group = shared_table(by_group, "panel-groups")
    # A group that is a panel is taken as a whole, also as a widget with text of its own.
    taken = by_group.select("doc", "seq").unionByName(by_group.select("doc", F.col("group").alias("seq"))).distinct()
    free = texts.join(taken, ["doc", "seq"], "left_anti")
    windows = _runs(input_columns(widgets) if columns is None else columns).select(
        F.col("doc").alias("_doc"), "col", "_run", *[F.col(c).cast("double").alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")]
    )
    centres = free.select("doc", "seq", "y", (F.col("x") + F.col("w") / 2).cast("double").alias("_px"), (F.col("y") + F.col("h") / 2).cast("double").alias("_py"))
    candidates = points_in_boxes(centres, windows).select("doc", "_run", "col", "seq", "y")
    kinds = {f.name: f.dataType.simpleString() for f in candidates.schema}
    by_column = candidates.groupBy("doc", "_run").applyInArrow(_claimed, f"doc {kinds['doc']}, col {kinds['col']}, seq {kinds['seq']}")
    return by_group, shared_table(by_column, "panel-columns")


def _tables(members: DataFrame, widgets: DataFrame, frames: DataFrame, key: str) -> DataFrame:
    """The panels of one kind: rows of cells from their members, with their rectangles."""
    items = members.join(widgets.select("doc", "seq", "x", "y", _text(F.col("lines"), "<br>").alias("_t")), ["doc", "seq"])
    entries = F.transform(F.array_sort(F.collect_list(F.struct("y", "x", "seq", "_t"))), lambda e: e["_t"])
    rows = banded(items, ["doc", key], ROW_TOLERANCE, "_band").groupBy("doc", key, "_band").agg(entries.alias("_e"))
    rest = F.array_join(F.slice("_e", 2, F.size("_e")), FIELD_JOINT)
    rows = rows.select("doc", key, "_band", F.when(F.size("_e") > 1, F.array(F.get("_e", 0), rest)).otherwise(F.col("_e")).alias("_row"))
    listed = rows.groupBy("doc", key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_band", "_row"))), lambda r: r["_row"]).alias("rows"))
    whole = lambda c: js_round(F.col(c).cast("double")).cast("long").alias(c)
    return listed.join(frames.select("doc", key, *[whole(c) for c in ("x", "y", "w", "h")]), ["doc", key], "left")


def form_panels(widgets: DataFrame, groups: DataFrame) -> DataFrame:
    """``doc, group, col, x, y, w, h, headers, rows``: each panel as a table of fields and contents.

    ``group`` is a group panel's ``seq``, ``col`` a column panel's left; the other one is null. Members of one reading
    row (tops within ``ROW_TOLERANCE`` of its first) make a row: the first by place is the field, the others are joined
    as its content; a row of one member has a field only. Rectangles are the group's (null without a place)
    or the column's window, in whole pixels.
    """
    columns = shared_table(input_columns(widgets), "panel-windows")
    by_group, by_column = panel_members(widgets, groups, columns)
    windows = columns.select("doc", "col", F.col("x0").alias("x"), F.col("y0").alias("y"), (F.col("x1") - F.col("x0")).alias("w"), (F.col("y1") - F.col("y0")).alias("h"))
    declared = _tables(by_group, widgets, widgets.withColumnRenamed("seq", "group"), "group")
    found = _tables(by_column, widgets, windows, "col")
    headers = F.array(*[F.lit(h) for h in HEADERS]).alias("headers")
    return declared.unionByName(found, allowMissingColumns=True).select("doc", "group", "col", "x", "y", "w", "h", headers, "rows")
