"""Tiled joins of points and rectangles, so that a page's widgets meet their neighbours only.

A rectangle is posted to the tiles it touches, in the fine grid, or in the coarse one if it spans more than
``SPAN`` fine tiles. A point looks up its one tile in each grid. The join is on (document, tile): no
document gives all pairs, and a page with very many widgets is spread over as many keys as it has tiles.

Defined cases: points and rectangles without a document or a place meet nothing; repeated rows meet as often as they are
there; empty sides give no pairs; columns other than the underscored ones of this module are passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.session import shared_table

#: Sides of the tiles of the fine and the coarse grid, and fine tiles that a rectangle of the fine grid spans at most.
SIDES, SPAN = (512.0, 32768.0), 16.0
#: Sides for crowded pages, where boxes should often cover a tile whole.
NARROW = (128.0, 2048.0, 32768.0)
#: Sides of the first tiles of :func:`with_smallest_box`, the boxes a tile holds uncut, boxes of a tile in one row, the parts a
#: side is cut into, cuts at most, and rows of boxes a partition up to which they are hashed.
FIRST, CROWD, LISTED, PARTS, CUTS, HASHED = tuple(128.0 * 16**k for k in range(7)), 32, 512, 4, 3, 200_000
_TILE, _SIDES, _ORDER = ["_doc", "_tx", "_ty"], ["_x0", "_y0", "_x1", "_y1"], ["_area", "_seq"]


def framed(boxes: DataFrame, doc: str = "doc", grow: float = 0.0, x: str = "x", y: str = "y", w: str = "w", h: str = "h") -> DataFrame:
    """``boxes`` with their bounds ``_x0, _y0, _x1, _y1``, grown by ``grow`` to all sides, and ``_doc`` for the key."""
    at = lambda c: F.col(c).cast("double")
    sides = {"_x0": at(x) - grow, "_y0": at(y) - grow, "_x1": at(x) + at(w) + grow, "_y1": at(y) + at(h) + grow}
    return boxes.withColumns(sides).withColumnRenamed(doc, "_doc")


def _key(grid: int, tx: Column, ty: Column) -> Column:
    """A tile as one number: its grid by 2 bits, and its column and row by 31 bits each."""
    low = lambda t: t.bitwiseAND(F.lit(2**31 - 1))
    return F.shiftleft(low(tx), 33).bitwiseOR(F.shiftleft(low(ty), 2)).bitwiseOR(F.lit(grid))


def _in_grid(boxes: DataFrame, grid: int) -> DataFrame:
    """A row (``_tile``) for each tile that a framed box of the grid touches."""
    longer = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"))
    fine = longer <= SPAN * SIDES[0]
    at = lambda c: F.floor(F.col(c) / SIDES[grid])
    span = lambda lo, hi: F.sequence(at(lo), F.greatest(at(hi), at(lo)))
    tiles = F.flatten(F.transform(span("_x0", "_x1"), lambda tx: F.transform(span("_y0", "_y1"), lambda ty: _key(grid, tx, ty))))
    return boxes.filter(F.col("_doc").isNotNull() & (~fine if grid else fine)).withColumn("_tile", F.explode(tiles))


def _point_tile(grid: int) -> Column:
    return _key(grid, F.floor(F.col("_px") / SIDES[grid]), F.floor(F.col("_py") / SIDES[grid]))


def _met(doc: str, condition: Column | None) -> Column:
    inside = F.col("_px").between(F.col("_x0"), F.col("_x1")) & F.col("_py").between(F.col("_y0"), F.col("_y1"))
    return (F.col(doc) == F.col("_doc")) & inside & (F.lit(True) if condition is None else condition)


def points_in_boxes(points: DataFrame, boxes: DataFrame, doc: str = "doc", condition: Column | None = None) -> DataFrame:
    """Pairs of a point (``_px, _py``) and a framed box of its document that holds it, edges included.

    A pair meets in one tile only, the point's in the box's grid, so none comes twice. ``condition`` is a further
    condition on a pair.
    """
    looked = points.withColumn("_at", F.explode(F.array(*[_point_tile(grid) for grid in range(len(SIDES))])))
    posted = _in_grid(boxes, 0).unionByName(_in_grid(boxes, 1))
    return looked.join(posted, (F.col("_at") == F.col("_tile")) & _met(doc, condition)).drop("_at", "_tile", "_doc")


def least_boxes(points: DataFrame, boxes: DataFrame, order: Column, doc: str = "doc") -> DataFrame:
    """Pairs as :func:`points_in_boxes` gives them, with ``_order``, less such as cannot be a point's least by ``order``.

    Where a box covers a tile whole, it holds all of the tile's points, so boxes beyond the least of those are left
    out there. A crowded page thus keeps a few boxes a tile, however many lie on one another.
    """
    longer = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"))
    posted, looked = None, []
    for grid, side in enumerate(NARROW):
        at = lambda c: F.floor(F.col(c) / side)  # noqa: B023, E731
        span = lambda lo, hi: F.sequence(at(lo), F.greatest(at(hi), at(lo)))  # noqa: B023, E731
        whole = lambda t, lo, hi: (F.col(lo) <= t * side) & ((t + 1) * side <= F.col(hi))  # noqa: B023, E731
        tile = lambda tx, ty: F.struct(_key(grid, tx, ty).alias("tile"), (whole(tx, "_x0", "_x1") & whole(ty, "_y0", "_y1")).alias("whole"))  # noqa: B023, E731
        fits = F.col("_doc").isNotNull() & (longer > SPAN * NARROW[grid - 1] if grid else F.lit(True)) & (longer <= SPAN * side if grid + 1 < len(NARROW) else F.lit(True))
        tiles = F.flatten(F.transform(span("_x0", "_x1"), lambda tx: F.transform(span("_y0", "_y1"), lambda ty: tile(tx, ty))))  # noqa: B023
        rows = boxes.withColumn("_order", order).filter(fits).withColumn("_at_tile", F.explode(tiles)).withColumns({"_tile": F.col("_at_tile.tile"), "_whole": F.col("_at_tile.whole")}).drop("_at_tile")
        posted = rows if posted is None else posted.unionByName(rows)
        looked.append(_key(grid, F.floor(F.col("_px") / side), F.floor(F.col("_py") / side)))
    least = posted.filter("_whole").groupBy("_doc", "_tile").agg(F.min("_order").alias("_least"))
    kept = posted.join(least, ["_doc", "_tile"], "left").filter(F.col("_least").isNull() | (F.col("_order") <= F.col("_least"))).drop("_least", "_whole")
    seen = points.withColumn("_at", F.explode(F.array(*looked)))
    return seen.join(kept, (F.col("_at") == F.col("_tile")) & _met(doc, None)).drop("_at", "_tile", "_doc")


def _tiled(rows: DataFrame, side: float, cut: bool, whole: bool = False) -> DataFrame:
    """A row (``_tx, _ty``) for each tile of a side that a box touches, or covers whole; of boxes dealt to tiles ``PARTS``
    times as wide before (``cut``), those within their tile."""
    for tile, lo, hi in (("_tx", "_x0", "_x1"), ("_ty", "_y0", "_y1")):
        first, last = F.floor(F.col(lo) / side), F.floor(F.col(hi) / side)
        if whole:
            first, last = F.ceil(F.col(lo) / side), last - 1
        if cut:
            first, last = F.greatest(first, F.col(tile) * PARTS), F.least(last, F.col(tile) * PARTS + (PARTS - 1))
        rows = rows.filter(first <= last).withColumn(tile, F.explode(F.sequence(first, last)))
    return rows


def _smallest_by_tile(boxes: DataFrame, side: float) -> list[tuple[float, DataFrame, int, bool]]:
    """(side, boxes by tile, their rows, whether a tile has more than ``LISTED``) for tiles of falling sides.

    Boxes are clipped to their tile. Those beyond the smallest that covers it whole are left out, and of those that look
    alike in the tile the smallest stays. Tiles of more than ``CROWD`` are cut, and the others with them where they hold fewer
    boxes; later cuts are for tiles of more than ``LISTED``. Tiles of two sides never overlap.
    """
    found, rows = [], boxes
    for cut in range(CUTS + 1):
        least = shared_table(_tiled(rows, side, cut > 0, whole=True).groupBy(*_TILE).agg(F.min("_area").alias("_least")), "least")
        near = _tiled(rows, side, cut > 0).join(least, _TILE, "left").filter(F.col("_least").isNull() | (F.col("_area") <= F.col("_least"))).drop("_least")
        for tile, lo, hi in (("_tx", "_x0", "_x1"), ("_ty", "_y0", "_y1")):
            near = near.withColumns({lo: F.greatest(F.col(lo), F.col(tile) * side), hi: F.least(F.col(hi), (F.col(tile) + 1) * side)})
        alike = F.lag(F.struct(*_SIDES)).over(Window.partitionBy(*_TILE).orderBy(*_SIDES, *_ORDER)) == F.struct(*_SIDES)
        rows = shared_table(near.withColumn("_alike", alike).filter(~F.coalesce("_alike", F.lit(False))).drop("_alike"), "tiles")
        sizes, most = rows.groupBy(*_TILE).agg(F.count("*").alias("_n")), LISTED if cut else CROWD
        held = lambda crowded: F.coalesce(F.sum(F.when(crowded, F.col("_n"))), F.lit(0))
        many, few, longest = sizes.agg(held(F.col("_n") > most), held(F.col("_n") <= most), F.coalesce(F.max("_n"), F.lit(0))).first()
        if not many or cut == CUTS:
            return [*found, (side, rows, many + few, longest > LISTED)]
        if few > many:
            crowded = sizes.filter(F.col("_n") > most).select(*_TILE)
            found.append((side, rows.join(crowded, _TILE, "left_anti"), few, False))
            rows = rows.join(crowded, _TILE, "left_semi")
        side /= PARTS
    return found


def with_smallest_box(points: DataFrame, boxes: DataFrame, doc: str = "doc") -> DataFrame:
    """``points`` (``_px, _py``) with ``box``: the ``seq`` of the smallest box (``seq, x, y, w, h``) that holds the point, edges
    included, the least ``seq`` on ties; null where there is none. A point keeps its row, repeated ones may become one.

    Boxes are dealt to tiles, and a tile keeps those up to the smallest that covers it whole. Where many are left, it is
    cut into finer tiles, which more boxes cover whole: so a tile keeps a few boxes, however many lie on one another, and a
    point meets its tile's one row of them. Only tiles that stay crowded after the last cut, as by edges that lie in one
    spot, meet the points that their first ``LISTED`` boxes do not hold pair by pair.
    """
    once = boxes.groupBy(doc, "x", "y", "w", "h").agg(F.min("seq").alias("_seq")).withColumn("_area", F.col("w") * F.col("h"))
    sized = framed(once, doc).select("_doc", *_SIDES, *_ORDER).filter("_doc IS NOT NULL AND _x0 <= _x1 AND _y0 <= _y1")
    longer = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"))
    grid = sum((longer > SPAN * side).cast("int") for side in FIRST[:-1])
    sized = shared_table(sized.withColumn("_grid", grid), "boxes")
    names, partitions = points.columns, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    inside = lambda b: F.col("_px").between(b("_x0"), b("_x1")) & F.col("_py").between(b("_y0"), b("_y1"))
    points = points.withColumn("_best", F.lit(None).cast(sized.select(F.struct(*_ORDER).alias("b")).schema["b"].dataType))
    for g in sorted(r["_grid"] for r in sized.select("_grid").distinct().collect()):
        for side, tiles, n, crowded in _smallest_by_tile(sized.filter(F.col("_grid") == g).drop("_grid"), FIRST[g]):
            if crowded:
                tiles = tiles.withColumn("_n", F.row_number().over(Window.partitionBy(*_TILE).orderBy(*_ORDER)))
            listed = tiles.filter(F.col("_n") <= LISTED) if crowded else tiles
            lists = listed.groupBy(*_TILE).agg(F.array_sort(F.collect_list(F.struct(*_ORDER, *_SIDES))).alias("_boxes"))
            at = (F.col(doc) == F.col("_doc")) & (F.floor(F.col("_px") / side) == F.col("_tx")) & (F.floor(F.col("_py") / side) == F.col("_ty"))
            first = F.get(F.filter("_boxes", lambda e: inside(lambda c: e[c])), F.lit(0))
            met = points.join(lists.hint("shuffle_hash") if n <= HASHED * partitions else lists, at, "left").withColumn("_first", first)
            found = F.when(F.col("_first").isNotNull(), F.struct("_first._area", "_first._seq"))
            met = met.select(*names, F.least("_best", found).alias("_best"), (F.col("_first").isNull() & (F.size("_boxes") == LISTED)).alias("_rest"))
            if not crowded:
                points = met.drop("_rest")
                continue
            met = shared_table(met, "met")
            pairs = met.filter("_rest").join(tiles.filter(F.col("_n") > LISTED), at & inside(F.col), "left")
            late = pairs.groupBy(*names, "_best").agg(F.min(F.when(F.col("_doc").isNotNull(), F.struct(*_ORDER))).alias("_late"))
            points = met.filter("_rest IS NOT TRUE").drop("_rest").unionByName(late.select(*names, F.least("_best", "_late").alias("_best")))
    return points.select(*names, F.col("_best._seq").alias("box"))


def points_in_no_box(points: DataFrame, boxes: DataFrame, doc: str = "doc", condition: Column | None = None) -> DataFrame:
    """The points that :func:`points_in_boxes` finds in no box: an anti join for each grid, so points stay one row.

    Few pages have boxes in the coarse grid; where none has, the points are not shuffled for it.
    """
    for grid in range(len(SIDES)):
        if grid and _in_grid(boxes, grid).isEmpty():
            continue
        points = points.withColumn("_at", _point_tile(grid)).join(_in_grid(boxes, grid), (F.col("_at") == F.col("_tile")) & _met(doc, condition), "left_anti").drop("_at")
    return points


def distance_to_box(px: Column, py: Column) -> Column:
    """Distance of a point to a pair's box (``_bx, _by, _bw, _bh``); 0 inside."""
    dx = F.greatest(F.col("_bx") - px, F.lit(0.0), px - (F.col("_bx") + F.col("_bw")))
    dy = F.greatest(F.col("_by") - py, F.lit(0.0), py - (F.col("_by") + F.col("_bh")))
    return F.sqrt(dx * dx + dy * dy)


def nearest_boxes(points: DataFrame, boxes: DataFrame, radius: float, keys: list[str], doc: str = "doc") -> DataFrame:
    """``points``' document and keys with ``best`` (``d, seq``): the nearest box (``seq, x, y, w, h``) within ``radius``, the
    least ``seq`` on ties; null where there is none. One row for each document and keys.

    Where the radius is wide, points that lie in a box are settled first, by the least ``seq`` of those that hold them
    (:func:`least_boxes`); then a quarter of the radius is looked at, and only points that have no box there look further.
    So a crowded page does not compare all that lies within the radius.
    """
    named = boxes.select(doc, F.col("seq").alias("_bseq"), *[F.col(c).cast("double").alias(f"_b{c}") for c in ("x", "y", "w", "h")])
    done, rest = None, points.select(doc, *keys, "_px", "_py")
    for reach in (0.0, radius / 4, radius) if radius > SIDES[0] / 4 else (radius,):
        if reach:
            frame = framed(named, doc, reach * (1 + 1e-9) + 1e-6, "_bx", "_by", "_bw", "_bh")
            pairs = points_in_boxes(rest, frame, doc).withColumn("_d", distance_to_box(F.col("_px"), F.col("_py"))).filter(F.col("_d") <= reach)
        else:
            pairs = least_boxes(rest, framed(named, doc, 0.0, "_bx", "_by", "_bw", "_bh"), F.col("_bseq"), doc).withColumn("_d", F.lit(0.0))
        found = pairs.select(doc, *keys, "_px", "_py", F.struct(F.col("_d").alias("d"), F.col("_bseq").alias("seq")).alias("best"))
        empty = rest.withColumn("best", F.lit(None).cast(found.schema["best"].dataType))
        best = found.unionByName(empty).groupBy(doc, *keys, "_px", "_py").agg(F.min("best").alias("best"))
        if radius > SIDES[0] / 4:  # each reach reads it twice
            best = shared_table(best, "nearest")
        done = best if done is None else done.filter(F.col("best").isNotNull()).unionByName(best)
        rest = best.filter(F.col("best").isNull()).drop("best")
    return done.select(doc, *keys, "best")
