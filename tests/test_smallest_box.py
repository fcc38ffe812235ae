"""The smallest box by cut tiles: the same answers as by loops, and few boxes a tile however many lie on a page."""

import random

import pytest
from pyspark.sql import functions as F

from tessella.operators import canvas, spatial

BOX = "doc long, seq long, x double, y double, w double, h double"


def _crowd(n, sizes, seed, step=1.0, spread=600):
    draw = random.Random(seed)
    at = lambda: draw.randrange(int(-spread / 4 / step), int(spread / step)) * step
    return [(draw.randrange(2), i, at(), at(), float(draw.choice(sizes)), float(draw.choice(sizes))) for i in range(n)]


def _least(points, boxes):
    out = {}
    for doc, seq, px, py in points:
        held = [(w * h, s) for d, s, x, y, w, h in boxes if None not in (doc, px, py, d, x, y) and d == doc and x <= px <= x + w and y <= py <= y + h]
        out[doc, seq] = min(held)[1] if held else None
    return out


@pytest.mark.parametrize("crowd, listed, cuts", [(32, 512, 3), (2, 4, 3), (2, 2, 1), (1, 1, 0)])
def test_points_take_the_smallest_box(spark, monkeypatch, crowd, listed, cuts):
    """Uncut, cut and overfull tiles; boxes of all grids; edges, corners of tiles, repeated boxes, missing places and documents."""
    monkeypatch.setattr(spatial, "CROWD", crowd)
    monkeypatch.setattr(spatial, "LISTED", listed)
    monkeypatch.setattr(spatial, "CUTS", cuts)
    boxes = _crowd(250, (0, 20, 128, 131, 300, 700, 2500, 40000, 600_000), 1, 0.5)
    boxes += [(0, 900, None, 1.0, 5.0, 5.0), (None, 901, 0.0, 0.0, 9.0, 9.0), (0, 903, 128.0, 128.0, 128.0, 128.0), (0, 902, 128.0, 128.0, 128.0, 128.0), (1, 904, 0.0, 0.0, -9.0, 5.0)]
    points = [(d, s, x, y) for d, s, x, y, _, _ in _crowd(300, (1,), 2, 0.5)]
    points += [(0, 950, 128.0, 256.0), (0, 951, 256.0, 256.0), (0, 952, -1e9, 0.0), (0, 953, None, 0.0), (None, 954, 1.0, 1.0), (7, 955, 1.0, 1.0)]
    found = spatial.with_smallest_box(spark.createDataFrame(points, "doc long, seq long, _px double, _py double"), spark.createDataFrame(boxes, BOX)).collect()
    assert len(found) == len(points) and {(r["doc"], r["seq"]): r["box"] for r in found} == _least(points, boxes)


def test_without_boxes_or_points(spark):
    points = spark.createDataFrame([(1, 1, 0.0, 0.0)], "doc long, seq long, _px double, _py double")
    boxes = spark.createDataFrame([(1, 5, 0.0, 0.0, 1.0, 1.0)], BOX)
    assert [r["box"] for r in spatial.with_smallest_box(points, boxes.limit(0)).collect()] == [None]
    assert spatial.with_smallest_box(points.limit(0), boxes).count() == 0


def test_boxes_a_point_meets_do_not_grow_with_the_page(spark, monkeypatch):
    """Boxes in steps of 60 on which tiles of 128 are seldom covered whole by the small ones, as on the canvases of canvas_groups."""
    held = []
    plain = spatial._smallest_by_tile

    def watched(boxes, side):
        found = plain(boxes, side)
        held.append(max(tiles.groupBy("_doc", "_tx", "_ty").count().agg(F.expr("percentile(count, 0.9)")).first()[0] for _, tiles, _, _ in found))
        return found

    monkeypatch.setattr(spatial, "_smallest_by_tile", watched)
    meets = []
    for n in (500, 8000):
        rows = spark.createDataFrame(_crowd(n, range(150, 310, 5), 3, 60.0), BOX)
        canvas.grouped_content(rows.withColumns({"x": F.col("x") + F.col("seq") % 7, "y": F.col("y") + F.col("seq") % 7}), rows).count()
        meets.append(held.pop())
    assert meets[1] <= spatial.CROWD and meets[1] <= 2 * meets[0]


def test_an_item_counts_once_and_empties_come_last(spark):
    items = [(1, 1, 10.0, 5.0, 2.0, 2.0), (1, 1, 10.0, 5.0, 2.0, 2.0), (1, 2, 3.0, 5.0, 2.0, 2.0), (1, 3, None, 5.0, 2.0, 2.0), (1, 4, 900.0, 5.0, 2.0, 2.0), (1, None, 1.0, 1.0, 1.0, 1.0)]
    boxes = [(1, 7, 0.0, 0.0, 200.0, 200.0), (1, 6, 0.0, 0.0, 200.0, 200.0), (1, 8, 0.0, 0.0, 300.0, 200.0)]
    found = canvas.grouped_content(spark.createDataFrame(items, BOX), spark.createDataFrame(boxes, BOX)).collect()
    assert sorted((r["container"] or 0, r["place"], r["seq"]) for r in found) == [(0, 0, 4), (0, 1, 3), (6, 0, 2), (6, 1, 1)]
