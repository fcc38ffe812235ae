"""The smallest container on crowded pages: few boxes a tile, the same results."""

import random

from pyspark.sql import functions as F

from tessella.operators import geometry, spatial

SHAPE = "doc long, seq long, x double, y double, w double, h double"


def _boxes(n, sizes, seed):
    draw = random.Random(seed)
    return [(draw.randrange(2), i, draw.randrange(-300, 900) / 2, draw.randrange(-300, 900) / 2, float(draw.choice(sizes)), float(draw.choice(sizes))) for i in range(n)]


def test_crowded_pages_give_the_same_containers(spark):
    made = _boxes(300, (20, 128, 256, 300, 700, 2500, 40000), 1)
    boxes = spark.createDataFrame(made + [(0, 900, None, 1.0, 5.0, 5.0), (None, 901, 0.0, 0.0, 9.0, 9.0), (0, 902, 128.0, 128.0, 128.0, 128.0), (0, 903, 128.0, 128.0, 128.0, 128.0)], SHAPE)
    items = _boxes(400, (0, 2, 10), 2) + [(0, 950, 128.0, 256.0, 0.0, 0.0), (0, 951, None, 0.0, 1.0, 1.0)]
    found = {(r["doc"], r["seq"]): r["container"] for r in geometry.smallest_container(spark.createDataFrame(items, SHAPE), boxes, crowded=True).collect()}
    rects = [tuple(r) for r in boxes.collect() if None not in tuple(r)]
    for doc, seq, x, y, w, h in items:
        held = [(bw * bh, s) for d, s, bx, by, bw, bh in rects if x is not None and d == doc and bx <= x + w / 2 <= bx + bw and by <= y + h / 2 <= by + bh]
        assert found.pop((doc, seq)) == (min(held)[1] if held else None)
    assert not found


def test_pairs_do_not_grow_with_the_square_of_a_crowded_page(spark):
    def pairs(n):
        rows = spark.createDataFrame(_boxes(n, (200, 250, 300), 3), SHAPE)
        points = rows.select("doc", "seq", F.col("x").alias("_px"), F.col("y").alias("_py"))
        frame = spatial.framed(rows.select("doc", F.col("seq").alias("c_seq"), "x", "y", "w", "h"))
        return spatial.least_boxes(points, frame, F.struct(F.col("w") * F.col("h"), "c_seq")).count(), spatial.points_in_boxes(points, frame).count()

    (few, all_few), (many, all_many) = pairs(200), pairs(1600)
    assert all_many > 30 * all_few and many < 16 * few and many < all_many / 5


def test_points_in_a_picture_do_not_look_around(spark, monkeypatch):
    looked = []
    plain = spatial.points_in_boxes

    def counted(points, boxes, doc="doc", condition=None):
        looked.append(points.count())
        return plain(points, boxes, doc, condition)

    monkeypatch.setattr(spatial, "points_in_boxes", counted)
    boxes = _boxes(60, (250, 300), 4)
    items = _boxes(300, (2, 10), 5) + [(0, 900, 5000.0, 5000.0, 2.0, 2.0), (1, 901, 1100.0, 0.0, 2.0, 2.0)]
    near = geometry.nearest_anchor(spark.createDataFrame(items, SHAPE), spark.createDataFrame(boxes, SHAPE), radius=400).collect()
    found = {(r["doc"], r["seq"]): (r["anchor"], r["distance"]) for r in near}
    outside = 0
    for doc, seq, x, y, w, h in items:
        px, py = x + w / 2, y + h / 2
        ways = sorted((max(bx - px, 0, px - bx - bw) ** 2 + max(by - py, 0, py - by - bh) ** 2, s) for d, s, bx, by, bw, bh in boxes if d == doc)
        outside += ways[0][0] > 0
        far = ways[0][0] > 400**2
        assert found[doc, seq] == ((None, None) if far else (ways[0][1], ways[0][0] ** 0.5))
    assert len(found) == len(items) and looked[0] == outside < len(items) / 2


def test_pages_without_huge_boxes_are_shuffled_once(spark):
    rows = spark.createDataFrame(_boxes(50, (20, 300), 6), SHAPE)
    huge = spark.createDataFrame(_boxes(50, (20, 40000), 6), SHAPE)
    joins = lambda df: geometry.outer_containers(df)._jdf.queryExecution().optimizedPlan().toString().count("LeftAnti")
    assert joins(rows) == 1 and joins(huge) == 2
    kept = lambda df: {(r["doc"], r["seq"]) for r in geometry.outer_containers(df).collect()}
    inside = lambda o, i: o[0] == i[0] and o[4] * o[5] > i[4] * i[5] and o[2] - 2 <= i[2] and o[3] - 2 <= i[3] and o[2] + o[4] + 2 >= i[2] + i[4] and o[3] + o[5] + 2 >= i[3] + i[5]
    for df in (rows, huge):
        made = [tuple(r) for r in df.collect()]
        assert kept(df) == {(i[0], i[1]) for i in made if not any(inside(o, i) for o in made)}


def test_cells_of_a_long_page_are_held_as_bits(spark):
    """More cells than a number has bits, each once, and an aggregate by words of cells instead of single ones."""
    from tessella.operators.geometry import needed_cells

    pages = spark.createDataFrame([(1, 150, 20_000, 150, 200)], "doc int, content_w long, content_h long, view_w long, view_h long")
    rects = spark.createDataFrame([(1, 0, y, 10, h) for y, h in ((0, 20_000), (0, 50), (5_950, 100), (19_990, 5))], "doc int, x long, y long, w long, h long")
    found = needed_cells(rects, pages)
    assert sorted(r.cell for r in found.collect()) == list(range(199)) and found.schema["cell"].dataType.simpleString() == "int"
    assert "bit_or" in found._jdf.queryExecution().optimizedPlan().toString()
