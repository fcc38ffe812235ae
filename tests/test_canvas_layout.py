"""Tiled joins, form panels and regions against brute force and by hand, edge cases included."""

import math
import random

from pyspark.sql import functions as F

from tessella.operators import canvas, geometry, panels, regions, sequence, spatial

BOX = "doc int, seq long, x double, y double, w double, h double"


def boxes(seed, n, spread, sizes):
    """Boxes of two documents, some on negative places, and ones without a place or document."""
    random.seed(seed)
    rows = [(random.randrange(2), i, random.uniform(-spread, spread), random.uniform(-spread, spread), float(random.choice(sizes)), float(random.choice(sizes))) for i in range(n)]
    return rows + [(None, n, 0.0, 0.0, 9.0, 9.0), (0, n + 1, None, 0.0, 9.0, 9.0)]


def test_points_meet_the_boxes_that_hold_them_once(spark):
    a, b = boxes(1, 150, 3000, [0, 1]), boxes(2, 60, 3000, [0, 40, 700, 9000, 200_000])
    points = spark.createDataFrame(a, BOX).select("doc", F.col("seq").alias("i"), F.col("x").alias("_px"), F.col("y").alias("_py"))
    frames = spatial.framed(spark.createDataFrame(b, BOX).withColumnRenamed("seq", "j"))
    holds = lambda p, q: p[0] is not None and p[0] == q[0] and None not in (p[2], q[2]) and q[2] <= p[2] <= q[2] + q[4] and q[3] <= p[3] <= q[3] + q[5]
    want = sorted((p[1], q[1]) for p in a for q in b if holds(p, q))
    assert sorted((r.i, r.j) for r in spatial.points_in_boxes(points, frames).select("i", "j").collect()) == want and len(want) > 100
    free = {r.i for r in spatial.points_in_no_box(points, frames.filter("w < 9000 AND h < 9000")).collect()}
    assert free == {p[1] for p in a if not any(holds(p, q) for q in b if q[4] < 9000 and q[5] < 9000)} and 0 < len(free) < 152
    assert spatial.points_in_boxes(points, frames.limit(0)).count() == 0


def test_nearest_boxes_of_both_reaches(spark):
    a, b = boxes(3, 120, 900, [0, 30]), boxes(4, 40, 900, [10, 60]) + [(0, 77, 5.0, 5.0, 10.0, 10.0), (0, 76, 5.0, 5.0, 10.0, 10.0)]
    left, right = spark.createDataFrame(a, BOX), spark.createDataFrame(b, BOX)
    for radius in (60, 400):
        want = {}
        for p in a:
            cx, cy = (None, None) if p[2] is None else (p[2] + p[4] / 2, p[3] + p[5] / 2)
            far = [(math.hypot(max(q[2] - cx, 0, cx - q[2] - q[4]), max(q[3] - cy, 0, cy - q[3] - q[5])), q[1]) for q in b if p[0] is not None and p[0] == q[0] and None not in (cx, q[2])]
            best = min(far, default=(math.inf, None))
            want[p[1]] = best[1] if best[0] <= radius else None
        assert {r.seq: r.anchor for r in geometry.nearest_anchor(left, right, radius=radius).collect()} == want


def test_anti_joins_keep_repeated_and_placeless_rows(spark):
    rows = [(1, 1, 0.0, 0.0, 900.0, 900.0), (1, 2, 600.0, 600.0, 10.0, 10.0), (1, 2, 600.0, 600.0, 10.0, 10.0), (1, 3, None, 0.0, 1.0, 1.0), (2, 4, 600.0, 600.0, 10.0, 10.0), (None, 5, 1.0, 1.0, 1.0, 1.0)]
    assert sorted(r.seq for r in geometry.outer_containers(spark.createDataFrame(rows, BOX)).collect()) == [1, 3, 4, 5]


def plain_panels(widgets):
    """Column panels of one document in order, with plain lists."""
    empty = sorted((w for w in widgets if not w[5] and 60 <= w[3] <= 200 and 14 <= w[4] <= 80), key=lambda w: w[1])
    claimed, out = set(), {}
    for i, w in enumerate(empty):
        if i and w[1] - empty[i - 1][1] <= 6:
            continue
        col = [e for e in empty if abs(e[1] - w[1]) <= 6]
        if len(col) < 4:
            continue
        x0, x1 = min(e[1] for e in col) - 110, max(e[1] + e[3] for e in col) + 220
        y0, y1 = min(e[2] for e in col) - 30, max(e[2] + e[4] for e in col) + 70
        members = sorted((m for m in widgets if m[5] and m[0] not in claimed and x0 <= m[1] + m[3] / 2 <= x1 and y0 <= m[2] + m[4] / 2 <= y1), key=lambda m: (m[2], m[1], m[0]))
        rows, at = [], -1e9
        for m in members:
            if m[2] - at > 14:
                rows, at = [*rows, []], m[2]
            rows[-1].append("<br>".join(m[5]))
        if len(members) >= 4 and len(rows) >= 4:
            claimed |= {m[0] for m in members}
            out[w[1]] = [r if len(r) == 1 else [r[0], " / ".join(r[1:])] for r in rows]
    return out


def test_form_panels_claim_in_order(spark):
    random.seed(8)
    found = 0
    schema = "doc int, seq long, x double, y double, w double, h double, lines array<string>, _note string"
    for _ in range(2):
        rows = []
        for i in range(160):
            text = [f"t{i}", "b"] if random.random() < 0.6 else random.choice([None, [], [""]])
            rows.append((i, float(random.choice([0, 3, 5, 8, 200, 204, 430, 1500, 1501])), float(random.randrange(600)), float(random.choice([60, 100, 200, 201])), float(random.choice([13, 14, 40])), text))
        widgets = spark.createDataFrame([(1, *r, "n") for r in rows] + [(None, 900, 0.0, 0.0, 60.0, 20.0, ["x"], "n"), (1, 901, None, 0.0, 60.0, 20.0, ["x"], "n")], schema)
        none = spark.createDataFrame([], "doc int, group long, seq long")
        plain = [(*r[:5], [t for t in r[5] or [] if t]) for r in rows]
        want = plain_panels(plain)
        got = {r.col: r.rows for r in panels.form_panels(widgets, none).collect()}
        assert got == want
        found += len(want)
    assert found > 4
    assert panels.form_panels(widgets.limit(0), none).count() == 0


def test_form_panels_settle_their_candidates_once(spark):
    widgets = spark.createDataFrame([], "doc int, seq long, x double, y double, w double, h double, lines array<string>")
    plan = panels.form_panels(widgets, spark.createDataFrame([], "doc int, group long, seq long"))._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroups" not in plan


def test_groups_come_before_columns_and_outer_before_inner(spark):
    text = [(1, i, 10.0, 40.0 * i, 50.0, 20.0, [f"f{i}"]) for i in range(6)]
    column = [(1, 20 + i, 80.0, 40.0 * i, 100.0, 20.0, None) for i in range(6)]
    frame = [(1, -5, 0.4, 0.5, 300.0, 400.0, None), (1, -4, 0.0, 0.0, 9.0, 9.0, None)]
    widgets = spark.createDataFrame(text + column + frame, "doc int, seq long, x double, y double, w double, h double, lines array<string>")
    groups = spark.createDataFrame([(1, -5, i) for i in range(5)] + [(1, -4, i) for i in range(4)] + [(1, -5, -4)], "doc int, group long, seq long")
    only = panels.form_panels(widgets, groups).collect()
    assert [(r.group, r.col, r.x, r.y, r.headers, r.rows) for r in only] == [(-5, None, 0, 1, ["字段", "内容"], [[f"f{i}"] for i in range(5)])]
    free = panels.form_panels(widgets, groups.limit(0)).collect()
    assert [(r.group, r.col, len(r.rows), r.x, r.w) for r in free] == [(None, 80.0, 6, -30, 430)]


def test_regions_in_reading_order(spark):
    item = "doc int, seq long, x double, y double, w double, h double, lines array<string>, panel array<array<string>>, _held2 int"
    rows = [
        (1, 1, 50.0, 10.0, 10.0, 10.0, ["b", None, "b2"], None, 0), (1, 2, 5.0, 14.0, 10.0, 10.0, ["a", ""], None, 0), (1, 3, 90.0, 20.0, 10.0, 10.0, ["a"], None, 0),
        (1, 4, 5.0, 30.0, 10.0, 10.0, None, [["k", "", "v"], ["m"]], 0), (1, 5, 5.0, 31.0, 10.0, 10.0, ["z"], None, 0), (1, 6, 5.0, 60.0, 10.0, 10.0, ["z"], None, 0),
        (1, 7, 5.0, 90.0, 10.0, 10.0, ["", None], None, 0), (1, 8, 500.0, 500.0, 10.0, 10.0, ["free"], None, 0), (1, 9, None, 500.0, 10.0, 10.0, ["lost"], None, 0),
    ]
    ground = [(1, 100, 0.0, 0.0, 200.0, 200.0), (1, 101, 480.0, 0.0, 200.0, 200.0)]
    got = regions.rendered_regions(spark.createDataFrame([*rows, rows[0]], item), spark.createDataFrame(ground, BOX).withColumns({c: F.col(c).cast("long") for c in "xywh"}))
    lines = [r.line for r in got.orderBy("doc", "part", "group", "line_no").collect()]
    assert lines == [
        regions.CANVAS_TITLE, "##### 内容组 1（x 0~200，y 0~200，界面容器）", "- a ｜ b", "- b2", "- 【表单】k：v ｜ m", "- z ×2", regions.FREE_TITLE, "- free",
    ]
    assert regions.rendered_regions(spark.createDataFrame([], item), spark.createDataFrame([], BOX).withColumns({c: F.col(c).cast("long") for c in "xywh"})).count() == 0


def test_running_sums_over_tied_places_follow_the_ties(spark):
    rows = spark.createDataFrame([(1, 5, i, i) for i in (3, 1, 2)] + [(1, 200_000, 0, 10)], "k int, p int, t int, v int")
    got = {(r.p, r.t): r.s for r in sequence.running_sum(rows, F.col("v"), ["k"], "p", "s", ties=["t"]).collect()}
    assert got == {(5, 1): 1, (5, 2): 3, (5, 3): 6, (200_000, 0): 16}
    prior = {(r.p, r.t): r.b for r in sequence.neighbour(rows, F.col("t"), ["k"], "p", "b", ties=["t"]).collect()}
    assert prior == {(5, 1): None, (5, 2): 1, (5, 3): 2, (200_000, 0): 3}


def test_scattered_texts_have_a_heading(spark):
    pictures = spark.createDataFrame([(1, i, 1000.0 * i, 0.0, 300.0, 300.0) for i in range(3)], BOX)
    blocks = spark.createDataFrame([(1, 10, 0.0, 0.0, 9.0, 9.0, ["near"], 0), (1, 11, 0.0, 5000.0, 9.0, 9.0, ["far"], 0)], BOX + ", lines array<string>, n_images int")
    found, members = canvas.sections(blocks, pictures)
    assert {r.section: (r.heading, r.text) for r in found.collect()} == {0: (None, "near"), -1: (canvas.SCATTERED, "far")}
    assert {r.seq: r.section for r in members.collect()} == {10: 0, 11: -1}
