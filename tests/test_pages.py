"""Edge cases of the page merge, the canvas and the layer styles: nulls, empty tables, repeated rows, clashing names."""

import json

from pyspark.sql import functions as F

from tessella.operators import canvas, layers, pages, style, tree
from tessella.sources import design

TABLE = "page int, seq int, title string, headers array<string>, rows array<array<string>>, notes string, is_panel boolean, source string, place int, t int"


def table_rows(spark, rows):
    return spark.createDataFrame([(p, s, None, h, None, None, panel, "x", 1, 2) for p, s, h, panel in rows], TABLE)


def test_read_tables_go_where_headers_are_known(spark):
    own = table_rows(spark, [(1, 2, ["b", "c"], None), (1, 1, ["a"], True), (1, 1, ["a"], True)])
    read = table_rows(spark, [(1, 0, ["A "], None), (1, 5, None, None), (1, 6, [], None), (1, 7, ["q", "r"], None), (1, 8, ["q", "R"], None), (2, 1, ["z"], None)])
    got = sorted((r.page, r.place, r.source, r.headers) for r in pages.merged_tables(own, read).collect())
    assert got == [(1, 0, "dom", ["a"]), (1, 1, "dom", ["a"]), (1, 2, "dom", ["b", "c"]), (1, 3, "vlm", None), (1, 4, "vlm", []), (1, 5, "vlm", ["q", "r"]), (2, 0, "vlm", ["z"])]
    assert pages.merged_tables(own.limit(0), read.limit(0)).count() == 0


def test_pages_without_readings(spark):
    page = spark.createDataFrame([(1, None, None, None, None), (2, "page", "a text of some length", True, 3)], "page int, type string, text string, has_structure boolean, n_screenshots int")
    none = lambda schema: spark.createDataFrame([], f"page int, {schema}")
    out = pages.merged_pages(page, none("failed boolean"), none("kind string, seq int, text string"), none("seq int, text string"), none("failed boolean"), none("is_panel boolean"))
    got = {r.page: (r.warnings, r.unverified, r.n_segments, r.has_vision, r.n_tables) for r in out.collect()}
    assert got == {1: ([], [], 0, False, 0), 2: ([], [], 3, False, 0)}
    failed = spark.createDataFrame([(2, True), (2, True)], "page int, failed boolean")
    out = pages.merged_pages(page, failed, none("kind string, seq int, text string"), none("seq int, text string"), failed, none("is_panel boolean"))
    warned = next(r.warnings for r in out.collect() if r.page == 2)
    assert warned == [pages.ALL_FAILED, pages.FAILED_IMAGES % 2]


def test_picture_results_with_anything_stay(spark):
    rows = spark.createDataFrame([(1, [], "", None), (2, ["x"], None, None), (3, None, "s", None), (4, None, None, "e"), (5, None, None, None)], "id int, texts array<string>, summary string, error string")
    assert sorted(r.id for r in pages.kept_images(rows).collect()) == [2, 3, 4]


WIDGET = "doc int, seq int, x double, y double, w double, h double, lines array<string>, n_images int, is_table boolean, anchor int, section int, e int"


def widgets(spark, rows):
    return spark.createDataFrame([(*r, 7, 7, 7) for r in rows], WIDGET)


def test_sections_need_pictures_and_text(spark):
    blocks = widgets(spark, [(1, 1, 10.0, 900.0, 10.0, 10.0, ["b"], 0, None), (1, 2, 10.0, 10.0, 10.0, 10.0, ["a", "z"], None, None), (1, 3, 9000.0, 0.0, 1.0, 1.0, ["far"], 0, None), (1, 4, 0.0, 0.0, 1.0, 1.0, None, 0, None), (1, 5, None, None, None, None, ["lost"], 0, None), (2, 1, 0.0, 0.0, 1.0, 1.0, ["x"], 0, None)])
    shots = widgets(spark, [(1, 10, 0.0, 800.0, 300.0, 300.0, None, 0, None), (1, 11, 0.0, 0.0, 300.0, 300.0, None, 0, None), (1, 12, 0.0, 4000.0, 300.0, 300.0, None, 0, None), (2, 10, 0.0, 0.0, 300.0, 300.0, None, 0, None)])
    found, members = canvas.sections(blocks, shots)
    assert sorted((r.section, r.text) for r in found.collect()) == [(-1, "far"), (0, "a\nz"), (1, "b")]
    assert sorted((r.seq, r.section) for r in members.collect()) == [(1, 1), (2, 0), (3, -1)]
    assert canvas.sections(blocks.limit(0), shots)[0].count() == 0 and canvas.sections(blocks, shots.limit(0))[1].count() == 0


def test_styles_without_values(spark):
    files = spark.createDataFrame([(1, json.dumps({"artboard": {"layers": [{"name": "a", "opacity": 0.25}, {"name": "b", "type": "text", "text": {"value": "t"}}, {"name": "c", "style": {"fills": [{"type": "gradient", "gradient": {"stops": []}}], "borders": [{"color": {}}]}}]}})), (2, None), (3, "[]")], "doc int, json string")
    rows = style.styled_layers(design.design_nodes(files, style=True), layers.layer_type(F.col("kind"))).collect()
    assert [(r.name, r.fill, r.gradient, r.border, r.shadow, r.shown_opacity) for r in sorted(rows, key=lambda r: r.id)] == [("a", None, None, None, None, 0.25), ("b", None, None, None, None, None), ("c", None, None, None, None, None)]
    assert design.collected_slices(design.design_nodes(files)).count() == 0


def test_wanted_pages_name_what_is_missing(spark):
    items = spark.createDataFrame([(1, 0, "a", "a", "e"), (1, 1, "b", "a/b", "e"), (1, 2, "b", "b", "e"), (1, 3, None, None, "e")], "tree int, pos int, name string, path string, error string")
    names = spark.createDataFrame([(1, " a/b "), (1, "a"), (1, "a"), (1, ""), (1, None), (1, "q"), (2, "a")], "tree int, name string")
    got = sorted(((r.tree, r.pos if r.pos is not None else -1, r["name"], r.error is None) for r in tree.wanted_pages(items, names).collect()))
    assert got == [(1, -1, "q", False), (1, 0, "a", True), (1, 1, "b", True), (2, -1, "a", False)]
