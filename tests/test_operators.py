"""Fixtures with known results, and the edge cases of single operators."""

import pytest
from pyspark.sql import functions as F

from tessella.functions import color, similarity, text
from tessella.operators import cache, documents, facts, flow, geometry, i18n, layers, sequence, sheet, tables, tree


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def grid(spark, rows):
    return spark.createDataFrame([(i + 1, r) for i, r in enumerate(rows)], "_row bigint, cells array<string>")


def test_text_follows_javascript(spark):
    lit = F.lit
    assert one(spark, text.trimmed(lit("﻿　 a  "))) == "a"
    assert one(spark, text.utf16_length(lit("😀a"))) == 3
    assert one(spark, text.utf16_head(lit("😀"))) == 55357
    assert one(spark, text.js_round(lit(-2.5))) == -2
    assert [one(spark, text.column_letters(lit(i))) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
    assert one(spark, text.markdown_cell(lit(" a|b\nc "))) == "a\\|b<br>c"
    assert one(spark, text.xml_unescaped(text.xml_escaped(lit("<a&\"\x01>")))) == '<a&">'
    assert [one(spark, text.byte_size(lit(n))) for n in (5, 2048, 3 * 2**20)] == ["5 B", "2.0 KB", "3.0 MB"]
    assert [one(spark, text.cell_text(lit(v).cast("string"))) for v in (None, "null", '{"text":"t"}', "12", '"s"')] == ["", "", "t", "12", "s"]


def test_colors(spark):
    c = lambda v, a: one(spark, color.composed_color(F.lit(v), F.lit(a)))
    assert c("rgba(255, 0, 16,1)", 1.0) == "#ff0010"
    assert c("#abc", 0.5) == "rgba(170,187,204,0.5)"
    assert c("rgb(100%,50%,0%)", 0.25) == "rgba(255,127,0,0.25)"
    assert c("red", 0.5) == "red"
    alpha = one(spark, color.effective_alpha(F.lit(0.2), F.lit(1.0), F.lit(0.2)))
    assert alpha == pytest.approx(0.2)


def test_similarity(spark):
    s = lambda a, b: one(spark, similarity.text_similarity(F.lit(a), F.lit(b)))
    assert (s("abc", "bcd"), s("Ab ", "ab"), s("ab", "abc"), s("", "a")) == (0.5, 1.0, 0.8, 0.0)


def test_sheet_headers_limits_and_blanks(spark):
    g = grid(spark, [["A", "", "a"], ["1", "", "x"], ["", " ", None], ["2", "9", "y"]])
    assert [tuple(r) for r in sheet.flat_rows(sheet.read_sheet(g, limit=0)).collect()] == [(2, "1", None, "x"), (4, "2", "9", "y")]
    assert sheet.read_sheet(g, columns=["a"]).indexes == [0, 2]
    assert sheet.read_sheet(g, limit=2).totals.first().truncated and not sheet.read_sheet(g, limit=3).totals.first().truncated
    with pytest.raises(ValueError, match="1.A"):
        sheet.read_sheet(g, columns=["none"])
    blank = sheet.read_sheet(grid(spark, [["", ""], ["1", ""]]))
    assert blank.synthesised and blank.headers == ["Col1", "Col2"]
    assert sheet.read_sheet(grid(spark, [])).rows.count() == 0


def test_fifty_blank_rows_end_a_sheet(spark):
    rows = [["h"], ["a"], *[[""]] * 49, ["b"], *[[None]] * 50, ["lost"]]
    assert [r.Col for r in sheet.flat_rows(sheet.read_sheet(grid(spark, rows), limit=0)).select(F.col("h").alias("Col")).collect()] == ["a", "b"]


def test_ordered_operators_do_not_depend_on_blocks(spark):
    rows = spark.range(500).selectExpr("id % 3 AS k", "id AS pos", "CASE WHEN id % 7 < 3 THEN id END AS v", "id % 11 < 5 AS f")
    for block in (1, 7, 100, 10_000):
        got = sequence.filled(rows, F.col("v"), ["k"], "pos", "o", backward=True, block=block)
        assert got.agg(F.sum("o"), F.count("o")).first() == sequence.filled(rows, F.col("v"), ["k"], "pos", "o", backward=True).agg(F.sum("o"), F.count("o")).first()
        runs = sequence.islands(rows, F.col("f"), ["k"], "pos", block=block)
        assert runs.agg(F.sum("island")).first() == sequence.islands(rows, F.col("f"), ["k"], "pos").agg(F.sum("island")).first()


def test_anchored_clusters_keep_their_anchor(spark):
    values = F.array(*[F.lit(v) for v in (9, 0, 2, 4, 5)])
    assert one(spark, sequence.anchored_clusters(values, 3)) == [0, 4, 9]


def test_translations(spark):
    heads = ["key", "中文", "英文", "印尼语"]
    rows = spark.createDataFrame([(2, "k", "好", "good\n\nday", ""), (3, "", "组", "", ""), (4, "", "坏", "bad", "buruk")], "_row int, key string, `中文` string, `英文` string, `印尼语` string")
    out = i18n.export_translations(rows, heads, key_column="key")
    assert {tuple(r) for r in out.entries.collect()} == {("zh", "k", "好"), ("en", "k_0", "good"), ("en", "k_1", "day"), ("in", "k_0", "good"), ("in", "k_1", "day"), ("zh", "txt_row_4", "坏"), ("en", "txt_row_4", "bad"), ("in", "txt_row_4", "buruk")}
    assert out.skipped.count() == 1
    assert [(r.row, r.langs) for r in out.missing.collect()] == [(2, ["in"])]
    with pytest.raises(ValueError):
        i18n.parse_rules([{"match": "x", "lang": "en", "type": "odd"}])


def test_numeric_conflicts(spark):
    dom = spark.createDataFrame([(1, "初级场 20积分 初级场+3积分 高级场 50积分")], "doc int, text string")
    model = spark.createDataFrame([(1, 1, "初级场 +2积分 高级场 50积分"), (1, 2, "初级场9积分")], "doc int, seq int, text string")
    assert [(r.key, r.value, r.known) for r in facts.fact_conflicts(dom, model).collect()] == [("初级场", "2", "20,3")]


def test_title_inference(spark):
    tables_ = spark.createDataFrame([("d", 1, 100, 500, 500, 300), ("d", 2, 100, 1500, 500, 200)], "doc string, seq int, x int, y int, w int, h int")
    blocks = spark.createDataFrame([("d", i, x, y, 300, 24, t) for i, (x, y, t) in enumerate([(120, 440, "title"), (120, 830, "below"), (120, 1440, "second"), (2000, 100, "far"), (120, 600, "inside")])], "doc string, seq int, x int, y int, w int, h int, text string")
    assert {r.seq: r.title for r in geometry.inferred_titles(tables_, blocks).collect()} == {1: "title", 2: "second"}


def test_scroll_points(spark):
    assert one(spark, geometry.scroll_points(F.lit(500), F.lit(300))) == [0, 200]
    assert one(spark, geometry.scroll_points(F.lit(100), F.lit(300))) == [0]


def test_similar_tables_merge_in_order(spark):
    rows = [(1, 1, "t", ["a", "b"], [["1", "2"], ["1", "2"]]), (1, 2, "T ", ["x"], [["1", "2"], ["3", "4"]]), (1, 3, "u", ["q"], [["5"]])]
    got = tables.similar_merged(spark.createDataFrame(rows, "doc int, seq int, title string, headers array<string>, rows array<array<string>>"))
    assert {r.seq: len(r.rows) for r in got.collect()} == {1: 3, 3: 1}


def test_trees(spark):
    nodes = spark.createDataFrame([(str(i), str(i - 1), f"n{i}") for i in range(20)], "id string, parent string, name string")
    assert tree.tree_paths(nodes).filter("id = '19'").first().depth == 20
    circle = spark.createDataFrame([("a", "b", ""), ("b", "a", "")], "id string, parent string, name string")
    with pytest.raises(ValueError):
        tree.ancestors(circle, 8)


def test_flow_stitch_needs_a_loose_end(spark):
    nodes = spark.createDataFrame([(1, s, q, str(q), t) for s, q, t in [(0, 0, "A"), (0, 1, "B"), (1, 0, "C"), (1, 1, " b"), (2, 0, "D")]], "doc int, seg int, seq int, node_id string, text string")
    edges = spark.createDataFrame([(1, 0, 0, "0", "1", None), (1, 1, 0, "0", "1", None)], "doc int, seg int, seq int, from_id string, to_id string, condition string")
    merged, ids = flow.merged_nodes(nodes)
    joined = flow.merged_edges(edges, ids)
    assert merged.count() == 4 and {(r["from"], r["to"]) for r in joined.collect()} == {("n1", "n2"), ("n3", "n2")}
    assert [(r["from"], r["to"]) for r in flow.stitched_edges(ids, joined).collect()] == [("n2", "n3")]


def test_tool_noise(spark):
    noise = lambda t: one(spark, documents.is_tool_text(F.lit(t)))
    assert [noise(t) for t in ("3/6", "默认比例", "Axure 页", "2026.01.02 活动", "有效期 2026/01/02 至 2026/02/03", "")] == [True, True, True, False, False, False]


def test_failed_results_stay_open(spark):
    tasks = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "key string, n int")
    done = spark.createDataFrame([("a", True), ("b", False)], "key string, failed boolean")
    assert sorted(tuple(r) for r in cache.open_tasks(tasks, done).collect()) == [("a", 1), ("c", 4)]


def test_empty_layers(spark):
    schema = "doc int, seq int, name string, type string, x int, y int, w int, h int, fill string, parent_path string, is_slice boolean, image_url string, text string, canvas_w int, canvas_h int"
    kept, counters = layers.clean_layers(spark.createDataFrame([], schema))
    assert kept.count() == 0 and counters.count() == 0


def test_colors_of_every_syntax(spark):
    short = lambda v: one(spark, color.short_color(F.lit(v)))
    assert [short(v) for v in ("rgba(1, 2,  255,1)", "rgb(1,2,3)", "rgba(1,2,3,1.0)", "rgba(1 ,2,3,1)", " rgba(0,0,0,1) ", "rgba(999,0,0,1)", "#abc", "", None)] == [
        "#0102ff", "rgb(1,2,3)", "rgba(1,2,3,1.0)", "rgba(1 ,2,3,1)", "#000000", "#3e70000", "#abc", "", None]
    half = lambda v: one(spark, color.composed_color(F.lit(v).cast("string"), F.lit(0.5)))
    assert [half(v) for v in ("rgba(1,2,3,.9)", "rgb(100%, 0.5%,200%)", "#AbCdEf", "#12345", "rgb(1,2)", "rgb(1%,2,3)", "hsl(1,2%,3%)", None)] == [
        "rgba(1,2,3,0.5)", "rgba(255,1,255,0.5)", "rgba(171,205,239,0.5)", "#12345", "rgb(1,2)", "rgb(1%,2,3)", "hsl(1,2%,3%)", None]
    solid = lambda v: one(spark, color.is_opaque_solid(F.lit(v).cast("string")))
    assert [solid(v) for v in ("#abcdef", "#abc", "rgba(1,2,3,1)", "rgba(1,2,3,0.5)", None)] == [True, False, True, False, False]


def test_adjacent_tables_need_headers_source_and_title(spark):
    rows = [
        (1, ["h"], "A", "dom", "n1"), (2, ["h"], None, "dom", ""), (3, ["h"], "A", "dom", "n2"), (4, ["h"], "B", "dom", None), (5, ["h"], "", "vlm", None), (6, ["h"], "C", "vlm", None),
        (7, [], "", "vlm", None), (8, [], "", "vlm", None), (9, ["h"], "", None, None), (10, ["h"], "", None, None), (None, ["h"], "", None, None),
    ]
    t = spark.createDataFrame([(1, p, h, [[str(p)]], x, s, n) for p, h, x, s, n in rows], "doc int, pos int, headers array<string>, rows array<array<string>>, title string, source string, notes string")
    got = [(r.pos, [c for row in r.rows for c in row], r.title, r.notes) for r in tables.adjacent_merged(t, ["doc"]).orderBy("pos").collect()]
    assert got == [(1, ["1", "2", "3"], "A", "n1；n2"), (4, ["4"], "B", ""), (5, ["5"], "", ""), (6, ["6"], "C", ""), (7, ["7"], "", ""), (8, ["8"], "", ""), (9, ["9", "10"], "", "")]


def test_sheet_names_are_legal(spark):
    name = lambda v: one(spark, text.safe_sheet_name(F.lit(v).cast("string")))
    assert [name(v) for v in (" a/b ", "", None, "[x]", "y" * 40, "😀" * 20)] == ["a_b", "sheet", "sheet", "_x_", "y" * 31, "😀" * 15]
