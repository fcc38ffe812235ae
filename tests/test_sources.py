"""Sources, sinks and the task stream on small fixtures."""

import json

import pyarrow as pa
from pyspark.sql import functions as F

from tessella.plans import styles
from tessella.sources import design, html, sheets, sinks, xlsx
from tessella.streaming.resume import resume_stream
from tests.compare import SF


def test_sheet_tokens(spark):
    raw = 'head["B:Orders","C*2","G:zz9","B:Draft","q","B:Price list 3","C*5","B:Orders","C*9","B:never placed"]'
    rows = sheets.sheet_list(spark.createDataFrame([("f", raw), ("empty", None)], "file_id string, raw string")).collect()
    assert sorted((r["index"], r["name"]) for r in rows) == [(2, "Orders"), (5, "Draft"), (5, "Price list 3")]


def test_recorded_ranges(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"start_row": 1, "values": [["h"], ["a"]]}) + "\n" + json.dumps({"start_row": 2, "values": [["b"]]}))
    assert {r["_row"]: r.cells for r in sheets.grid_from_ranges(sheets.read_ranges(spark, str(tmp_path))).collect()} == {1: ["h"], 2: ["a"]} | {2: ["b"]}


def test_workbooks_round_trip(spark, tmp_path):
    rows = [("b", "s[1]", 1, ["x", "", "<&>\u0001"]), ("b", "s[1]", 3, [None, "y"]), ("b", "t", 1, [])]
    listed = xlsx.write_workbooks(spark.createDataFrame(rows, "book string, sheet string, _row bigint, cells array<string>"), f"file://{tmp_path}/o").collect()
    assert [r.n_rows for r in listed] == [3]
    found = xlsx.read_workbooks(spark.read.format("binaryFile").load(listed[0].path)).collect()
    assert sorted((r.sheet, r["_row"], r.cells) for r in found) == [("s_1_", 1, ["x", "", "<&>"]), ("s_1_", 3, ["", "y"]), ("t", 1, [])]


def test_html_elements(spark):
    pages = spark.createDataFrame([(1, "<p>a<b>c</p><img src=x width=40px>d"), (2, None), (3, "")], "page_id int, html string")
    got = [(r.tag, r.text, r.parent, r.width) for r in html.html_elements(pages).orderBy("seq").collect()]
    assert got == [("p", "a", None, None), ("b", "c", 0, None), ("img", None, None, 40.0)]


def test_design_shapes(spark):
    nested = {"artboard": {"frame": {"width": 100, "height": 100}, "layers": [{"name": "Panel", "frame": {"width": 5, "height": 5}, "layers": [{"name": "t", "type": "text", "text": "hi", "frame": {"x": 1, "y": 1, "width": 2, "height": 2}}, {"name": "x 备份", "layers": [{"name": "y"}]}]}]}}
    flat = {"info": [{"id": "0", "name": "Board"}, {"id": "1", "parentID": "0", "name": "Panel", "type": "group"}, {"id": "2", "parentID": "1", "name": "t", "type": "text", "font": {"content": "hi"}, "ddsOriginFrame": {"x": 1, "y": 1, "width": 2, "height": 2}, "opacity": 50}]}
    files = spark.createDataFrame([(1, json.dumps(nested)), (2, json.dumps(flat)), (3, "no json"), (4, None)], "doc int, json string")
    got = sorted((r.doc, r.text, r.parent_path, r.x) for r in design.design_layers(design.design_nodes(files)).collect())
    assert got == [(1, "hi", "Panel", 1), (2, "hi", "Panel", 1)]


def test_a_fill_is_composed_once_a_layer(spark):
    """Neither the filter nor the parts of the expression split a colour's arguments anew."""
    files = spark.createDataFrame([], "doc int, json string")
    plan = design.design_layers(design.design_nodes(files))._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("split(") <= 5


def test_plugin_files_of_odd_shapes():
    rows = lambda info: [(r[2], [a["name"] for a in r[1]]) for r in design.layer_rows(json.dumps({"info": info}))]
    node = lambda i, above=None, **more: {"id": i, "parentID": above, "name": i, **more}
    assert rows([node("a"), node("b", "gone"), node("c", "a"), node("d", "c")]) == [("c", []), ("d", ["c"]), ("b", [])]
    assert rows([node("a", "b"), node("b", "a")]) == [] and rows([]) == [] and rows([None, 3]) == []
    assert rows([node("r"), node("x", "r"), node("x", "x"), node("y", "x")]) == [("x", []), ("x", ["x"]), ("y", ["x"])]
    assert rows([node("r"), node(None, "r"), node(None), node("l", "l")]) == [(None, []), (None, [])]
    odd = dict(fills="x", borders=[None, 1, {"color": "red"}], shadows={}, points=[None, 5], radius="r", font=7, ddsImage="u", image=3, opacity="half", ddsOriginFrame=[1], left="x", type="text")
    assert rows([node("r"), node("o", "r", **odd)]) == [("o", [])]


def test_charsets():
    assert design.decoded("中文".encode("gbk")) == "中文" and design.decoded("é".encode()) == "é" and design.decoded(None) == ""


def test_sinks(spark, tmp_path):
    sinks.write_languages(spark.createDataFrame([("en", "k", "v"), ("zh", "k", "w")], "lang string, key string, text string"), str(tmp_path / "l"))
    assert spark.read.json(str(tmp_path / "l")).count() == 2
    inline, spilled = sinks.split_by_size(spark.createDataFrame([(1, "a"), (2, "b" * 40000)], "doc int, markdown string"))
    assert inline.count() == 1 and spilled.count() == 1
    listed = sinks.write_reports(spark.createDataFrame([(2, "b"), (1, "é"), (3, None)], "doc int, markdown string"), str(tmp_path / "r")).orderBy("doc").collect()
    assert [(r.doc, r.n_bytes) for r in listed] == [(1, 2), (2, 1), (3, 0)] and all(r.file.endswith(".parquet") for r in listed)


def test_stream_works_off_gaps_only(spark, tmp_path):
    source, results = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "key string, n bigint, failed boolean"
    work = lambda t: t.select("key", "n", (F.col("n") % 2 == 1).alias("failed"))
    for rows in ([("a", 0), ("b", 1)], [("a", 0), ("b", 2), ("c", 4)]):
        spark.createDataFrame(rows, "key string, n bigint").write.mode("append").parquet(source)
        resume_stream(spark.readStream.schema("key string, n bigint").parquet(source), work, results, schema, str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.key, r.n) for r in spark.read.parquet(results).collect()) == [("a", 0), ("b", 1), ("b", 2), ("c", 4)]


def test_sheets_fall_back_file_by_file(spark):
    files = [("ok", "Doc", "sheet", '["B:s","C*1"]', None), ("broken", "", None, '["B:s","C*1"]', "HTTP 500"), ("silent", None, "mosheet", "nothing", None), ("text", "T", "newdoc", None, None), (None, "n", "sheet", None, None)]
    cells = [("broken", "a", 1, ["h", "", None, "i"]), ("broken", "a", 2, ["", " "]), ("broken", "a", 3, ["x"]), ("broken", "b", 2, ["y"]), ("ok", "unused", 1, ["z"])]
    found = lambda f, c: sheets.sheets_with_fallback(spark.createDataFrame(f, "file_id string, name string, type string, raw string, list_error string"), spark.createDataFrame(c, "file_id string, sheet string, _row bigint, cells array<string>"))
    got = {(r.file_id, r.name): (r.document, r.source, r.fallback_reason, r.error, r["index"], r.rows, r.cols, r.headers) for r in found(files, cells).collect()}
    assert got == {
        ("ok", "s"): ("Doc", sheets.STREAM, None, None, 1, None, None, None), ("broken", "a"): ("broken", sheets.EXPORT, "HTTP 500", None, None, 1, 2, ["h", "i"]), ("broken", "b"): ("broken", sheets.EXPORT, "HTTP 500", None, None, 1, 0, []),
        ("silent", None): ("silent", sheets.EXPORT, sheets.NO_TOKEN, None, None, None, None, None), ("text", None): ("T", None, None, "no sheets in type newdoc", None, None, None, None),
    }
    assert found([], []).count() == 0


def test_pages_are_walked_as_their_elements_are_asked_for(monkeypatch):
    walked, own = [], html.elements
    monkeypatch.setattr(html, "BATCH", 10)
    monkeypatch.setattr(html, "elements", lambda text: walked.append(text) or own(text))
    pages = pa.RecordBatch.from_pydict({"page_id": list(range(50)), "html": ["<p>a</p>" * 4] * 49 + [None]})
    found = html.element_batches([pages], "page_id")
    first = next(found)
    assert first.num_rows == 10 and len(walked) == 3
    rows = first.to_pylist() + [r for batch in found for r in batch.to_pylist()]
    assert [(r["page_id"], r["seq"]) for r in rows] == [(page, i) for page in range(49) for i in range(4)]


def test_style_files_are_dealt_out(spark):
    files = styles._parts(spark, SF)
    assert files.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert files.count() == spark.read.parquet(f"{SF}/part.parquet").count()
