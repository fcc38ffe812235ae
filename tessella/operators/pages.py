"""Merging of what several readers found on a page: tables, warnings, provenance; the report's appendix.

The structured content of a page (its own text, tables, blocks, flow) is trusted; what a model read from
its pictures is checked against it and marked. Pages have ``page, type, text``; what belongs to them
carries ``page``. Everything is joins and aggregates by page; only like headers are chosen in order, on the linked ones.
Null texts count as empty; a page without any reading is there with none; tables are told apart by ``seq``, which
is unique for a page and source and not negative.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.text import utf16_length
from tessella.operators.alike import header_links, known_nodes, like_itself
from tessella.operators.documents import confidence, unverified_texts
from tessella.operators.facts import fact_conflicts
from tessella.session import shared_checkpoint

# Texts of the report.
ALL_FAILED = "该页面所有分段 VLM 解析失败，已降级为纯 DOM 输出，建议检查 VLM_API_KEY / 网络后重试"
SHORT_CHECKED = "DOM 文字流较短，VLM 结果无法用 DOM 文字逐项核对，建议人工复核"
NOTHING_FOUND = "DOM 文字提取为空，且无 VLM 识别，页面可能无结构化文字内容"
UNVERIFIED_CELLS = "表格中有 %d 个单元格内容未在 DOM 文字中找到，可能为图片识别，建议人工复核"
CONFLICT = "「%s」VLM 识别为 %s%s，DOM 中未出现该值（DOM 记录：%s%s）——以 DOM 为准，请复核"
FAILED_IMAGES = "内嵌图解析失败 %d 张，未产出图内文字，该部分数值未经校验，建议重跑或人工查看截图"
PENDING_NODES = "流程图节点「%s」未在 DOM 文字中找到，可能为 VLM 误识别"
PENDING_CELLS = "表格有 %d 个单元格未在 DOM 中找到，建议复核"
APPENDIX = "附录"
SOURCES_TITLE, PENDING_TITLE, NONE_PENDING = "解析来源与置信度", "待确认项", "无"
APPENDIX_HEAD = ("| 页面 | 类型 | 解析方式 | 分段数 | 表格 | 控件块 | 置信度 | 备注 |", "|---|---|---|---|---|---|---|---|")
TYPE_LABELS = {"flowchart": "流程图", "table": "配置表", "page": "普通页面", "image": "内嵌图"}
NUMERALS = ("一", "二", "三", "四", "五", "六", "七", "八", "九", "十")
#: What is checked on a page of each type: kind of item, characters of its head, least characters.
CHECKS = {"flowchart": ("node", 4, 3), "table": ("cell", 4, 4), "page": ("component", 3, 3)}
SHORT_TEXT = 10
#: Added to no place: trusted tables are numbered this much below the read ones.
LATE = 2**62


def merged_tables(trusted: DataFrame, read: DataFrame, page: str = "page", alike: float = 0.8) -> DataFrame:
    """``page, place, source, title, headers, rows, notes, is_panel``: the trusted tables in order, then
    the read ones whose headers are not more than ``alike`` to those of any table kept before."""
    fields = ["seq", "title", "headers", "rows", "notes", "is_panel"]
    rows = trusted.select(page, F.lit("dom").alias("source"), *fields).unionByName(read.select(page, F.lit("vlm").alias("source"), *fields))
    # A node is a distinct header list of a page and source by its first table; trusted ones come first.
    rows = rows.withColumn("_late", F.col("source") != "dom")
    lists = rows.groupBy(page, "_late", "headers").agg(F.min("seq").cast("long").alias("_first"))
    order = F.when(F.col("_late"), F.col("_first")).otherwise(F.col("_first") - F.lit(LATE))
    heads = lists.withColumn("node", order)
    known = known_nodes(header_links(heads, alike, page).filter("node >= 0"), page).withColumn("_known", F.lit(True))
    judged = heads.join(known, [page, "node"], "left").select(page, "_late", "headers", "_first", F.coalesce("_known", F.lit(False)).alias("_known"))
    same = (F.col(page) == F.col("_page")) & (F.col("_late") == F.col("_l")) & F.col("headers").eqNullSafe(F.col("_h"))
    judged = judged.select(F.col(page).alias("_page"), F.col("_late").alias("_l"), F.col("headers").alias("_h"), "_first", "_known")
    again = (F.col("seq") != F.col("_first")) & like_itself(F.col("headers"), alike)
    kept = rows.join(judged, same).filter(~F.col("_late") | (~F.col("_known") & ~again))
    place = F.row_number().over(Window.partitionBy(page).orderBy("_late", "seq")) - 1
    return kept.withColumn("place", place).select(page, "place", "source", *fields[1:])


def cross_checked(pages: DataFrame, items: DataFrame, page: str = "page") -> DataFrame:
    """``page, n_items, short, unverified``: items (``kind, seq, text``) that the page's text does not confirm.

    Only the kind that belongs to the page's type is checked; on a page whose text is ``short`` nothing is.
    """
    short = utf16_length(F.coalesce("text", F.lit(""))) < SHORT_TEXT
    counts = items.groupBy(page).agg(F.count("*").alias("n_items"))
    found = None
    for kind, (item, head, least) in CHECKS.items():
        of_type = pages.filter((F.col("type") == kind) & ~short).select(page, "text")
        bad = unverified_texts(items.filter(F.col("kind") == item), of_type, page, head, least).select(page, "seq", "text")
        found = bad if found is None else found.unionByName(bad)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda s: s["text"])
    unverified = found.groupBy(page).agg(listed.alias("unverified"))
    joined = pages.select(page, short.alias("short")).join(counts, page, "left").join(unverified, page, "left")
    return joined.select(page, F.coalesce("n_items", F.lit(0)).alias("n_items"), "short", F.coalesce("unverified", F.array().cast("array<string>")).alias("unverified"))


def merged_pages(pages: DataFrame, segments: DataFrame, items: DataFrame, texts: DataFrame, images: DataFrame, tables: DataFrame, page: str = "page") -> DataFrame:
    """A row a page: ``page, type, warnings, unverified, n_segments, has_vision, n_tables, n_panels``.

    ``pages`` also have ``has_structure`` and ``n_screenshots``; ``segments`` (``failed``) are the readings;
    ``texts`` (``seq, text``) hold all that was read, for conflicts of numbers; ``images`` have ``failed``;
    ``tables`` come from :func:`merged_tables`. Warnings: all readings failed, the check against the text,
    conflicts of numbers, failed pictures.
    """
    read = segments.groupBy(page).agg(F.count("*").alias("n_read"), F.count(F.when(F.coalesce("failed", F.lit(False)), 1)).alias("n_failed"))
    pictures = images.groupBy(page).agg(F.count(F.when(F.coalesce("failed", F.lit(False)), 1)).alias("n_bad"))
    shown = tables.groupBy(page).agg(F.count(F.when(~F.coalesce("is_panel", F.lit(False)), 1)).alias("n_tables"), F.count(F.when(F.col("is_panel"), 1)).alias("n_panels"))
    conflicts = fact_conflicts(pages.select(page, "text"), texts.select(page, "seq", "text"), page)
    line = F.format_string(CONFLICT, "key", "value", "unit", "recorded", "unit")
    conflicts = conflicts.groupBy(page).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("w")))), lambda s: s["w"]).alias("conflicts"))
    rows = pages
    for other in (cross_checked(pages, items, page), read, pictures, shown, conflicts):
        rows = rows.join(other, page, "left")
    number = lambda c: F.coalesce(c, F.lit(0))
    all_failed = (number("n_read") > 0) & (F.col("n_read") == F.col("n_failed"))
    n_bad_cells = F.when(F.col("type") == "table", F.size("unverified")).otherwise(0)
    own = F.array(
        F.when(all_failed, F.lit(ALL_FAILED)),
        F.when(F.col("short"), F.when(F.col("n_items") > 0, F.lit(SHORT_CHECKED)).when(~F.col("has_structure"), F.lit(NOTHING_FOUND))).when(n_bad_cells > 0, F.format_string(UNVERIFIED_CELLS, n_bad_cells)),
    )
    last = F.array(F.when(number("n_bad") > 0, F.format_string(FAILED_IMAGES, "n_bad")))
    warnings = F.array_compact(F.concat(own, F.coalesce("conflicts", F.array().cast("array<string>")), last))
    return rows.select(
        page, "type", warnings.alias("warnings"), "unverified", F.when(number("n_screenshots") > 0, F.col("n_screenshots")).otherwise(number("n_read")).cast("long").alias("n_segments"),
        ((number("n_read") > 0) & ~all_failed).alias("has_vision"), number("n_tables").alias("n_tables"), number("n_panels").alias("n_panels"),
    )


def kept_images(images: DataFrame) -> DataFrame:
    """Picture results with any text, summary or error; empty ones go."""
    some = lambda c: F.coalesce(c, F.lit("")) != ""
    return images.filter((F.coalesce(F.size("texts"), F.lit(0)) > 0) | some("summary") | some("error"))


def appendix_lines(pages: DataFrame, doc: str = "doc") -> DataFrame:
    """``doc, part, seq, k, line``: the appendix of each report as ordered lines.

    ``pages`` (``seq, name, type``) have what :func:`tessella.operators.documents.confidence` reads, and
    ``n_segments, unverified``. The appendix's number follows the chapters that are there; its two parts are
    the sources table and the pending items, in the pages' order. A report's headings are a row a report.
    """
    pages = shared_checkpoint(pages)  # six parts of the appendix read them
    rated = confidence(pages)
    label = F.col("type")
    for kind, name in TYPE_LABELS.items():
        label = F.when(F.col("type") == kind, name).otherwise(label)
    cell = lambda c: F.coalesce(c.cast("string"), F.lit("0"))
    row = F.concat(F.lit("| "), F.concat_ws(" | ", F.col("name"), label, F.col("method"), cell(F.col("n_segments")), cell(F.col("n_tables")), cell(F.col("n_blocks")), F.col("confidence"), F.col("remark")), F.lit(" |"))
    rows = rated.select(doc, F.lit(1).alias("part"), "seq", F.lit(0).alias("k"), row.alias("line"))
    unverified = F.coalesce("unverified", F.array().cast("array<string>"))
    nodes = F.when((F.col("type") == "flowchart") & (F.size(unverified) > 0), F.format_string(PENDING_NODES, F.array_join(unverified, "、")))
    cells = F.when((F.col("type") == "table") & (F.size(unverified) > 0), F.format_string(PENDING_CELLS, F.size(unverified)))
    listed = F.array_compact(F.concat(F.coalesce("warnings", F.array().cast("array<string>")), F.array(nodes, cells)))
    pending = rated.select(doc, F.lit(3).alias("part"), "seq", F.posexplode(listed).alias("k", "w"), "name")
    pending = pending.select(doc, "part", "seq", "k", F.concat(F.lit("- ["), "name", F.lit("] "), "w").alias("line"))
    has = pending.select(doc).distinct().withColumn("some", F.lit(True))
    heads = pages.groupBy(doc).agg((F.count_distinct(F.when(F.col("type").isin(*CHECKS), F.col("type"))) + 1).alias("no")).join(has, doc, "left")
    numeral = F.coalesce(F.get(F.array(*[F.lit(n) for n in NUMERALS]), F.col("no").cast("int") - 1), F.col("no").cast("string"))
    titles = [
        (0, 0, F.concat(F.lit("## "), numeral, F.lit(f"、{APPENDIX}"))), (0, 1, F.concat(F.lit("### "), F.col("no").cast("string"), F.lit(f".1 {SOURCES_TITLE}"))),
        (0, 2, F.lit(APPENDIX_HEAD[0])), (0, 3, F.lit(APPENDIX_HEAD[1])), (2, 0, F.concat(F.lit("### "), F.col("no").cast("string"), F.lit(f".2 {PENDING_TITLE}"))),
        (2, 1, F.when(F.col("some").isNull(), F.lit(NONE_PENDING))),
    ]
    made = F.array(*[F.struct(F.lit(part).alias("part"), F.lit(k).alias("k"), line.alias("line")) for part, k, line in titles])
    lines = heads.select(doc, F.explode(made).alias("t")).select(doc, "t.part", F.lit(0).cast("long").alias("seq"), "t.k", "t.line").filter("line IS NOT NULL")
    return lines.unionByName(rows.withColumn("seq", F.col("seq").cast("long"))).unionByName(pending.withColumn("seq", F.col("seq").cast("long")))
