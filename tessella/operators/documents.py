"""Page text operators: types, noise and safety rules, line cleaning, label counts, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import js_round, merge_key, squashed, trimmed, utf16_length

# Words that decide a page's type.
FLOW_NAMES = "流程|flow|流转|架构|状态图|时序|泳道"
STRONG_FLOW = "流程图|状态图|状态机|时序图|泳道"
WEAK_FLOW = "流程|流转|flow"
TABLE_NAMES = "奖励|配置|规则|参数|列表|权限|字典|枚举|价格|套餐"
TABLE_WORDS = "等级|奖励|配置项|参数值"

# Texts that belong to a design tool's own interface.
TOOL_RULES = {
    "product": "(?i)axure|figma|墨刀|mockplus|axshare|sketch",
    "prototype": "原型(播放器|查看器|工具|分页|文档)|设计工具|文档工具",
    "zoom": "(默认|显示|缩放)比例|缩放(下拉|选项)",
    "paging": "翻页|上翻|下翻",
    "thumbnail": "缩略图|画板总览",
    "viewer": "查看器|播放器|分页控件|文档工具栏|设计工具(栏|条)|原型工具(栏|条)",
}
PAGE_NUMBER = r"[0-9]+\s*/\s*[0-9]+"

# What makes an SVG unsafe.
SVG_RULES = {
    "dtd": r"(?i)<!\s*(?:DOCTYPE|ENTITY)|<\?xml-stylesheet",
    "active": r"(?i)<\s*(script|foreignObject|iframe|object|embed|audio|video|animate|animateMotion|animateTransform|set)\b",
    "event": r"(?i)\son[a-z]+\s*=",
    "style": r"(?i)@import|expression\s*\(|javascript\s*:",
}
HREF = r"""(?i)(?:xlink:)?href\s*=\s*["']([^"']*)"""
PAINT = r"""(?i)url\s*\(\s*['"]?([^)'"]+)"""
HTML_START = r"(?is)^\s*(<!doctype html|<html)"

NOTE_TYPES = "(?i)(水滴形|线段|Vertical line|占位符|便签)"
SHORT_LABEL = 12


def page_type(name: Column, text: Column, strong: str = STRONG_FLOW, weak: str = WEAK_FLOW, table_words: str = TABLE_WORDS) -> Column:
    """flowchart, table or page, by the name, the head of the text and its tables; words are parameters."""
    name, text = F.lower(F.coalesce(name, F.lit(""))), F.lower(F.coalesce(text, F.lit("")))
    head = F.substring(text, 1, 300)
    hits = F.size(F.array_distinct(F.regexp_extract_all(head, F.lit(f"({weak})"), F.lit(1))))
    table = name.rlike(TABLE_NAMES) | text.rlike(r"\|.*\|.*\|") | F.substring(text, 1, 1000).rlike(table_words)
    return F.when(name.rlike(FLOW_NAMES) | head.rlike(strong) | (hits >= 2), "flowchart").when(table, "table").otherwise("page")


def tool_flags(text: Column) -> dict[str, Column]:
    """A column for each rule of tool-interface noise; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    flags = {name: t.rlike(rule) for name, rule in TOOL_RULES.items()}
    flags["page_number"] = t.rlike(PAGE_NUMBER) & ((utf16_length(t) <= 12) | t.contains("页"))
    return flags


def is_tool_text(text: Column) -> Column:
    """Whether any rule of tool-interface noise holds."""
    out = F.lit(False)
    for flag in tool_flags(text).values():
        out = out | flag
    return out


def without_tool_texts(texts: Column) -> Column:
    """An array of texts without tool-interface noise; null stays null."""
    return F.filter(texts, lambda t: ~is_tool_text(t))


def svg_flags(text: Column) -> dict[str, Column]:
    """A column for each reason to refuse an SVG, and counts of outside references."""
    outside = lambda pattern: F.size(F.filter(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda v: ~F.trim(v).startswith("#")))
    flags = {name: text.rlike(rule) for name, rule in SVG_RULES.items()}
    return flags | {"html": text.rlike(HTML_START), "outside_refs": outside(HREF), "outside_paints": outside(PAINT)}


def is_unsafe_svg(text: Column) -> Column:
    """Whether an SVG must be refused; a page that poses as one as well."""
    flags = svg_flags(text)
    refs = (flags.pop("outside_refs") > 0) | (flags.pop("outside_paints") > 0)
    for flag in flags.values():
        refs = refs | flag
    return refs


def text_lines(docs: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """``keys, line_no, line``: the trimmed, non-blank lines of a text."""
    lines = docs.select(*keys, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    return lines.withColumn("line", trimmed(F.col("line"))).filter("line <> ''")


def cleaned_lines(pages: DataFrame, page: str = "page", text: str = "text", corpus: str = "corpus") -> DataFrame:
    """``page, line_no, line, verdict`` of a page's lines: symbols, repeated, covered or kept.

    In this order a line goes if it has no word character, if an equal one (white space aside) came
    before, or if the page's structured content (``corpus``) holds it; one-character lines are never
    covered.
    """
    parts = F.split(F.col(text), "\n")
    body = squashed(F.coalesce(F.col(corpus), F.lit("")))
    lines = pages.select(page, body.alias("_body"), F.posexplode(parts).alias("line_no", "line"))
    lines = lines.withColumn("line", trimmed(F.col("line"))).filter("line <> ''").withColumn("_key", squashed(F.col("line")))
    covered = (F.length("_key") >= 2) & (F.col("_body") != "") & F.col("_body").contains(F.col("_key"))
    lines = lines.select(page, "line_no", "line", "_key", covered.alias("_covered"), F.col("line").rlike(r"^[^A-Za-z0-9_\x{4e00}-\x{9fa5}]+$").alias("_symbols"))
    first = lines.filter("NOT _symbols").groupBy(page, "_key").agg(F.min("line_no").alias("_first"))
    joined = lines.join(first, [page, "_key"], "left")
    verdict = F.when(F.col("_symbols"), "symbols").when(F.col("line_no") > F.col("_first"), "repeated").when(F.col("_covered"), "covered").otherwise("kept")
    return joined.select(page, "line_no", "line", verdict.alias("verdict"))


def block_counts(blocks: DataFrame, page: str = "page") -> DataFrame:
    """``page, kind, text, type, n, first_seq`` of text blocks (``seq, type, lines``).

    A block is a note by its type, a label if it is one line of at most twelve characters, else a
    rule; equal ones are counted with the type of the first. Notes of digits only are dropped.
    """
    one = F.size("lines") == 1
    kind = F.when(F.col("type").rlike(NOTE_TYPES), "note").when(one & (utf16_length(F.element_at("lines", 1)) <= SHORT_LABEL), "label").otherwise("rule")
    text = F.when(F.col("_kind") == "note", F.array_join("lines", " ")).otherwise(F.array_join("lines", "\n"))
    keyed = blocks.filter(F.size("lines") > 0).withColumn("_kind", kind).withColumn("_text", text)
    counts = keyed.groupBy(page, F.col("_kind").alias("kind"), F.col("_text").alias("text")).agg(F.min_by("type", "seq").alias("type"), F.count("*").alias("n"), F.min("seq").alias("first_seq"))
    return counts.filter(~((F.col("kind") == "note") & trimmed(F.col("text")).rlike("^[0-9]+$")))


def image_sizes(images: DataFrame, page: str = "page") -> DataFrame:
    """``page, n_images, sizes``: sizes as ``w×h`` in order of appearance, with ``×n`` where repeated."""
    one = F.concat(F.col("width").cast("string"), F.lit("×"), F.col("height").cast("string"))
    sizes = images.groupBy(page, one.alias("size")).agg(F.count("*").alias("n"), F.min("seq").alias("seq"))
    text = F.concat("size", F.when(F.col("n") > 1, F.concat(F.lit("×"), F.col("n").cast("string"))).otherwise(F.lit("")))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", text.alias("t")))), lambda s: s["t"]), "、")
    return sizes.groupBy(page).agg(F.sum("n").alias("n_images"), listed.alias("sizes"))


def unverified_texts(items: DataFrame, pages: DataFrame, page: str = "page", head: int = 4, least: int = 3) -> DataFrame:
    """Items (``text``) whose normalised head does not occur in the page's normalised text.

    Items of fewer than ``least`` normalised characters pass; so do those of pages without text.
    """
    key = merge_key(F.col("text"))
    body = pages.select(page, merge_key(F.col("text")).alias("_body")).filter("_body <> ''")
    joined = items.withColumn("_key", key).join(body, page)
    return joined.filter((utf16_length(F.col("_key")) >= least) & ~F.col("_body").contains(F.substring("_key", 1, head))).drop("_key", "_body")


def needs_vision(pages: DataFrame) -> Column:
    """Whether a page (``n_widgets, n_blocks, n_tables, has_flow, type, text``) needs its screenshots
    read: it has widgets, and too little structure or a flow chart without a graph."""
    rich = (F.col("n_blocks") > 0) | (F.col("n_tables") > 0) | (utf16_length(trimmed(F.coalesce("text", F.lit("")))) >= 50)
    return (F.col("n_widgets") > 0) & (~rich | ((F.col("type") == "flowchart") & ~F.col("has_flow")))


def confidence(pages: DataFrame) -> DataFrame:
    """``pages`` with ``method, confidence, remark`` as the report's appendix states them.

    Reads ``n_blocks, n_tables, has_flow, n_image_results, has_vision, warnings`` (array).
    """
    some = F.array_compact(F.array(
        F.when(F.col("n_blocks") > 0, "DOM结构化"), F.when(F.col("has_flow"), "DOM拓扑"), F.when(F.col("n_image_results") > 0, "内嵌图解析"), F.when(F.col("has_vision"), "VLM"),
    ))
    method = F.when(F.size(some) > 0, F.array_join(some, "+")).otherwise(F.lit("仅DOM"))
    structured = (F.col("n_blocks") > 0) | (F.col("n_tables") > 0)
    warned = F.coalesce(F.size("warnings") > 0, F.lit(False))
    level = F.when(warned, "待复核").when(F.col("has_flow"), "高").when(F.col("has_vision") & structured, "中高").when(structured, "中").otherwise("低")
    remark = (
        F.when(warned, F.array_join("warnings", "; "))
        .when(F.col("has_flow"), "流程图拓扑由 DOM 连接线还原")
        .when(F.col("has_vision") & structured, "")
        .when(structured, "仅 DOM 确定性提取（内容已充分，VLM 按策略跳过或未配置）")
        .otherwise("无有效提取结果")
    )
    return pages.withColumns({"method": method, "confidence": level, "remark": remark})


CHAPTERS = [("flowchart", "流程说明"), ("page", "页面详情"), ("table", "配置与表格")]
NUMERALS = "一二三四五六七八九十"


def rendered_document(sections: DataFrame, doc: str = "doc", chapters: Sequence[tuple[str, str]] = CHAPTERS) -> DataFrame:
    """``doc, markdown``: sections (``type, seq, title, body``) as numbered chapters by type.

    Only chapters with sections are there; numbers follow, and section numbers carry their
    chapter's. Sections join in order; a document's report is one text.
    """
    order = F.lit(None).cast("int")
    heading = F.lit("")
    for i, (kind, name) in enumerate(chapters):
        order = F.when(F.col("type") == kind, i).otherwise(order)
        heading = F.when(F.col("_order") == i, name).otherwise(heading)
    rows = sections.withColumn("_order", order).filter(F.col("_order").isNotNull())
    grouped = rows.groupBy(doc, "_order").agg(F.array_sort(F.collect_list(F.struct("seq", "title", "body"))).alias("s"))
    listed = grouped.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("_order", heading.alias("name"), "s"))).alias("c"))
    numeral = lambda i: F.substring(F.lit(NUMERALS), i + 1, F.lit(1))
    section = lambda i: lambda s, j: F.concat(F.lit("### "), (i + 1).cast("string"), F.lit("."), (j + 1).cast("string"), F.lit(" "), s["title"], F.lit("\n\n"), s["body"])
    chapter = lambda c, i: F.concat(F.lit("## "), numeral(i), F.lit("、"), c["name"], F.lit("\n\n"), F.array_join(F.transform(c["s"], section(i)), "\n\n"))
    return listed.select(doc, F.array_join(F.transform("c", chapter), "\n\n").alias("markdown"))


def joined_segments(segments: DataFrame, doc: str = "doc") -> DataFrame:
    """``doc, summary, layout`` of segment results (``seg, summary, layout, failed``): summaries joined
    by a space, layouts by line with their number; failed segments are left out."""
    good = segments.filter(~F.coalesce("failed", F.lit(False)))
    s = F.array_sort(F.collect_list(F.struct("seg", F.coalesce("summary", F.lit("")).alias("summary"), F.coalesce("layout", F.lit("")).alias("layout"))))
    gathered = good.groupBy(doc).agg(s.alias("s"))
    some = lambda c, render: F.filter(F.transform("s", lambda x: F.when(x[c] != "", render(x))), lambda t: t.isNotNull())
    label = lambda x: F.concat(F.lit("[第"), (x["seg"] + 1).cast("string"), F.lit("段] "), x["layout"])
    return gathered.select(doc, F.array_join(some("summary", lambda x: x["summary"]), " ").alias("summary"), F.array_join(some("layout", label), "\n").alias("layout"))


def content_images(images: DataFrame) -> DataFrame:
    """Images of at least 40 by 40 with ``is_content``: 120 by 120 or more and no connector part."""
    size = (F.col("width") >= 40) & (F.col("height") >= 40)
    content = (F.col("width") >= 120) & (F.col("height") >= 120) & ~F.coalesce(F.col("src").rlike(r"_seg\d+\.svg$"), F.lit(False))
    return images.filter(size).withColumn("is_content", content).withColumns({"width": js_round(F.col("width")), "height": js_round(F.col("height"))})
