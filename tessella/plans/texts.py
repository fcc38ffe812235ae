"""Queries of the text, fact, similarity and report operators."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import color, similarity, urls
from tessella.functions import text as T
from tessella.operators import documents, facts, sequence
from tessella.plans.common import SEQ, sql_merge_key, sql_squash, sql_text_similarity, sql_trim, table
from tessella.sources import html

# Words of the input's own languages, given as parameters beside the built-in ones.
_STRONG, _WEAK, _TABLE = "license|copyright", "the|der|que|los", "password|secret"


def page_type_classify(spark, sf_dir):
    """Type of every document."""
    docs = table(spark, sf_dir, "documents")
    kind = documents.page_type(F.col("source"), F.col("text"), f"{documents.STRONG_FLOW}|{_STRONG}", f"{documents.WEAK_FLOW}|{_WEAK}", f"{documents.TABLE_WORDS}|{_TABLE}")
    return docs.select("doc_id", kind.alias("type"))


def noise_filter(spark, sf_dir):
    """Rules of tool noise on every document line."""
    lines = documents.text_lines(table(spark, sf_dir, "documents"), ["doc_id"]).select("doc_id", "line_no", "line")
    flags = documents.tool_flags(F.col("line"))
    flagged = lines.select("doc_id", "line_no", *[v.alias(k) for k, v in flags.items()])
    return flagged.withColumn("noise", reduce(or_, map(F.col, flags)))  # each rule is matched once a line


def svg_html_safety(spark, sf_dir):
    """Reasons to refuse each page as an image."""
    flags = documents.svg_flags(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", *[v.alias(k) for k, v in flags.items()], documents.is_unsafe_svg(F.col("html")).alias("unsafe"))


FACT_TEXT = "regexp_replace(p_brand, '#', '') || '场 +' || p_size || CASE WHEN p_partkey % 3 = 0 THEN '积分' ELSE '个' END || ', x' || p_type || ': ' || (p_partkey % 4) || '.5K'"


def _fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr("p_size AS doc", "p_partkey AS seq", f"{FACT_TEXT} AS text")


def num_facts(spark, sf_dir):
    """Facts of texts built from parts."""
    return facts.numeric_facts(_fact_rows(spark, sf_dir), ["doc", "seq"])


def num_conflicts(spark, sf_dir):
    """Conflicts between even and odd parts of a size."""
    rows = _fact_rows(spark, sf_dir)
    return facts.fact_conflicts(rows.filter("seq % 2 = 0"), rows.filter("seq % 2 = 1"))


def char_jaccard(spark, sf_dir):
    """Similarity of each part's name and type, and of brand and type."""
    sim = lambda a, b: F.round(similarity.text_similarity(F.col(a), F.col(b)), 9)
    return table(spark, sf_dir, "part").select("p_partkey", sim("p_name", "p_type").alias("name_type"), sim("p_brand", "p_type").alias("brand_type"))


def header_similarity(spark, sf_dir):
    """Similarity of the header lists of a region's nations."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    a = n.select(F.col("n_nationkey").alias("a"), F.col("n_regionkey").alias("k"), F.array("n_name", "r_name", F.reverse("n_name")).alias("ah"))
    b = n.select(F.col("n_nationkey").alias("b"), F.col("n_regionkey").alias("k"), F.array("r_name", "r_name", F.upper("n_name")).alias("bh"))
    pairs = a.join(b, "k").filter("a < b")
    return pairs.select("a", "b", F.round(similarity.header_similarity(F.col("ah"), F.col("bh")), 9).alias("similarity"))


def label_rule_counts(spark, sf_dir):
    """Lines of each source counted as labels and rules."""
    lines = documents.text_lines(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang"])
    blocks = lines.select(F.col("source").alias("page"), (F.col("doc_id") * 1_000_000 + F.col("line_no")).alias("seq"), F.col("lang").alias("type"), F.array("line").alias("lines"))
    return documents.block_counts(blocks)


def _conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = lambda who: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == who, F.struct("turn", "text")))), lambda s: s["text"]), "\n")
    return table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("page")).agg(said("user").alias("text"), said("assistant").alias("corpus"))


def dom_text_clean(spark, sf_dir):
    """What becomes of the user's lines given the assistant's."""
    return documents.cleaned_lines(_conversation_pages(spark, sf_dir))


def prefix_crossvalidate(spark, sf_dir):
    """Assistant turns whose head the user never said."""
    pages = _conversation_pages(spark, sf_dir).select("page", "text")
    items = table(spark, sf_dir, "conversations").filter("role = 'assistant'").select(F.col("conv_id").alias("page"), "turn", "text")
    return documents.unverified_texts(items, pages).select("page", "turn")


def dedup_keep_last(spark, sf_dir):
    """One of equal texts: the last, but a German one if there is any."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2(_key("text"), 256).alias("key"))
    return sequence.keep_preferred_last(docs, [F.col("key")], F.col("lang") == "de", ["doc_id"]).select("doc_id", "lang", "group_size")


def _key(column: str):
    from tessella.functions.text import merge_key

    return merge_key(F.col(column))


def dedup_keep_first(spark, sf_dir):
    """The first page of each host."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", urls.host(F.col("url")).alias("host"))
    return sequence.keep_first(pages, [F.col("host")], ["page_id"])


def page_rollup(spark, sf_dir):
    """Method, confidence and remark of documents as their labels and lines give them."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    pages = docs.select(
        "doc_id", F.size(F.split("text", "\n")).alias("n_lines"), F.when(F.col("text").contains("|"), 1).otherwise(0).alias("n_tables"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("has_flow"), F.when(F.col("lang") == "es", 1).otherwise(0).alias("n_image_results"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("has_vision"), F.when(F.col("n_chars") > 10000, F.array(F.lit("long"), F.lit("split"))).otherwise(F.array().cast("array<string>")).alias("warnings"),
    ).withColumn("n_blocks", F.when(F.col("n_lines") > 3, F.col("n_lines")).otherwise(0))
    return documents.confidence(pages).select("doc_id", "method", "confidence", "remark")


def vision_need(spark, sf_dir):
    """Documents that would need their screenshots read."""
    pages = table(spark, sf_dir, "documents").selectExpr("doc_id", "text", "n_chars % 4 AS n_widgets", "CASE WHEN n_chars % 3 = 0 THEN 1 ELSE 0 END AS n_blocks", "0 AS n_tables", "lang = 'fr' AS has_flow", "CASE WHEN source = 'src1' THEN 'flowchart' ELSE 'page' END AS type")
    return pages.select("doc_id", documents.needs_vision(pages).alias("needed"))


def doc_render(spark, sf_dir):
    """Each conversation as a report."""
    kind = F.when(F.col("role") == "user", "page").when(F.col("turn") % 4 == 1, "flowchart").otherwise("table")
    sections = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), kind.alias("type"), F.col("turn").alias("seq"), F.concat("role", F.lit(" "), F.col("turn").cast("string")).alias("title"), F.col("text").alias("body"))
    return documents.rendered_document(sections)


def segment_text(spark, sf_dir):
    """Summaries and layouts of a conversation's turns joined."""
    seg = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc"), F.col("turn").alias("seg"), F.when(F.col("role") == "user", F.col("text")).alias("summary"), F.when(F.col("role") != "user", F.col("text")).alias("layout"), (F.length("text") % 5 == 0).alias("failed"))
    return documents.joined_segments(seg)


def image_sizes(spark, sf_dir):
    """Images of each order by size."""
    images = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS page", f"{SEQ} AS seq", "CAST(40 + l_quantity % 5 * 60 AS BIGINT) AS width", "CAST(30 + l_suppkey % 4 * 50 AS BIGINT) AS height", "concat('i', l_partkey, '_seg', l_linenumber, '.svg') AS src")
    return documents.image_sizes(documents.content_images(images))


_COLOR = "CASE p_partkey % 6 WHEN 0 THEN 'rgba(' || p_size || ', 20,3,1)' WHEN 1 THEN 'rgb(1,2,' || p_size || ')' WHEN 2 THEN 'rgba(' || p_size || '%,50%,0.5%,.8)' WHEN 3 THEN '#aB' || (p_size % 10) WHEN 4 THEN '#01fE' || (10 + p_size % 80) ELSE p_name END"


def color_normalize(spark, sf_dir):
    """Colours of all syntaxes with an alpha composed in."""
    part = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_COLOR} AS c", "CASE WHEN p_partkey % 5 = 0 THEN 1.0D ELSE 0.25D * (p_partkey % 4 + 1) END AS a")
    return part.select("p_partkey", color.short_color(F.col("c")).alias("short"), color.composed_color(F.col("c"), F.col("a")).alias("composed"), color.is_opaque_solid(F.col("c")).alias("opaque"))


def scale_urls(spark, sf_dir):
    """Image addresses at several scales."""
    pages = table(spark, sf_dir, "pages")
    w, h = (F.col("page_id") % 50 + 0.5), (F.col("page_id") % 30 + 1)
    return pages.select("page_id", *[urls.scale_url(F.col("url"), w, h, s).alias(f"u_{s}") for s in ("original", "1x", "2x", "ios_3x", "android_hdpi", "android_xxxhdpi")], urls.scale_url(F.col("url"), w, h, "2x", image_format="webp").alias("webp"), *[urls.scale_url(F.col("url"), w, h, s, n).alias(f"u{n}_{s}") for n in (2, 3) for s in ("2x", "ios_3x", "android_xxxhdpi")])


def url_checks(spark, sf_dir):
    """Host, page parameter and allow-list verdict of every URL."""
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", urls.host(u).alias("host"), urls.query_parameter(u, "page").alias("page"), urls.path_id(u, "en").alias("en_id"), urls.is_allowed_asset(u, ["example.com", "m.example.net"]).alias("allowed"))


_ANSWER = "CASE page_id % 4 WHEN 0 THEN '```json' || chr(10) || url || chr(10) || '```' WHEN 1 THEN '```  ' || url WHEN 2 THEN url || ' ```' ELSE 'x```' || url END"


def text_extras(spark, sf_dir):
    """Fences, numbers at ends, day stamps, short keys and first lines."""
    p = table(spark, sf_dir, "pages").selectExpr("page_id", f"{_ANSWER} AS answer", "CASE WHEN page_id % 5 = 0 THEN url ELSE concat('u', url, '_seg', page_id) END AS part", "split(html, chr(10)) AS lines", "timestampadd(HOUR, CAST(page_id AS INT) * 7, TIMESTAMP_NTZ '2024-02-27 05:00:00') AS moment", "url")
    return p.select("page_id", T.unfenced(F.col("answer")).alias("answer"), T.number_after(F.col("part"), "_seg").alias("number"), T.day_stamp(F.col("moment")).alias("day"), T.short_key(F.array("url", F.lit("m"))).alias("key"), F.md5(T.head_lines(F.col("lines"))).alias("head"))


def text_escapes(spark, sf_dir):
    """Whole pages as file names, XML and there and back, and Markdown rows."""
    p = table(spark, sf_dir, "pages")
    xml = T.xml_escaped(F.col("html"))
    return p.select(
        "page_id", T.safe_file_name(F.col("url")).alias("file"), F.md5(T.safe_file_name(F.col("html"))).alias("html_file"), F.md5(xml).alias("xml"), F.md5(T.xml_unescaped(xml)).alias("plain"),
        F.md5(T.markdown_row(F.array(F.col("url"), F.lit(None).cast("string"), F.concat(F.lit(" a|b\r\n"), "html")))).alias("markdown"),
    )


def html_extract(spark, sf_dir):
    """Elements of every page."""
    return html.html_elements(table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (
    page_type_classify, noise_filter, svg_html_safety, num_facts, num_conflicts, char_jaccard, header_similarity, label_rule_counts, dom_text_clean, prefix_crossvalidate,
    dedup_keep_last, dedup_keep_first, page_rollup, vision_need, doc_render, segment_text, image_sizes, color_normalize, scale_urls, url_checks, html_extract, text_extras, text_escapes,
)}

_Q = lambda s: s.replace("'", "''")
_TOOL = {k: f"regexp_matches(line, '{v}')" for k, v in documents.TOOL_RULES.items()}
_TOOL["page_number"] = f"(regexp_matches(line, '{documents.PAGE_NUMBER}') AND (length(line) + length(regexp_replace(line, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')) <= 12 OR contains(line, '页')))"
_LINES = f"SELECT doc_id, source, lang, CAST(i - 1 AS INTEGER) AS line_no, {sql_trim('ls[i]')} AS line FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT *, string_split(text, chr(10)) AS ls FROM documents))"
_SVG = {k: f"regexp_matches(html, '{_Q(v)}')" for k, v in documents.SVG_RULES.items()} | {"html": f"regexp_matches(html, '{documents.HTML_START}')"}
_OUT = {k: f"CAST(len(list_filter(regexp_extract_all(html, '{_Q(v)}', 1), lambda u: NOT starts_with(trim(u), '#'))) AS INTEGER)" for k, v in (("outside_refs", documents.HREF), ("outside_paints", documents.PAINT))}
_FACTS = f"""
WITH t AS (SELECT p_size AS doc, p_partkey AS seq, {FACT_TEXT} AS text FROM part),
m AS (SELECT doc, seq, regexp_extract_all(text, '{facts.FACT}', 1) AS k, regexp_extract_all(text, '{facts.FACT}', 2) AS v, regexp_extract_all(text, '{facts.FACT}', 3) AS u FROM t),
f AS (SELECT doc, seq, CAST(i - 1 AS INTEGER) AS pos, k[i] AS "key", v[i] AS value, u[i] AS unit FROM (SELECT *, unnest(range(1, len(k) + 1)) AS i FROM m))"""
_PAGES = "SELECT conv_id AS page, coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (role = 'user'), '') AS text, coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (role = 'assistant'), '') AS corpus FROM conversations GROUP BY conv_id"
_HOST = "nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '')"


def _scaled(scale: str, fmt: str = "png", stored: int = 4) -> str:
    if scale == "original":
        return "url"
    f = stored if scale == "android_xxxhdpi" else urls.SCALES[scale] * (1 if scale[0].isdigit() else stored / 4)
    lw, lh = "CAST(floor(greatest(1, floor(page_id % 50 + 0.5 + 0.5))) AS BIGINT)", "CAST(page_id % 30 + 1 AS BIGINT)"
    w, h = f"CAST(floor({lw} * {f} + 0.5) AS BIGINT)", f"CAST(floor({lh} * {f} + 0.5) AS BIGINT)"
    return f"url || '?x-oss-process=image/' || CASE WHEN {w} = {lw} * {stored} AND {h} = {lh} * {stored} THEN '' ELSE 'resize,w_' || {w} || ',h_' || {h} || '/' END || 'format,{fmt}'"


_ARGS = "regexp_split_to_array(regexp_extract(c, '^rgba?\\((.*)\\)$', 1), ',\\s*')"
_CALL = "len(g) BETWEEN 3 AND 4 AND regexp_matches(coalesce(g[4], '0'), '^[0-9.]+$')"
_WHOLE, _SHARE = (f"len(list_filter(g[1:3], lambda v: regexp_matches(v, '{p}'))) = 3" for p in ("^[0-9]+$", "^[0-9]+(\\.[0-9]+)?%$"))
_byte = "list_transform(g[1:3], lambda v: CAST(CAST(least(255, greatest(0, floor(CAST(rtrim(v, '%') AS DOUBLE) * 2.55 + 0.5))) AS BIGINT) AS VARCHAR))"
_hexed = lambda i: f"CAST(('0x' || substr(h, {i}, 2)) AS INTEGER)"
_SHORT = f"CASE WHEN starts_with(c, 'rgba') AND len(g) = 4 AND g[4] = '1' AND {_WHOLE} THEN '#' || array_to_string(list_transform(g[1:3], lambda v: lpad(lower(to_hex(CAST(v AS BIGINT))), 2, '0')), '') ELSE c END"

_NAMED = lambda c: f"regexp_replace({c}, '[/\\\\:*?\"<>|]', '_', 'g')"
_CELL = lambda c: sql_trim(f"replace(regexp_replace({c}, '\\r?\\n', '<br>', 'g'), '|', '\\|')")
ORACLES = {
    "text_escapes": f"""
        WITH p AS (SELECT *, regexp_replace(html, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g') AS clean, ' a|b' || chr(13) || chr(10) || html AS cell FROM pages)
        SELECT page_id, {_NAMED('url')} AS file, md5({_NAMED('html')}) AS html_file, md5(replace(replace(replace(replace(clean, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')) AS xml, md5(clean) AS plain,
          md5('| ' || {_CELL('url')} || ' |  | ' || {_CELL('cell')} || ' |') AS markdown FROM p""",
    "page_type_classify": f"""
        WITH t AS (SELECT doc_id, lower(coalesce(source, '')) AS name, lower(coalesce(text, '')) AS text FROM documents)
        SELECT doc_id, CASE WHEN regexp_matches(name, '{documents.FLOW_NAMES}') OR regexp_matches(text[:300], '{documents.STRONG_FLOW}|{_STRONG}')
            OR len(list_distinct(regexp_extract_all(text[:300], '{documents.WEAK_FLOW}|{_WEAK}'))) >= 2 THEN 'flowchart'
          WHEN regexp_matches(name, '{documents.TABLE_NAMES}') OR regexp_matches(text, '\\|.*\\|.*\\|') OR regexp_matches(text[:1000], '{documents.TABLE_WORDS}|{_TABLE}') THEN 'table' ELSE 'page' END AS type FROM t""",
    "noise_filter": f"SELECT doc_id, line_no, {', '.join(f'{v} AS {k}' for k, v in _TOOL.items())}, {' OR '.join(_TOOL.values())} AS noise FROM ({_LINES}) WHERE line <> ''",
    "svg_html_safety": f"SELECT page_id, {', '.join(f'{v} AS {k}' for k, v in (_SVG | _OUT).items())}, {' OR '.join(_SVG.values())} OR {_OUT['outside_refs']} > 0 OR {_OUT['outside_paints']} > 0 AS unsafe FROM pages",
    "num_facts": _FACTS + ' SELECT doc, seq, pos, "key", value, unit FROM f',
    "num_conflicts": _FACTS + """, known AS (SELECT doc, "key", unit, list_sort(list(value)) AS known, array_to_string(list(value ORDER BY pos, value)[1:3], '、') AS recorded FROM (SELECT doc, "key", unit, value, min(pos) AS pos FROM f WHERE seq % 2 = 0 GROUP BY ALL) GROUP BY ALL),
        one AS (SELECT * FROM f WHERE seq % 2 = 1 QUALIFY row_number() OVER (PARTITION BY doc, seq, "key", unit ORDER BY pos) = 1),
        bad AS (SELECT one.*, known.known, recorded FROM one JOIN known USING (doc, "key", unit) WHERE NOT list_contains(known.known, value) QUALIFY row_number() OVER (PARTITION BY doc, "key", unit ORDER BY seq, pos) = 1)
        SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY seq, pos, "key", unit) AS INTEGER) AS rank, "key", unit, value, array_to_string(known, ',') AS known, recorded FROM bad QUALIFY rank <= 8""",
    "char_jaccard": f"SELECT p_partkey, round({sql_text_similarity('p_name', 'p_type')}, 9) AS name_type, round({sql_text_similarity('p_brand', 'p_type')}, 9) AS brand_type FROM part",
    "header_similarity": f"""
        WITH n AS (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey)
        SELECT a.n_nationkey AS a, b.n_nationkey AS b, round(((CASE WHEN {sql_text_similarity('a.n_name', 'b.r_name')} > 0.6 THEN 1 ELSE 0 END) + (CASE WHEN {sql_text_similarity('a.r_name', 'b.r_name')} > 0.6 THEN 1 ELSE 0 END)
          + (CASE WHEN {sql_text_similarity('reverse(a.n_name)', 'upper(b.n_name)')} > 0.6 THEN 1 ELSE 0 END)) / 3, 9) AS similarity FROM n a JOIN n b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey""",
    "label_rule_counts": f"""
        WITH l AS (SELECT source AS page, doc_id * 1000000 + line_no AS seq, lang AS type, line AS text, CASE WHEN length(line) + length(regexp_replace(line, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')) <= 12 THEN 'label' ELSE 'rule' END AS kind FROM ({_LINES}) WHERE line <> '')
        SELECT page, kind, text, arg_min(type, seq) AS type, count(*) AS n, min(seq) AS first_seq FROM l GROUP BY page, kind, text""",
    "dom_text_clean": f"""
        WITH p AS ({_PAGES}), s AS (SELECT page, {sql_squash('corpus')} AS body, string_split(text, chr(10)) AS ls FROM p),
        l AS (SELECT page, body, CAST(i - 1 AS INTEGER) AS line_no, {sql_trim('ls[i]')} AS line FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM s)),
        k AS (SELECT *, {sql_squash('line')} AS k, regexp_matches(line, '^[^A-Za-z0-9_\\x{{4e00}}-\\x{{9fa5}}]+$') AS symbols FROM l WHERE line <> ''),
        n AS (SELECT *, row_number() OVER (PARTITION BY page, k, symbols ORDER BY line_no) AS nth FROM k)
        SELECT page, line_no, line, CASE WHEN symbols THEN 'symbols' WHEN nth > 1 THEN 'repeated' WHEN length(k) >= 2 AND body <> '' AND contains(body, k) THEN 'covered' ELSE 'kept' END AS verdict FROM n""",
    "prefix_crossvalidate": f"""
        WITH p AS (SELECT page, {sql_merge_key('text')} AS body FROM ({_PAGES})), i AS (SELECT conv_id AS page, turn, {sql_merge_key('text')} AS k FROM conversations WHERE role = 'assistant')
        SELECT page, turn FROM i JOIN p USING (page) WHERE body <> '' AND length(k) >= 3 AND NOT contains(body, k[:4])""",
    "dedup_keep_last": f"""
        WITH k AS (SELECT doc_id, lang, sha256({sql_merge_key("coalesce(text, '')")}) AS k FROM documents)
        SELECT doc_id, lang, n AS group_size FROM (SELECT *, count(*) OVER (PARTITION BY k) AS n, row_number() OVER (PARTITION BY k ORDER BY coalesce(lang = 'de', false) DESC, doc_id DESC) AS nth FROM k) WHERE nth = 1""",
    "dedup_keep_first": f"SELECT page_id, url, host FROM (SELECT page_id, url, {_HOST} AS host FROM pages) QUALIFY row_number() OVER (PARTITION BY host ORDER BY page_id) = 1",
    "page_rollup": """
        WITH p AS (SELECT d.doc_id, len(string_split(text, chr(10))) > 3 AS blocks, contains(text, '|') AS tables, coalesce(toxic = 1, false) AS flow, lang = 'es' AS images, coalesce(quality = 1, false) AS vision, n_chars > 10000 AS warned FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
        SELECT doc_id, coalesce(nullif(array_to_string(list_filter([CASE WHEN blocks THEN 'DOM结构化' END, CASE WHEN flow THEN 'DOM拓扑' END, CASE WHEN images THEN '内嵌图解析' END, CASE WHEN vision THEN 'VLM' END], lambda x: x IS NOT NULL), '+'), ''), '仅DOM') AS method,
          CASE WHEN warned THEN '待复核' WHEN flow THEN '高' WHEN vision AND (blocks OR tables) THEN '中高' WHEN blocks OR tables THEN '中' ELSE '低' END AS confidence,
          CASE WHEN warned THEN 'long; split' WHEN flow THEN '流程图拓扑由 DOM 连接线还原' WHEN vision AND (blocks OR tables) THEN '' WHEN blocks OR tables THEN '仅 DOM 确定性提取（内容已充分，VLM 按策略跳过或未配置）' ELSE '无有效提取结果' END AS remark FROM p""",
    "vision_need": f"SELECT doc_id, n_chars % 4 > 0 AND (NOT (n_chars % 3 = 0 OR length({sql_trim('text')}) + length(regexp_replace({sql_trim('text')}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')) >= 50) OR (source = 'src1' AND NOT lang = 'fr')) AS needed FROM documents",
    "doc_render": """
        WITH s AS (SELECT conv_id AS doc, CASE WHEN role = 'user' THEN 1 WHEN turn % 4 = 1 THEN 0 ELSE 2 END AS o, turn AS seq, role || ' ' || turn AS title, text AS body FROM conversations),
        n AS (SELECT *, dense_rank() OVER (PARTITION BY doc ORDER BY o) AS c, row_number() OVER (PARTITION BY doc, o ORDER BY seq) AS j FROM s),
        g AS (SELECT doc, c, '## ' || substr('一二三四五六七八九十', c, 1) || '、' || ['流程说明', '页面详情', '配置与表格'][o + 1] || chr(10) || chr(10) || string_agg('### ' || c || '.' || j || ' ' || title || chr(10) || chr(10) || body, chr(10) || chr(10) ORDER BY j) AS t FROM n GROUP BY doc, c, o)
        SELECT doc, string_agg(t, chr(10) || chr(10) ORDER BY c) AS markdown FROM g GROUP BY doc""",
    "segment_text": """
        SELECT conv_id AS doc, coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (role = 'user' AND text <> ''), '') AS summary,
          coalesce(string_agg('[第' || (turn + 1) || '段] ' || text, chr(10) ORDER BY turn) FILTER (role <> 'user' AND text <> ''), '') AS layout FROM conversations WHERE length(text) % 5 <> 0 GROUP BY conv_id""",
    "image_sizes": f"""
        WITH i AS (SELECT l_orderkey AS page, {SEQ} AS seq, CAST(40 + l_quantity % 5 * 60 AS BIGINT) || '×' || (30 + l_suppkey % 4 * 50) AS size, 40 + l_quantity % 5 * 60 AS w, 30 + l_suppkey % 4 * 50 AS h FROM lineitem),
        g AS (SELECT page, size, count(*) AS n, min(seq) AS seq FROM i WHERE w >= 40 AND h >= 40 GROUP BY page, size)
        SELECT page, CAST(sum(n) AS BIGINT) AS n_images, string_agg(size || CASE WHEN n > 1 THEN '×' || n ELSE '' END, '、' ORDER BY seq) AS sizes FROM g GROUP BY page""",
    "color_normalize": f"""
        WITH p AS (SELECT p_partkey, {_COLOR} AS c, CASE WHEN p_partkey % 5 = 0 THEN 1.0 ELSE 0.25 * (p_partkey % 4 + 1) END AS a FROM part),
        h AS (SELECT *, {_ARGS} AS g, CASE WHEN a = 0.25 THEN '0.25' WHEN a = 0.5 THEN '0.5' ELSE '0.75' END AS t,
          CASE WHEN length(c) = 4 AND c[1] = '#' THEN array_to_string(list_transform([2, 3, 4], lambda i: c[i] || c[i]), '') WHEN c[1] = '#' THEN c[2:] ELSE '' END AS h FROM p)
        SELECT p_partkey, {_SHORT} AS short, CASE WHEN a >= 1 THEN {_SHORT}
          WHEN {_CALL} AND {_WHOLE} THEN 'rgba(' || array_to_string(g[1:3], ',') || ',' || t || ')'
          WHEN {_CALL} AND {_SHARE} THEN 'rgba(' || array_to_string({_byte}, ',') || ',' || t || ')'
          WHEN length(h) = 6 THEN 'rgba(' || {_hexed(1)} || ',' || {_hexed(3)} || ',' || {_hexed(5)} || ',' || t || ')' ELSE c END AS composed,
          (c[1] = '#' AND length(c) = 7) OR (starts_with(c, 'rgba') AND len(g) = 4 AND g[4] = '1' AND {_WHOLE}) AS opaque FROM h""",
    "scale_urls": "SELECT page_id, " + ", ".join(f"{_scaled(s)} AS u_{s}" for s in ("original", "1x", "2x", "ios_3x", "android_hdpi", "android_xxxhdpi")) + f", {_scaled('2x', 'webp')} AS webp, " + ", ".join(f"{_scaled(s, 'png', n)} AS u{n}_{s}" for n in (2, 3) for s in ("2x", "ios_3x", "android_xxxhdpi")) + " FROM pages",
    "text_extras": f"""
        WITH p AS (SELECT page_id, url, {_ANSWER} AS a, string_split(html, chr(10)) AS l FROM pages)
        SELECT page_id, regexp_replace(regexp_replace(a, '(?i)^```(?:json)?\\s*', ''), '\\s*```$', '') AS answer, CASE WHEN page_id % 5 = 0 THEN 0 ELSE page_id END AS number,
          strftime(TIMESTAMP '2024-02-27 05:00:00' + to_hours(CAST(page_id * 7 AS INTEGER)), '%Y-%m-%d') AS day, sha1(url || chr(0) || 'm')[:16] AS key, md5(array_to_string(l[1:5], chr(10))) AS head FROM p""",
    "url_checks": f"""SELECT page_id, {_HOST} AS host, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, nullif(regexp_extract(url, '/en/([A-Za-z0-9_-]+)', 1), '') AS en_id,
        coalesce(regexp_matches(url, '(?i)^https://') AND NOT regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*@') AND ({_HOST} = 'example.com' OR ends_with({_HOST}, '.example.com') OR {_HOST} = 'm.example.net' OR ends_with({_HOST}, '.m.example.net')), false) AS allowed FROM pages""",
}
