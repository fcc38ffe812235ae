"""Queries of the page merge: tables of two readers, warnings, the report's appendix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import documents, facts, pages, structures
from tessella.plans.common import sql_merge_key, sql_text_similarity, table
from tessella.plans.texts import FACT_TEXT

_TYPE = "CASE p_size % 3 WHEN 0 THEN 'flowchart' WHEN 1 THEN 'table' ELSE 'page' END"
_KIND = "CASE p_size % 3 WHEN 0 THEN 'node' WHEN 1 THEN 'cell' ELSE 'component' END"
_READ = "p_partkey % 2 = 1"


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part")


def _tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _part(spark, sf_dir).selectExpr(
        "p_size AS page", "p_partkey AS seq", "p_partkey % 4 = 0 AS own", "p_brand AS title", "CASE WHEN p_partkey % 9 = 0 THEN array() ELSE array(p_name, p_type) END AS headers",
        "array(array(p_name)) AS rows", "CASE WHEN p_partkey % 5 = 0 THEN p_type END AS notes", "p_partkey % 8 = 0 AS is_panel",
    )
    return pages.merged_tables(rows.filter("own").drop("own"), rows.filter("NOT own").drop("own"))


def page_tables(spark, sf_dir):
    """Tables of a size's parts: trusted ones, then read ones whose headers are new."""
    return _tables(spark, sf_dir).select("page", "place", "source", "title", F.array_join("headers", "|").alias("headers"), "notes", "is_panel")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _part(spark, sf_dir).selectExpr("p_size", "p_partkey", f"{_TYPE} AS type", f"{FACT_TEXT} AS text")
    own = F.when((F.col("p_partkey") % 2 == 0) & (F.col("p_size") % 10 != 0), F.struct("p_partkey", "text"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(own)), lambda s: s["text"]), "\n")
    return part.groupBy(F.col("p_size").alias("page")).agg(F.first("type").alias("type"), text.alias("text")).selectExpr("*", "page % 20 = 0 AS has_structure", "page % 2 AS n_screenshots")


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = _part(spark, sf_dir).filter(_READ)
    segments = read.selectExpr("p_size AS page", "p_size % 5 = 0 OR p_partkey % 3 = 0 AS failed")
    items = read.filter("p_partkey % 3 = 1 AND p_size % 20 <> 10").selectExpr("p_size AS page", f"{_KIND} AS kind", "p_partkey AS seq", f"CASE WHEN p_partkey % 5 = 1 THEN p_name ELSE {FACT_TEXT} END AS text")
    texts = read.selectExpr("p_size AS page", "p_partkey AS seq", f"{FACT_TEXT} AS text")
    images = read.filter("p_partkey % 7 = 0").selectExpr("p_size AS page", "p_partkey % 4 = 1 AS failed")
    return pages.merged_pages(_pages(spark, sf_dir), segments, items, texts, images, _tables(spark, sf_dir))


def page_merge(spark, sf_dir):
    """Pages made of a size's parts with their warnings and counts."""
    return _merged(spark, sf_dir).withColumn("warnings", F.array_join("warnings", ";")).withColumn("unverified", F.array_join("unverified", "|"))


def doc_appendix(spark, sf_dir):
    """The appendix of a report for each remainder of the page number."""
    rows = _merged(spark, sf_dir).selectExpr(
        "page % 7 AS doc", "page AS seq", "concat('p', page) AS name", "type", "warnings", "unverified", "n_segments", "has_vision", "n_tables", "page % 4 AS n_blocks", "page % 6 = 0 AS has_flow", "page % 2 AS n_image_results",
    )
    return pages.appendix_lines(rows)


def image_results(spark, sf_dir):
    """Picture results that have anything to show."""
    rows = table(spark, sf_dir, "documents").selectExpr("doc_id", "CASE WHEN doc_id % 3 = 0 THEN array() WHEN doc_id % 3 = 1 THEN array(lang) END AS texts", "CASE WHEN doc_id % 5 = 0 THEN source WHEN doc_id % 5 = 1 THEN '' END AS summary", "CASE WHEN doc_id % 7 = 0 THEN 'timeout' END AS error")
    return pages.kept_images(rows).select("doc_id")


#: What a turn of a conversation, read as a reading of a page, says; ``w`` are the turn's words.
_READING = {
    "page": "conv_id", "seg": "turn", "failed": "length(text) % 7 = 0", "page_type": "CASE WHEN turn % 2 = 1 THEN role ELSE '' END", "layout": "CASE WHEN length(text) % 3 > 0 THEN role END",
    "visual_hierarchy": "CASE WHEN length(text) % 2 = 0 THEN concat(role, turn) END", "a": "CASE WHEN length(text) % 4 = 0 THEN 'Top Bar' ELSE role END", "b": "CASE WHEN turn % 3 = 0 THEN '翻页' ELSE 'button' END",
    "c": "substr(text, 1, 3)", "d": "CASE WHEN length(text) % 5 = 0 THEN 'Figma' ELSE substr(text, 1, 2) END",
}


def page_structures(spark, sf_dir):
    """Readings of each conversation's turns as one structure."""
    rows = table(spark, sf_dir, "conversations").selectExpr(*[f"{e} AS {n}" for n, e in _READING.items()])
    both = lambda x, y: F.array(x, y)
    component = lambda n, t, d: F.struct(F.col(n).alias("name"), F.col(t).alias("type"), F.col(d).alias("description"))
    rows = rows.withColumns({
        "components": both(component("a", "b", "c"), component("c", "a", "d")), "interactions": both(F.col("a"), F.concat("c", F.lit("，"))), "states": both(F.col("d"), F.lower("c")), "key_info": both(F.col("c"), F.lit(" 3/6 ")),
        "states_detail": both(F.struct(F.col("d").alias("element"), F.col("c").alias("detail")), F.struct(F.col("a").alias("element"), F.col("b").alias("detail"))),
    })
    found = structures.merged_structures(rows)
    flat = lambda c, *names: F.array_join(F.transform(c, lambda e: F.concat_ws("/", *[e[n] for n in names])), ";").alias(c)
    lists = [F.array_join(c, ";").alias(c) for c in structures.LISTS]
    return found.select("page", "n_segments", "page_type", "layout", "visual_hierarchy", flat("components", "name", "type", "description"), *lists, flat("states_detail", "element", "detail"))


QUERIES = {f.__name__: f for f in (page_tables, page_merge, doc_appendix, image_results, page_structures)}


def _tool(x: str) -> str:
    rules = [f"regexp_matches({x}, '{rule}')" for rule in documents.TOOL_RULES.values()]
    return "(" + " OR ".join([*rules, f"(regexp_matches({x}, '{documents.PAGE_NUMBER}') AND (length({x}) <= 12 OR contains({x}, '页')))"]) + ")"


_STRUCTURES = f"""
WITH r AS (SELECT {', '.join(f'{e} AS "{n}"' for n, e in _READING.items())} FROM conversations),
  g AS (SELECT *, count(*) OVER (PARTITION BY page) AS n, row_number() OVER (PARTITION BY page ORDER BY seg) AS k FROM r WHERE NOT failed),
  e0 AS (SELECT page, n, seg, 'components' AS kind, unnest([0, 1]) AS i, unnest([a, c]) AS x, unnest([b, a]) AS y, unnest([c, d]) AS z FROM g
         UNION ALL SELECT page, n, seg, 'interactions', unnest([0, 1]), unnest([a, c || '，']), '', '' FROM g UNION ALL SELECT page, n, seg, 'states', unnest([0, 1]), unnest([d, lower(c)]), '', '' FROM g
         UNION ALL SELECT page, n, seg, 'key_info', unnest([0, 1]), unnest([c, ' 3/6 ']), '', '' FROM g UNION ALL SELECT page, n, seg, 'states_detail', unnest([0, 1]), unnest([d, a]), '', unnest([c, b]) FROM g WHERE n = 1),
  e1 AS (SELECT * FROM e0 QUALIFY row_number() OVER (PARTITION BY page, kind, CASE WHEN n = 1 THEN CAST(i AS VARCHAR) ELSE {sql_merge_key("CASE WHEN kind = 'components' THEN x || '|' || y ELSE x END")} END ORDER BY seg, i) = 1),
  e AS (SELECT * FROM e1 WHERE NOT {_tool('x')} AND NOT (kind = 'components' AND ({_tool('y')} OR {_tool('z')}))),
  l AS (SELECT page, {', '.join(f"coalesce(string_agg({v}, ';' ORDER BY seg, i) FILTER (kind = '{k}'), '') AS {k}" for k, v in (('components', "x || '/' || y || '/' || z"), ('interactions', 'x'), ('states', 'x'), ('key_info', 'x'), ('states_detail', "x || '/' || z")))} FROM e GROUP BY page),
  h AS (SELECT r.page, CAST(count(g.seg) AS INTEGER) AS n_segments, coalesce(arg_min(g.page_type, g.seg) FILTER (g.page_type <> ''), '') AS page_type,
          CASE WHEN count(g.seg) > 1 THEN string_agg('[第' || g.k || '段] ' || coalesce(g.layout, ''), chr(10) ORDER BY g.k) ELSE coalesce(any_value(g.layout), '') END AS layout,
          coalesce(string_agg(g.visual_hierarchy, ' ' ORDER BY g.k) FILTER (g.visual_hierarchy <> ''), '') AS visual_hierarchy
        FROM r LEFT JOIN g ON g.page = r.page AND g.seg = r.seg GROUP BY r.page)
SELECT h.*, {', '.join(f"coalesce({c}, '') AS {c}" for c in ('components', 'interactions', 'states', 'key_info', 'states_detail'))} FROM h LEFT JOIN l USING (page)
"""

_TABLES = f"""
  t AS (SELECT p_size AS page, p_partkey AS seq, CASE WHEN p_partkey % 4 = 0 THEN 'dom' ELSE 'vlm' END AS source, p_brand AS title, CASE WHEN p_partkey % 9 = 0 THEN CAST([] AS VARCHAR[]) ELSE [p_name, p_type] END AS headers,
    CASE WHEN p_partkey % 5 = 0 THEN p_type END AS notes, p_partkey % 8 = 0 AS is_panel FROM part),
  o AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY source = 'vlm', seq) AS n FROM t),
  k AS (SELECT *, [headers] AS kept, true AS stays FROM o WHERE n = 1 UNION ALL
    SELECT o.*, CASE WHEN s THEN list_append(k.kept, o.headers) ELSE k.kept END, s FROM k JOIN o ON o.page = k.page AND o.n = k.n + 1,
      LATERAL (SELECT o.source = 'dom' OR len(list_filter(k.kept, lambda h: len(h) = 2 AND len(o.headers) = 2 AND {sql_text_similarity('h[1]', 'o.headers[1]')} > 0.6 AND {sql_text_similarity('h[2]', 'o.headers[2]')} > 0.6)) = 0 AS s)),
  kept AS (SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY n) - 1 AS INTEGER) AS place, source, title, array_to_string(headers, '|') AS headers, notes, is_panel FROM k WHERE stays)"""
_MERGED = f"""
WITH RECURSIVE {_TABLES},
  p AS (SELECT p_size AS page, any_value({_TYPE}) AS type, coalesce(string_agg({FACT_TEXT}, chr(10) ORDER BY p_partkey) FILTER (p_partkey % 2 = 0 AND p_size % 10 <> 0), '') AS text FROM part GROUP BY p_size),
  seg AS (SELECT p_size AS page, count(*) AS n, count(*) FILTER (p_size % 5 = 0 OR p_partkey % 3 = 0) AS bad, count(*) FILTER (p_partkey % 7 = 0 AND p_partkey % 4 = 1) AS pics FROM part WHERE {_READ} GROUP BY p_size),
  i AS (SELECT p_size AS page, p_partkey AS seq, CASE WHEN p_partkey % 5 = 1 THEN p_name ELSE {FACT_TEXT} END AS text FROM part WHERE {_READ} AND p_partkey % 3 = 1 AND p_size % 20 <> 10),
  c AS (SELECT page, count(*) AS n_items FROM i GROUP BY page),
  u AS (SELECT page, array_to_string(list(i.text ORDER BY seq), '|') AS unverified, count(*) AS n_bad FROM i JOIN p USING (page) WHERE length(p.text) >= 10 AND length({sql_merge_key('i.text')}) >= CASE type WHEN 'table' THEN 4 ELSE 3 END
    AND NOT contains({sql_merge_key('p.text')}, left({sql_merge_key('i.text')}, CASE type WHEN 'page' THEN 3 ELSE 4 END)) GROUP BY page),
  ft AS (SELECT page, 0 AS seq, true AS own, text FROM p UNION ALL SELECT p_size, p_partkey, false, {FACT_TEXT} FROM part WHERE {_READ}),
  fm AS (SELECT *, regexp_extract_all(text, '{facts.FACT}', 1) AS fk, regexp_extract_all(text, '{facts.FACT}', 2) AS fv, regexp_extract_all(text, '{facts.FACT}', 3) AS fu FROM ft),
  f AS (SELECT page, seq, own, n AS pos, fk[n] AS "key", fv[n] AS value, fu[n] AS unit FROM (SELECT *, unnest(range(1, len(fk) + 1)) AS n FROM fm)),
  known AS (SELECT page, "key", unit, list(value) AS vals, array_to_string(list(value ORDER BY pos)[1:3], '、') AS recorded FROM (SELECT page, "key", unit, value, min(pos) AS pos FROM f WHERE own GROUP BY ALL) GROUP BY ALL),
  one AS (SELECT * FROM f WHERE NOT own QUALIFY row_number() OVER (PARTITION BY page, seq, "key", unit ORDER BY pos) = 1),
  bad AS (SELECT one.*, recorded FROM one JOIN known USING (page, "key", unit) WHERE NOT list_contains(vals, value) QUALIFY row_number() OVER (PARTITION BY page, "key", unit ORDER BY seq, pos) = 1),
  conf AS (SELECT page, list('「' || "key" || '」VLM 识别为 ' || value || unit || '，DOM 中未出现该值（DOM 记录：' || recorded || unit || '）——以 DOM 为准，请复核' ORDER BY seq, pos, "key", unit)[1:8] AS w FROM bad GROUP BY page),
  tc AS (SELECT page, count(*) FILTER (NOT is_panel) AS n_tables, count(*) FILTER (is_panel) AS n_panels FROM kept GROUP BY page),
  m AS (SELECT p.page, type, list_filter(list_concat(list_concat([CASE WHEN seg.n = seg.bad THEN '{pages.ALL_FAILED}' END,
      CASE WHEN length(text) < 10 THEN CASE WHEN n_items > 0 THEN '{pages.SHORT_CHECKED}' WHEN p.page % 20 <> 0 THEN '{pages.NOTHING_FOUND}' END
           WHEN type = 'table' AND n_bad > 0 THEN '表格中有 ' || n_bad || ' 个单元格内容未在 DOM 文字中找到，可能为图片识别，建议人工复核' END], coalesce(w, [])),
      [CASE WHEN pics > 0 THEN '内嵌图解析失败 ' || pics || ' 张，未产出图内文字，该部分数值未经校验，建议重跑或人工查看截图' END]), lambda x: x IS NOT NULL) AS ws,
    coalesce(unverified, '') AS unverified, coalesce(n_bad, 0) AS n_bad, CASE WHEN p.page % 2 > 0 THEN CAST(p.page % 2 AS BIGINT) ELSE coalesce(seg.n, 0) END AS n_segments, coalesce(seg.n > seg.bad, false) AS has_vision,
    coalesce(n_tables, 0) AS n_tables, coalesce(n_panels, 0) AS n_panels
    FROM p LEFT JOIN seg USING (page) LEFT JOIN c USING (page) LEFT JOIN u USING (page) LEFT JOIN conf USING (page) LEFT JOIN tc USING (page))"""

ORACLES = {
    "page_tables": f"WITH RECURSIVE {_TABLES} SELECT * FROM kept",
    "page_merge": _MERGED + " SELECT page, type, array_to_string(ws, ';') AS warnings, unverified, n_segments, has_vision, n_tables, n_panels FROM m",
    "doc_appendix": _MERGED + f""",
  x AS (SELECT page % 7 AS doc, CAST(page AS BIGINT) AS seq, 'p' || page AS name, *, page % 4 > 0 AS blocks, page % 6 = 0 AS flow, page % 2 > 0 AS images, len(ws) > 0 AS warned FROM m),
  y AS (SELECT *, blocks OR n_tables > 0 AS structured, CASE type WHEN 'flowchart' THEN '流程图' WHEN 'table' THEN '配置表' ELSE '普通页面' END AS label,
    list_concat(ws, CASE WHEN unverified = '' THEN [] WHEN type = 'flowchart' THEN ['流程图节点「' || replace(unverified, '|', '、') || '」未在 DOM 文字中找到，可能为 VLM 误识别'] WHEN type = 'table' THEN ['表格有 ' || n_bad || ' 个单元格未在 DOM 中找到，建议复核'] ELSE [] END) AS todo FROM x),
  r AS (SELECT doc, 1 AS part, seq, 0 AS k, '| ' || name || ' | ' || label || ' | ' || coalesce(nullif(array_to_string(list_filter([CASE WHEN blocks THEN 'DOM结构化' END, CASE WHEN flow THEN 'DOM拓扑' END, CASE WHEN images THEN '内嵌图解析' END, CASE WHEN has_vision THEN 'VLM' END], lambda v: v IS NOT NULL), '+'), ''), '仅DOM')
      || ' | ' || n_segments || ' | ' || n_tables || ' | ' || (page % 4) || ' | ' || CASE WHEN warned THEN '待复核' WHEN flow THEN '高' WHEN has_vision AND structured THEN '中高' WHEN structured THEN '中' ELSE '低' END || ' | '
      || CASE WHEN warned THEN array_to_string(ws, '; ') WHEN flow THEN '流程图拓扑由 DOM 连接线还原' WHEN has_vision AND structured THEN '' WHEN structured THEN '仅 DOM 确定性提取（内容已充分，VLM 按策略跳过或未配置）' ELSE '无有效提取结果' END || ' |' AS line FROM y),
  w AS (SELECT doc, 3 AS part, seq, CAST(unnest(range(len(todo))) AS INTEGER) AS k, '- [' || name || '] ' || unnest(todo) AS line FROM y),
  h AS (SELECT doc, count(DISTINCT type) + 1 AS no, doc IN (SELECT doc FROM w) AS any_todo FROM y GROUP BY doc),
  z AS (SELECT doc, unnest([{{'part': 0, 'k': 0, 'line': '## ' || ['一', '二', '三', '四'][no] || '、附录'}}, {{'part': 0, 'k': 1, 'line': '### ' || no || '.1 解析来源与置信度'}}, {{'part': 0, 'k': 2, 'line': '{pages.APPENDIX_HEAD[0]}'}}, {{'part': 0, 'k': 3, 'line': '{pages.APPENDIX_HEAD[1]}'}},
    {{'part': 2, 'k': 0, 'line': '### ' || no || '.2 待确认项'}}, {{'part': 2, 'k': 1, 'line': CASE WHEN NOT any_todo THEN '无' END}}]) AS t FROM h)
  SELECT * FROM r UNION ALL SELECT * FROM w UNION ALL SELECT doc, t.part, CAST(0 AS BIGINT), t.k, t.line FROM z WHERE t.line IS NOT NULL""",
    "image_results": "SELECT doc_id FROM documents WHERE doc_id % 3 = 1 OR (doc_id % 5 = 0 AND coalesce(source, '') <> '') OR doc_id % 7 = 0",
    "page_structures": _STRUCTURES,
}
