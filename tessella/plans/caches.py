"""Queries of the two-level cache of pages (conversations, turns as parts) and of fetched files (documents as bodies)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.operators import pagecache
from tessella.plans.common import table
from tessella.sources import assets

_PARTS = {"page": "conv_id", "kind": "CASE WHEN role = 'user' THEN 'segment' ELSE 'image' END", "type": "CASE WHEN role = 'user' THEN 'page' ELSE 'image' END", "pos": "CAST(turn AS BIGINT)", "content": "text"}
# What earlier runs left: pages of every third conversation, two versions of them, and parts by their length.
_OLD_PAGE, _OLD_PART, _FAILS = "page % 3 = 0", "length(content) % 2 = 0", "length(content) % 5 = 0"


def _plan(spark, sf_dir) -> DataFrame:
    parts = table(spark, sf_dir, "conversations").selectExpr(*[f"{e} AS {n}" for n, e in _PARTS.items()])
    keyed = pagecache.part_keys(parts)
    old = keyed.filter(_OLD_PAGE).selectExpr("page_key", "pos", "concat('old ', pos) AS result", "1 AS written_at")
    new = keyed.filter(_OLD_PAGE).selectExpr("page_key", "pos", "concat('page ', pos) AS result", "2 AS written_at")
    of_parts = keyed.filter(_OLD_PART).selectExpr("key", "concat('part ', substr(key, 1, 4)) AS result", "1 AS written_at")
    return pagecache.planned(keyed, old.unionByName(new), of_parts)


def _scattered(spark, sf_dir) -> DataFrame:
    plan = _plan(spark, sf_dir)
    worked = pagecache.gap_queue(plan).selectExpr("key", "concat('new ', substr(key, 1, 4)) AS result", f"{_FAILS} AS failed")
    return pagecache.scattered(plan, worked)


def page_cache_plan(spark, sf_dir):
    """Every part's keys, the level its result was found at, and the result."""
    return _plan(spark, sf_dir).select("page", "kind", "pos", "key", "page_key", "n_parts", "level", "result")


def page_cache_queue(spark, sf_dir):
    """The gaps of all pages as one queue."""
    return pagecache.gap_queue(_plan(spark, sf_dir)).withColumn("content", F.md5("content"))


def page_cache_scatter(spark, sf_dir):
    """How each page came by its results once the gaps are worked on."""
    return pagecache.page_summary(_scattered(spark, sf_dir))


def page_cache_entries(spark, sf_dir):
    """Entries of pages that are complete now."""
    return pagecache.page_entries(_scattered(spark, sf_dir))


# Bodies of every kind: an SVG (an active one at times), a page, an empty answer, a picture's header, plain text.
_BODY = {
    0: "encode(concat('<svg><desc>', doc_id, '</desc>', CASE WHEN doc_id % 4 = 0 THEN '<script>' ELSE '' END, '</svg>'), 'UTF-8')", 1: "encode(concat('  <!DOCTYPE html>', text), 'UTF-8')",
    2: "CAST('' AS BINARY)", 3: "unhex(concat('89504E470D0A1A0A0000000D49484452', lpad(hex(doc_id), 8, '0'), '00000280', md5(text)))", 4: "encode(text, 'UTF-8')",
}


def asset_manifest(spark, sf_dir):
    """What the bytes of each fetched file are, or why it is refused."""
    body = "CASE doc_id % 6 " + " ".join(f"WHEN {k} THEN {v}" for k, v in _BODY.items()) + " END"
    files = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{body} AS body")
    return assets.inspected(files).drop("body")


QUERIES = {f.__name__: f for f in (asset_manifest, page_cache_plan, page_cache_queue, page_cache_scatter, page_cache_entries)}

_number = lambda start: f"sum(CAST('0x' || substr(md5(pos || ':' || key), {start}, 15) AS BIGINT))"
_SQL = f"""
WITH p AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _PARTS.items())} FROM conversations),
k AS (SELECT *, md5(coalesce(CAST(page AS VARCHAR), '') || '::' || kind || '::' || type || '::' || md5(coalesce(content, '')) || '::1') AS key FROM p),
g AS (SELECT page AS g_page, kind AS g_kind, count(*) AS n_parts, md5(coalesce(CAST(page AS VARCHAR), '') || '::' || kind || '::1::' || count(*) || '::' || {_number(1)} || '::' || {_number(16)}) AS page_key FROM k GROUP BY page, kind),
l AS (SELECT *, EXISTS (SELECT 1 FROM k o WHERE o.key = k.key AND {_OLD_PART.replace('content', 'o.content')}) AS by_part FROM k JOIN g ON g_page IS NOT DISTINCT FROM page AND g_kind = kind),
r AS (SELECT *, CASE WHEN {_OLD_PAGE} THEN 'page' WHEN by_part THEN 'part' END AS level, CASE WHEN {_OLD_PAGE} THEN 'page ' || pos WHEN by_part THEN 'part ' || key[:4] END AS result FROM l),
s AS (SELECT *, level IS NULL AND {_FAILS} AS failed FROM r)"""
ORACLES = {
    "asset_manifest": """
        WITH b AS (SELECT doc_id, doc_id % 6 AS k, CASE doc_id % 6 WHEN 0 THEN encode('<svg><desc>' || doc_id || '</desc>' || CASE WHEN doc_id % 4 = 0 THEN '<script>' ELSE '' END || '</svg>') WHEN 1 THEN encode('  <!DOCTYPE html>' || text)
            WHEN 3 THEN unhex('89504E470D0A1A0A0000000D49484452' || lpad(hex(doc_id), 8, '0') || '00000280' || md5(text)) WHEN 4 THEN encode(text) ELSE encode('') END AS body FROM documents),
          r AS (SELECT *, CASE WHEN octet_length(body) = 0 THEN 'empty_asset' WHEN k = 0 AND doc_id % 4 = 0 THEN 'unsafe_svg' WHEN k = 1 THEN 'html_response' WHEN k = 4 THEN 'invalid_image' END AS reason FROM b)
        SELECT doc_id, sha256(body) AS sha256, CASE WHEN reason IS NULL THEN CASE k WHEN 0 THEN 'svg' WHEN 3 THEN 'png' END END AS format, octet_length(body) AS n_bytes,
          CASE WHEN k = 3 AND reason IS NULL THEN doc_id END AS width, CASE WHEN k = 3 AND reason IS NULL THEN CAST(640 AS BIGINT) END AS height, reason FROM r""",
    "page_cache_plan": f"{_SQL} SELECT page, kind, pos, key, page_key, n_parts, level, result FROM r",
    "page_cache_queue": f"{_SQL} SELECT key, page, kind, type, pos, n_parts, md5(content) AS content FROM r WHERE level IS NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY page, kind, type, pos, n_parts) = 1",
    "page_cache_scatter": f"""{_SQL} SELECT page, kind, count(*) AS n_parts, count(*) FILTER (level = 'page') AS n_page, count(*) FILTER (level = 'part') AS n_part, count(*) FILTER (level IS NULL AND NOT failed) AS n_worked,
        count(*) FILTER (failed) AS n_failed, bool_and(level IS NOT NULL) AS cached FROM s GROUP BY page, kind""",
    "page_cache_entries": f"""{_SQL} SELECT page_key, pos, CASE WHEN level IS NULL THEN 'new ' || key[:4] ELSE result END AS result FROM s
        WHERE page_key IN (SELECT page_key FROM s GROUP BY page_key HAVING NOT bool_or(failed) AND NOT bool_and(coalesce(level = 'page', false)))""",
}
