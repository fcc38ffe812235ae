"""Queries of form panels and of regions rendered in reading order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import canvas, geometry, panels, regions
from tessella.plans.common import PLACE, derived, placed, select_sql, sql_anchors, table

#: Widgets of a supplier's line items: columns of boxes, windows that overlap, texts between them.
_WIDGET = {
    "doc": "l_suppkey", "seq": PLACE, "x": "l_partkey % 12 * 150 + l_linenumber % 3 * 3 + CASE WHEN l_partkey % 12 > 6 THEN 1500 ELSE 0 END", "y": "l_orderkey % 40 * 17",
    "w": "CAST(l_quantity * 3 + 57 AS BIGINT)", "h": "l_linenumber * 4 + 8", "word": "CASE WHEN l_orderkey % 4 > 0 THEN 't' || l_partkey END",
    "outer_group": "l_linenumber = 7", "inner_group": "l_linenumber = 7 AND l_partkey % 2 = 0", "small_group": "l_linenumber = 6 AND l_partkey % 150 = 0",
}
_GROUPS = (("outer_group", -2), ("inner_group", -1), ("small_group", -3))


def _widgets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = derived(placed(spark, sf_dir), _WIDGET | {"seq": "place"}).withColumn("lines", F.when(F.col("word").isNotNull(), F.array("word", F.lit("z"))))
    ids = F.explode(F.array_compact(F.array(*[F.when(F.col(name), F.lit(group).cast("bigint")) for name, group in _GROUPS])))
    groups = rows.select("doc", ids.alias("group"), "seq")
    frames = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS doc", "explode(array(-1L, -2L, -3L)) AS seq").selectExpr("doc", "seq", "10 AS x", "20.5D AS y", "300 AS w", "40 AS h", "CAST(NULL AS array<string>) AS lines")
    return rows.select(*frames.columns).unionByName(frames), groups


def form_panels(spark, sf_dir):
    """Panels of each supplier's canvas as tables of fields and contents."""
    found = panels.form_panels(*_widgets(spark, sf_dir))
    rows = F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "\n")
    return found.select("doc", "group", "col", "x", "y", "w", "h", F.size("rows").alias("n_rows"), F.md5(rows).alias("rows"))


#: Items of a canvas: texts of one to two lines that repeat beside each other, panels, and grounds without text.
_ITEM = {
    "doc": "l_suppkey % 61", "seq": PLACE, "x": "l_partkey % 40 * 60 + 0.5", "y": "l_orderkey % 50 * 50 + l_linenumber * 3", "w": "60 + l_quantity * 5", "h": "90 + l_linenumber * 25",
    "kind": "l_partkey % 4", "a": "'t' || (l_linenumber % 2)", "b": "CASE WHEN l_suppkey % 2 = 0 THEN 'u' || (l_orderkey % 3) ELSE '' END", "is_panel": "l_partkey % 37 = 0",
}


def region_render(spark, sf_dir):
    """Each canvas as lines in reading order, by its containers."""
    rows = derived(placed(spark, sf_dir), _ITEM | {"seq": "place"})
    made = rows.withColumn("is_table", F.lit(False)).withColumn("lines", F.when(F.col("kind") == 1, F.array("a")).when(F.col("kind") == 2, F.array("b", "a")).when(F.col("kind") == 3, F.array("b")))
    panel = F.when(F.col("is_panel"), F.array(F.array("a", "b"), F.array(F.lit("g"), F.lit("h"))))
    items = made.withColumn("panel", panel).filter("kind > 0 OR is_panel")
    boxes = geometry.outer_containers(canvas.containers(made.filter("kind = 0 AND NOT is_panel")))
    return regions.rendered_regions(items, boxes)


QUERIES = {f.__name__: f for f in (form_panels, region_render)}

_PANELS = f"""
WITH RECURSIVE w AS ({select_sql(_WIDGET, "lineitem")}),
  t AS (SELECT * FROM w WHERE word IS NOT NULL),
  gr AS (SELECT doc, seq, CASE WHEN outer_group THEN -2 WHEN inner_group THEN -1 WHEN small_group THEN -3 END AS g, y, x, word FROM t),
  gp AS (SELECT doc, g FROM gr WHERE g IS NOT NULL GROUP BY doc, g HAVING count(*) >= 4 AND len({sql_anchors('list(y)', 14)}) >= 4),
  gm AS (SELECT gr.* FROM gr JOIN gp USING (doc, g)),
  b AS (SELECT * FROM w WHERE word IS NULL AND w BETWEEN 60 AND 200 AND h BETWEEN 14 AND 80),
  lx AS (SELECT doc, x, lag(x) OVER (PARTITION BY doc ORDER BY x) AS p FROM (SELECT DISTINCT doc, x FROM b)),
  co AS (SELECT doc, x, last_value(CASE WHEN p IS NULL OR x - p > 6 THEN x END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY x ROWS UNBOUNDED PRECEDING) AS col FROM lx),
  win AS (SELECT doc, col, min(x) - 110 AS x0, min(y) - 30 AS y0, max(x + w) + 220 AS x1, max(y + h) + 70 AS y1, row_number() OVER (PARTITION BY doc ORDER BY col) AS k
          FROM b JOIN co USING (doc, x) WHERE x - col <= 6 GROUP BY doc, col HAVING count(*) >= 4),
  cand AS (SELECT win.doc, k, list({{'seq': t.seq, 'y': t.y}} ORDER BY t.y) FILTER (t.seq IS NOT NULL) AS m
           FROM win LEFT JOIN (SELECT * FROM t ANTI JOIN gm USING (doc, seq)) t ON t.doc = win.doc AND t.x + t.w / 2 BETWEEN x0 AND x1 AND t.y + t.h / 2 BETWEEN y0 AND y1 GROUP BY win.doc, k),
  st AS (SELECT DISTINCT doc, 0::BIGINT AS k, []::BIGINT[] AS taken, []::BIGINT[] AS got FROM win
         UNION ALL
         SELECT doc, k, CASE WHEN ok THEN list_concat(taken, ids) ELSE taken END, CASE WHEN ok THEN ids ELSE [] END FROM (
           SELECT doc, k, taken, list_transform(fresh, lambda e: e.seq) AS ids, CASE WHEN len(fresh) >= 4 THEN len({sql_anchors('list_transform(fresh, lambda e: e.y)', 14)}) >= 4 ELSE false END AS ok FROM (
             SELECT s.doc, c.k, s.taken, list_filter(c.m, lambda e: NOT list_contains(s.taken, e.seq)) AS fresh FROM st s JOIN cand c ON c.doc = s.doc AND c.k = s.k + 1))),
  cm AS (SELECT st.doc, win.col, unnest(got) AS seq FROM st JOIN win USING (doc, k)),
  mem AS (SELECT doc, g AS "group", NULL::BIGINT AS col, seq, y, x, word FROM gm UNION ALL SELECT cm.doc, NULL, cm.col, cm.seq, t.y, t.x, t.word FROM cm JOIN t USING (doc, seq)),
  ax AS (SELECT doc, "group", col, {sql_anchors('list(y)', 14)} AS ys FROM mem GROUP BY ALL),
  en AS (SELECT mem.doc, mem."group", mem.col, list_max(list_filter(ys, lambda a: a <= mem.y)) AS band, mem.y, mem.x, mem.seq, word || '<br>z' AS t
         FROM mem JOIN ax ON ax.doc = mem.doc AND ax."group" IS NOT DISTINCT FROM mem."group" AND ax.col IS NOT DISTINCT FROM mem.col),
  ro AS (SELECT doc, "group", col, band, list(t ORDER BY y, x, seq) AS e FROM en GROUP BY ALL),
  pa AS (SELECT doc, "group", col, count(*) AS n, string_agg(CASE WHEN len(e) > 1 THEN e[1] || '|' || array_to_string(e[2:], ' / ') ELSE e[1] END, chr(10) ORDER BY band) AS txt FROM ro GROUP BY ALL)
SELECT pa.doc, "group", pa.col, CASE WHEN "group" IS NULL THEN x0 ELSE 10 END AS x, CASE WHEN "group" IS NULL THEN y0 ELSE 21 END AS y, CASE WHEN "group" IS NULL THEN x1 - x0 ELSE 300 END AS w,
  CASE WHEN "group" IS NULL THEN y1 - y0 ELSE 40 END AS h, CAST(n AS INTEGER) AS n_rows, md5(txt) AS rows FROM pa LEFT JOIN win ON win.doc = pa.doc AND win.col = pa.col
"""

_REGIONS = f"""
WITH i0 AS ({select_sql(_ITEM, "lineitem")}),
  k0 AS (SELECT doc, seq, CAST(floor(x + 0.5) AS BIGINT) AS x, CAST(floor(y + 0.5) AS BIGINT) AS y, CAST(floor(w + 0.5) AS BIGINT) AS w, CAST(floor(h + 0.5) AS BIGINT) AS h FROM i0 WHERE kind = 0 AND NOT is_panel AND w >= 150 AND h >= 120),
  k AS (SELECT * FROM k0 c WHERE NOT EXISTS (SELECT 1 FROM k0 o WHERE o.doc = c.doc AND o.w * o.h > c.w * c.h AND o.x - 2 <= c.x AND o.y - 2 <= c.y AND o.x + o.w + 2 >= c.x + c.w AND o.y + o.h + 2 >= c.y + c.h)),
  it AS (SELECT *, list_filter(CASE kind WHEN 1 THEN [a] WHEN 2 THEN [b, a] WHEN 3 THEN [b] END, lambda t: t <> '') AS ls FROM i0 WHERE kind > 0 OR is_panel),
  ho AS (SELECT it.doc, it.seq, k.seq AS c FROM it LEFT JOIN k ON k.doc = it.doc AND it.x + it.w / 2 BETWEEN k.x AND k.x + k.w AND it.y + it.h / 2 BETWEEN k.y AND k.y + k.h
         QUALIFY row_number() OVER (PARTITION BY it.doc, it.seq ORDER BY k.w * k.h, k.seq) = 1),
  p AS (SELECT it.*, c, sum(CASE WHEN is_panel THEN 1 ELSE 0 END) OVER (PARTITION BY it.doc, c ORDER BY y, x, it.seq ROWS UNBOUNDED PRECEDING) AS sg FROM it JOIN ho USING (doc, seq)),
  tx AS (SELECT * FROM p WHERE NOT is_panel AND len(ls) > 0),
  ax AS (SELECT doc, c, sg, {sql_anchors('list(y)', 12)} AS ys FROM tx GROUP BY ALL),
  bd AS (SELECT tx.*, list_max(list_filter(ys, lambda v: v <= tx.y)) AS band FROM tx JOIN ax ON ax.doc = tx.doc AND ax.sg = tx.sg AND ax.c IS NOT DISTINCT FROM tx.c),
  un AS (SELECT * FROM bd QUALIFY row_number() OVER (PARTITION BY doc, c, sg, band, array_to_string(ls, '|') ORDER BY y, x, seq) = 1),
  ex AS (SELECT doc, c, sg, band, x, y, seq, unnest(range(len(ls))) AS r, unnest(ls) AS t FROM un),
  li AS (SELECT doc, c, sg, 1 AS late, band, r, string_agg(t, ' ｜ ' ORDER BY x, y, seq) AS t FROM ex GROUP BY ALL
         UNION ALL SELECT doc, c, sg, 0, 0, 0, '【表单】' || a || CASE WHEN b <> '' THEN '：' || b ELSE '' END || ' ｜ g：h' FROM p WHERE is_panel),
  lg AS (SELECT *, CASE WHEN t IS DISTINCT FROM lag(t) OVER (PARTITION BY doc, c ORDER BY sg, late, band, r) THEN 1 ELSE 0 END AS ch FROM li),
  isl AS (SELECT *, sum(ch) OVER (PARTITION BY doc, c ORDER BY sg, late, band, r ROWS UNBOUNDED PRECEDING) AS n FROM lg),
  fin AS (SELECT doc, c, n, any_value(t) || CASE WHEN count(*) > 1 THEN ' ×' || count(*) ELSE '' END AS t FROM isl GROUP BY doc, c, n),
  rg AS (SELECT p.doc, p.c, any_value(k.x) AS x, any_value(k.y) AS y, any_value(k.w) AS w, any_value(k.h) AS h FROM p LEFT JOIN k ON k.doc = p.doc AND k.seq = p.c GROUP BY p.doc, p.c),
  no AS (SELECT *, CASE WHEN c IS NULL THEN 2 ELSE 1 END AS part, CASE WHEN c IS NULL THEN 0 ELSE row_number() OVER (PARTITION BY doc, c IS NULL ORDER BY y, x, c) END AS grp FROM rg)
SELECT DISTINCT doc, 0 AS part, 0 AS "group", 0::BIGINT AS line_no, '{regions.CANVAS_TITLE}' AS line FROM rg
UNION ALL SELECT doc, part, CAST(grp AS INTEGER), 0, CASE WHEN c IS NULL THEN '{regions.FREE_TITLE}' ELSE '##### 内容组 ' || grp || '（x ' || x || '~' || (x + w) || '，y ' || y || '~' || (y + h) || '，界面容器）' END FROM no
UNION ALL SELECT no.doc, part, CAST(grp AS INTEGER), CAST(n AS BIGINT), '- ' || t FROM fin JOIN no ON no.doc = fin.doc AND no.c IS NOT DISTINCT FROM fin.c
"""

ORACLES = {"form_panels": _PANELS, "region_render": _REGIONS}
