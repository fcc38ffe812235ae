"""Queries of canvas operators: containers, sections, groups and texts over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import canvas, sequence, tables
from tessella.plans.common import PLACE, derived, placed, select_sql, sql_anchors, sql_nearest

_WIDGET = {
    "doc": "l_suppkey % 61", "seq": PLACE, "x": "l_partkey % 40 * 60 + 0.5", "y": "l_orderkey % 50 * 50 + l_linenumber", "w": "60 + l_quantity * 5", "h": "90 + l_linenumber * 25",
    "word": "CASE WHEN l_partkey % 3 > 0 THEN 't' || l_partkey END", "is_picture": "l_suppkey % 3 = 0 AND l_orderkey % 9 = 0", "n_images": "CASE WHEN l_partkey % 6 = 0 THEN 1 ELSE 0 END", "is_table": "l_partkey % 15 = 0",
}


def _widgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived(placed(spark, sf_dir), _WIDGET | {"seq": "place"})
    return rows.withColumn("lines", F.when(F.col("word").isNotNull(), F.array("word", F.lit("z"))))


def canvas_containers(spark, sf_dir):
    """Large widgets without text."""
    return canvas.containers(_widgets(spark, sf_dir)).select("doc", "seq", "x", "y", "w", "h")


def _sections(spark: SparkSession, sf_dir: str):
    rows = _widgets(spark, sf_dir)
    return canvas.sections(rows.filter("NOT is_picture"), rows.filter("is_picture"))


def canvas_sections(spark, sf_dir):
    """Sections around large pictures."""
    return _sections(spark, sf_dir)[0].withColumn("text", F.md5("text"))


def canvas_members(spark, sf_dir):
    """The section of each block."""
    return _sections(spark, sf_dir)[1]


def canvas_groups(spark, sf_dir):
    """Widgets with text by the container that holds them."""
    rows = _widgets(spark, sf_dir).withColumn("x", F.col("x").cast("double"))  # whole steps and a half, exact and quicker to sort than decimals
    return canvas.grouped_content(rows.filter("lines IS NOT NULL"), canvas.containers(rows))


_CELL = {"table_id": "l_orderkey", "seq": PLACE, "x": "l_partkey % 3 * 80", "y": "l_suppkey % 4 * 30", "w": "70", "h": "25", "text": "CASE WHEN l_quantity > 10 THEN 'c' || l_linenumber END", "over": "l_linenumber > 4"}


def table_floats(spark, sf_dir):
    """Cells of each order's table with the texts of widgets over them."""
    rows = derived(placed(spark, sf_dir), _CELL | {"seq": "place"})
    cells, over = rows.filter("NOT over"), rows.filter("over")
    axes = cells.groupBy("table_id").agg(sequence.anchored_clusters(F.array_sort(F.collect_set("y")), tables.ROW_TOLERANCE).alias("ys"), sequence.anchored_clusters(F.array_sort(F.collect_set("x")), tables.COLUMN_TOLERANCE).alias("xs"))
    boxes = canvas.bounding_boxes(cells).withColumn("doc", F.col("table_id"))
    floats = over.filter("text IS NOT NULL").selectExpr("table_id AS doc", "seq", "x + 3 AS x", "y + 2 AS y", "w - 5 AS w", "h - 5 AS h", "array(concat('f', text), 'g') AS lines")
    return canvas.floats_in_cells(tables.grid_cells(cells), axes, boxes, floats)


QUERIES = {f.__name__: f for f in (canvas_containers, canvas_sections, canvas_members, canvas_groups, table_floats)}

_W = f"""
WITH w AS ({select_sql(_WIDGET, "lineitem")}),
  box AS (SELECT doc, seq, CAST(floor(x + 0.5) AS BIGINT) AS x, CAST(floor(y + 0.5) AS BIGINT) AS y, CAST(floor(w + 0.5) AS BIGINT) AS w, CAST(floor(h + 0.5) AS BIGINT) AS h FROM w WHERE word IS NULL AND NOT is_table AND w >= 150 AND h >= 120)"""
_S = _W + """,
  b0 AS (SELECT *, CASE WHEN word IS NULL THEN '' ELSE word || chr(10) || 'z' END AS t, coalesce(length(word) + 1, 0) AS chars FROM w WHERE NOT is_picture AND (word IS NOT NULL OR n_images > 0)),
  a0 AS (SELECT * FROM w WHERE is_picture AND w >= 250 AND h >= 200),
  cut AS (SELECT doc FROM (SELECT doc, count(*) AS n FROM a0 GROUP BY doc) JOIN (SELECT doc, sum(chars) AS chars FROM b0 GROUP BY doc) USING (doc) WHERE n >= 3 OR chars >= 3000),
  b AS (SELECT * FROM b0 WHERE doc IN (SELECT doc FROM cut)), a AS (SELECT * FROM a0 WHERE doc IN (SELECT doc FROM cut)),
  d AS (SELECT b.doc, b.seq, b.x, b.y, b.t, a.seq AS anchor, sqrt(pow(greatest(a.x - (b.x + b.w / 2), 0, b.x + b.w / 2 - a.x - a.w), 2) + pow(greatest(a.y - (b.y + b.h / 2), 0, b.y + b.h / 2 - a.y - a.h), 2)) AS dist
        FROM b JOIN a USING (doc) QUALIFY row_number() OVER (PARTITION BY b.doc, b.seq ORDER BY dist, a.seq) = 1),
  m AS (SELECT doc, seq, x, y, t, CASE WHEN dist <= 400 THEN anchor END AS anchor FROM d),
  g AS (SELECT m.doc, m.anchor, coalesce(string_agg(t, chr(10) ORDER BY m.y, m.x, m.seq) FILTER (t <> ''), '') AS text, coalesce(string_agg(t, chr(10) ORDER BY m.seq) FILTER (t <> ''), '') AS loose, arg_min(m.x, m.seq) AS fx, arg_min(m.y, m.seq) AS fy FROM m GROUP BY ALL),
  s AS (SELECT g.*, a.x, a.y, a.w, a.h, CASE WHEN anchor IS NULL THEN -1 ELSE CAST(row_number() OVER (PARTITION BY g.doc ORDER BY anchor IS NULL, a.y, a.x, anchor) - 1 AS INTEGER) END AS section FROM g LEFT JOIN a ON a.doc = g.doc AND a.seq = g.anchor)"""
_r = lambda own, other: f"CAST(floor(CASE WHEN anchor IS NULL THEN {other} ELSE {own} END + 0.5) AS BIGINT)"

ORACLES = {
    "canvas_containers": _W + " SELECT * FROM box",
    "canvas_sections": _S + f" SELECT doc, section, anchor, {_r('x', 'fx')} AS x, {_r('y', 'fy')} AS y, {_r('w', 0)} AS w, {_r('h', 0)} AS h, md5(CASE WHEN anchor IS NULL THEN loose ELSE text END) AS text, CASE WHEN anchor IS NULL THEN '{canvas.SCATTERED}' END AS heading FROM s",
    "canvas_members": _S + " SELECT m.doc, m.seq, section FROM m JOIN s ON s.doc = m.doc AND s.anchor IS NOT DISTINCT FROM m.anchor",
    "canvas_groups": _W + """,
  i AS (SELECT * FROM w WHERE word IS NOT NULL),
  h AS (SELECT i.doc, i.seq, i.x, i.y, c.seq AS container FROM i LEFT JOIN box c ON c.doc = i.doc AND i.x + i.w / 2 BETWEEN c.x AND c.x + c.w AND i.y + i.h / 2 BETWEEN c.y AND c.y + c.h
        QUALIFY row_number() OVER (PARTITION BY i.doc, i.seq ORDER BY c.w * c.h, c.seq) = 1)
  SELECT doc, container, seq, CAST(row_number() OVER (PARTITION BY doc, container ORDER BY y, x, seq) - 1 AS INTEGER) AS place FROM h""",
    "table_floats": f"""
WITH r AS ({select_sql(_CELL, "lineitem")}), c AS (SELECT * FROM r WHERE NOT over),
  k AS (SELECT table_id, {sql_anchors('list(y)', tables.ROW_TOLERANCE)} AS ys, {sql_anchors('list(x)', tables.COLUMN_TOLERANCE)} AS xs, min(x) AS x0, min(y) AS y0, max(x + w) AS x1, max(y + h) AS y1 FROM c GROUP BY table_id),
  g AS (SELECT table_id, CAST({sql_nearest('ys', 'y')} AS INTEGER) AS "row", CAST({sql_nearest('xs', 'x')} AS INTEGER) AS col, arg_max_null(text, seq) AS text FROM c JOIN k USING (table_id) GROUP BY ALL),
  f AS (SELECT table_id, CAST({sql_nearest('ys', '(y + 2 + (h - 5) / 2)')} AS INTEGER) AS "row", CAST({sql_nearest('xs', '(x + 3 + (w - 5) / 2)')} AS INTEGER) AS col, string_agg('f' || text || '<br>g', ' / ' ORDER BY seq) AS t
        FROM (SELECT * FROM r WHERE over AND text IS NOT NULL) JOIN k USING (table_id) WHERE x + 3 >= x0 - 6 AND y + 2 >= y0 - 6 AND x + w - 2 <= x1 + 6 AND y + h - 3 <= y1 + 6 GROUP BY ALL)
  SELECT table_id, "row", col, CASE WHEN coalesce(g.text, '') <> '' THEN g.text ELSE coalesce(f.t, g.text) END AS text FROM g FULL JOIN f USING (table_id, "row", col)""",
}
