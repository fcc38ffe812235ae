"""Queries of the rectangle, layer and table operators, over rectangles derived from line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import geometry, layers, sequence, tables
from tessella.plans.common import PLACE, RECT_SQL, SEQ, derived, placed, rects, select_sql, sql_anchors, sql_nearest, table
from tessella.sources import design


def occlusion_anti_join(spark, sf_dir):
    """Layers that stay visible."""
    return geometry.visible_layers(rects(spark, sf_dir)).select("doc", "seq", "x", "y", "w", "h")


def outer_containers(spark, sf_dir):
    """Rectangles in no larger one."""
    return geometry.outer_containers(rects(spark, sf_dir)).select("doc", "seq", "x", "y", "w", "h")


def _two(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    r = rects(spark, sf_dir)
    return r.filter("type = 'rect'"), r.filter("type <> 'rect'")


def containment_argmin(spark, sf_dir):
    """The smallest container of each item."""
    boxes, items = _two(spark, sf_dir)
    return geometry.smallest_container(items, boxes)


def nearest_anchor(spark, sf_dir):
    """The nearest anchor within 60."""
    anchors, blocks = _two(spark, sf_dir)
    found = geometry.nearest_anchor(blocks, anchors, radius=60)
    return found.select("doc", "seq", "anchor", F.round("distance", 6).alias("distance"))


def title_inference(spark, sf_dir):
    """The text right above each table."""
    shapes, texts = _two(spark, sf_dir)
    named = texts.withColumn("text", F.concat(F.lit("t"), F.col("seq").cast("string")))
    return geometry.inferred_titles(shapes, named)


def grid_cells(spark, sf_dir):
    """Cells of the scroll grid that show something."""
    pages = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS doc", "CAST(200 + o_orderkey % 300 AS BIGINT) AS content_w", "CAST(220 + o_orderkey % 170 AS BIGINT) AS content_h", "CAST(150 AS BIGINT) AS view_w", "CAST(200 AS BIGINT) AS view_h")
    return geometry.needed_cells(rects(spark, sf_dir), pages)


def anchored_cluster(spark, sf_dir):
    """Clusters of an order's quantities."""
    found = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(sequence.anchored_clusters(F.collect_set(F.col("l_quantity").cast("long")), 3).alias("a"))
    return found.select("l_orderkey", F.array_join(F.transform("a", lambda v: v.cast("string")), ",").alias("anchors"))


_FRAGMENT = {
    "doc": "l_orderkey % 97", "parent_path": "CAST(l_suppkey % 5 AS STRING)", "seq": PLACE,
    "x": "CAST(l_orderkey % 500 * 3 + l_linenumber AS BIGINT)", "y": "CAST(l_partkey % 7 * 10 AS BIGINT)", "w": "CAST(1 + l_quantity AS BIGINT)", "h": "CAST(l_linenumber + 2 AS BIGINT)",
}


def run_chain_fragments(spark, sf_dir):
    """Chains of small rectangles."""
    return geometry.fragment_chains(derived(placed(spark, sf_dir), _FRAGMENT | {"seq": "place"}), ["doc", "parent_path"])


def reading_lines(spark, sf_dir):
    """Items in reading order, a line for each band."""
    items = rects(spark, sf_dir).selectExpr("doc", "seq", "x", "y", "concat(type, '-', CAST(w AS STRING)) AS text")
    return geometry.reading_lines(items)


def connector_edges(spark, sf_dir):
    """Connectors snapped to nodes."""
    nodes, lines = _two(spark, sf_dir)
    ends = lines.selectExpr("doc", "seq", "x AS sx1", "y AS sy1", "x AS sx2", "y + h AS sy2", "x + w AS ex1", "y AS ey1", "x + w AS ex2", "y + h AS ey2")
    return geometry.connector_edges(ends, nodes)


def connector_nodes(spark, sf_dir):
    """The nodes that connectors link."""
    return geometry.linked_nodes(_two(spark, sf_dir)[0].select("doc", "seq"), connector_edges(spark, sf_dir))


_LAYER = {"name": "'n' || l_linenumber", "text": "CASE WHEN l_suppkey % 9 = 0 THEN 'words' END", "parent_path": "CASE WHEN l_partkey % 2 = 0 THEN 'Panel' END", "canvas_w": "CAST(240 AS BIGINT)", "canvas_h": "CAST(190 AS BIGINT)"}


def _layer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.plans.common import RECT

    return derived(table(spark, sf_dir, "lineitem"), RECT | _LAYER)


def layer_clean(spark, sf_dir):
    """Layers after all cleaning passes."""
    return layers.clean_layers(_layer_rows(spark, sf_dir))[0].select("doc", "seq")


def layer_counters(spark, sf_dir):
    """What each cleaning pass took away."""
    return layers.clean_layers(_layer_rows(spark, sf_dir))[1]


def _json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested design files built from each order's line items."""
    item = lambda s: F.struct(
        F.when(s["l_partkey"] % 10 == 0, "old backup").when(s["l_partkey"] % 10 == 1, "Rectangle 12").when(s["l_partkey"] % 10 == 2, "union").otherwise(F.concat(F.lit("item "), s["l_linenumber"].cast("string"))).alias("name"),
        (s["l_partkey"] % 10 != 3).alias("visible"), F.lit("shape").alias("type"),
        F.struct((s["l_partkey"] % 50 * 5 + 0.5).alias("left"), (s["l_suppkey"] % 40 * 5).alias("top"), (s["l_quantity"] * 4).alias("width"), F.lit(20).alias("height")).alias("frame"),
        F.struct(F.array(F.struct(F.struct(F.lit("rgba(10,20,30,1)").alias("value"), F.when(s["l_linenumber"] > 1, F.lit(0.5)).alias("a")).alias("color"))).alias("fills")).alias("style"),
        F.array(F.struct(F.lit("child").alias("name"), F.lit("text").alias("type"), F.lit("hi").alias("text"), F.struct(F.lit(1).alias("x"), F.lit(2).alias("y"), F.lit(3).alias("width"), F.lit(4).alias("height")).alias("frame"))).alias("layers"),
    )
    # The few columns of an item are sorted and shuffled, not the nested items made of them.
    raw = F.struct(F.expr(SEQ).alias("k"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    listed = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doc")).agg(F.sort_array(F.collect_list(raw)).alias("l"))
    panel = F.struct(F.lit("Panel").alias("name"), F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(300).alias("width"), F.lit(200).alias("height")).alias("frame"), F.transform("l", item).alias("layers"))
    board = F.struct(F.struct(F.lit(300).alias("width"), F.lit(200).alias("height")).alias("frame"), F.array(panel).alias("layers"))
    return listed.select("doc", F.to_json(F.struct(board.alias("artboard"))).alias("json"))


def design_layers(spark, sf_dir):
    """Layers of nested design files."""
    found = design.design_layers(design.design_nodes(_json_files(spark, sf_dir)))
    return found.select("doc", "seq", "name", "type", "x", "y", "w", "h", "fill", "parent_path", "text")


_CELL = {"table_id": "l_orderkey", "x": "CAST(l_partkey % 4 * 30 + l_suppkey % 3 AS BIGINT)", "y": "CAST(l_suppkey % 3 * 10 + l_partkey % 2 AS BIGINT)", "seq": SEQ, "text": "CASE WHEN l_quantity < 25 THEN '' ELSE 'q' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR(9)) END"}


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = dict(_CELL, text="CASE WHEN l_quantity < 25 THEN '' ELSE concat('q', CAST(CAST(l_quantity AS BIGINT) AS STRING)) END")
    return tables.grid_cells(derived(table(spark, sf_dir, "lineitem"), cells))


def table_grid(spark, sf_dir):
    """Cells placed in rows and columns."""
    return _placed(spark, sf_dir)


def table_grid_pruned(spark, sf_dir):
    """Grids without blank rows and columns."""
    return tables.pruned_grid(_placed(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    occlusion_anti_join, outer_containers, containment_argmin, nearest_anchor, title_inference, grid_cells, anchored_cluster,
    run_chain_fragments, reading_lines, connector_edges, connector_nodes, layer_clean, layer_counters, design_layers, table_grid, table_grid_pruned,
)}

_R = f"WITH r AS ({RECT_SQL}), a AS (SELECT * FROM r WHERE type = 'rect'), b AS (SELECT * FROM r WHERE type <> 'rect')"
_OPAQUE = "(regexp_matches(o.fill, '^#[0-9a-fA-F]{6}$') OR regexp_matches(o.fill, '^rgba\\(\\d+,\\s*\\d+,\\s*\\d+,\\s*1\\)$'))"
_COVERED = f"o.doc = i.doc AND o.seq > i.seq AND o.type <> 'text' AND {_OPAQUE} AND o.x <= i.x AND o.y <= i.y AND o.x + o.w >= i.x + i.w AND o.y + o.h >= i.y + i.h"
_EXEMPT = "(i.type = 'text' OR i.is_slice OR i.image_url IS NOT NULL)"


def _fragment_sql(source: str, keys: str) -> str:
    """Chains in ``source`` whose bands are equal ``y`` (the data's bands lie more than two apart)."""
    return f"""
      p AS (SELECT *, lag(x + w) OVER (PARTITION BY {keys}, y ORDER BY x, seq) AS prior, count(*) OVER (PARTITION BY {keys}, y) AS band_n FROM {source} WHERE w <= 24 AND h <= 8),
      q AS (SELECT *, sum(CASE WHEN abs(x - prior) <= 6 THEN 0 ELSE 1 END) OVER (PARTITION BY {keys}, y ORDER BY x, seq) AS run FROM p),
      z AS (SELECT *, count(*) OVER (PARTITION BY {keys}, y, run) AS n, max(w) OVER (PARTITION BY {keys}, y, run) / min(w) OVER (PARTITION BY {keys}, y, run) AS ratio FROM q),
      chain AS (SELECT * FROM z WHERE n >= 4 AND band_n >= 4 AND ratio >= 1.3)"""


_CLEAN = f"""
WITH r AS (SELECT *, CASE WHEN type = 'text' THEN 'words' END AS text, CASE WHEN seq // 10000000 % 2 = 0 THEN 'Panel' END AS parent_path FROM ({RECT_SQL})),
s1 AS (SELECT * FROM r WHERE NOT (x + w <= 0 OR y + h <= 0 OR x >= 240 OR y >= 190)),
s2 AS (SELECT * FROM s1 QUALIFY row_number() OVER (PARTITION BY doc, is_slice, x, y, w, h, CASE WHEN NOT is_slice THEN concat_ws(':', type, fill, coalesce(parent_path, '-'), coalesce(image_url, '-'), coalesce(text, '-')) END ORDER BY (type = 'image') DESC, seq DESC) = 1),
s3 AS (SELECT * FROM s2 i WHERE {_EXEMPT} OR NOT EXISTS (SELECT 1 FROM s2 o WHERE {_COVERED})),
s4 AS (SELECT * FROM s3 i WHERE {_EXEMPT} OR greatest(least(x + w, 240) - greatest(x, 0), 0) * greatest(least(y + h, 190) - greatest(y, 0), 0) / (w * h)::DOUBLE >= 0.25),
f0 AS (SELECT * FROM s4 i WHERE NOT {_EXEMPT} AND parent_path IS NOT NULL), {_fragment_sql('f0', 'doc, parent_path')},
s5 AS (SELECT * FROM s4 WHERE NOT EXISTS (SELECT 1 FROM chain c WHERE c.doc = s4.doc AND c.seq = s4.seq))"""

_AXES = f"SELECT table_id, {sql_anchors('list(y)', 2)} AS ys, {sql_anchors('list(x)', 3)} AS xs FROM c GROUP BY table_id"
_GRID = f"""
WITH c AS ({select_sql(_CELL, 'lineitem')}), axes AS ({_AXES}),
g AS (SELECT table_id, CAST({sql_nearest('ys', 'y')} AS INTEGER) AS "row", CAST({sql_nearest('xs', 'x')} AS INTEGER) AS col, seq, text FROM c JOIN axes USING (table_id)),
grid AS (SELECT table_id, "row", col, arg_max(text, seq) AS text FROM g GROUP BY ALL)"""

_CONNECT = _R + """, e AS (SELECT doc, seq AS c, unnest([{'i': 0, 's': 's', 'px': x, 'py': y}, {'i': 1, 's': 's', 'px': x, 'py': y + h}, {'i': 2, 's': 'e', 'px': x + w, 'py': y}, {'i': 3, 's': 'e', 'px': x + w, 'py': y + h}]) AS p FROM b),
        d AS (SELECT e.doc, c, p.i AS i, p.s AS s, a.seq AS n, sqrt(pow(greatest(a.x - p.px, 0, p.px - a.x - a.w), 2) + pow(greatest(a.y - p.py, 0, p.py - a.y - a.h), 2)) AS dist FROM e JOIN a USING (doc) WHERE doc IN (SELECT doc FROM a GROUP BY doc HAVING count(*) >= 3)),
        k AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY doc, c, i ORDER BY dist, n) = 1),
        m AS (SELECT u.doc, u.c, u.n AS f, v.n AS t FROM k u JOIN k v ON u.doc = v.doc AND u.c = v.c AND u.s = 's' AND v.s = 'e' AND u.n <> v.n AND u.dist <= 60 AND v.dist <= 60
              QUALIFY row_number() OVER (PARTITION BY u.doc, u.c ORDER BY u.dist + v.dist, u.i, v.i) = 1),
        x AS (SELECT doc, f AS "from", t AS "to", min(c) AS c_seq FROM m GROUP BY ALL),
        ce AS (SELECT * FROM x WHERE doc IN (SELECT doc FROM x GROUP BY doc HAVING count(*) >= 2))"""
ORACLES = {
    "occlusion_anti_join": f"WITH r AS ({RECT_SQL}) SELECT doc, seq, x, y, w, h FROM r i WHERE {_EXEMPT} OR NOT EXISTS (SELECT 1 FROM r o WHERE {_COVERED})",
    "outer_containers": f"WITH r AS ({RECT_SQL}) SELECT doc, seq, x, y, w, h FROM r i WHERE NOT EXISTS (SELECT 1 FROM r o WHERE o.doc = i.doc AND o.w * o.h > i.w * i.h AND o.x - 2 <= i.x AND o.y - 2 <= i.y AND o.x + o.w + 2 >= i.x + i.w AND o.y + o.h + 2 >= i.y + i.h)",
    "containment_argmin": _R + " SELECT b.doc, b.seq, arg_min(a.seq, a.w * a.h * 1000000000000000::HUGEINT + a.seq) AS container FROM b LEFT JOIN a ON a.doc = b.doc AND b.x + b.w / 2 BETWEEN a.x AND a.x + a.w AND b.y + b.h / 2 BETWEEN a.y AND a.y + a.h GROUP BY b.doc, b.seq",
    "nearest_anchor": _R + """, d AS (SELECT b.doc, b.seq, a.seq AS a_seq, greatest(a.x - (b.x + b.w / 2), 0, b.x + b.w / 2 - (a.x + a.w)) AS dx, greatest(a.y - (b.y + b.h / 2), 0, b.y + b.h / 2 - (a.y + a.h)) AS dy FROM b LEFT JOIN a USING (doc)),
        n AS (SELECT *, sqrt(dx * dx + dy * dy) AS dist, row_number() OVER (PARTITION BY doc, seq ORDER BY sqrt(dx * dx + dy * dy), a_seq) AS nth FROM d)
        SELECT doc, seq, CASE WHEN dist <= 60 THEN a_seq END AS anchor, CASE WHEN dist <= 60 AND a_seq IS NOT NULL THEN round(dist, 6) END AS distance FROM n WHERE nth = 1""",
    "title_inference": _R + """ SELECT a.doc, a.seq, arg_min('t' || b.seq, (a.y - b.y - b.h) * 1000000000000000::HUGEINT + b.seq) AS title FROM a LEFT JOIN b ON a.doc = b.doc AND least(b.x + b.w, a.x + a.w) - greatest(b.x, a.x) >= least(a.w * 0.2, 80.0)
        AND b.y + b.h <= a.y + 30 AND a.y - (b.y + b.h) <= 120 GROUP BY a.doc, a.seq""",
    "grid_cells": f"""WITH r AS ({RECT_SQL}), p AS (SELECT o_orderkey AS doc, 200 + o_orderkey % 300 AS cw, 220 + o_orderkey % 170 AS ch FROM orders),
        g AS (SELECT *, list_concat(CASE WHEN cw > 150 THEN range(0, cw - 150, 100) ELSE [] END, [greatest(cw - 150, 0)]) AS xs, list_concat(CASE WHEN ch > 200 THEN range(0, ch - 200, 100) ELSE [] END, [greatest(ch - 200, 0)]) AS ys FROM p),
        c AS (SELECT doc, cw, ch, xs, ys, xi, unnest(range(len(ys))) AS yi FROM (SELECT *, unnest(range(len(xs))) AS xi FROM g))
        SELECT DISTINCT c.doc, CAST(yi * len(xs) + xi AS INTEGER) AS cell FROM c JOIN r ON r.doc = c.doc AND r.x + r.w > xs[xi + 1] AND r.x < least(xs[xi + 1] + 150, cw) AND r.y + r.h > ys[yi + 1] AND r.y < least(ys[yi + 1] + 200, ch)""",
    "anchored_cluster": f"SELECT l_orderkey, array_to_string({sql_anchors('list(CAST(l_quantity AS BIGINT))', 3)}, ',') AS anchors FROM lineitem GROUP BY l_orderkey",
    "run_chain_fragments": f"WITH f AS ({select_sql(_FRAGMENT, 'lineitem')}), {_fragment_sql('f', 'doc, parent_path')} SELECT doc, parent_path, seq, x, y, w, h FROM chain",
    "reading_lines": f"""WITH r AS (SELECT doc, seq, x, y, type || '-' || w AS text FROM ({RECT_SQL})), k AS (SELECT doc, {sql_anchors('list(y)', 12)} AS ys FROM r GROUP BY doc),
        b AS (SELECT r.*, list_max(list_filter(ys, lambda v: v <= y)) AS band FROM r JOIN k USING (doc)),
        o AS (SELECT doc, band, text, x, y, seq FROM b QUALIFY row_number() OVER (PARTITION BY doc, band, text ORDER BY y, x, seq) = 1)
        SELECT doc, band, string_agg(text, ' ｜ ' ORDER BY x, y, seq) AS line FROM o GROUP BY doc, band""",
    "connector_edges": _CONNECT + ' SELECT doc, "from", "to", c_seq FROM ce',
    "connector_nodes": _CONNECT + ' SELECT DISTINCT doc, "from" AS seq FROM ce UNION SELECT DISTINCT doc, "to" FROM ce',
    "layer_clean": _CLEAN + " SELECT doc, seq FROM s5",
    "layer_counters": _CLEAN + """, n AS (SELECT doc, 0 AS k FROM r UNION ALL SELECT doc, 1 FROM s1 UNION ALL SELECT doc, 2 FROM s2 UNION ALL SELECT doc, 3 FROM s3 UNION ALL SELECT doc, 4 FROM s4 UNION ALL SELECT doc, 5 FROM s5),
        t AS (SELECT doc, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS b, count(*) FILTER (k = 2) AS c, count(*) FILTER (k = 3) AS d, count(*) FILTER (k = 4) AS e, count(*) FILTER (k = 5) AS f FROM n GROUP BY doc)
        SELECT doc, a AS n_input, a - b AS n_outside, b - c AS n_repeated, c - d AS n_occluded, d - e AS n_sliver, e - f AS n_fragment, f AS n_kept FROM t""",
    "design_layers": f"""
        WITH i AS (SELECT l_orderkey AS doc, *, (row_number() OVER (PARTITION BY l_orderkey ORDER BY {SEQ}) - 1) * 2 + 1 AS s FROM lineitem),
        k AS (SELECT * FROM i WHERE l_partkey % 10 NOT IN (0, 3)),
        own AS (SELECT doc, s AS seq, CASE WHEN l_partkey % 10 IN (1, 2) THEN CASE WHEN l_partkey % 10 = 1 THEN 'Rectangle 12' END ELSE 'item ' || l_linenumber END AS name, 'rect' AS type,
          CAST(floor(l_partkey % 50 * 5 + 1.0) AS BIGINT) AS x, CAST(l_suppkey % 40 * 5 AS BIGINT) AS y, CAST(l_quantity * 4 AS BIGINT) AS w, CAST(20 AS BIGINT) AS h,
          CASE WHEN l_linenumber > 1 THEN 'rgba(10,20,30,0.5)' ELSE '#0a141e' END AS fill, 'Panel' AS parent_path, NULL AS text FROM k),
        kid AS (SELECT doc, s + 1 AS seq, 'child' AS name, 'text' AS type, 1 AS x, 2 AS y, 3 AS w, 4 AS h, NULL AS fill, CASE WHEN l_partkey % 10 = 1 THEN 'Panel/Rectangle 12' ELSE 'Panel/item ' || l_linenumber END AS parent_path, 'hi' AS text FROM k WHERE l_partkey % 10 <> 2)
        SELECT * FROM own UNION ALL SELECT * FROM kid""",
    "table_grid": _GRID + ' SELECT table_id, "row", col, text FROM grid',
    "table_grid_pruned": _GRID + """, rk AS (SELECT DISTINCT table_id, "row" FROM grid WHERE text <> ''), dk AS (SELECT DISTINCT table_id, col FROM grid WHERE text <> '' AND "row" > 0),
        ck AS (SELECT * FROM dk UNION ALL SELECT DISTINCT table_id, col FROM grid WHERE table_id NOT IN (SELECT table_id FROM dk)),
        rn AS (SELECT *, CAST(row_number() OVER (PARTITION BY table_id ORDER BY "row") - 1 AS INTEGER) AS nr FROM rk), cn AS (SELECT *, CAST(row_number() OVER (PARTITION BY table_id ORDER BY col) - 1 AS INTEGER) AS nc, count(*) OVER (PARTITION BY table_id) AS width FROM ck)
        SELECT grid.table_id, nr AS "row", nc AS col, text FROM grid JOIN rn ON rn.table_id = grid.table_id AND rn."row" = grid."row" JOIN cn ON cn.table_id = grid.table_id AND cn.col = grid.col WHERE width >= 2""",
}
