"""Queries of layer styles, slices and pruned subtrees of design files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import layers, style
from tessella.plans.common import table
from tessella.sources import design

# A design file for each part: a panel that may be hidden, a backup or a boolean operation, and a layer in it.
_FILE = """
'{"artboard":{"frame":{"width":300,"height":200},"layers":[{"name":"' || CASE p_partkey % 5 WHEN 0 THEN 'Panel' WHEN 1 THEN 'old backup' WHEN 2 THEN 'union 2' ELSE 'Group 7' END
|| '","visible":' || CASE WHEN p_partkey % 7 = 0 THEN 'false' ELSE 'true' END || ',"layers":[{"name":"box","type":"' || CASE WHEN p_partkey % 4 = 3 THEN 'textLayer' ELSE 'shape' END
|| '","frame":{"left":' || (p_size + 0.5) || ',"top":2,"width":' || p_size || '.4,"height":9.5},"opacity":' || CASE p_partkey % 3 WHEN 0 THEN '0.5' WHEN 1 THEN '1' ELSE 'null' END
|| CASE WHEN p_partkey % 6 = 1 THEN ',"hasExportImage":true,"image":{"imageUrl":"https://x/' || p_partkey || '.png"}' ELSE '' END
|| ',"style":{"fills":[' || CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN '{"type":"gradient","opacity":0.5,"gradient":{"stops":[{"color":{"value":"rgba(1,2,3,1)","a":1},"position":0.' || p_size || '},{"color":{"value":"#ffffff","a":0.5},"position":0.98765},{"position":1}]}}'
  WHEN 2 THEN '{"type":"color","color":{"value":"rgba(10,20,30,0.2)","a":0.2},"opacity":0.2}' ELSE '{"color":{"value":"rgba(9,8,7,1)"}}' END
|| '],"borders":[' || CASE p_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN '{"isEnabled":false,"color":{"value":"#000000"}},{"color":{"value":"#010203"},"width":0.567,"lineAlignment":"outside"}' WHEN 2 THEN '{"width":3}' ELSE '{"color":{"value":"#0a0b0c","a":0.5},"width":1}' END
|| '],"shadows":[' || CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN '{"inset":true,"color":{"value":"rgba(0,0,0,0.4)"},"x":1.5,"y":-2,"blur":' || p_size || '}' ELSE '{"isEnabled":false,"color":{"value":"#fff"}},{"color":{"value":"rgba(0,0,0,1)"},"x":0,"y":4.4,"blur":2,"spread":-1.5}' END
|| ']},"paths":[' || CASE p_partkey % 6 WHEN 0 THEN '' WHEN 1 THEN '{"radius":{"topLeft":4.4,"topRight":4,"bottomLeft":4,"bottomRight":4}}' WHEN 2 THEN '{"radius":{"topLeft":8,"topRight":12,"bottomRight":12}}'
  WHEN 3 THEN '{"radius":{"topLeft":1,"topRight":1,"bottomLeft":1,"bottomRight":1}},{},{"radius":{"topLeft":6}}' ELSE '{"radius":{"topLeft":0}}' END
|| '],"radius":{"topLeft":' || CASE WHEN p_partkey % 12 = 0 THEN '0' ELSE '5' END || ',"topRight":5,"bottomLeft":5,"bottomRight":5}'
|| ',"text":' || CASE WHEN p_partkey % 4 = 3 THEN '{"value":"hi","style":{"color":{"value":"#102030","a":' || CASE WHEN p_partkey % 8 = 3 THEN '0.6' ELSE '1' END || '},"font":{"size":' || p_size || '.6,"weight":500,"fontFamily":"F","lineHeight":{"unit":"'
  || CASE WHEN p_partkey % 8 = 3 THEN 'AUTO' ELSE 'PIXELS' END || '","value":20.5},"letterSpacing":{"value":' || (p_partkey % 3) || '.25},"align":"' || CASE WHEN p_partkey % 8 = 3 THEN 'Left' ELSE 'Center' END || '","verticalAlignment":"top","italic":' || CASE WHEN p_partkey % 8 = 3 THEN 'true' ELSE 'false' END || '}}}' ELSE 'null' END
|| '}]}]}}'"""


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys that files are made of, dealt out over the session's partitions: the table is small and lies in few
    files, but what is made of its rows is not small."""
    return table(spark, sf_dir, "part").select("p_partkey", "p_size").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")


def _nodes(spark: SparkSession, sf_dir: str, with_style: bool = False) -> DataFrame:
    files = _parts(spark, sf_dir).selectExpr("p_partkey AS doc", f"{_FILE} AS json")
    return design.design_nodes(files, style=with_style)


def layer_style(spark, sf_dir):
    """Looks of every layer that is no text."""
    found = style.styled_layers(_nodes(spark, sf_dir, True), layers.layer_type(F.col("kind"))).filter("name = 'box' AND text IS NULL")
    listed = lambda c, *names: F.concat_ws(",", *[F.col(f"{c}.{n}").cast("string") for n in names])
    stops = F.array_join(F.transform("gradient", lambda s: F.concat_ws("@", s["color"], s["position"].cast("string"))), " ")
    return found.select(
        "doc", "fill", stops.alias("gradient"), "corner_radius", F.array_join("corners", ",").alias("corners"), listed("border", "color", "width", "alignment").alias("border"),
        listed("shadow", "color", "x", "y", "blur", "spread").alias("shadow"), listed("inner_shadow", "color", "x", "y", "blur", "spread").alias("inner_shadow"), "shown_opacity",
    )


def text_style(spark, sf_dir):
    """Looks of every text layer."""
    found = style.styled_layers(_nodes(spark, sf_dir, True), layers.layer_type(F.col("kind"))).filter("text IS NOT NULL")
    return found.select("doc", "text", "text_color", "text_style.*", "shown_opacity")


def slice_collect(spark, sf_dir):
    """Slices of the raw trees, hidden ones included."""
    return design.collected_slices(_nodes(spark, sf_dir)).drop("id")


def layer_pruned(spark, sf_dir):
    """Nodes that hidden, backup and boolean subtrees take away."""
    return layers.pruned_counts(_nodes(spark, sf_dir))


# A plugin file for each part: an artboard, a node of a lost parent before the artboard's own, a group with a box, a text.
_PLUGIN = """
'{"info":[{"id":"r","name":"Board","width":300,"height":200},{"id":"s","parentID":"gone","name":"stray","left":1,"top":1,"width":2,"height":2},{"id":"g","parentID":"r","name":"Panel","isVisible":' || CASE WHEN p_partkey % 9 = 0 THEN 'false' ELSE 'true' END
|| '},{"id":"t","parentID":"r","name":"label","type":"text","left":3,"top":4,"width":5,"height":6,"characterSpacing":1.25,"font":{"font":"Sans-' || CASE p_partkey % 4 WHEN 0 THEN 'BoldItalic' WHEN 1 THEN 'Heavy' ELSE 'Regular' END
|| '","displayName":"Sans","size":' || p_size || '.6,"line":20.5,"align":"center","verticalAlignment":' || (p_partkey % 3) || ',"color":{"value":"rgba(1,2,3,1)","a":0},' || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE '"content":"hi",' END
|| '"styles":[{"content":"run","decorationLine":"' || CASE WHEN p_partkey % 2 = 0 THEN 'underline' ELSE 'line-through' END || '"}]}},{"id":"b","parentID":"g","name":"box","type":"' || CASE WHEN p_partkey % 6 = 2 THEN 'bitmap' ELSE 'shapePath' END
|| '","left":' || p_size || ',"top":2.5,"width":7,"height":8,"ddsOriginFrame":{"x":' || p_size || '.5,"y":-2.5,"width":' || CASE WHEN p_partkey % 2 = 0 THEN '30' ELSE '0' END || ',"height":9}'
|| CASE WHEN p_partkey % 3 = 0 THEN ',"opacity":50' ELSE '' END || CASE WHEN p_partkey % 6 = 1 THEN ',"exportable":true' ELSE '' END || CASE WHEN p_partkey % 6 < 4 THEN ',"ddsImage":{"imageUrl":"https://x/' || p_partkey || '.png"}' ELSE '' END
|| ',"fills":[{"isEnabled":false,"color":{"value":"#ffffff"}},' || CASE WHEN p_partkey % 5 < 2 THEN '{"color":{"value":"rgba(10,20,30,0.2)","a":0}}' ELSE '{"color":{"value":"#0a0b0c","a":0.5}}' END
|| '],"borders":[' || CASE p_partkey % 7 WHEN 1 THEN '{"isEnabled":false},{"color":{"value":"#010203"},"thickness":2,"width":9,"position":"外边框"}' WHEN 2 THEN '{"color":{"value":"#010203"},"width":1.5,"position":"内边框"}' WHEN 3 THEN '{"color":{"value":"#010203"},"thickness":1}' ELSE '' END
|| '],"shadows":[' || CASE WHEN p_partkey % 3 = 1 THEN '{"color":{"value":"rgba(0,0,0,0.4)","a":0},"x":1,"y":2,"blur":3,"spread":0}' ELSE '' END
|| '],' || CASE p_partkey % 4 WHEN 0 THEN '"points":[{"cornerRadius":4},{"cornerRadius":4},{"cornerRadius":4},{"cornerRadius":4}],"radius":[9]' WHEN 1 THEN '"points":[{"cornerRadius":8},{"cornerRadius":2},{},{"cornerRadius":1}]' WHEN 2 THEN '"points":[],"radius":[6]' ELSE '"radius":[0,0,0,0]' END
|| '}]}'"""


def plugin_style(spark, sf_dir):
    """Layers of plugin files in drawing order with their looks."""
    files = _parts(spark, sf_dir).selectExpr("p_partkey AS doc", f"{_PLUGIN} AS json")
    found = style.styled_layers(design.design_nodes(files, style=True), layers.layer_type(F.col("kind")))
    listed = lambda c, *names: F.concat_ws(",", *[F.col(f"{c}.{n}").cast("string") for n in names])
    whole = lambda c: F.col(c).cast("long")
    return found.select(
        "doc", F.col("id").alias("seq"), "name", F.concat_ws("/", F.transform("above", lambda a: a["name"])).alias("above"), "visible", whole("canvas_w").alias("canvas_w"), whole("fx").alias("x"), whole("fy").alias("y"), whole("fw").alias("w"),
        "fill", listed("border", "color", "width", "alignment").alias("border"), listed("shadow", "color", "x", "y", "blur", "spread").alias("shadow"), "corner_radius", F.array_join("corners", ",").alias("corners"),
        "is_slice", "image_url", "slice_url", "text", "text_color", listed("text_style", "font_size", "font_weight", "font_family", "line_height", "letter_spacing", "align", "vertical_align", "italic", "underline", "linethrough").alias("text_style"),
    )


QUERIES = {f.__name__: f for f in (plugin_style, layer_style, text_style, slice_collect, layer_pruned)}

_OPACITY = "CASE WHEN p_partkey % 3 = 0 THEN 0.5 ELSE 1.0 END"
_half = "p_partkey % 3 = 0"
_box = lambda value: f"CASE WHEN name = 'box' THEN {value} END"
_words = lambda value: f"CASE WHEN name = 'label' THEN {value} END"
_listed = lambda value: f"CASE WHEN name = 'box' THEN {value} ELSE '' END"
ORACLES = {
    "plugin_style": f"""
        WITH n AS (SELECT part.*, unnest(['Panel', 'box', 'label', 'stray']) AS name, unnest([0, 1, 2, 3]) AS seq FROM part)
        SELECT p_partkey AS doc, CAST(seq AS BIGINT) AS seq, name, CASE WHEN name = 'box' THEN 'Panel' ELSE '' END AS above, name <> 'Panel' OR p_partkey % 9 <> 0 AS visible, CAST(300 AS BIGINT) AS canvas_w,
          CAST(CASE name WHEN 'Panel' THEN 0 WHEN 'stray' THEN 1 WHEN 'label' THEN 3 ELSE p_size + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END END AS BIGINT) AS x,
          CAST(CASE name WHEN 'Panel' THEN 0 WHEN 'stray' THEN 1 WHEN 'label' THEN 4 ELSE CASE WHEN p_partkey % 2 = 0 THEN -2 ELSE 3 END END AS BIGINT) AS y,
          CAST(CASE name WHEN 'Panel' THEN 0 WHEN 'stray' THEN 2 WHEN 'label' THEN 5 ELSE CASE WHEN p_partkey % 2 = 0 THEN 30 ELSE 7 END END AS BIGINT) AS w,
          {_box(f"CASE WHEN p_partkey % 5 < 2 THEN CASE WHEN {_half} THEN 'rgba(10,20,30,0.5)' ELSE 'rgba(10,20,30,0.2)' END WHEN {_half} THEN 'rgba(10,11,12,0.25)' ELSE 'rgba(10,11,12,0.5)' END")} AS fill,
          {_listed(f"CASE WHEN p_partkey % 7 BETWEEN 1 AND 3 THEN CASE WHEN {_half} THEN 'rgba(1,2,3,0.5)' ELSE '#010203' END || CASE p_partkey % 7 WHEN 1 THEN ',2.0,outside' WHEN 2 THEN ',1.5,inside' ELSE ',1.0,center' END ELSE '' END")} AS border,
          {_listed("CASE WHEN p_partkey % 3 = 1 THEN 'rgba(0,0,0,0.4),1,2,3,0' ELSE '' END")} AS shadow,
          CAST({_box("CASE p_partkey % 4 WHEN 0 THEN 4 WHEN 2 THEN 6 END")} AS BIGINT) AS corner_radius, {_box("CASE WHEN p_partkey % 4 = 1 THEN '8,2,1,0' END")} AS corners,
          name = 'box' AND p_partkey % 6 = 1 AS is_slice, {_box("CASE WHEN p_partkey % 6 = 2 THEN 'https://x/' || p_partkey || '.png' END")} AS image_url, {_box("CASE WHEN p_partkey % 6 = 1 THEN 'https://x/' || p_partkey || '.png' END")} AS slice_url,
          {_words("CASE WHEN p_partkey % 5 = 0 THEN 'run' ELSE 'hi' END")} AS text, {_words("'#010203'")} AS text_color,
          CASE WHEN name = 'label' THEN (p_size + 1) || CASE WHEN p_partkey % 4 < 2 THEN ',700.0' ELSE '' END || ',Sans,21,1.3,center' || CASE p_partkey % 3 WHEN 1 THEN ',middle' WHEN 2 THEN ',bottom' ELSE '' END
            || CASE WHEN p_partkey % 4 = 0 THEN ',true' ELSE '' END || ',true' ELSE '' END AS text_style
        FROM n""",
    "layer_style": f"""
        SELECT p_partkey AS doc,
          CASE p_partkey % 5 WHEN 2 THEN CASE WHEN {_half} THEN 'rgba(10,20,30,0.1)' ELSE 'rgba(10,20,30,0.2)' END WHEN 3 THEN CASE WHEN {_half} THEN 'rgba(9,8,7,0.5)' ELSE '#090807' END WHEN 4 THEN CASE WHEN {_half} THEN 'rgba(9,8,7,0.5)' ELSE '#090807' END END AS fill,
          CASE WHEN p_partkey % 5 = 1 THEN CASE WHEN {_half} THEN 'rgba(1,2,3,0.25)@' ELSE 'rgba(1,2,3,0.5)@' END || CAST(CAST(floor(CAST('0.' || p_size AS DOUBLE) * 1000 + 0.5) / 1000 AS DOUBLE) AS VARCHAR) || CASE WHEN {_half} THEN ' rgba(255,255,255,0.25)@0.988' ELSE ' rgba(255,255,255,0.5)@0.988' END END AS gradient,
          CAST(CASE p_partkey % 6 WHEN 0 THEN CASE WHEN p_partkey % 12 = 0 THEN NULL ELSE 5 END WHEN 1 THEN 4 WHEN 2 THEN NULL WHEN 3 THEN 1 ELSE CASE WHEN p_partkey % 12 = 0 THEN NULL ELSE 5 END END AS BIGINT) AS corner_radius,
          CASE p_partkey % 6 WHEN 0 THEN CASE WHEN p_partkey % 12 = 0 THEN '0,5,5,5' END WHEN 2 THEN '8,12,0,12' WHEN 3 THEN '1,1,1,1' END AS corners,
          CASE p_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN CASE WHEN {_half} THEN 'rgba(1,2,3,0.5),0.57,outside' ELSE '#010203,0.57,outside' END WHEN 2 THEN '' ELSE CASE WHEN {_half} THEN 'rgba(10,11,12,0.25),1.0,inside' ELSE 'rgba(10,11,12,0.5),1.0,inside' END END AS border,
          CASE WHEN p_partkey % 3 = 2 THEN '#000000,0,4,2,-1' ELSE '' END AS shadow, CASE WHEN p_partkey % 3 = 1 THEN 'rgba(0,0,0,0.4),2,-2,' || p_size || ',0' ELSE '' END AS inner_shadow,
          CASE WHEN p_partkey % 5 = 0 AND {_half} THEN CAST(0.5 AS DOUBLE) END AS shown_opacity
        FROM part WHERE p_partkey % 4 <> 3""",
    "text_style": f"""
        SELECT p_partkey AS doc, 'hi' AS text, CASE WHEN p_partkey % 8 = 3 THEN CASE WHEN {_half} THEN 'rgba(16,32,48,0.3)' ELSE 'rgba(16,32,48,0.6)' END WHEN {_half} THEN 'rgba(16,32,48,0.5)' ELSE '#102030' END AS text_color,
          CAST(p_size + 1 AS BIGINT) AS font_size, 500.0::DOUBLE AS font_weight, 'F' AS font_family, CASE WHEN p_partkey % 8 = 3 THEN 'auto' ELSE '21' END AS line_height,
          CAST(CASE p_partkey % 3 WHEN 0 THEN 0.3 WHEN 1 THEN 1.3 ELSE 2.3 END AS DOUBLE) AS letter_spacing, CASE WHEN p_partkey % 8 <> 3 THEN 'center' END AS align, CAST(NULL AS VARCHAR) AS vertical_align,
          CASE WHEN p_partkey % 8 = 3 THEN true END AS italic, CAST(NULL AS BOOLEAN) AS underline, CAST(NULL AS BOOLEAN) AS linethrough, CAST(NULL AS DOUBLE) AS shown_opacity
        FROM part WHERE p_partkey % 4 = 3""",
    "slice_collect": "SELECT p_partkey AS doc, 'box' AS name, 'https://x/' || p_partkey || '.png' AS url, CAST(p_size + 1 AS BIGINT) AS x, CAST(2 AS BIGINT) AS y, CAST(p_size AS BIGINT) AS w, CAST(10 AS BIGINT) AS h FROM part WHERE p_partkey % 6 = 1",
    "layer_pruned": """
        SELECT p_partkey AS doc, CAST(2 AS BIGINT) AS n_nodes, CAST(CASE WHEN p_partkey % 7 = 0 THEN 2 ELSE 0 END AS BIGINT) AS n_hidden,
          CAST(CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 5 = 1 THEN 2 ELSE 0 END AS BIGINT) AS n_backup, CAST(CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 5 = 2 THEN 1 ELSE 0 END AS BIGINT) AS n_operand FROM part""",
}
