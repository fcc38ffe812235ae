"""How layers look: gradients, corners, borders, shadows and text styles, as struct expressions.

Reads the ``style`` of :func:`tessella.sources.design.design_nodes`, which holds the file's own values,
and ``opacity`` of the layer. Everything is computed in the row; missing members count as their
defaults, and what has its default value is null. Colours carry the alphas of colour, layer and fill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.color import composed_color, effective_alpha, short_color
from tessella.functions.text import js_round

_COLOR = "struct<value:string,a:double>"
_CORNERS = "struct<topLeft:double,topRight:double,bottomLeft:double,bottomRight:double>"
STYLE = (
    f"struct<fills:array<struct<type:string,color:{_COLOR},opacity:double,gradient:struct<stops:array<struct<color:{_COLOR},position:double>>>>>,"
    f"borders:array<struct<isEnabled:boolean,color:{_COLOR},opacity:double,width:double,lineAlignment:string>>,"
    "shadows:array<struct<isEnabled:boolean,inset:boolean,color:struct<value:string>,x:double,y:double,blur:double,spread:double>>,"
    f"paths:array<{_CORNERS}>,radius:{_CORNERS},color:{_COLOR},"
    "font:struct<size:double,fontSize:double,fontWeight:double,weight:double,name:string,fontFamily:string,postScriptName:string,lineHeight:struct<unit:string,value:double>,"
    "letterSpacing:struct<value:double>,align:string,verticalAlignment:string,italic:boolean,underline:boolean,linethrough:boolean>>"
)
CORNERS = ("topLeft", "topRight", "bottomLeft", "bottomRight")


def _one(value: Column) -> Column:
    return F.coalesce(value, F.lit(1.0))


def _whole(value: Column) -> Column:
    return js_round(F.coalesce(value, F.lit(0.0))).cast("long")


def _enabled(items: Column, more=lambda x: F.lit(True)) -> Column:
    """The first of the items that is not switched off, or null."""
    return F.get(F.filter(items, lambda x: F.coalesce(x["isEnabled"], F.lit(True)) & more(x)), 0)


def shade(color: Column, opacity: Column, layer_opacity: Column) -> Column:
    """A colour (``value, a``) with its alphas composed in; null without a value."""
    return composed_color(color["value"], effective_alpha(_one(color["a"]), _one(layer_opacity), _one(opacity)))


def gradient(fill: Column, layer_opacity: Column) -> Column:
    """The stops (``color, position``) of a gradient fill; null if it is none or no stop has a colour."""
    stop = lambda s: F.struct(shade(s["color"], fill["opacity"], layer_opacity).alias("color"), (js_round(s["position"] * 1000) / 1000).alias("position"))
    stops = F.filter(F.transform(fill["gradient"]["stops"], stop), lambda s: s["color"].isNotNull())
    return F.when((fill["type"] == "gradient") & (F.size(stops) > 0), stops)


def corners(paths: Column, radius: Column) -> Column:
    """``radius`` and ``corners`` of a box: those of its paths that are not square, else its own.

    One number if all corners of all paths are equal; else the first path's four, and its greatest as
    ``radius`` if the paths differ.
    """
    rounded = lambda r: F.array(*[_whole(r[c]) for c in CORNERS])
    some = lambda rs: F.filter(F.transform(rs, rounded), lambda r: F.array_max(r) != 0)
    of_paths = some(F.coalesce(paths, F.array().cast(f"array<{_CORNERS}>")))
    radii = F.when(F.size(of_paths) > 0, of_paths).when(radius.isNotNull(), some(F.array(radius))).otherwise(of_paths)
    first, same = F.get(radii, 0), F.size(F.array_distinct(radii)) == 1
    uniform = same & (F.size(F.array_distinct(first)) == 1)
    return F.struct(
        F.when(uniform, F.get(first, 0)).when(first.isNotNull() & ~same, F.array_max(first)).alias("radius"),
        F.when(first.isNotNull() & ~uniform, first).alias("corners"),
    )


def border(borders: Column, layer_opacity: Column) -> Column:
    """``color, width, alignment`` of the first border that is on; null without a colour."""
    b = _enabled(borders)
    color = shade(b["color"], b["opacity"], layer_opacity)
    place = F.when(b["lineAlignment"].isin("outside", "center"), b["lineAlignment"]).otherwise(F.lit("inside"))
    return F.when(color.isNotNull(), F.struct(color.alias("color"), (js_round(F.coalesce(b["width"], F.lit(0.0)) * 100) / 100).alias("width"), place.alias("alignment")))


def shadow(shadows: Column, inset: bool) -> Column:
    """``color, x, y, blur, spread`` of the first outer or inner shadow that is on; its colour has its alpha already."""
    s = _enabled(shadows, lambda x: (F.coalesce(x["color"]["value"], F.lit("")) != "") & (F.coalesce(x["inset"], F.lit(False)) == inset))
    return F.when(s.isNotNull(), F.struct(short_color(s["color"]["value"]).alias("color"), *[_whole(s[c]).alias(c) for c in ("x", "y", "blur", "spread")]))


def text_style(font: Column) -> list[Column]:
    """Columns of a text's style; sizes in whole pixels, defaults (left, top, 0) as null."""
    some = lambda v: F.when(v != 0, v)
    aligned = lambda v, default: F.when((v != "") & (F.lower(v) != default), F.lower(v))
    line = F.when(font["lineHeight"]["unit"] == "AUTO", F.lit("auto")).otherwise(some(_whole(font["lineHeight"]["value"])).cast("string"))
    spacing = font["letterSpacing"]["value"]
    return [
        some(_whole(F.coalesce(font["size"], font["fontSize"]))).alias("font_size"), some(F.coalesce(font["fontWeight"], font["weight"])).alias("font_weight"),
        F.coalesce(font["name"], font["fontFamily"], font["postScriptName"]).alias("font_family"), line.alias("line_height"),
        F.when(spacing != 0, js_round(spacing * 10) / 10).alias("letter_spacing"), aligned(font["align"], "left").alias("align"), aligned(font["verticalAlignment"], "top").alias("vertical_align"),
        *[F.when(font[c], F.lit(True)).alias(c) for c in ("italic", "underline", "linethrough")],
    ]


def styled_layers(nodes: DataFrame, kind: Column) -> DataFrame:
    """``nodes`` with the columns of their looks instead of ``style``; ``kind`` is text, image or rect.

    ``shown_opacity`` is there only where no colour has taken the layer's opacity in.
    """
    rows = nodes.withColumn("_kind", kind).withColumn("_s", F.from_json("style", STYLE)).withColumn("_fill", F.get(F.col("_s.fills"), 0))
    text, layer, s = F.col("_kind") == "text", F.col("opacity"), F.col("_s")
    stops = gradient(F.col("_fill"), layer)
    own = F.coalesce(s["color"], F.col("_fill.color"))
    fill_opacity = F.when(s["color"].isNull(), F.col("_fill.opacity"))
    flat = F.when(~((F.col("_fill.type") == "gradient") & F.col("_fill.gradient.stops").isNotNull()) | F.col("_fill.type").isNull(), shade(F.col("_fill.color"), F.col("_fill.opacity"), layer))
    rounded = corners(s["paths"], s["radius"])
    looks = rows.select(
        "*", F.when(~text, flat).alias("fill"), F.when(~text, stops).alias("gradient"), F.when(text, shade(own, fill_opacity, layer)).alias("text_color"),
        F.when(~text, rounded["radius"]).alias("corner_radius"), F.when(~text, rounded["corners"]).alias("corners"), F.when(~text, border(s["borders"], layer)).alias("border"),
        shadow(s["shadows"], False).alias("shadow"), shadow(s["shadows"], True).alias("inner_shadow"), F.when(text, F.struct(*text_style(s["font"]))).alias("text_style"),
    )
    baked = F.coalesce(F.col("fill"), F.col("text_color"), F.get("gradient", 0)["color"]).isNotNull()
    four = F.round(layer, 4)
    return looks.withColumn("shown_opacity", F.when((layer < 1) & ~baked, four)).drop("_kind", "_s", "_fill", "style")
