"""Design files: JSON trees of both shapes to flat layer rows, charset recovery included."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import js_round
from tessella.operators.layers import fill_color, is_contentful, layer_type, parent_path, prune_reason, shown_name

_FIELDS = [
    ("id", pa.int64()), ("above", pa.list_(pa.struct([("name", pa.string()), ("visible", pa.bool_())]))), ("name", pa.string()), ("visible", pa.bool_()), ("kind", pa.string()),
    ("fx", pa.float64()), ("fy", pa.float64()), ("fw", pa.float64()), ("fh", pa.float64()), ("color", pa.string()), ("color_alpha", pa.float64()),
    ("fill_opacity", pa.float64()), ("opacity", pa.float64()), ("text", pa.string()), ("is_slice", pa.bool_()), ("image_url", pa.string()), ("slice_url", pa.string()), ("style", pa.string()),
    ("canvas_w", pa.float64()), ("canvas_h", pa.float64()),
]
#: Words of font names and of border places, and numbers of upright alignments (fixed values of plugin files).
HEAVY, SLANTED = ("bold", "heavy", "black"), ("italic", "oblique")
PLACES = {"外边框": "outside", "内边框": "inside"}
UPRIGHT = {0: "top", 1: "middle", 2: "bottom"}
_ALPHA = re.compile(r"rgba\(\s*\d+\s*,\s*\d+\s*,\s*\d+\s*,\s*(\d+\.?\d*|\.\d+)\s*\)")
#: Rows a batch.
BATCH = 20_000


def decoded(body: bytes | None, charset: str | None = None) -> str:
    """Text of a body: by the declared charset, else UTF-8, else GBK, else UTF-8 with replacements."""
    for name in (charset, "utf-8", "gbk"):
        try:
            if name:
                return (body or b"").decode(name)
        except (LookupError, UnicodeDecodeError):
            continue
    return (body or b"").decode("utf-8", errors="replace")


def decode_bodies(bodies: DataFrame, key: str = "doc", body: str = "body", charset: str = "charset") -> DataFrame:
    """``key, json`` of raw bodies, see :func:`decoded`."""
    narrow = bodies.select(key, body, charset)
    kind = narrow.schema[0].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = [decoded(b, c) for b, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "json"])

    return narrow.mapInArrow(run, f"{key} {kind}, json string")


def _number(value) -> float | None:
    try:
        return None if value is None or isinstance(value, bool) else float(value)
    except (TypeError, ValueError):
        return None


def _nested(root: dict) -> list:
    """The top layers of a nested file: the first of the known keys, else the first list of objects
    found at most six levels down."""
    level = [root]
    for _ in range(6):
        for node in level:
            for key in ("layers", "children"):
                if isinstance(node.get(key), list) and node[key]:
                    return node[key]
        level = [v for node in level for v in node.values() if isinstance(v, dict)]
    return []


def _object(value) -> dict:
    return value if isinstance(value, dict) else {}


def _plugin_color(color) -> dict | None:
    """A colour of a plugin file without its alpha where that contradicts the alpha of its own text, which holds."""
    color = color if isinstance(color, dict) else None
    value = _object(color).get("value")
    stated = _ALPHA.search(value) if isinstance(value, str) else None
    alpha = _number(color.get("a")) if stated else None
    if alpha is None or abs(alpha - float(stated[1])) <= 1e-3:
        return color
    return {k: v for k, v in color.items() if k != "a"}


def _plugin_paints(items) -> list[dict]:
    """Fills, borders or shadows that are not switched off, in the fields of nested files."""
    made = []
    for item in items if isinstance(items, list) else []:
        if not isinstance(item, dict) or item.get("isEnabled") is False:
            continue
        paint = item | {"color": _plugin_color(item.get("color"))}
        stops = _object(item.get("gradient")).get("colorStops")
        if isinstance(stops, list):
            paint["gradient"] = {"stops": [{"position": s.get("position"), "color": _plugin_color(s.get("color"))} for s in stops if isinstance(s, dict)]}
        made.append(paint)
    return made


def _plugin_corners(node: dict) -> dict | None:
    """The corners by the points' radii, else the ``radius`` list; null if all are square."""
    points = node.get("points")
    listed = [p.get("cornerRadius") if isinstance(p, dict) else None for p in points] if isinstance(points, list) and points else node.get("radius")
    radii = [_number(r) or 0.0 for r in listed] if isinstance(listed, list) else []
    if not any(radii):
        return None
    return {name: radii[i] if i < len(radii) else radii[0] for i, name in enumerate(("topLeft", "topRight", "bottomRight", "bottomLeft"))}


def _plugin_text(node: dict) -> dict | None:
    """Content, colour and font of a text layer; bold and slanted faces are told by the font's name."""
    font = node.get("font")
    if node.get("type") != "text" or not isinstance(font, dict):
        return None
    runs = font.get("styles")
    run = runs[0] if isinstance(runs, list) and runs and isinstance(runs[0], dict) else {}
    first = lambda *values: next((v for v in values if v is not None), None)
    face, line = str(font.get("font") or font.get("displayName") or "").lower(), run.get("decorationLine")
    size, height, upright = _number(first(font.get("size"), run.get("size"))), font.get("line"), _number(font.get("verticalAlignment"))
    look = {
        "size": size or None, "name": font.get("displayName") or None, "postScriptName": font.get("font") or None, "fontWeight": 700 if any(w in face for w in HEAVY) else None,
        "lineHeight": None if height is None else {"unit": "PIXELS", "value": _number(height) or 0.0}, "letterSpacing": {"value": _number(first(node.get("characterSpacing"), font.get("kerning"))) or 0.0},
        "align": font["align"] if isinstance(font.get("align"), str) else None, "verticalAlignment": UPRIGHT.get(upright, "top"),
        "italic": any(w in face for w in SLANTED) or None, "underline": line == "underline" or None, "linethrough": line == "line-through" or None,
    }
    content = first(font.get("content"), run.get("content"))
    return {"style": {"content": "" if content is None else str(content), "color": first(_plugin_color(font.get("color")), _plugin_color(run.get("color"))), "font": look}}


def _plugin_frame(node: dict) -> dict:
    """The origin frame if it has a size, else left and top; whole pixels, half up."""
    origin = node.get("ddsOriginFrame")
    sized = isinstance(origin, dict) and (_number(origin.get("width")) or 0) > 0 and (_number(origin.get("height")) or 0) > 0
    names = ("x", "y", "width", "height") if sized else ("left", "top", "width", "height")
    return {to: math.floor((_number((origin if sized else node).get(name)) or 0.0) + 0.5) for to, name in zip(("x", "y", "width", "height"), names)}


def _nested_from_info(info: list[dict]) -> tuple[dict, list[dict]]:
    """Flat plugin nodes linked by parentID: the frame of the artboard and its nested layers.

    The artboard is the first node without a known parent; other such nodes come after its own children. Of nodes with
    one id the first holds the children, so that no loop can be reached; nodes on a loop of parents, which no root
    reaches, are left out, and nodes without an id have no children.
    """
    known = {n["id"] for n in info if n.get("id") is not None}
    below, roots = {}, []
    for n in info:
        above = n.get("parentID")
        (roots if above is None or above not in known else below.setdefault(above, [])).append(n)
    if not roots:
        return {}, []
    made = []
    for n in info:
        image, vector = _object(n.get("ddsImage")).get("imageUrl"), _object(n.get("image"))
        marked = n.get("exportable") is True
        shown = {"imageUrl": image} if image and (marked or n.get("type") == "bitmap") else vector if not marked and vector.get("svgUrl") else {}
        made.append((n, {
            "name": n.get("name"), "type": n.get("type"), "visible": n.get("isVisible") is not False, "frame": _plugin_frame(n), "radius": _plugin_corners(n), "text": _plugin_text(n),
            "opacity": n["opacity"] / 100 if isinstance(n.get("opacity"), (int, float)) and not isinstance(n.get("opacity"), bool) else None, "hasExportImage": marked, "image": shown,
            "style": {"fills": _plugin_paints(n.get("fills")), "shadows": _plugin_paints(n.get("shadows")),
                      "borders": [b | {"width": b["thickness"] if b.get("thickness") is not None else b.get("width"), "lineAlignment": PLACES.get(b.get("position"), "center")} for b in _plugin_paints(n.get("borders"))]},
        }))
    by_node = {id(n): layer for n, layer in made}
    for n, layer in made:
        layer["layers"] = [by_node[id(c)] for c in below.pop(n.get("id"), [])] if n.get("id") is not None else []
    return _plugin_frame(roots[0]), by_node[id(roots[0])]["layers"] + [by_node[id(r)] for r in roots[1:]]


def _style(node: dict) -> dict:
    """What :mod:`tessella.operators.style` reads of a node, as it is in the file."""
    style, content = node.get("style") or node.get("css") or {}, node.get("text")
    text_style = content.get("style") or {} if isinstance(content, dict) else {}
    paths = [p.get("radius") for p in node.get("paths") or [] if isinstance(p, dict)]
    return {"fills": style.get("fills"), "borders": style.get("borders"), "shadows": style.get("shadows"), "paths": paths, "radius": node.get("radius"), "font": text_style.get("font"), "color": text_style.get("color")}


def layer_rows(text: str | None, style: bool = False) -> Iterator[tuple]:
    """Rows of a file's layers in drawing order (pre-order), see ``_FIELDS``; none if it is no JSON object.
    ``style`` is null unless asked for."""
    try:
        root = json.loads(text or "")
    except ValueError:
        return
    if not isinstance(root, dict):
        return
    frame, info = (root.get("artboard") or {}).get("frame") or {}, root.get("info")
    if isinstance(info, list) and info and not root.get("artboard"):
        frame, top = _nested_from_info([n for n in info if isinstance(n, dict)])
    else:
        top = _nested(root.get("artboard") or root)
    canvas = _number(frame.get("width")), _number(frame.get("height"))
    stack = [(n, ()) for n in reversed(top)]
    at = 0
    while stack:
        node, above = stack.pop()
        if not isinstance(node, dict):
            continue
        box = node.get("frame") or node.get("rect") or node.get("boundingBox") or node
        fills = (node.get("style") or {}).get("fills") or [{}]
        content = node.get("text")
        worded = content.get("style") or {} if isinstance(content, dict) else {}
        color = worded.get("color") or (fills[0] or {}).get("color") or {}
        value = content if isinstance(content, str) else worded.get("content") or content.get("value") if isinstance(content, dict) else None
        kind = node.get("type") or node.get("shapeType") or ("text" if content is not None else "rect")
        slice_, image = bool(node.get("hasExportImage")), (node.get("image") or {}).get("imageUrl")
        name, visible = None if node.get("name") is None else str(node["name"]), node.get("visible") is not False
        yield (
            at, list(above), name, visible, str(kind),
            _number(box.get("x", box.get("left"))), _number(box.get("y", box.get("top"))), _number(box.get("width", box.get("w"))), _number(box.get("height", box.get("h"))),
            color.get("value") if isinstance(color.get("value"), str) else None, _number(color.get("a")), _number((fills[0] or {}).get("opacity")), _number(node.get("opacity")),
            value or None, slice_, None if slice_ else image, image if slice_ else None, json.dumps(_style(node), ensure_ascii=False) if style else None, *canvas,
        )
        at += 1
        children = node.get("layers")
        if isinstance(children, list):
            here = (*above, {"name": name, "visible": visible})
            stack += [(c, here) for c in reversed(children)]


def design_nodes(files: DataFrame, key: str = "doc", text: str = "json", style: bool = False) -> DataFrame:
    """All layers of design files as rows: the key and the fields of :func:`layer_rows`."""
    narrow = files.select(F.col(key), F.col(text))
    kind = narrow.schema[0].dataType.simpleString()
    schema = ", ".join(f"{n} {'array<struct<name:string,visible:boolean>>' if n == 'above' else {pa.int64(): 'bigint', pa.string(): 'string', pa.bool_(): 'boolean', pa.float64(): 'double'}[t]}" for n, t in _FIELDS)

    def run(batches):
        for batch in batches:
            # The rows of many files share a batch, but no more of them are held at a time.
            rows = ((i, *r) for i in range(batch.num_rows) for r in layer_rows(batch.column(1)[i].as_py(), style))
            while part := list(islice(rows, BATCH)):
                at, *columns = zip(*part)
                made = [pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *made], names=[key, *[n for n, _ in _FIELDS]])

    return narrow.mapInArrow(run, f"{key} {kind}, {schema}")


def design_layers(nodes: DataFrame) -> DataFrame:
    """Layers ready for cleaning, of :func:`design_nodes` with key ``doc``.

    Hidden, backup and operand subtrees are gone; layers without size or content as well; frames are
    whole pixels; ``parent_path`` joins the ancestors' meaningful names. A node carries its ancestors, so
    there is no shuffle.
    """
    size = lambda c: js_round(F.coalesce(F.col(c), F.lit(0.0))).cast("long")
    fill = F.when(F.col("color").isNotNull(), fill_color(F.col("color"), F.col("color_alpha"), F.col("opacity"), F.col("fill_opacity")))
    # Filtered by the colour, which is there where the fill is, as a filter by the fill would compose it a second time.
    drawn = is_contentful(F.col("color"), F.col("text"), F.col("image_url"), F.when(F.col("is_slice"), F.lit("1")))
    sized = (js_round(F.coalesce("fw", F.lit(0.0))) > 0) & (js_round(F.coalesce("fh", F.lit(0.0))) > 0)
    kept = nodes.filter(sized & drawn).filter(prune_reason(F.col("above"), F.col("name"), F.col("visible")).isNull())
    return kept.select(
        "doc", F.col("id").alias("seq"), shown_name(F.col("name"), F.col("is_slice")).alias("name"), layer_type(F.col("kind")).alias("type"),
        size("fx").alias("x"), size("fy").alias("y"), size("fw").alias("w"), size("fh").alias("h"), fill.alias("fill"), parent_path(F.col("above")).alias("parent_path"), "is_slice", "image_url", "text",
        size("canvas_w").alias("canvas_w"), size("canvas_h").alias("canvas_h"),
    )


def collected_slices(nodes: DataFrame, doc: str = "doc") -> DataFrame:
    """``doc, id, name, url, x, y, w, h`` of the layers marked for export that have an image, of
    :func:`design_nodes`; hidden and backup ones count too, as files are collected from the raw tree."""
    size = lambda c: js_round(F.coalesce(F.col(c), F.lit(0.0))).cast("long")
    marked = nodes.filter(F.col("is_slice") & (F.col("slice_url") != ""))
    name = F.when(F.coalesce("name", F.lit("")) != "", F.col("name")).otherwise(F.lit("slice"))
    return marked.select(doc, "id", name.alias("name"), F.col("slice_url").alias("url"), size("fx").alias("x"), size("fy").alias("y"), size("fw").alias("w"), size("fh").alias("h"))
