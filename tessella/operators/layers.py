"""Design layers: classification and the cleaning passes, as one chain of joins and aggregates.

Layers have ``doc, seq`` (drawing order), ``name, type, x, y, w, h, fill, parent_path, is_slice,
image_url, text`` and the canvas size ``canvas_w, canvas_h``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.color import composed_color, effective_alpha
from tessella.functions.text import js_round
from tessella.operators.geometry import fragment_chains, inside_canvas, visible_fraction, visible_layers
from tessella.operators.sequence import keep_preferred_last
from tessella.session import shared_table

# Names that a design tool gives by itself, markers among them, and boolean operations.
AUTO_NAME = r"(?i)^(frame|group|编组|矩形|椭圆|形状|切片|蒙版|layer|rect|image|vector|line|subtract|union|intersect|difference)[\s_-]?\d*$"
MARKER_NAME = r"(?i)^(蒙版|mask|切片|slice)"
BOOLEAN_NAME = r"(?i)^(subtract|union|intersect|difference)([\s_-]?\d*)?$"
BACKUP_NAME = r"(?i)备份|backup"
LEAST_VISIBLE = 0.25


def layer_type(kind: Column) -> Column:
    """text, image or rect of a tool's own type name."""
    k = F.lower(F.coalesce(kind, F.lit("")))
    return F.when(k.rlike("text|label|font"), "text").when(k.rlike("image|bitmap|img"), "image").otherwise("rect")


def shown_name(name: Column, is_slice: Column) -> Column:
    """A layer's name, or null if the tool made it up; slices and markers keep theirs."""
    auto = F.trim(name).rlike(AUTO_NAME) & ~F.trim(name).rlike(MARKER_NAME)
    return F.when((name != "") & (F.coalesce(is_slice, F.lit(False)) | ~auto), name)


def is_contentful(*values: Column) -> Column:
    """Whether any of the drawing attributes is there."""
    return F.coalesce(*[v.cast("string") for v in values]).isNotNull()


def prune_reason(above: Column, name: Column, visible: Column) -> Column:
    """Why a node is pruned: hidden, backup or operand; null if it is not.

    ``above`` are its ancestors (``name, visible``) from the root down. A hidden or backup node takes its whole
    subtree, a boolean one what lies below it. The first reason from the root down counts.
    """
    own = lambda n, v: F.when(v == False, "hidden").when(n.rlike(BACKUP_NAME), "backup")  # noqa: E712, E731
    theirs = F.transform(above, lambda a: F.coalesce(own(a["name"], a["visible"]), F.when(F.trim(a["name"]).rlike(BOOLEAN_NAME), "operand")))
    return F.coalesce(F.get(F.array_compact(theirs), 0), own(name, visible))


def parent_path(above: Column) -> Column:
    """The ancestors' meaningful names joined by slashes; null if there is none."""
    names = F.array_compact(F.transform(above, lambda a: shown_name(a["name"], F.lit(False))))
    return F.when(F.size(names) > 0, F.array_join(names, "/"))


def fill_color(value: Column, color_alpha: Column, layer_opacity: Column, fill_opacity: Column) -> Column:
    """A fill with the alphas of colour, layer and fill composed in; missing alphas count as 1."""
    one = lambda c: F.coalesce(c, F.lit(1.0))
    return composed_color(value, effective_alpha(one(color_alpha), one(layer_opacity), one(fill_opacity)))


def clean_layers(layers: DataFrame, least_visible: float = LEAST_VISIBLE, occlusion: bool = True, fragments: bool = True) -> tuple[DataFrame, DataFrame]:
    """(layers, counters): the cleaning passes in order.

    Outside the canvas; repeated (slices by place and size, others by every field but the name; an
    image stays, else the last); covered whole by a later opaque layer; visible for less than
    ``least_visible`` of the area; chains of small fragments in a container. Text, slices and images
    are exempt from the last three. ``counters`` has a row a document. The layers are written as Parquet once
    with a mark of what the first two passes take, before the join that looks for covers, and once after that join.
    """
    exempt = (F.col("type") == "text") | F.coalesce("is_slice", F.lit(False)) | F.col("image_url").isNotNull()
    sized = F.coalesce((F.col("canvas_w") > 0) & (F.col("canvas_h") > 0), F.lit(False))
    slice_key = F.when(F.coalesce("is_slice", F.lit(False)), F.lit("slice"))
    rest = [F.when(slice_key.isNull(), F.col(c)) for c in ("type", "fill", "parent_path", "image_url", "text")]
    keys = [F.col("doc"), slice_key, F.col("x"), F.col("y"), F.col("w"), F.col("h"), *rest]
    input_counts = layers.groupBy("doc").agg(F.count("*").alias("n_input"))
    inside = inside_canvas(layers)
    # Of equal layers the one kept knows how many there were, so the pass needs no second look at the others.
    kept = keep_preferred_last(inside, keys, F.col("type") == "image", ["seq"])
    kept = shared_table(kept.select(*layers.columns, "group_size"), "layers-once")
    shown = visible_layers(kept) if occlusion else kept
    sliver = (~exempt & sized & (visible_fraction() < least_visible)) if least_visible > 0 else F.lit(False)
    # Written as the passes behind it read it several times, else each would look for covers anew.
    shown = shared_table(shown.select(*layers.columns, F.coalesce(sliver, F.lit(False)).alias("_sliver")), "layers-shown")
    if fragments:
        small = shown.filter(~F.col("_sliver") & ~exempt & F.col("parent_path").isNotNull())
        chain = fragment_chains(small.drop("_sliver"), ["doc", "parent_path"]).select("doc", "seq").withColumn("_chain", F.lit(True))
        shown = shown.join(chain, ["doc", "seq"], "left")
    else:
        shown = shown.withColumn("_chain", F.lit(None).cast("boolean"))
    marked = shown.select(*layers.columns, "_sliver", F.coalesce("_chain", F.lit(False)).alias("_chain"))
    before = kept.groupBy("doc").agg(F.sum("group_size").alias("n_inside"), F.count("*").alias("n_once"))
    after = marked.groupBy("doc").agg(F.count("*").alias("n_seen"), F.count(F.when(F.col("_sliver"), 1)).alias("n_sliver"), F.count(F.when(F.col("_chain"), 1)).alias("n_fragment"))
    n = lambda c: F.coalesce(c, F.lit(0))
    lost = {"outside": n("n_input") - n("n_inside"), "repeated": n("n_inside") - n("n_once")}
    lost |= {"occluded": n("n_once") - n("n_seen")} if occlusion else {}
    lost |= {"sliver": n("n_sliver")} if least_visible > 0 else {}
    lost |= {"fragment": n("n_fragment")} if fragments else {}
    counts = input_counts.join(before, "doc", "left").join(after, "doc", "left")
    counters = counts.select("doc", "n_input", *[c.alias(f"n_{name}") for name, c in lost.items()], (n("n_seen") - n("n_sliver") - n("n_fragment")).alias("n_kept"))
    return marked.filter("NOT _sliver AND NOT _chain").select(*layers.columns), counters


def rounded_frame(x: Column, y: Column, w: Column, h: Column) -> list[Column]:
    """Whole-pixel ``x, y, w, h``; missing numbers count as 0."""
    return [js_round(F.coalesce(v.try_cast("double"), F.lit(0.0))).cast("long").alias(n) for v, n in ((x, "x"), (y, "y"), (w, "w"), (h, "h"))]


def pruned_counts(nodes: DataFrame, doc: str = "doc") -> DataFrame:
    """``doc, n_nodes, n_hidden, n_backup, n_operand`` of design nodes, by the first reason of each."""
    marked = nodes.select(doc, prune_reason(F.col("above"), F.col("name"), F.col("visible")).alias("_why"))
    counts = [F.count(F.when(F.col("_why") == why, 1)).alias(f"n_{why}") for why in ("hidden", "backup", "operand")]
    return marked.groupBy(doc).agg(F.count("*").alias("n_nodes"), *counts)
