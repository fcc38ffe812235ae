"""Rectangle operators: anti joins by containment, nearest and smallest partners, bands and grids.

Rectangles have a document key and ``seq`` (their order in it, unique there), ``x, y, w, h``. Containment and
nearest partners are joined by tiles (:mod:`tessella.operators.spatial`), so partners meet within a document's
tiles only. Ties go to the smaller ``seq``.

Defined cases: rectangles without a place or document meet nothing and are kept by the anti joins; of repeated rows one
result row is given, but the anti joins keep or drop them all; empty tables give no rows; columns that begin with an
underscore, ``o_`` or ``c_`` are the operators' own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.color import is_opaque_solid
from tessella.functions.text import utf16_length
from tessella.operators.sequence import anchored_clusters
from tessella.operators.spatial import framed, least_boxes, nearest_boxes, points_in_boxes, points_in_no_box, with_smallest_box


def renamed(rects: DataFrame, prefix: str, doc: str = "doc") -> DataFrame:
    """All columns but the document key with a prefix, for self-joins."""
    return rects.select(doc, *[F.col(c).alias(f"{prefix}{c}") for c in rects.columns if c != doc])


def _holds(outer: str, inner: str, slack: float = 0) -> Column:
    c = lambda p, n: F.col(f"{p}{n}")
    return (
        (c(outer, "x") - slack <= c(inner, "x"))
        & (c(outer, "y") - slack <= c(inner, "y"))
        & (c(outer, "x") + c(outer, "w") + slack >= c(inner, "x") + c(inner, "w"))
        & (c(outer, "y") + c(outer, "h") + slack >= c(inner, "y") + c(inner, "h"))
    )


def visible_layers(layers: DataFrame, doc: str = "doc") -> DataFrame:
    """Layers (with ``type, fill, is_slice, image_url``) that no later opaque solid layer covers whole.

    Text, slices and images are never removed; text never covers.
    """
    cover = renamed(layers.filter((F.col("type") != "text") & is_opaque_solid(F.col("fill"))).select(doc, "seq", "x", "y", "w", "h"), "o_", doc)
    exempt = (F.col("type") == "text") | F.coalesce("is_slice", F.lit(False)) | F.col("image_url").isNotNull()
    return _without_held(layers, cover, (F.col("o_seq") > F.col("seq")) & ~exempt, doc)


def _without_held(rects: DataFrame, other: DataFrame, condition: Column, doc: str, slack: float = 0) -> DataFrame:
    """``rects`` without those that lie in one of ``other`` (``o_`` columns) under a condition on the pair.

    A rectangle lies in another only if its corner does, so the corner looks for holders in its tile.
    """
    corners = rects.withColumns({"_px": F.col("x").cast("double"), "_py": F.col("y").cast("double")})
    holders = framed(other, doc, slack, "o_x", "o_y", "o_w", "o_h")
    return points_in_no_box(corners, holders, doc, condition & _holds("o_", "", slack)).drop("_px", "_py")


def outer_containers(rects: DataFrame, doc: str = "doc", slack: float = 2) -> DataFrame:
    """Rectangles that do not lie in a strictly larger one of their document (within ``slack``)."""
    other = renamed(rects.select(doc, "seq", "x", "y", "w", "h"), "o_", doc)
    return _without_held(rects, other, F.col("o_w") * F.col("o_h") > F.col("w") * F.col("h"), doc, slack)


def _centres(rects: DataFrame, doc: str, *kept: str) -> DataFrame:
    middle = lambda at, size: (F.col(at) + F.col(size) / 2).cast("double")
    return rects.select(doc, "seq", *kept, middle("x", "w").alias("_px"), middle("y", "h").alias("_py"))


def smallest_container(items: DataFrame, containers: DataFrame, doc: str = "doc", crowded: bool = False) -> DataFrame:
    """``doc, seq, container``: the smallest container that holds an item's centre, or null.

    ``crowded`` is for pages on which many containers lie on one another: those that cannot be the smallest
    are left out before items meet them, at the price of two more shuffles of the containers.
    """
    boxes = renamed(containers.select(doc, "seq", "x", "y", "w", "h"), "c_", doc)
    centres = _centres(items, doc)
    frame, order = framed(boxes, doc, 0, "c_x", "c_y", "c_w", "c_h"), F.struct((F.col("c_w") * F.col("c_h")).alias("area"), "c_seq")
    pairs = least_boxes(centres, frame, order, doc) if crowded else points_in_boxes(centres, frame, doc).withColumn("_order", order)
    held = pairs.select(doc, "seq", F.col("_order").alias("c"))
    alone = centres.select(doc, "seq", F.lit(None).cast(held.schema["c"].dataType).alias("c"))
    return held.unionByName(alone).groupBy(doc, "seq").agg(F.min("c").alias("c")).select(doc, "seq", F.col("c.c_seq").alias("container"))


def contained(items: DataFrame, containers: DataFrame, doc: str = "doc") -> DataFrame:
    """``doc, seq, x, y, container``: items with the smallest container as :func:`smallest_container` finds it, for pages of any
    crowd; repeated rows may be kept."""
    return with_smallest_box(_centres(items, doc, "x", "y"), containers, doc).select(doc, "seq", "x", "y", F.col("box").alias("container"))


def nearest_anchor(blocks: DataFrame, anchors: DataFrame, doc: str = "doc", radius: float = 400) -> DataFrame:
    """``doc, seq, anchor, distance``: the anchor nearest to a block's centre, null beyond ``radius``."""
    best = nearest_boxes(_centres(blocks, doc), anchors, radius, ["seq"], doc)
    return best.select(doc, "seq", F.col("best.seq").alias("anchor"), F.col("best.d").alias("distance"))


def inferred_titles(tables: DataFrame, blocks: DataFrame, doc: str = "doc") -> DataFrame:
    """``doc, seq, title``: the text block right above a table, or null.

    It has 2 to 80 characters, overlaps by a fifth of the width (80 at most), ends at most 30 below
    the table's top and at most 120 above it; the least gap wins.
    """
    text = renamed(blocks.filter(utf16_length(F.col("text")).between(2, 80)).select(doc, "seq", "x", "y", "w", "h", "text"), "b_", doc).withColumnRenamed(doc, "_doc")
    overlap = F.least(F.col("b_x") + F.col("b_w"), F.col("x") + F.col("w")) - F.greatest("b_x", "x")
    bottom = F.col("b_y") + F.col("b_h")
    above = (overlap >= F.least(F.col("w") * 0.2, F.lit(80.0))) & (bottom <= F.col("y") + 30) & (F.col("y") - bottom <= 120)
    joined = tables.join(text, (F.col(doc) == F.col("_doc")) & above, "left")
    return joined.groupBy(doc, "seq").agg(F.min_by("b_text", F.struct(F.col("y") - bottom, "b_seq")).alias("title"))


def scroll_points(content: Column, view: Column, overlap: int = 100) -> Column:
    """Scroll positions that show all of ``content``: steps of view less overlap (100 at least), the
    last one flush with the end."""
    most = F.greatest(content - view, F.lit(0)).cast("long")
    step = F.greatest(view - overlap, F.lit(100)).cast("long")
    below = F.when(most > 0, F.sequence(F.lit(0).cast("long"), most - 1, step)).otherwise(F.array().cast("array<bigint>"))
    return F.concat(below, F.array(most))


def needed_cells(rects: DataFrame, pages: DataFrame, doc: str = "doc") -> DataFrame:
    """``doc, cell``: cells (row * columns + column) of the scroll grid that show some rectangle.

    ``pages`` has ``content_w, content_h, view_w, view_h``. A rectangle is sent only to the few cells
    it meets.
    """
    grid = pages.select(doc, "content_w", "content_h", "view_w", "view_h", scroll_points(F.col("content_w"), F.col("view_w")).alias("xs"), scroll_points(F.col("content_h"), F.col("view_h")).alias("ys"))
    meets = lambda lo, size, view, total: lambda p: (F.col(lo) + F.col(size) > p) & (F.col(lo) < F.least(p + F.col(view), F.col(total)))
    places = lambda points, cond: F.filter(F.transform(points, lambda p, i: F.when(cond(p), i)), lambda i: i.isNotNull())
    hit = rects.join(grid, doc).select(
        doc, F.size("xs").alias("n"), places("xs", meets("x", "w", "view_w", "content_w")).alias("xi"), places("ys", meets("y", "h", "view_h", "content_h")).alias("yi")
    )
    cells = F.flatten(F.transform("yi", lambda y: F.transform("xi", lambda x: y * F.col("n") + x)))
    # A page's cells are gathered as the bits of a few numbers, so an aggregate holds a row for 60 cells, not one for each.
    each = hit.select(doc, F.explode(cells).alias("cell"))
    words = each.groupBy(doc, F.expr("cell div 60").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cell % 60)")).alias("_bits"))
    found = F.filter(F.sequence(F.lit(0), F.lit(59)), lambda i: F.getbit("_bits", i) == 1)
    return words.select(doc, "_word", F.explode(found).alias("_bit")).select(doc, (F.col("_word") * 60 + F.col("_bit")).cast("int").alias("cell"))


def inside_canvas(layers: DataFrame) -> DataFrame:
    """Layers that touch the canvas (``canvas_w, canvas_h``); all of them where it has no size."""
    out = (F.col("x") + F.col("w") <= 0) | (F.col("y") + F.col("h") <= 0) | (F.col("x") >= F.col("canvas_w")) | (F.col("y") >= F.col("canvas_h"))
    sized = F.coalesce((F.col("canvas_w") > 0) & (F.col("canvas_h") > 0), F.lit(False))
    return layers.filter(~(sized & out))


def visible_fraction() -> Column:
    """Share of a layer's area that lies on the canvas."""
    vw = F.least(F.col("x") + F.col("w"), F.col("canvas_w")) - F.greatest("x", F.lit(0))
    vh = F.least(F.col("y") + F.col("h"), F.col("canvas_h")) - F.greatest("y", F.lit(0))
    return F.greatest(vw, F.lit(0)) * F.greatest(vh, F.lit(0)) / (F.col("w") * F.col("h"))


def banded(rects: DataFrame, keys: list[str], tolerance: float, out: str = "band") -> DataFrame:
    """``rects`` with the anchor ``y`` of their band; bands are anchored clusters of a group's ``y``."""
    ys = rects.groupBy(*keys).agg(anchored_clusters(F.array_sort(F.collect_set("y")), tolerance).alias("_anchors"))
    anchor = F.array_max(F.filter("_anchors", lambda a: a <= F.col("y")))
    return rects.join(ys, keys).withColumn(out, anchor).drop("_anchors")


def fragment_chains(rects: DataFrame, keys: list[str], most_w: float = 24, most_h: float = 8, gap: float = 6, least: int = 4, uneven: float = 1.3) -> DataFrame:
    """Small rectangles that form a chain: at least ``least`` in a band, each within ``gap`` of the one
    before, widths uneven by a factor. Bands tolerate 2; keys are a container of a document."""
    small = banded(rects.filter((F.col("w") <= most_w) & (F.col("h") <= most_h)), keys, 2)
    order = Window.partitionBy(*keys, "band").orderBy("x", "seq")
    prior = F.lag(F.col("x") + F.col("w")).over(order)
    small = small.withColumn("_break", F.when(F.abs(F.col("x") - prior) <= gap, 0).otherwise(1))
    runs = small.withColumn("_run", F.sum("_break").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    stats = runs.groupBy(*keys, "band", "_run").agg(F.count("*").alias("_n"), (F.max("w") / F.min("w")).alias("_ratio"))
    sizes = small.groupBy(*keys, "band").agg(F.count("*").alias("_band_n"))
    found = runs.join(stats, [*keys, "band", "_run"]).join(sizes, [*keys, "band"])
    return found.filter((F.col("_n") >= least) & (F.col("_band_n") >= least) & (F.col("_ratio") >= uneven)).select(rects.columns)


def reading_lines(items: DataFrame, doc: str = "doc", tolerance: float = 12, joint: str = " ｜ ") -> DataFrame:
    """``doc, band, line``: items (``text``) of one reading row joined by x, equal texts of a row once."""
    rows = banded(items, [doc], tolerance)
    once = rows.groupBy(doc, "band", "text").agg(F.min(F.struct("y", "x", "seq")).alias("at"))
    gathered = once.groupBy(doc, "band").agg(F.array_sort(F.collect_list(F.struct(F.col("at.x").alias("x"), F.col("at.y").alias("y"), F.col("at.seq").alias("seq"), "text"))).alias("t"))
    return gathered.select(doc, "band", F.array_join(F.transform("t", lambda s: s["text"]), joint).alias("line"))


def connector_edges(connectors: DataFrame, nodes: DataFrame, doc: str = "doc", tolerance: float = 60) -> DataFrame:
    """``doc, from, to``: connectors' ends snapped to the nearest nodes.

    ``connectors`` has two end candidates on each side (``sx1, sy1, sx2, sy2, ex1, ey1, ex2, ey2``)
    and ``seq``. Each candidate takes its nearest node within ``tolerance``; the pair of different
    nodes with the least sum wins, the first connector of an edge stays, and a document counts only
    with three nodes and two edges or more.
    """
    ends = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(s).alias("side"), F.col(f"{p}x{k}").cast("double").alias("px"), F.col(f"{p}y{k}").cast("double").alias("py")) for i, (s, p, k) in enumerate([("s", "s", 1), ("s", "s", 2), ("e", "e", 1), ("e", "e", 2)])])
    points = connectors.select(doc, F.col("seq").alias("c_seq"), F.explode(ends).alias("p")).select(doc, "c_seq", "p.*")
    several = nodes.groupBy(doc).agg(F.count("*").alias("_n")).filter("_n >= 3").select(doc)
    boxes = nodes.join(several, doc, "left_semi").select(doc, "seq", "x", "y", "w", "h")
    best = nearest_boxes(points.withColumnsRenamed({"px": "_px", "py": "_py"}), boxes, tolerance, ["c_seq", "i", "side"], doc).filter(F.col("best").isNotNull())
    best = best.select(doc, "c_seq", "i", "side", F.struct("best.d", F.col("best.seq").alias("n_seq")).alias("b"))
    start = best.filter("side = 's'").select(doc, "c_seq", F.col("i").alias("si"), F.col("b.d").alias("sd"), F.col("b.n_seq").alias("from"))
    end = best.filter("side = 'e'").select(doc, "c_seq", F.col("i").alias("ei"), F.col("b.d").alias("ed"), F.col("b.n_seq").alias("to"))
    pairs = start.join(end, [doc, "c_seq"]).filter(F.col("from") != F.col("to"))
    chosen = pairs.groupBy(doc, "c_seq").agg(F.min(F.struct((F.col("sd") + F.col("ed")).alias("cost"), "si", "ei", "from", "to")).alias("b"))
    edges = chosen.groupBy(doc, F.col("b.from").alias("from"), F.col("b.to").alias("to")).agg(F.min("c_seq").alias("c_seq"))
    enough = edges.groupBy(doc).agg(F.count("*").alias("_n")).filter("_n >= 2").select(doc)
    return edges.join(enough, doc, "left_semi")


def linked_nodes(nodes: DataFrame, edges: DataFrame, doc: str = "doc") -> DataFrame:
    """The nodes that an edge of :func:`connector_edges` begins or ends at; isolated ones go."""
    ends = edges.select(doc, F.explode(F.array("from", "to")).alias("seq")).distinct()
    return nodes.join(ends, [doc, "seq"], "left_semi")
