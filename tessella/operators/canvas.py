"""What lies where on a page's canvas: panels, sections around pictures, texts that float over tables.

Widgets have ``doc, seq, x, y, w, h`` and ``lines`` (array of texts; null or empty: none). A widget without
a place takes no part. Joins are within a document; sections and groups are plain aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.text import js_round, utf16_length
from tessella.operators.geometry import contained, nearest_anchor, renamed
from tessella.operators.sequence import nearest_of

BIG_WIDTH, BIG_HEIGHT = 250, 200
SECTION_PICTURES, SECTION_CHARS, SECTION_RADIUS = 3, 3000, 400
CONTAINER_WIDTH, CONTAINER_HEIGHT = 150, 120
FLOAT_SLACK = 6
# Fixed value: heading of the texts near no picture.
SCATTERED = "【画布散落文字，未邻近任何界面截图】"


def _text(lines: Column, between: str = "\n") -> Column:
    return F.array_join(F.coalesce(lines, F.array().cast("array<string>")), between)


def containers(widgets: DataFrame) -> DataFrame:
    """Large widgets without text that are no table (``is_table``): the ground of a screen or panel, in whole pixels."""
    large = (F.col("w") >= CONTAINER_WIDTH) & (F.col("h") >= CONTAINER_HEIGHT)
    kept = widgets.filter(large & ~F.coalesce("is_table", F.lit(False)) & (_text(F.col("lines")) == ""))
    return kept.withColumns({c: js_round(F.col(c)).cast("long") for c in ("x", "y", "w", "h")})


def bounding_boxes(cells: DataFrame, key: str = "table_id") -> DataFrame:
    """``key, x, y, w, h``: the rectangle around a table's cells."""
    ends = cells.groupBy(key).agg(F.min("x").alias("x"), F.min("y").alias("y"), F.max(F.col("x") + F.col("w")).alias("_r"), F.max(F.col("y") + F.col("h")).alias("_b"))
    return ends.select(key, "x", "y", (F.col("_r") - F.col("x")).alias("w"), (F.col("_b") - F.col("y")).alias("h"))


def floats_in_cells(grid: DataFrame, axes: DataFrame, boxes: DataFrame, floats: DataFrame, key: str = "table_id", doc: str = "doc") -> DataFrame:
    """``key, row, col, text``: a grid whose empty places hold the texts of widgets that float over the table.

    ``axes`` are the grid's ``ys`` and ``xs``, ``boxes`` the tables' rectangles with their document. A float lies
    within a table's rectangle (``FLOAT_SLACK`` beyond) and goes to the row and column nearest to its centre;
    texts of one place are joined by a slash, in order. Places without a cell get one.
    """
    frame = renamed(boxes.join(axes, key), "t_", doc).withColumnRenamed(doc, "_doc")
    inside = (
        (F.col("x") >= F.col("t_x") - FLOAT_SLACK) & (F.col("y") >= F.col("t_y") - FLOAT_SLACK)
        & (F.col("x") + F.col("w") <= F.col("t_x") + F.col("t_w") + FLOAT_SLACK) & (F.col("y") + F.col("h") <= F.col("t_y") + F.col("t_h") + FLOAT_SLACK)
    )
    over = floats.select(doc, "seq", "x", "y", "w", "h", "lines").filter(_text(F.col("lines")) != "").join(frame, (F.col(doc) == F.col("_doc")) & inside)
    placed = over.select(
        F.col(f"t_{key}").alias(key), nearest_of(F.col("t_ys"), F.col("y") + F.col("h") / 2).alias("row"), nearest_of(F.col("t_xs"), F.col("x") + F.col("w") / 2).alias("col"),
        F.struct("seq", _text(F.col("lines"), "<br>").alias("t")).alias("e"),
    )
    texts = placed.groupBy(key, "row", "col").agg(F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["t"]), " / ").alias("_float"))
    full = grid.join(texts, [key, "row", "col"], "full")
    return full.select(key, "row", "col", F.when(F.coalesce("text", F.lit("")) != "", F.col("text")).otherwise(F.coalesce("_float", "text")).alias("text"))


def sections(blocks: DataFrame, pictures: DataFrame, doc: str = "doc") -> tuple[DataFrame, DataFrame]:
    """(sections, members): blocks around the nearest large picture.

    A document has sections if it has ``SECTION_PICTURES`` large pictures or ``SECTION_CHARS`` characters of text,
    and at least one large picture. A block (with lines or ``n_images``) belongs to the one nearest to its centre,
    the first on ties, within ``SECTION_RADIUS``; the others are scattered (section -1).
    ``sections`` are numbered by place from the top, pictures without blocks left out, with ``text`` in
    reading order, and a ``heading`` over scattered texts; ``members`` gives each block its ``section``.
    """
    rows = blocks.select(doc, "seq", "x", "y", "w", "h", "lines", "n_images").dropna(subset=["x", "y", "w", "h"])
    shown = rows.filter((_text(F.col("lines")) != "") | (F.coalesce("n_images", F.lit(0)) > 0))
    big = pictures.filter((F.col("w") >= BIG_WIDTH) & (F.col("h") >= BIG_HEIGHT))
    much = shown.groupBy(doc).agg(F.sum(utf16_length(_text(F.col("lines"), ""))).alias("_chars"))
    many = big.groupBy(doc).agg(F.count("*").alias("_n")).join(much, doc)
    cut = many.filter((F.col("_n") >= SECTION_PICTURES) | (F.col("_chars") >= SECTION_CHARS)).select(doc)
    shown, big = shown.join(cut, doc, "left_semi"), big.join(cut, doc, "left_semi")
    near = shown.join(nearest_anchor(shown, big, doc, SECTION_RADIUS).select(doc, "seq", "anchor"), [doc, "seq"])
    gathered = near.groupBy(doc, "anchor").agg(F.collect_list(F.struct("y", "x", "seq", _text(F.col("lines")).alias("t"))).alias("e"))
    at = renamed(big.select(doc, "seq", "x", "y", "w", "h"), "a_", doc).withColumnRenamed(doc, "_doc")
    loose, by_seq = F.col("anchor").isNull(), lambda e: F.struct(e["seq"], e["t"].alias("t"), e["x"], e["y"])
    lines = lambda entries: F.array_join(F.filter(F.transform(F.array_sort(entries), lambda e: e["t"]), lambda t: t != ""), "\n")
    told = gathered.select(
        doc, "anchor", F.when(loose, lines(F.transform("e", by_seq))).otherwise(lines(F.col("e"))).alias("text"),
        F.when(loose, F.array_min(F.transform("e", by_seq))).alias("first"))
    listed = told.join(at, (F.col("anchor") == F.col("a_seq")) & (F.col(doc) == F.col("_doc")), "left")
    # A row a picture is numbered, without its texts' entries.
    place = F.row_number().over(Window.partitionBy(doc).orderBy(loose, "a_y", "a_x", "anchor", "a_w", "a_h")) - 1
    whole = lambda own, other: js_round(F.when(loose, other).otherwise(F.col(own))).cast("long")
    found = listed.select(
        doc, F.when(loose, -1).otherwise(place).alias("section"), "anchor", whole("a_x", F.col("first.x")).alias("x"), whole("a_y", F.col("first.y")).alias("y"),
        whole("a_w", F.lit(0)).alias("w"), whole("a_h", F.lit(0)).alias("h"), "text", F.when(loose, F.lit(SCATTERED)).alias("heading"),
    )
    members = near.select(doc, "seq", "anchor").join(found.select(F.col(doc).alias("_doc"), F.col("anchor").alias("_anchor"), "section"), (F.col(doc) == F.col("_doc")) & F.col("anchor").eqNullSafe(F.col("_anchor")))
    return found, members.select(doc, "seq", "section")


def grouped_content(items: DataFrame, boxes: DataFrame, doc: str = "doc") -> DataFrame:
    """``doc, container, seq, place``: items by the smallest container that holds their centre, in reading order
    within it; those in none have a null container. Of repeated rows one counts; items without a document or ``seq`` are left out."""
    held = contained(items.dropna(subset=[doc, "seq"]), boxes, doc)
    # The container leads, as rows are sorted by their first key's value before the others are looked at.
    order = Window.partitionBy("container", doc).orderBy(*[F.asc_nulls_last(c) for c in ("y", "x", "seq")])
    placed = held.withColumns({"place": F.dense_rank().over(order) - 1, "_again": F.lag("seq").over(order) == F.col("seq")})
    return placed.filter(~F.coalesce("_again", F.lit(False))).select(doc, "container", "seq", "place")
