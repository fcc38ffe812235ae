"""Table operators: grids from cell rectangles, merging of adjacent and of similar tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.text import merge_key, trimmed
from tessella.operators.alike import header_links, joined_nodes, like_itself
from tessella.operators.sequence import anchored_clusters, nearest_of, neighbour, running_sum
from tessella.session import shared_table

ROW_TOLERANCE, COLUMN_TOLERANCE = 2, 3


def grid_cells(cells: DataFrame, table: str = "table_id") -> DataFrame:
    """``table, row, col, text``: cells (``x, y, seq, text``) placed in a grid.

    Rows and columns are anchored clusters of tops and lefts; a cell goes to the nearest of each, and
    the last cell of a place wins.
    """
    axes = cells.groupBy(table).agg(anchored_clusters(F.array_sort(F.collect_set("y")), ROW_TOLERANCE).alias("ys"), anchored_clusters(F.array_sort(F.collect_set("x")), COLUMN_TOLERANCE).alias("xs"))
    placed = cells.join(axes, table).select(table, nearest_of(F.col("ys"), F.col("y")).alias("row"), nearest_of(F.col("xs"), F.col("x")).alias("col"), "seq", "text")
    return placed.groupBy(table, "row", "col").agg(F.max_by("text", "seq").alias("text"))


def pruned_grid(grid: DataFrame, table: str = "table_id") -> DataFrame:
    """A grid without blank rows and, if any data row has text, without columns whose data is blank;
    tables of fewer than two columns go. Rows and columns are numbered anew."""
    full = F.coalesce(F.col("text"), F.lit("")) != ""
    some = lambda c, cond: F.array_sort(F.collect_set(F.when(cond, F.col(c))))
    shape = grid.groupBy(table).agg(some("row", full).alias("rows"), some("col", full & (F.col("row") > 0)).alias("data"), some("col", F.lit(True)).alias("all"))
    shape = shape.select(table, "rows", F.when(F.size("data") > 0, F.col("data")).otherwise(F.col("all")).alias("cols")).filter(F.size("cols") >= 2)
    place = lambda c: (F.array_position(f"{c}s", F.col(c)) - 1).cast("int").alias(c)
    return grid.join(shape, table).select(table, place("row"), place("col"), "text").filter("row >= 0 AND col >= 0")


def adjacent_merged(tables: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """Adjacent tables (``headers, rows, title, source, notes``) as one, their rows one after another.

    A table joins the one before it if it has headers, these and the source are the same, and it has no title
    or that of the table which the run began with. Notes are joined. A null title or note is as an empty one;
    tables without a position or key are left out.
    """
    keys = list(keys)
    mark = F.struct(F.array_join(F.coalesce("headers", F.array()), "\u0001", "").alias("h"), F.col("source").alias("s"))
    same = F.col("_prior").eqNullSafe(mark) & (F.size("headers") > 0)
    # An ordered operator reads its input twice, so each one's result is written before the next one reads it.
    marked = shared_table(neighbour(tables, mark, keys, pos, "_prior"), "marked")
    runs = shared_table(running_sum(marked, F.when(same, 0).otherwise(1), keys, pos, "_run").drop("_prior"), "runs")
    # Within a run a title opens a new table unless it is the last one that was named before.
    titled = F.coalesce("title", F.lit("")) != ""
    named = neighbour(runs.filter(titled), F.col("title"), [*keys, "_run"], pos, "_earlier")
    named = named.withColumn("_opens", F.when(F.col("_earlier") == F.col("title"), 0).otherwise(1)).drop("_earlier")
    parts = running_sum(shared_table(named.unionByName(runs.filter(~titled).withColumn("_opens", F.lit(0))), "named"), F.col("_opens"), [*keys, "_run"], pos, "_part")
    entries = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), "rows", "notes")))
    notes = F.array_join(F.filter(F.transform(entries, lambda e: e["notes"]), lambda n: n != ""), "；")
    first = lambda c: F.min_by(c, pos).alias(c)
    merged = parts.groupBy(*keys, "_run", "_part").agg(
        F.min(pos).alias(pos), first("headers"), first("title"), first("source"), F.flatten(F.transform(entries, lambda e: F.coalesce(e["rows"], F.array().cast("array<array<string>>")))).alias("rows"), notes.alias("notes")
    )
    return merged.drop("_run", "_part")


def _row_key(row: Column) -> Column:
    return merge_key(F.array_join(row, "|", ""))


def similar_merged(tables: DataFrame, doc: str = "doc", seq: str = "seq", alike: float = 0.7) -> DataFrame:
    """Tables (``title, headers, rows``) of a document merged greedily in order.

    A table joins the first earlier one that stands for itself and has the same title or headers more alike than
    ``alike``; of its rows those not yet there are added (a first table's own repeats stay). Tables that agree in
    title and headers are judged once (:mod:`tessella.operators.alike`), rows are merged by their keys.
    """
    title = F.coalesce("title", F.lit(""))
    rows = tables.select(doc, F.col(seq).cast("long").alias("_seq"), "title", "headers", "rows", F.when(title == "", F.lit("")).otherwise(F.concat(F.lit("="), merge_key(title))).alias("_key"))
    nodes = rows.groupBy(doc, "_key", "headers").agg(F.min("_seq").alias("node"))
    firsts = joined_nodes(nodes.withColumnRenamed("_key", "title"), header_links(nodes, alike, doc), doc)
    judged = nodes.join(firsts, [doc, "node"]).select(F.col(doc).alias("_doc"), F.col("_key").alias("_k"), F.col("headers").alias("_h"), "node", "first")
    same = (F.col(doc) == F.col("_doc")) & (F.col("_key") == F.col("_k")) & F.col("headers").eqNullSafe(F.col("_h"))
    # A copy of a table that is not even like itself stands for itself as the first one does.
    alone = (F.col("node") == F.col("first")) & (F.col("_key") == "") & ~F.coalesce(like_itself(F.col("headers"), alike), F.lit(False))
    placed = rows.join(judged, same).withColumn("_to", F.when(alone, F.col("_seq")).otherwise(F.col("first")))
    cells = placed.select(doc, "_to", "_seq", F.posexplode("rows").alias("_i", "_row"))
    seen = F.min(F.struct("_seq", "_i")).over(Window.partitionBy(doc, "_to", _row_key(F.col("_row"))))
    kept = cells.withColumn("_seen", seen).filter((F.col("_seq") == F.col("_to")) | (F.struct("_seq", "_i") == F.col("_seen")))
    listed = kept.groupBy(doc, F.col("_to").alias("_seq")).agg(F.transform(F.array_sort(F.collect_list(F.struct("_seq", "_i", "_row"))), lambda r: r["_row"]).alias("rows"))
    heads = placed.filter(F.col("_seq") == F.col("_to")).select(doc, "_seq", "title", "headers")
    merged = heads.join(listed, [doc, "_seq"], "left")
    return merged.select(doc, F.col("_seq").alias(seq), "title", "headers", F.coalesce("rows", F.array().cast("array<array<string>>")).alias("rows"))


def header_only(rows: Column) -> Column:
    """Whether no cell of a table's rows has text."""
    return ~F.exists(rows, lambda r: F.exists(r, lambda c: trimmed(F.coalesce(c, F.lit(""))) != ""))
