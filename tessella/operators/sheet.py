"""Reading spreadsheet grids: header resolution, pruning, blank rows, limits, single columns.

A grid is a DataFrame with ``_row`` (1-based, without gaps) and ``cells`` (array of strings). The
header row and short lists of wanted names are resolved on the driver; data rows stay distributed.
Rows past fifty blank rows in a row are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import is_blank, trimmed
from tessella.operators.sequence import blank_cut, running_sum

BLANK_STOP = 50
ROW_LIMIT = 200
COLUMN_LIMIT = 500


@dataclass
class Sheet:
    """Result of :func:`read_sheet`; ``rows`` has ``_row`` and ``values`` (map of header to text)."""

    headers: list[str]
    indexes: list[int]
    synthesised: bool
    rows: DataFrame
    totals: DataFrame


def header_names(cells: Sequence[str | None]) -> tuple[list[str], bool]:
    """Names of the columns: trimmed headers, ``Col{i}`` for blank ones; whether all were blank."""
    plain = [(c or "").strip() for c in cells]
    return [h or f"Col{i + 1}" for i, h in enumerate(plain)], not any(plain)


def pick_columns(names: Sequence[str], wanted: Sequence[str | int]) -> list[int]:
    """Indexes of the wanted columns, by name (any case, all duplicates) or by 1-based place, in the
    order of the request. Raises ValueError naming the columns there are if none matches."""
    picked: list[int] = []
    for w in wanted:
        if isinstance(w, int):
            hits = [w - 1] if 0 < w <= len(names) else []
        else:
            hits = [i for i, n in enumerate(names) if n.lower() == w.strip().lower()]
        picked += [i for i in hits if i not in picked]
    if not picked:
        there = ", ".join(f"{i + 1}.{n}" for i, n in enumerate(names))
        raise ValueError(f"no column matches {list(wanted)}; there are: {there}")
    return picked


def row_is_blank(cells: Column) -> Column:
    """Whether no cell has text."""
    return ~F.exists(cells, lambda c: ~is_blank(c))


def before_blank_tail(grid: DataFrame, stop: int = BLANK_STOP) -> DataFrame:
    """The grid's rows before the ``stop``-th blank row in a row."""
    cut = blank_cut(grid.withColumn("_sheet", F.lit(0)), row_is_blank(F.col("cells")), ["_sheet"], "_row", stop)
    limit = cut.agg(F.coalesce(F.max("cut"), F.lit(2**62)).alias("_cut"))  # one row
    return grid.join(F.broadcast(limit), F.col("_row") < F.col("_cut")).drop("_cut")


def _header(grid: DataFrame) -> list[str | None]:
    first = grid.filter(F.col("_row") == 1).select("cells").first()
    return list(first.cells or []) if first else []


def read_sheet(
    grid: DataFrame, columns: Sequence[str | int] | None = None, rows: Sequence[int] | None = None, limit: int = ROW_LIMIT
) -> Sheet:
    """Data rows of a grid: blank rows skipped, columns and rows pruned, at most ``limit`` rows (0: all).

    Without ``columns`` the headers are those that have a name or any cell in the rows read (a cell of white space
    counts); if no header has a name, all columns stay, used or not.

    ``totals`` is one row ``total_rows, kept_rows, truncated``; reading stops at the limit, so
    ``total_rows`` counts up to there and exactly ``limit`` rows count as truncated. An empty grid
    gives no headers and no rows.
    """
    names, synthesised = header_names(_header(grid))
    indexes = pick_columns(names, columns) if columns else list(range(len(names)))
    data = before_blank_tail(grid).filter((F.col("_row") > 1) & ~row_is_blank(F.col("cells")))
    wanted = data.filter(F.col("_row").isin(list(rows))) if rows else data
    kept = wanted.orderBy("_row").limit(limit) if limit else wanted
    pairs = [F.struct(F.lit(names[i]).alias("key"), F.get(F.col("cells"), i).alias("value")) for i in indexes]
    filled = F.filter(F.array(*pairs), lambda p: p["value"].isNotNull() & (p["value"] != "")) if pairs else F.array()
    values = F.map_from_entries(filled) if pairs else F.create_map().cast("map<string,string>")
    out = kept.select("_row", values.alias("values"))
    end = kept.agg(F.count("*").alias("kept_rows"), F.max("_row").alias("_last"))
    reached = F.lit(bool(limit)) & (F.col("kept_rows") >= limit)
    # The one row of ``end`` is joined to two sums, not to the rows.
    seen = data.join(F.broadcast(end.select("_last")), F.lit(True), "left").agg(F.count("*").alias("all_rows"), F.count(F.when(F.col("_row") <= F.col("_last"), 1)).alias("upto_last"))
    totals = end.join(F.broadcast(seen), F.lit(True)).select("kept_rows", F.when(reached, F.col("upto_last")).otherwise(F.col("all_rows")).alias("total_rows"), reached.alias("truncated"))
    if columns:
        headers = [names[i] for i in indexes]
    else:
        unnamed = [] if synthesised else [i for i, c in enumerate(_header(grid)) if not (c or "").strip()]
        has_cell = [F.max(F.coalesce(F.get(F.col("cells"), i) != "", F.lit(False))).alias(f"c{i}") for i in unnamed]
        used = before_blank_tail(grid).agg(*has_cell).first() if unnamed else {}
        headers = [n for i, n in enumerate(names) if i not in unnamed or used[f"c{i}"]]
    return Sheet(headers, indexes, synthesised, out, totals)


def flat_rows(sheet: Sheet) -> DataFrame:
    """``_row`` and a column for each header; null where a cell is empty."""
    return sheet.rows.select("_row", *[F.col("values").getItem(h).alias(h) for h in dict.fromkeys(sheet.headers)])


def read_column(grid: DataFrame, column: str | int, rows: Sequence[int] | None = None, limit: int = COLUMN_LIMIT) -> DataFrame:
    """``_row, value`` of one column (the first of that name, or a 1-based place).

    Blank cells stay as empty text. With ``rows`` exactly those rows from 2 on are looked up; without,
    reading stops at the ``limit``-th filled cell or at fifty blank cells in a row.
    """
    names, _ = header_names(_header(grid))
    index = pick_columns(names, [column])[0]
    cells = grid.filter(F.col("_row") >= 2).select("_row", F.coalesce(F.get(F.col("cells"), index), F.lit("")).alias("value"))
    if rows:
        return cells.filter(F.col("_row").between(min(rows), max(rows)) & F.col("_row").isin(sorted(set(rows))))
    keyed = cells.withColumn("_sheet", F.lit(0)).withColumn("_at", F.col("_row") - 1)
    cut = blank_cut(keyed, is_blank(F.col("value")), ["_sheet"], "_at", BLANK_STOP).agg(F.coalesce(F.max("cut"), F.lit(2**62)).alias("_cut"))
    keyed = keyed.join(F.broadcast(cut), F.col("_at") <= F.col("_cut")).drop("_cut")
    if limit:
        count = F.when(is_blank(F.col("value")), 0).otherwise(1)
        keyed = running_sum(keyed, count, ["_sheet"], "_row", "_filled")
        keyed = keyed.filter((F.col("_filled") < limit) | ((F.col("_filled") == limit) & (trimmed(F.col("value")) != "")))
    return keyed.select("_row", "value")
