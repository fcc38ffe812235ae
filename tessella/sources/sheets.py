"""Sheet payloads: recorded cell ranges as grids, sheet lists from a token stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import cell_text, trimmed
from tessella.operators.sequence import filled, keep_first

# Names of the sources, types of files that have sheets, and the reason where a stream names none.
STREAM, EXPORT, SHEET_TYPES = "content-api", "xlsx-export", ("mosheet", "sheet")
NO_TOKEN = "content 中未解析出任何工作表 token"
SHOWN_HEADERS = 12
TOKEN = r'"(B:[^"]+|C\*[0-9]+)"'


def grid_from_ranges(ranges: DataFrame) -> DataFrame:
    """``_row, cells`` of recorded ranges (``start_row, values``); rows of overlapping ranges: the last
    range's. ``values`` holds JSON cell values (array of arrays of strings)."""
    rows = ranges.select("start_row", F.posexplode("values").alias("at", "raw"))
    keyed = rows.select((F.col("start_row") + F.col("at")).alias("_row"), "start_row", F.transform("raw", cell_text).alias("cells"))
    return keyed.groupBy("_row").agg(F.max_by("cells", "start_row").alias("cells"))


def read_ranges(spark, path: str) -> DataFrame:
    """Recorded ranges from JSON lines ``{"start_row": n, "values": [[...], ...]}``."""
    raw = spark.read.text(path)
    parsed = raw.select(F.from_json("value", "start_row bigint, values array<array<string>>").alias("r"))
    return parsed.select("r.*").filter("values IS NOT NULL")


def sheet_list(streams: DataFrame, key: str = "file_id", raw: str = "raw") -> DataFrame:
    """``key, name, index`` of the sheets named in a content stream.

    Names (``"B:name"``) take the index of the next ``"C*n"``; names after the last one are lost; the
    first of equal names stays.
    """
    tokens = streams.select(key, F.posexplode(F.regexp_extract_all(F.col(raw), F.lit(TOKEN), F.lit(1))).alias("pos", "token"))
    number = F.when(F.col("token").startswith("C*"), F.substring(F.col("token"), F.lit(3), F.length("token")).cast("int"))
    found = filled(tokens, number, [key], "pos", "index", backward=True)
    names = found.filter(F.col("token").startswith("B:") & F.col("index").isNotNull())
    named = names.select(key, F.substring(F.col("token"), F.lit(3), F.length("token")).alias("name"), "index", "pos")
    return keep_first(named, [F.col(key), F.col("name")], ["index", "pos"]).select(key, "name", "index")


def sheets_with_fallback(files: DataFrame, cells: DataFrame) -> DataFrame:
    """``file_id, document, source, fallback_reason, error, name, index, rows, cols, headers``: each file's sheets from its
    content stream, or from its exported workbook where the stream failed or names no sheet.

    ``files`` have ``file_id, name, type, raw`` (the stream) and ``list_error``; ``cells`` (``file_id, sheet, _row, cells``)
    are the rows of exported workbooks, counted from 1. A file of a type without sheets is a row with ``error``; a null type
    is unknown and read. Sheets of a stream have their ``index``, those of a workbook their filled rows below the first,
    and number and first ones of its headers. A file without any sheet keeps one row without a name; null ids
    are left out; a failed file never stops the others.
    """
    known = files.filter("file_id IS NOT NULL")
    wrong = F.col("type").isNotNull() & ~F.col("type").isin(*SHEET_TYPES)
    document = F.coalesce(F.when(F.col("name") != "", F.col("name")), F.col("file_id").cast("string")).alias("document")
    bad = known.filter(wrong).select("file_id", document, F.concat(F.lit("no sheets in type "), "type").alias("error"))
    usable = known.filter(~wrong).select("file_id", document, "list_error", F.when(F.col("list_error").isNull(), F.col("raw")).alias("raw"))
    listed = sheet_list(usable)
    streamed = usable.join(listed, "file_id").select("file_id", "document", F.lit(STREAM).alias("source"), "name", "index")
    filled_row = F.exists("cells", lambda c: trimmed(F.coalesce(c, F.lit(""))) != "")
    first = F.filter(F.max(F.when(F.col("_row") == 1, F.col("cells"))), lambda c: c.isNotNull() & (c != ""))
    books = cells.groupBy("file_id", F.col("sheet").alias("name")).agg(F.count(F.when((F.col("_row") > 1) & filled_row, 1)).alias("rows"), F.coalesce(first, F.array().cast("array<string>")).alias("_first"))
    books = books.select("file_id", "name", "rows", F.size("_first").alias("cols"), F.slice("_first", 1, SHOWN_HEADERS).alias("headers"))
    failed = usable.join(listed.select("file_id").distinct(), "file_id", "left_anti")
    exported = failed.join(books, "file_id", "left").select("file_id", "document", F.lit(EXPORT).alias("source"), F.coalesce("list_error", F.lit(NO_TOKEN)).alias("fallback_reason"), "name", "rows", "cols", "headers")
    out = streamed.unionByName(exported, allowMissingColumns=True).unionByName(bad, allowMissingColumns=True)
    return out.select("file_id", "document", "source", "fallback_reason", "error", "name", "index", "rows", "cols", "headers")
