"""Writers: JSON per language, JSON rows, Markdown reports that spill beyond a size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Reports above so many bytes are written out, smaller ones may be returned.
SPILL_BYTES = 30 * 1024


def write_languages(entries: DataFrame, path: str) -> None:
    """One folder of JSON lines a language (``lang, key, text``)."""
    entries.select("lang", "key", "text").write.mode("overwrite").partitionBy("lang").json(path)


def write_rows(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines."""
    rows.write.mode("overwrite").json(path)


def split_by_size(reports: DataFrame, text: str = "markdown", most: int = SPILL_BYTES) -> tuple[DataFrame, DataFrame]:
    """(inline, spilled): reports of at most ``most`` bytes, and the others."""
    size = F.octet_length(F.coalesce(F.col(text), F.lit("")))
    return reports.filter(size <= most), reports.filter(size > most)


def write_reports(reports: DataFrame, path: str, doc: str = "doc", text: str = "markdown") -> DataFrame:
    """All reports as one table, sorted by document within files that a range of documents shares; returns its
    manifest ``doc, file, n_bytes``. However many reports there are, the number of files is that of tasks."""
    rows = reports.select(doc, F.col(text).alias("text"))
    rows.repartitionByRange(doc).sortWithinPartitions(doc).write.mode("overwrite").parquet(path)
    kept = reports.sparkSession.read.parquet(path)
    return kept.select(doc, F.input_file_name().alias("file"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
