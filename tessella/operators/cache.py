"""Content-keyed results: keys, what is still open, last-written lookups and totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_key(*parts: Column) -> Column:
    """MD5 of the parts joined by ``::``; null parts count as empty."""
    return F.md5(F.concat_ws("::", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def open_tasks(tasks: DataFrame, cache: DataFrame, key: str = "key") -> DataFrame:
    """Tasks without a cached result, one of each key (the first by its columns), so that equal tasks
    run once. Failed results (``failed``) never count as cached."""
    good = cache.filter(~F.coalesce("failed", F.lit(False))) if "failed" in cache.columns else cache
    todo = tasks.join(good.select(key).distinct(), key, "left_anti")
    rest = [c for c in tasks.columns if c != key]
    return todo.groupBy(key).agg(F.min(F.struct(*rest)).alias("_t")).select(key, "_t.*")


def with_results(tasks: DataFrame, cache: DataFrame, values: Sequence[str], key: str = "key", version: str = "written_at") -> DataFrame:
    """``tasks`` with the last written good result of their key, null where there is none."""
    good = cache.filter(~F.coalesce("failed", F.lit(False))) if "failed" in cache.columns else cache
    last = good.groupBy(key).agg(F.max_by(F.struct(*values), version).alias("_r"))
    return tasks.join(last, key, "left").select(*tasks.columns, *[F.col(f"_r.{v}").alias(v) for v in values])


def cache_totals(cache: DataFrame, payload: str) -> DataFrame:
    """``n_entries, n_bytes`` of a cache table."""
    return cache.agg(F.count("*").alias("n_entries"), F.coalesce(F.sum(F.octet_length(payload)), F.lit(0)).alias("n_bytes"))
