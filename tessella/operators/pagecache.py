"""Results of pages kept at two levels: a page's parts are looked up as a whole, then one by one, and only the
gaps of all pages are worked on, as one queue.

Parts have ``page, kind, type, pos, content``; ``kind`` sets a page's screenshots and its embedded pictures apart, so
that neither level of one hides the other's. Tables of results: ``page_key, pos, result, written_at`` for pages and
``key, result, written_at`` for parts; only good results are kept, so a failure is tried again.

Defined cases: null content, page, kind and type count as empty text in the keys, and null pages or kinds are pages
or kinds of their own; rows alike in all columns share a result; a page without parts has no row; empty tables give
empty results. Every join is on a part's own key or on (page key, place), so a page of any length is spread.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators.cache import content_key
from tessella.session import shared_checkpoint

PAGES = "page_key string, pos long, result string, written_at timestamp"
PARTS = "key string, result string, written_at timestamp"


def _digits(text: Column, start: int) -> Column:
    """Fifteen hex digits of a text's MD5 as a number."""
    return F.conv(F.substring(F.md5(text), start, 15), 16, 10).cast("decimal(20,0)")


def part_keys(parts: DataFrame, version: str = "1") -> DataFrame:
    """``parts`` with ``key``, of one part, and ``page_key`` and ``n_parts`` of its page and kind.

    A page's key is made of its parts' keys in their places by two sums, which are added up before the shuffle, so
    that no list of a page's parts is ever held.
    """
    keyed = parts.withColumn("key", content_key(F.col("page"), F.col("kind"), F.col("type"), F.md5(F.coalesce("content", F.lit(""))), F.lit(version)))
    placed = F.concat_ws(":", F.coalesce(F.col("pos").cast("string"), F.lit("")), F.col("key"))
    sums = keyed.groupBy(F.col("page").alias("g_page"), F.col("kind").alias("g_kind")).agg(
        F.count("*").alias("n_parts"), F.sum(_digits(placed, 1)).alias("g_a"), F.sum(_digits(placed, 16)).alias("g_b"))
    whole = sums.select("g_page", "g_kind", "n_parts", content_key(F.col("g_page"), F.col("g_kind"), F.lit(version), F.col("n_parts"), F.col("g_a"), F.col("g_b")).alias("page_key"))
    same = F.col("page").eqNullSafe(F.col("g_page")) & F.col("kind").eqNullSafe(F.col("g_kind"))
    return keyed.join(whole, same).drop("g_page", "g_kind")


def planned(keyed: DataFrame, pages: DataFrame, parts: DataFrame) -> DataFrame:
    """``keyed`` with ``level`` (``page``, ``part``, null for a gap) and the last written ``result`` of that level."""
    of_page = pages.groupBy(F.col("page_key").alias("r_page"), F.col("pos").alias("r_pos")).agg(F.max_by(F.struct("result"), "written_at").alias("by_page"))
    of_part = parts.groupBy(F.col("key").alias("r_key")).agg(F.max_by(F.struct("result"), "written_at").alias("by_part"))
    rows = keyed.join(of_page, (F.col("page_key") == F.col("r_page")) & (F.col("pos") == F.col("r_pos")), "left").join(of_part, F.col("key") == F.col("r_key"), "left")
    level = F.when(F.col("by_page").isNotNull(), "page").when(F.col("by_part").isNotNull(), "part")
    return rows.withColumn("level", level).withColumn("result", F.coalesce("by_page.result", "by_part.result")).drop("r_page", "r_pos", "r_key", "by_page", "by_part")


def gap_queue(plan: DataFrame) -> DataFrame:
    """``key, page, kind, type, pos, n_parts, content`` of the gaps, one of each key: the first by these columns."""
    first = F.min(F.struct("page", "kind", "type", "pos", "n_parts", "content"))
    return plan.filter("level IS NULL").groupBy("key").agg(first.alias("t")).select("key", "t.*")


def scattered(plan: DataFrame, worked: DataFrame) -> DataFrame:
    """``plan`` with the results of its gaps, and ``failed``: a gap whose work failed or is missing.

    ``worked`` has ``key, result, failed``, a row a key.
    """
    done = worked.select(F.col("key").alias("w_key"), F.col("result").alias("w_result"), F.coalesce("failed", F.lit(False)).alias("w_failed"))
    rows = plan.join(done, F.col("key") == F.col("w_key"), "left")
    gap = F.col("level").isNull()
    failed = gap & F.coalesce("w_failed", F.lit(True))
    return rows.withColumn("result", F.when(gap & ~failed, F.col("w_result")).otherwise(F.col("result"))).withColumn("failed", failed).drop("w_key", "w_result", "w_failed")


def page_entries(rows: DataFrame) -> DataFrame:
    """``page_key, pos, result`` of pages to be written: complete, and not read from their own entry as a whole."""
    state = rows.groupBy(F.col("page_key").alias("s_key")).agg(F.bool_or("failed").alias("s_failed"), F.bool_and(F.coalesce(F.col("level") == "page", F.lit(False))).alias("s_known"))
    return rows.join(state.filter("NOT s_failed AND NOT s_known"), F.col("page_key") == F.col("s_key")).select("page_key", F.col("pos").cast("long").alias("pos"), "result")


def page_summary(rows: DataFrame) -> DataFrame:
    """``page, kind, n_parts, n_page, n_part, n_worked, n_failed, cached`` of :func:`scattered`; a page's kind counts as
    cached if nothing of it had to be worked on."""
    level = lambda name: F.count_if(F.col("level") == name)
    return rows.groupBy("page", "kind").agg(
        F.count("*").alias("n_parts"), level("page").alias("n_page"), level("part").alias("n_part"),
        F.count_if(F.col("level").isNull() & ~F.col("failed")).alias("n_worked"), F.count_if("failed").alias("n_failed"), F.bool_and(F.col("level").isNotNull()).alias("cached"))


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.schema(schema).parquet(path) if store.exists(folder) else spark.createDataFrame([], schema)


def process_pages(parts: DataFrame, work: Callable[[DataFrame], DataFrame], store: str, version: str = "1") -> DataFrame:
    """Rows of :func:`scattered` for ``parts``; ``work`` maps :func:`gap_queue` to ``key, result, failed``.

    ``store`` is a shared folder. The work is done once, its table is written; the good parts are appended to the store
    before the pages. A run that is lost in between leaves parts without their page, and the next one finds them
    part by part, works on nothing again, and writes the page.
    """
    spark = parts.sparkSession
    plan = shared_checkpoint(planned(part_keys(parts, version), _stored(spark, f"{store}/pages", PAGES), _stored(spark, f"{store}/parts", PARTS)))
    worked = shared_checkpoint(work(gap_queue(plan)).select("key", "result", "failed"))
    good = worked.filter(~F.coalesce("failed", F.lit(False))).select("key", "result", F.current_timestamp().alias("written_at"))
    good.write.mode("append").parquet(f"{store}/parts")
    rows = shared_checkpoint(scattered(plan, worked))
    page_entries(rows).withColumn("written_at", F.current_timestamp()).write.mode("append").parquet(f"{store}/pages")
    return rows
