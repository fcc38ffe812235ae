"""Streams of tasks worked off against a table of results, so that only gaps are worked on again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessella.operators.cache import open_tasks

#: Folders of results.
RANGES = 64


def _results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The results so far; empty before the first batch."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.schema(schema).parquet(path) if store.exists(hadoop) else spark.createDataFrame([], schema)


def resume_stream(tasks: DataFrame, work: Callable[[DataFrame], DataFrame], results: str, schema: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Run ``work`` on each batch's tasks (``key`` and others) that have no good result yet.

    ``work`` maps tasks to ``schema`` (with ``key`` and ``failed``). Each batch appends to ``results``
    and is recorded in ``checkpoint``; a batch that is replayed after a failure finds its own results
    and does nothing twice. Failed results are kept as rows, and their tasks are open again. Results lie in
    ``RANGES`` folders by hash of the key, and a batch reads only the folders its tasks' keys fall in.
    """
    folder = F.pmod(F.xxhash64("key"), F.lit(RANGES)).cast("int")

    def batch(rows: DataFrame, _: int) -> None:
        wanted = [r.folder for r in rows.select(folder.alias("folder")).distinct().collect()]  # at most RANGES
        known = _results(rows.sparkSession, results, f"{schema}, folder int").filter(F.col("folder").isin(wanted)).drop("folder")
        work(open_tasks(rows, known)).withColumn("folder", folder).write.mode("append").partitionBy("folder").parquet(results)

    writer = tasks.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
