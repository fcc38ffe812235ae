"""Helpers the training-data operators share: the shared folder, written tables, words."""

from __future__ import annotations

import atexit
import ctypes
import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.session import shared_folder

#: A word everywhere in the contracts: a run of anything but these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
#: A table is broadcast only if it is proven to have at most so many rows and so many bytes.
BROADCAST_ROWS = 400_000
BROADCAST_BYTES = 64 * 2**20
#: Python tasks work off Arrow batches in slices of about so many bytes of text.
SLICE_BYTES = 2 * 2**20
#: Spark's setting for the bytes of an Arrow batch, its default, and what the operators set instead.
BATCH_SETTING, DEFAULT_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", 4 * 2**20


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: texts by their length, arrays by their entries."""
    total = F.lit(0)
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        column = F.col(f"`{field.name}`")
        own = F.octet_length(column) if kind in ("string", "binary") else F.size(column) * 12 if kind == "array" else F.lit(0)
        total = total + F.greatest(F.coalesce(own, F.lit(0)), F.lit(0)) + 8
    return total


def small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if its rows and bytes are proven few; else as it is, for a shuffle join."""
    n, size = df.select(row_bytes(df).alias("b")).agg(F.count("*"), F.coalesce(F.sum("b"), F.lit(0))).first()  # a row a partition
    return F.broadcast(df) if n <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df


def in_batches(df: DataFrame) -> DataFrame:
    """``df``, whose Arrow batches are to be small: the session's bound on their bytes is lowered if it is the default.

    The JVM keeps the native memory of large batches, and workers hold several times a batch.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING) == DEFAULT_BATCH:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return df


def release_memory() -> None:
    """Give the free pages of this process's heap back to the system, as its workers live on beside the JVM; nothing
    happens where the C library has no call for it."""
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def slices(batches: Iterable[pa.RecordBatch], text: int | str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches joined and cut into slices of about ``most`` bytes of the text column (one row at least).

    What a task makes of a batch in Python is several times larger, so tasks make it slice by slice. What
    they free goes back to the system at once, as workers are reused.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    held, size = [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        slot = (size + np.cumsum(sizes, dtype=np.int64) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), batch.num_rows]
        parts = [batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a]
        if held and (not parts or slot[0]):
            yield pa.concat_batches(held)
            held, size = [], 0
        for part in parts[:-1]:
            yield pa.concat_batches([*held, part]) if held else part
            held, size = [], 0
        if parts:
            held.append(parts[-1])
            size += int(sizes[len(sizes) - parts[-1].num_rows :].sum())
    if held:
        yield pa.concat_batches(held) if len(held) > 1 else held[0]
    del held
    release_memory()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it; see :func:`tessella.session.shared_folder`."""
    return shared_folder(spark)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared one; removed when the driver ends."""
    path = f"{shared_dir(spark)}/tessella/{name}-{uuid.uuid4().hex}"
    atexit.register(drop_folder, spark, path)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system; a session that has ended is left alone."""
    context = spark.sparkContext
    if context._jsc is None or context._gateway is None:
        return
    try:
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the gateway may be gone at interpreter exit
        return


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    Cuts lineage, survives the loss of any executor, and fixes values such as
    ``monotonically_increasing_id`` that a recomputation could change.
    """
    path = new_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def uniform(*columns: Column, seed: int) -> Column:
    """A reproducible number in the open interval (0, 1) drawn from a hash of the columns."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    return (bits.cast("double") + F.lit(0.5)) * F.lit(2.0**-53)


def partition_count(spark: SparkSession, least: int = 1) -> int:
    """The session's shuffle partitions, for steps that AQE cannot size."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
