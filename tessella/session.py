"""Session settings shared by the queries, the bench and the tests."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: SQL settings every query of the library relies on; they are safe to set on a running session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set what the queries rely on; leaves sizing (partitions, memory) to the cluster."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("TESSELLA_DRIVER_MEMORY", memory))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    A local session that names none gets a temporary one; on a cluster that is an error, as executors
    would not see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="tessella-shared-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def shared_table(df, name: str):
    """``df`` written as Parquet in the shared folder and read again, so that readers scan the columns they need."""
    path = f"{shared_folder(df.sparkSession)}/tessella/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_checkpoint(df):
    """``df`` with its lineage cut by a checkpoint in the shared folder."""
    context, folder = df.sparkSession.sparkContext, shared_folder(df.sparkSession)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return df.checkpoint()
