"""Intermediate tables in the cluster's shared checkpoint folder.

A frame that is read several times, or whose row placement must not change between
reads, is written once and read back.  Unlike a cached frame it survives the loss of
executors, and unlike an arbitrary plan it has a known size, so Spark's own size check
decides whether a join may broadcast it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a temporary folder when Spark runs in one process."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    application = spark.sparkContext.applicationId
    if shared:
        return f"{shared.rstrip('/')}/linkrank-{application}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="linkrank-")
    return _local_folders[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def write_and_read(df: DataFrame, path: str, **options: str) -> DataFrame:
    """``options`` are those of Spark's writer."""
    df.write.options(**options).mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    return write_and_read(df, scratch_path(df.sparkSession, name), **options)


def drop(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing will read again."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; frames that read them end with it."""
    drop(spark, scratch_root(spark))
