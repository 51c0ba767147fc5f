"""What the operators share around their tasks: the package on the executors, files in the
shared folder, held-out rows and a bounded sample of labelled rows."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors, once for each application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="linkrank-package-"), "linkrank_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(application)


def give_back() -> None:
    """Return a Python worker's free memory to the system at the end of a task.

    Workers are kept for later tasks, of other stages too, beside which it would count.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The store that holds ``path`` (a URI or a plain path), and the path within it."""
    if urlparse(path).scheme:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str | Column) -> Column:
    """crc32(id as text) mod 5; a null id counts as the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 5


def labelled_sample(labels: DataFrame, target: str, most: int) -> DataFrame:
    """(doc_id, label, weight): at most ``most`` training rows of each label.

    The same rows give the same sample.  Rows without id or label, held-out rows (remainder 0)
    and ids with both labels are left out.  ``weight`` is the number of usable rows of the label
    that a row stands for.  The bound on the result makes it safe to broadcast.
    """
    usable = (
        labels.select("doc_id", F.col(target).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .filter(remainder("doc_id") != 0)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter(F.col("label") == F.col("other"))
        .select("doc_id", "label", F.xxhash64("doc_id").alias("draw"))
    )
    totals = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}  # two rows
    picked = [
        usable.filter(F.col("label") == value)
        .orderBy("draw", "doc_id")
        .limit(most)
        .withColumn("weight", F.lit(max(1.0, totals.get(value, 0) / most)))
        for value in (0, 1)
    ]
    return picked[0].unionByName(picked[1]).select("doc_id", "label", "weight")


def bitmap(slots: DataFrame, bits: int):
    """The distinct values of the only column, each below ``bits``, as a numpy bitmap of int64.

    ``bits`` is a fixed parameter, so what reaches the driver does not grow with the rows.
    """
    import numpy as np

    slot = F.col(slots.columns[0])
    out = np.zeros(bits // 64, dtype=np.int64)
    packed = slots.groupBy((slot / 64).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))).alias("bits")
    )
    for row in packed.toLocalIterator():
        out[row["word"]] = row["bits"]
    return out


def in_bitmap(bits, slots):
    """Which of an array of slots are set."""
    return (bits[slots >> 6] >> (slots & 63)) & 1 == 1
