"""Stored node ids as versions that are never changed.

Below a folder, ``base=<n>`` holds a whole index (id, name) and ``delta=<n>`` the names that a later
run added.  The index is the newest whole base and the whole deltas after it; a version is whole
when Spark has marked it as written to the end.  A run that dies at any point leaves the versions
before it as they were, and its unfinished one is written over by the next run.  An extension
writes new names only, however large the index is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from linkrank.operators.graph import build_index, index_extension
from linkrank.streaming.ingest import delete_folders, whole_versions

FIELDS = "id long, name string"
#: An index of more deltas than this is written as a new base.
MOST_DELTAS = 32


def _numbers(spark: SparkSession, folder: str) -> tuple[list[int], list[int]]:
    """Whole bases, and whole deltas after the newest of them."""
    bases = whole_versions(spark, folder, "base")
    return bases, [d for d in whole_versions(spark, folder, "delta") if bases and d > bases[-1]]


def read_versions(spark: SparkSession, folder: str) -> DataFrame | None:
    """(id, name) of the index, or None where none was written to the end.

    The frame stays readable until two more bases are written.
    """
    bases, deltas = _numbers(spark, folder)
    if not bases:
        return None
    paths = [f"{folder}/base={bases[-1]}", *(f"{folder}/delta={d}" for d in deltas)]
    return reduce(DataFrame.unionByName, [spark.read.schema(FIELDS).parquet(p) for p in paths])


def write_base(index: DataFrame, folder: str) -> DataFrame:
    """Make ``index`` the stored one.  The base before stays for those who read it; older versions go."""
    spark = index.sparkSession
    bases, deltas = _numbers(spark, folder)
    number = max([-1, *bases, *deltas]) + 1
    index.select("id", "name").write.mode("overwrite").parquet(f"{folder}/base={number}")
    if bases:
        gone = [f"{folder}/base={b}" for b in bases[:-1]]
        gone += [f"{folder}/delta={d}" for d in whole_versions(spark, folder, "delta") if d < bases[-1]]
        delete_folders(spark, gone)
    return read_versions(spark, folder)


def extend_versions(names: DataFrame, folder: str) -> DataFrame:
    """Give new names ids after the largest one; without a stored index, build it."""
    spark = names.sparkSession
    known = read_versions(spark, folder)
    if known is None:
        return write_base(build_index(names), folder)
    bases, deltas = _numbers(spark, folder)
    number = max([*bases, *deltas]) + 1
    index_extension(known, names).write.mode("overwrite").parquet(f"{folder}/delta={number}")
    found = read_versions(spark, folder)
    return write_base(found, folder) if len(deltas) >= MOST_DELTAS else found
