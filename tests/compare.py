"""Run every registered query beside its SQL and compare the rows.

Usage: python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"create view {name} as select * from read_parquet('{path}')")
    return db


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def check(spark, db, name: str, folder: str) -> str:
    """Empty if both sides agree, else what differs."""
    df = entry.queries()[name](spark, folder)
    columns, rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(entry.oracle_sql()[name])
    expected_columns, expected = rows_of([d[0] for d in result.description], result.fetchall())
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    different = [(a, b) for a, b in zip(rows, expected) if a != b]
    if different:
        return f"{len(different)} of {len(rows)} rows differ, e.g. {different[0]}"
    return "" if rows else "no rows"


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", os.environ.get("SHUFFLE_PARTITIONS", "8"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    failed = 0
    for name in names:
        started = time.time()
        try:
            verdict = check(spark, db, name, folder)
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(verdict)
        print(f"{name:28s} {time.time() - started:6.1f}s  {verdict or 'ok'}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
