"""Crawl files that registered queries make of large tables: many tasks write them."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from linkrank.plans import catalogue

PAGES = [(i, f"http://a{i}.example.com/", f"<a href=/x{i}>") for i in range(40)]


@pytest.fixture
def folders(spark, tmp_path, monkeypatch):
    """{name: scratch folder}, made while queries run on tables of three files that count as large."""
    spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    made, path = {}, catalogue.scratch_path

    def noted(session, name):
        made[name] = path(session, name)
        return made[name]

    monkeypatch.setattr(catalogue, "CRAWL_BYTES", 1, raising=False)
    monkeypatch.setattr(catalogue, "scratch_path", noted)
    return made


def files(folder, pattern):
    return sorted(p.relative_to(folder).as_posix() for p in Path(folder.removeprefix("file:")).rglob(pattern))


def test_gzip_ranges_are_of_files_by_many_tasks(spark, folders, tmp_path, rows):
    found = rows(catalogue.gzip_ranges_scan(spark, str(tmp_path)))
    assert found == sorted(((u, len(h)) for _, u, h in PAGES), key=repr)
    assert len(files(folders["crawl"], "*.json.gz")) == 3


def test_pending_files_of_many_tasks(spark, folders, tmp_path, rows):
    assert rows(catalogue.pending_files(spark, str(tmp_path))) == [("crawl0.jl.gz",), ("crawl3.jl.gz",)]
    assert files(folders["crawl"], "crawl0.jl.gz") == ["0/crawl0.jl.gz", "more1/0/crawl0.jl.gz", "more2/0/crawl0.jl.gz"]


def test_failed_files_of_many_tasks(spark, folders, tmp_path, rows):
    found = rows(catalogue.failed_files(spark, str(tmp_path)))
    first = [(1, f"crawl{n}.jl.gz", n == 2, 0 if n == 2 else 10) for n in range(4)]
    assert found == [*first, (2, "crawl2.jl.gz", False, 10)]
    assert len(files(folders["crawl"], "crawl2.jl.gz")) == 3


def test_logs_of_a_run_by_many_tasks(spark, folders, tmp_path, monkeypatch):
    lines = spark.range(60).select(
        (F.col("id") % 20).alias("l_orderkey"), F.col("id").cast("int").alias("l_linenumber"),
        F.col("id").alias("l_partkey"), (F.col("id") * 7).alias("l_suppkey"),
    )
    lines.repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = spark.range(20).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("1996-01-02").cast("timestamp").alias("o_orderdate"))
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(catalogue, "run_pipeline", lambda *_, **__: None)
    monkeypatch.setattr(catalogue, "_places", lambda *_: None)
    catalogue.settings_run(spark, str(tmp_path))
    logs = files(folders["extracted"], "*txt")
    assert len(logs) == 3
    texts = [x for name in logs for x in Path(folders["extracted"].removeprefix("file:"), name).read_text().splitlines()]
    assert len(texts) == 60 and all(set(json.loads(x)) == {"url", "children"} for x in texts)
