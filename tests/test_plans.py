"""What the physical plans must look like at any size."""

import os
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from linkrank.operators import graph, links
from linkrank.operators.pagerank import _layout, _step
from linkrank.operators.staging import clear_scratch, stage
from linkrank.sinks.tables import write_page_links

EDGES = "src string, dst string, weight bigint"


@contextmanager
def settings(spark, **values):
    keys = {k.replace("__", "."): str(v) for k, v in values.items()}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in keys:
            spark.conf.unset(key)


def executed_plan(df):
    """The final adaptive plan of a run that needs every column."""
    digest = df.groupBy(F.pmod(F.xxhash64(*df.columns), F.lit(5)).alias("k")).count()
    digest.collect()
    return digest._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hub_edges(spark):
    """A third of the edges leaves one source, a third reaches one destination."""
    n = 60_000
    ids = spark.range(n)
    name = F.concat(F.lit("site"), F.col("id"), F.lit(".example.com"))
    far = F.concat(F.lit("page"), F.xxhash64("id"), F.lit(".example.org"))
    edges = (
        ids.select(F.lit("out-hub").alias("src"), name.alias("dst"))
        .union(ids.select(name, F.lit("in-hub")))
        .union(ids.select(name, far))
    )
    return stage(edges.withColumn("weight", F.col("src").eqNullSafe("x").cast("long") + 1), "hubs")


def test_parsing_does_not_shuffle(spark):
    pages = spark.createDataFrame([("http://a.com", "<a href=/x>")], "url string, raw_content string")
    parsed = links.link_rows(links.parse_pages(pages))
    assert "Exchange" not in parsed._jdf.queryExecution().executedPlan().toString()


def test_counting_is_partial_before_its_only_shuffle(spark):
    rows = spark.createDataFrame([("type2", "ab", "cd")], "link_type string, src string, dst string")
    plan = links.count_links(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan


def test_degrees_scan_the_edges_once(hub_edges):
    plan = graph.degrees(hub_edges)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "partial_sum" in plan


@pytest.mark.parametrize("join", ["edge_table", "encode_edges"])
def test_hubs_are_split_in_joins(spark, hub_edges, join):
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__shuffle__partitions=16,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes=64 << 10,
        spark__sql__adaptive__skewJoin__skewedPartitionFactor=2,
        spark__sql__adaptive__advisoryPartitionSizeInBytes=64 << 10,
    ):
        if join == "edge_table":
            df = graph.edge_table(hub_edges)
        else:
            index = stage(graph.build_index(graph.graph_nodes(hub_edges)), "index")
            df = graph.encode_edges(hub_edges, index)
        assert "SortMergeJoin(skew=true)" in executed_plan(df)


def test_pagerank_step_leaves_the_edges_in_place(spark, hub_edges):
    """With shuffle joins, the cached edges are neither shuffled nor sorted again."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        totals = stage(graph.degrees(hub_edges), "totals")
        ranks = totals.select("node", "outdeg", "uniqueout", F.lit(0.1).alias("pagerank"))
        placed, keys = _layout(hub_edges, totals, 1, 6, 10_000)
        placed.persist()
        placed.createOrReplaceTempView("placed_edges")
        assert keys == ["src", "slice"]
        sizes = [r["n"] for r in placed.groupBy("src", "slice").agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < 12_000
        args = (["pagerank"], {"pagerank"}, {"pagerank": 0.0}, 10, 0.85, 10_000)
        step = _step(ranks, "placed_edges", keys, *args)
        plan = step._jdf.queryExecution().executedPlan().toString()
        spark.catalog.dropTempView("placed_edges")
        placed.unpersist()
    edges_side = plan[plan.index("SortMergeJoin") : plan.index("InMemoryRelation")]
    assert not re.search("Exchange|Sort \\[", edges_side)


def last_plan(spark):
    store = spark._jsparkSession.sharedState().statusStore()
    runs = store.executionsList()
    return runs.apply(runs.size() - 1).physicalPlanDescription()


def test_writing_by_type_does_not_sort(spark, tmp_path):
    pages = spark.createDataFrame([("http://a.com", "<a href=/x>")], "url string, raw_content string")
    write_page_links(links.parse_pages(pages), str(tmp_path / "links"))
    assert "link_type" in last_plan(spark) and "Sort" not in last_plan(spark)
    assert len(list((tmp_path / "links").glob("link_type=*"))) == 3


def test_scratch_is_cleared(spark):
    table = stage(spark.range(3), "short-lived")
    folder = table.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    folder = "/" + folder.lstrip("/")
    assert os.path.isdir(folder)
    clear_scratch(spark)
    assert not os.path.isdir(folder)
