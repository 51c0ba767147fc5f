import gzip
import json

import pytest
from pyspark.sql import functions as F

from linkrank.operators import graph, links, ranking
from linkrank.operators.attributes import FEATURES
from linkrank.sinks import tables
from linkrank.sources import crawl, graph as stored

EDGES = "src string, dst string, weight bigint"


@pytest.fixture
def crawl_folder(tmp_path):
    pages = [{"url": f"http://s{i}.com/p", "raw_content": "<a href='/x'>", "more": i} for i in range(5)]
    lines = [json.dumps(p) for p in pages]
    (tmp_path / "one.jl").write_text("\n".join([*lines[:2], "{broken", json.dumps({"index": 1})]) + "\n")
    with gzip.open(tmp_path / "two.jl.gz", "wt") as out:
        out.write("\n".join([*lines[2:], json.dumps({"url": "http://t.com", "raw_content": None})]))
    (tmp_path / "ledger.txt").write_text("one.jl\n")
    (tmp_path / ".DS_Store").write_text("x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "deep.jl").write_text(json.dumps({"url": "http://deep.com"}))
    return str(tmp_path)


def test_crawl_scan(spark, crawl_folder, rows):
    pages = crawl.read_pages(spark, crawl_folder)
    named = pages.withColumn("crawl_file", F.regexp_extract("crawl_file", "[^/]+$", 0))
    assert rows(named.filter(pages.url.isNotNull()), "url", "crawl_file") == [
        *[(f"http://s{i}.com/p", "one.jl") for i in range(2)],
        *[(f"http://s{i}.com/p", "two.jl.gz") for i in range(2, 5)],
        ("http://t.com", "two.jl.gz"),
    ]
    bad = pages.filter(F.col(crawl.CORRUPT_COLUMN).isNotNull())
    assert rows(bad, "url", crawl.CORRUPT_COLUMN) == [(None, "{broken")]
    assert crawl.read_pages(spark, crawl_folder, min_partitions=9).rdd.getNumPartitions() == 9


def test_large_gzip_files_are_spread_on_request(spark, crawl_folder, rows):
    import random

    noise = random.Random(1)
    with gzip.open(f"{crawl_folder}/huge.jl.gz", "wt") as out:
        for i in range(2000):
            page = {"url": f"http://h{i}.com", "raw_content": str(noise.random())}
            out.write(json.dumps(page) + "\n")
    usual = crawl.read_pages(spark, crawl_folder)
    assert "Union" not in usual._jdf.queryExecution().optimizedPlan().toString()
    spreading = crawl.read_pages(spark, crawl_folder, spread_above=4096)
    assert rows(spreading) == rows(usual)
    tasks = spreading.filter("crawl_file like '%/huge.jl.gz'").groupBy(F.spark_partition_id()).count()
    assert tasks.count() == spark.sparkContext.defaultParallelism
    plan = spreading._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" in plan


def test_files_of_two_folders_stay_apart(spark, tmp_path):
    for name in ("x", "y z"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.jl").write_text(json.dumps({"url": f"http://{name[0]}.com"}))
    pages = crawl.read_pages(spark, [str(tmp_path / "x"), str(tmp_path / "y z")])
    assert pages.select("crawl_file").distinct().count() == 2


def test_a_file_named_directly_is_read(spark, tmp_path, rows):
    (tmp_path / "crawl.txt").write_text(json.dumps({"url": "http://t.com"}))
    assert rows(crawl.read_pages(spark, str(tmp_path / "crawl.txt")), "url") == [("http://t.com",)]
    with pytest.raises(FileNotFoundError):
        crawl.read_pages(spark, str(tmp_path / "absent"))


def test_fail_fast(spark, crawl_folder):
    with pytest.raises(Exception, match="(?i)malformed"):
        crawl.read_pages(spark, crawl_folder, fail_fast=True).collect()


def test_other_url_key(spark, tmp_path, rows):
    (tmp_path / "a.jl").write_text(json.dumps({"cleaned_url": "http://a.com", "raw_content": "<a href=/x>"}))
    pages = crawl.read_pages(spark, str(tmp_path), url_col="cleaned_url")
    assert rows(links.list_raw_links(pages)) == [("http://a.com", ["/x"])]


def test_extracted_scan(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text(
        json.dumps({"url": "http://a.com", "children": ["/x"]}) + "\n" + json.dumps({"children": ["http://b.com"]})
    )
    pages = crawl.read_extracted(spark, str(tmp_path))
    got = rows(links.link_rows(links.clean_extracted(pages, link_types=["type2"])), "src", "dst")
    assert got == [("a.com", "a.com"), ("www.error.com", "b.com")]


def test_file_listing(spark, crawl_folder, rows):
    assert rows(crawl.list_files(spark, crawl_folder), "file_name") == [("one.jl",), ("two.jl.gz",)]
    assert rows(crawl.list_files(spark, crawl_folder, "*z"), "file_name") == [("two.jl.gz",)]


def test_page_links_both_formats(spark, tmp_path, rows):
    pages = spark.createDataFrame(
        [("http://a.com", "<a href=/x><a href=http://b.com>"), ("http://c.com", None)],
        "url string, raw_content string",
    )
    parsed = links.parse_pages(pages)
    tables.write_page_links(parsed, str(tmp_path / "parquet"))
    tables.write_page_links_json(parsed, str(tmp_path / "json"))
    wanted = rows(parsed.filter("link_type != 'type1'"))
    assert rows(stored.read_page_links(spark, str(tmp_path / "parquet"), ["type2", "type3"])) == wanted
    assert rows(stored.read_page_links_json(spark, str(tmp_path / "json"), ["type2", "type3"])) == wanted
    part = next((tmp_path / "json" / "link_type=type2").glob("*.gz"))
    assert set(json.loads(gzip.open(part, "rt").readline())) == {"parentURL", "childLinks"}


def test_type_selection_reads_only_its_folder(spark, tmp_path):
    edges = spark.createDataFrame(
        [("type1", "a", "b", 1), ("type2", "a", "b", 1)], "link_type string, " + EDGES
    )
    tables.write_edges(edges, str(tmp_path / "edges"))
    plan = stored.read_edges(spark, str(tmp_path / "edges"), ["type2"])
    assert all("link_type=type2" in f for f in plan.inputFiles()) or "PartitionFilters" in (
        plan._jdf.queryExecution().executedPlan().toString()
    )
    assert plan.count() == 1


def test_connectivity_files(spark, tmp_path, rows):
    """Graph files on one line, as several files, add up with those written here."""
    first = {"a": {"b": 2, "": 1}, "lonely": {}}
    second = {"a": {"b": 3}, "c": {"a": 1}}
    for name, graph_map in (("one.jl.gz", first), ("two.jl.gz", second)):
        with gzip.open(tmp_path / name, "wt") as out:
            out.write(json.dumps(graph_map))
    edges, parents = stored.read_connectivity(spark, str(tmp_path))
    assert rows(edges) == [("a", "", 1), ("a", "b", 5), ("c", "a", 1)]
    assert rows(parents) == [("a",), ("c",), ("lonely",)]
    tables.write_connectivity(graph.node_connectivity(edges, parents), str(tmp_path / "out"))
    again = stored.read_connectivity(spark, str(tmp_path / "out"))
    assert rows(again[0]) == rows(edges) and rows(again[1]) == rows(parents)


def test_index_files(spark, tmp_path, rows):
    index = spark.createDataFrame([(0, "x"), (1, "y")], "id long, name string")
    tables.write_index(index, str(tmp_path / "index"))
    assert rows(stored.read_index(spark, str(tmp_path / "index"))) == [(0, "x"), (1, "y")]


@pytest.mark.parametrize("line", ['{"a": {"b": 1', '{"a": {"b": 1.5}}', '{"src": "a", "slice": 0, "chil'])
def test_unreadable_graph_lines_end_the_job(spark, tmp_path, line):
    (tmp_path / "g.jl").write_text('{"a": {"b": 1}}\n\n' + line + "\n")
    edges, parents = stored.read_connectivity(spark, str(tmp_path / "g.jl"))
    with pytest.raises(Exception, match="(?i)malformed"):
        edges.collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        parents.collect()


def test_slices_are_labelled(spark, tmp_path, rows):
    edges = spark.createDataFrame([("hub", f"d{i}", 1) for i in range(30)] + [("slice", "src", 2)], EDGES)
    tables.write_connectivity(graph.node_connectivity(edges, max_children=10), str(tmp_path / "out"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert all(set(x) == {"src", "slice", "children"} for x in lines)
    hub = [x for x in lines if x["src"] == "hub"]
    assert len(hub) == len({x["slice"] for x in hub}) > 1
    assert rows(stored.read_connectivity(spark, str(tmp_path / "out"))[0]) == rows(edges)


NASTY = ["tab\t", "\nline", 'a "quote"', "comma,", "back\\slash", "", " blank ", "cr\r\nlf", '"', "plain"]


def test_csv_returns_what_went_in(spark, tmp_path, rows):
    edges = spark.createDataFrame([(n, "x" + n, i) for i, n in enumerate(NASTY)], EDGES)
    table = edges.withColumn("dstcount", F.lit(2).cast("long"))
    tables.write_edge_table(table, str(tmp_path / "edges"))
    schema = "src string, dst string, weight bigint, dstcount bigint"
    back = tables.read_csv(spark, str(tmp_path / "edges"), schema).fillna("", ["src"])
    assert rows(back) == rows(table)
    import csv

    with_other = []
    for part in (tmp_path / "edges").glob("part-*.csv"):
        with open(part, newline="", encoding="utf-8") as f:
            with_other += list(csv.reader(f))[1:]
    assert sorted((r[0], r[1], int(r[2])) for r in with_other) == sorted((n, "x" + n, i) for i, n in enumerate(NASTY))


def test_url_lists_from_file_and_folder(spark, tmp_path, rows):
    (tmp_path / "one.lst").write_text(" a.com \nb.com\t\r\n")
    (tmp_path / "two").write_text("b.com\n")
    (tmp_path / "log.txt").write_text("never.com\n")
    assert rows(stored.read_url_list(spark, str(tmp_path))) == [("a.com",), ("b.com",), ("b.com",)]
    assert rows(stored.read_url_list(spark, str(tmp_path / "log.txt"))) == [("never.com",)]
    (tmp_path / "with blank").mkdir()
    (tmp_path / "with blank" / "x.txt").write_text("never.com\n")
    for path in (f"{tmp_path}//log.txt", f"{tmp_path}/*.txt", f"{tmp_path}/with blank/x.txt", f"file://{tmp_path}/log.txt"):
        assert rows(stored.read_url_list(spark, path)) == [("never.com",)], path
    with pytest.raises(FileNotFoundError):
        stored.read_url_list(spark, str(tmp_path / "absent"))


def test_ranked_csv_parts_are_in_order(spark, tmp_path):
    data = [(f"u{i:03d}", *[float((i * 37) % 101) for _ in FEATURES]) for i in range(300)]
    table = spark.createDataFrame(data, "url string, " + ", ".join(f"{f} double" for f in FEATURES))
    tables.write_sorted_lists(table.repartition(8), str(tmp_path), "_all")
    for feature in FEATURES:
        names = []
        for part in sorted((tmp_path / f"{feature}_all").glob("part-*.csv")):
            head, *body = part.read_text().splitlines()
            assert head == "url," + ",".join(FEATURES)
            names += [line.split(",")[0] for line in body]
        assert names == [r["url"] for r in ranking.ranked(table, feature).collect()]


def test_all_rankings_come_from_one_sort(spark, tmp_path, rows):
    big = 1 << 53  # doubles do not tell this from the next number
    kinds = ", ".join(f"{f} {'double' if 'ratio' in f or 'pagerank' in f else 'bigint'}" for f in FEATURES)
    table = spark.createDataFrame(
        [(f"u{i}", i % 2, 7, big + i, -i, i / 7, [None, float("nan"), 0.5][i % 3], 1.0, 0.5) for i in range(40)], f"url string, {kinds}"
    )
    found = ranking.all_orders(table)
    found.write.format("noop").mode("overwrite").save()
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange rangepartitioning") == 1
    for twice in range(2):  # the second time they are written over
        tables.write_sorted_lists(table.repartition(8), str(tmp_path), "_all")
    assert {p.name for p in tmp_path.iterdir()} == {f"{f}_all" for f in FEATURES}
    for f in FEATURES:
        wanted = [r["url"] for r in ranking.ranked(table, f).collect()]
        assert [r["url"] for r in found.filter(F.col("sorted_by") == f).collect()] == wanted
        lines = [x.split(",")[0] for p in sorted((tmp_path / f"{f}_all").glob("part-*")) for x in p.read_text().splitlines()]
        assert [x for x in lines if x != "url"] == wanted
    tables.write_sorted_lists(table.limit(0), str(tmp_path / "none"))
    assert tables.read_csv(spark, str(tmp_path / "none" / "outdeg"), f"url string, {kinds}").count() == 0


def test_edge_table_and_audit_log(spark, tmp_path):
    edges = spark.createDataFrame([("a", "b", 1), ("c", "b", 2)], EDGES)
    tables.write_edge_table(graph.edge_table(edges), str(tmp_path / "edges"))
    assert spark.read.option("header", True).csv(str(tmp_path / "edges")).count() == 2
    for _ in range(2):
        tables.append_audit_log(edges, str(tmp_path / "log"))
    assert spark.read.option("header", True).csv(str(tmp_path / "log")).count() == 4
