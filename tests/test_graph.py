import random

import pytest
from pyspark.sql import functions as F

from linkrank.operators import graph, positions

EDGES = "src string, dst string, weight bigint"


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(
        [("a", "b", 3), ("a", "c", 1), ("b", "a", 2), ("c", "c", 5), ("d", "b", 1)], EDGES
    )


def test_degrees_and_ratios(small, rows):
    table = graph.with_ratios(graph.degrees(small))
    got = {r["node"]: r.asDict() for r in table.collect()}
    assert {k: (v["outdeg"], v["indeg"], v["uniqueout"], v["uniquein"]) for k, v in got.items()} == {
        "a": (4, 2, 2, 1), "b": (2, 4, 1, 2), "c": (5, 6, 1, 2), "d": (1, 0, 1, 0)
    }
    assert got["b"]["in_out_ratio"] == 2.0 and got["d"]["in_out_ratio"] == 0.0
    assert got["a"]["uin_uout_ratio"] == 0.5


def test_ratio_of_a_node_without_out_links_is_zero(spark):
    edges = spark.createDataFrame([("a", "z", 4)], EDGES)
    row = graph.with_ratios(graph.degrees(edges)).filter("node = 'z'").first()
    assert (row["in_out_ratio"], row["uin_uout_ratio"]) == (0.0, 0.0)


def test_positions_are_dense_and_ordered(spark):
    values = list(range(1000))
    random.Random(3).shuffle(values)
    df = spark.createDataFrame([(v, v % 3) for v in values], "v int, k int").repartition(7)
    placed = positions.with_position(df, [F.desc("k"), F.asc("v")], "p", 1).collect()
    expected = sorted(values, key=lambda v: (-(v % 3), v))
    assert [r["v"] for r in sorted(placed, key=lambda r: r["p"])] == expected
    assert sorted(r["p"] for r in placed) == list(range(1, 1001))


def test_positions_of_nothing(spark):
    df = spark.createDataFrame([], "v int")
    assert positions.with_position(df, [F.col("v")], "p").collect() == []


def test_index_is_dense_and_stable_when_extended(spark, small, rows):
    first = graph.build_index(spark.createDataFrame([("q",), ("b",), ("b",)], "name string"))
    assert rows(first) == [(0, "b"), (1, "q")]
    extended = graph.extend_index(first, graph.graph_nodes(small))
    assert rows(extended) == [(0, "b"), (1, "q"), (2, "a"), (3, "c"), (4, "d")]
    assert rows(graph.extend_index(extended, graph.graph_nodes(small))) == rows(extended)
    empty = spark.createDataFrame([], "id bigint, name string")
    assert rows(graph.extend_index(empty, graph.graph_nodes(small)), "id") == [(0,), (1,), (2,), (3,)]


def test_encoding_round_trip(small, rows):
    index = graph.build_index(graph.graph_nodes(small))
    encoded = graph.encode_edges(small, index)
    assert encoded.columns == ["src_id", "dst_id", "weight"]
    assert rows(graph.decode_edges(encoded, index)) == rows(small)


def test_nodes_include_parents_without_links(spark, small, rows):
    parents = spark.createDataFrame([("a",), ("lonely",)], "src string")
    assert ("lonely",) in rows(graph.graph_nodes(small, parents))
    assert rows(graph.graph_summary(small, parents)) == [(5, 5, 12, 2)]


def test_edge_table_keeps_shared_destinations(small, rows):
    assert rows(graph.edge_table(small)) == [
        ("a", "b", 3, 2), ("a", "c", 1, 2), ("c", "c", 5, 2), ("d", "b", 1, 2)
    ]


def test_connectivity_of_a_hub_is_sliced_and_adds_up(spark, rows):
    hub = [("hub", f"d{i}", i + 1) for i in range(500)]
    rest = [(f"s{i}", "hub", 1) for i in range(1000)]
    edges = spark.createDataFrame(hub + rest, EDGES)
    parents = spark.createDataFrame([("hub",), ("empty",)], "src string")
    maps = graph.node_connectivity(edges, parents, max_children=50)
    sizes = {(r["src"], r["slice"]): len(r["children"]) for r in maps.collect()}
    hub_sizes = [n for (src, _), n in sizes.items() if src == "hub"]
    assert sum(hub_sizes) == 500 and len(hub_sizes) == 10
    assert sizes[("empty", 0)] == 0
    lines = graph.connectivity_json(maps)
    assert rows(graph.edges_from_json(lines)) == rows(edges)
    assert ("empty",) in rows(graph.parents_from_json(lines))
