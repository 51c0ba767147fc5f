import random

import pytest
from pyspark.sql import functions as F

from linkrank.operators.attributes import FEATURES, url_attributes
from linkrank.operators.graph import build_index, graph_nodes
from linkrank.operators.pagerank import NotConverged, _partitions, pagerank

EDGES = "src string, dst string, weight bigint"


def brute_force(edges, steps=None, weighted=True, damping=0.85, tol=1e-6):
    nodes = sorted({n for s, d, _ in edges for n in (s, d)})
    n = len(nodes)
    total = dict.fromkeys(nodes, 0)
    for s, _, w in edges:
        total[s] += w if weighted else 1
    rank = dict.fromkeys(nodes, 1.0 / n)
    for _ in range(steps or 100):
        idle = sum(rank[v] for v in nodes if total[v] == 0)
        new = dict.fromkeys(nodes, (1 - damping) / n + damping * idle / n)
        for s, d, w in edges:
            new[d] += damping * rank[s] * (w if weighted else 1) / total[s]
        change = sum(abs(new[v] - rank[v]) for v in nodes)
        rank = new
        if steps is None and change < n * tol:
            break
    return rank


def ranks_of(spark, edges, **options):
    df = spark.createDataFrame(edges, EDGES)
    return {r["node"]: r for r in pagerank(df, **options).collect()}


def random_graph():
    """A hub that sends a third of all links, one that receives a third, and a crowd."""
    rng = random.Random(11)
    pairs = {("out-hub", f"n{i}") for i in range(120)}
    pairs |= {(f"n{i}", "in-hub") for i in range(120)}
    while len(pairs) < 360:
        pairs.add((f"n{rng.randrange(150)}", f"n{rng.randrange(150)}"))
    return [(s, d, rng.randint(1, 9)) for s, d in sorted(pairs)]


@pytest.mark.parametrize(
    "edges, expected",
    [
        ([("a", "b", 1), ("b", "a", 1)], {"a": 0.5, "b": 0.5}),
        ([("a", "a", 7)], {"a": 1.0}),
    ],
)
def test_solved_graphs(spark, edges, expected):
    got = ranks_of(spark, edges)
    assert {k: r["pagerank"] for k, r in got.items()} == pytest.approx(expected, abs=1e-6)


def test_star_and_weight_split(spark):
    star = [("c", f"l{i}", 1) for i in range(4)]
    got = ranks_of(spark, star, walks=["pagerank"])
    assert len({round(got[f"l{i}"]["pagerank"], 9) for i in range(4)}) == 1
    assert sum(r["pagerank"] for r in got.values()) == pytest.approx(1.0)
    split = ranks_of(spark, [("a", "b", 3), ("a", "c", 1), ("b", "a", 1), ("c", "a", 1)], fixed_iters=3)
    base = 0.15 / 3
    assert (split["b"]["pagerank"] - base) / (split["c"]["pagerank"] - base) == pytest.approx(3.0)
    assert split["b"]["pagerank_noweight"] == pytest.approx(split["c"]["pagerank_noweight"])


def test_against_brute_force_until_convergence(spark):
    edges = random_graph()
    got = ranks_of(spark, edges)
    for name, weighted in (("pagerank", True), ("pagerank_noweight", False)):
        expected = brute_force(edges, weighted=weighted)
        assert {k: r[name] for k, r in got.items()} == pytest.approx(expected, abs=1e-12)


def test_sliced_hubs_give_the_same_ranks(spark):
    edges = random_graph()
    got = ranks_of(spark, edges, fixed_iters=5, rows_per_slice=7)
    expected = brute_force(edges, steps=5)
    assert {k: r["pagerank"] for k, r in got.items()} == pytest.approx(expected, abs=1e-12)


def test_shuffle_joins_give_the_same_ranks_and_leave_the_edges_in_place(spark):
    edges = random_graph()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = ranks_of(spark, edges, fixed_iters=3, rows_per_slice=50)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = brute_force(edges, steps=3)
    assert {k: r["pagerank"] for k, r in got.items()} == pytest.approx(expected, abs=1e-12)


def test_not_converged_raises_and_frees_the_cache(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "c", 1), ("c", "a", 1), ("a", "c", 5)], EDGES)
    with pytest.raises(NotConverged):
        pagerank(edges, max_iter=1, tol=1e-15)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


@pytest.mark.parametrize(
    "rows, expected", [(1, 1), (150_000, 2), (10**6, 4), (10**9, 100), (10**13, 1_000_000)]
)
def test_layout_partitions(spark, rows, expected):
    assert _partitions(spark, rows) == expected


def test_empty_graph(spark):
    assert pagerank(spark.createDataFrame([], EDGES)).collect() == []


def test_attributes_by_name_and_by_id_agree(spark):
    df = spark.createDataFrame(random_graph(), EDGES)
    by_name = url_attributes(df, fixed_iters=4)
    by_id = url_attributes(df, node_index=build_index(graph_nodes(df)), fixed_iters=4)
    assert by_name.columns == ["url", *FEATURES] == by_id.columns
    both = by_name.alias("a").join(by_id.alias("b"), "url")
    assert both.count() == by_name.count()
    for feature in FEATURES:
        worst = both.agg(F.max(F.abs(F.col(f"a.{feature}") - F.col(f"b.{feature}")))).first()[0]
        assert worst < 1e-12
    sums = by_name.agg(F.sum("outdeg"), F.sum("indeg")).first()
    assert sums[0] == sums[1] == sum(w for _, _, w in random_graph())
