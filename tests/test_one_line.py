"""Graphs and indices stored as one line, cut at every byte."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from linkrank.sources.one_line import (
    _ranges,
    _records,
    import_index,
    read_one_line_graph,
    read_one_line_ids,
    read_one_line_names,
)

GRAPH = {
    "plain.com": {"a.com": 1, "b.com": 22},
    'quo"ted': {'x":{"y': 3, "back\\": 4, 'both\\":': 5, '":': 6},
    "none": {},
    "braces}{": {"{}": 7, "},": 8, ",": 9, '", "': 10},
    "é漢😀": {"ü/": 11, "line\nbreak": 12, "": 13},
    "": {"e": 14},
    "hub": {f"h{i}": i for i in range(20)},
    ":c": {",d": 15, ":": 16, '":': 17, "\\": 18},
    "last": {},
}


def expected(graph):
    return sorted((s, d, w) for s, children in graph.items() for d, w in children.items())


@pytest.mark.parametrize("size", [13, 64, 10**6])
def test_graph_cut_anywhere(spark, tmp_path, rows, size):
    path = tmp_path / "graph.jl"
    path.write_text(json.dumps(GRAPH, ensure_ascii=size > 13), encoding="utf-8")
    edges, parents = read_one_line_graph(spark, str(path), size)
    assert rows(edges, "src", "dst", "weight") == sorted(expected(GRAPH), key=repr)
    assert rows(parents) == sorted(((s,) for s in GRAPH), key=repr)


def test_one_plain_file_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "graph.jl"
    path.write_text(json.dumps({"hub": {f"site{i}.example.com": i for i in range(2_000)}}, separators=(",", ":")))
    size = path.stat().st_size
    edges, _ = read_one_line_graph(spark, str(path), 10_000)
    assert edges.agg(F.count("*"), F.sum("weight")).first() == (2_000, sum(range(2_000)))
    with _ranges(spark, 10_000):
        records = _records(spark, str(path), '":')
        assert records.select(F.spark_partition_id().alias("p")).distinct().count() == -(-size // 10_000) > 3


def test_gzip_several_lines_and_files(spark, tmp_path, rows):
    folder = tmp_path / "graphs"
    folder.mkdir()
    with gzip.open(folder / "one.jl.gz", "wt", encoding="utf-8") as f:
        f.write(json.dumps(GRAPH) + "\n" + json.dumps({"second": {"a.com": 1}}) + "\n{}\n")
    (folder / "two.jl").write_text(json.dumps({"plain.com": {"a.com": 5}, "only": {}}))
    (folder / "empty.jl").write_text("{}")
    edges, parents = read_one_line_graph(spark, str(folder))
    merged = {**GRAPH, "plain.com": {"a.com": 6, "b.com": 22}, "second": {"a.com": 1}, "only": {}}
    assert rows(edges, "src", "dst", "weight") == sorted(expected(merged), key=repr)
    assert parents.count() == len(merged)


@pytest.mark.parametrize("text", ['{"a": {"b": "x"}}', '{"a": {"b": 1.5}}', '{"a": 3}', '{"a": {"b": 1', '{"a" : {"b" : 1}}', '{"a": {"b'])
def test_other_text_ends_the_job(spark, tmp_path, text):
    path = tmp_path / "bad.jl"
    path.write_text(text)
    with pytest.raises(Exception):
        edges, parents = read_one_line_graph(spark, str(path))
        edges.collect()
        parents.collect()


NAMES = ["a.com", "b,c", 'q",', 'x\\', '["y"]', "", "é漢", '",', "z\n", '"', '\\",\\', ",x", ",", ":", "last]"]


@pytest.mark.parametrize("size", [5, 30, 10**6])
def test_index_cut_anywhere(spark, tmp_path, rows, size):
    names, ids = tmp_path / "names.jl", tmp_path / "ids.jl"
    names.write_text(json.dumps({"gnv": NAMES}))
    ids.write_text(json.dumps({n: i for i, n in enumerate(NAMES)}) + "\n")
    for head in ([",first"], ["\\"], [""]):
        names.write_text(json.dumps({"g\"nv": head}))
        assert rows(read_one_line_names(spark, str(names), size), "id", "name") == [(0, head[0])]
    names.write_text(json.dumps({"gnv": NAMES}))
    bare = tmp_path / "bare.jl"
    bare.write_text(json.dumps(NAMES, separators=(",", ":"), ensure_ascii=False) + "\n", encoding="utf-8")
    wanted = sorted(enumerate(NAMES), key=repr)
    assert rows(read_one_line_names(spark, str(names), size), "id", "name") == wanted
    assert rows(read_one_line_names(spark, str(bare), size), "id", "name") == wanted
    assert rows(read_one_line_ids(spark, str(ids), size), "id", "name") == wanted
    assert rows(import_index(spark, str(names), str(ids), size), "id", "name") == wanted


def test_index_files_that_disagree(spark, tmp_path):
    names, ids = tmp_path / "names.jl", tmp_path / "ids.jl"
    names.write_text(json.dumps(["a", "b"]))
    for other in ({"a": 1, "b": 0}, {"a": 0}, {"a": 0, "b": 1, "c": 2}):
        ids.write_text(json.dumps(other))
        with pytest.raises(Exception, match="disagree"):
            import_index(spark, str(names), str(ids)).collect()


def test_empty_array(spark, tmp_path):
    path = tmp_path / "names.jl"
    for text in ("[]", '{"gnv": []}\n'):
        path.write_text(text)
        assert read_one_line_names(spark, str(path)).count() == 0


def test_random_graphs(spark, tmp_path, rows):
    draw = random.Random(5)
    letters = ['"', "\\", ":", ",", "{", "}", " ", "a", "é", "\n", '":', '\\"']
    name = lambda: "".join(draw.choice(letters) for _ in range(draw.randint(0, 6)))
    graph = {name(): {name(): draw.randint(-5, 10**12) for _ in range(draw.randint(0, 5))} for _ in range(12)}
    path = tmp_path / "graph.jl"
    path.write_text(json.dumps(graph))
    edges, parents = read_one_line_graph(spark, str(path), 9)
    assert rows(edges, "src", "dst", "weight") == sorted(expected(graph), key=repr)
    assert parents.count() == len(graph)
