import gzip
import json
from dataclasses import replace

import pytest

import linkrank
from linkrank.__main__ import main
from linkrank.options import Options
from linkrank.plans.full_run import audit_stage, run_pipeline

# Keys of the JSON settings file, as in ``linkrank.options``.
SETTINGS = {
    "types to parse": ["type2", "type3"],
    "link attributes sort parameter": "indeg",
    "output sorted lists by each attribute": "true",
    "output filtered sorted lists by each attribute": "false",
    "filter link attributes by top pagerank": "True",
    "top N of pagerank to filter": 1,
    "filter custom URL list": "True",
    "URL filter list": ["c.com"],
    "filter custom URL from files": "False",
    "custom URL list file or directory": "/nowhere",
}


def page(url, *hrefs):
    return json.dumps({"url": url, "raw_content": "".join(f"<a href='{h}'>t</a>" for h in hrefs)})


@pytest.fixture
def crawl(tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jl").write_text(
        "\n".join([page("http://www.a.com/1", "/x", "http://b.com"), "{broken", page("http://b.com", "http://a.com")])
    )
    with gzip.open(src / "b.jl.gz", "wt") as out:
        out.write("\n".join([page("http://c.com", "http://a.com/q"), page("http://d.com", "#top")]))
    (src / "ledger.txt").write_text("x")
    return src, tmp_path / "out"


def test_settings_file():
    options = Options.from_json(json.dumps(SETTINGS), exclude_path="/list")
    assert options.link_types == ("type2", "type3") and options.sort_by == "indeg"
    assert options.write_sorted and not options.write_sorted_filtered
    assert options.exclude_top_pagerank == 1 and options.exclude_urls == ("c.com",)
    assert options.exclude_path == "/list"
    assert Options.from_json("{}").link_types == ("type2",)


@pytest.mark.parametrize("text", ["", "{", "[1]"])
def test_unreadable_settings_give_the_defaults(text):
    with pytest.warns(UserWarning, match="defaults"):
        assert Options.from_json(text, sort_by="indeg") == Options(sort_by="indeg")


def read_csv(spark, path):
    return [r["url"] for r in spark.read.option("header", True).csv(str(path)).collect()]


def test_full_run(spark, crawl, rows):
    src, out = crawl
    (src.parent / "listed").write_text(" d.com \nb.com\n")
    options = Options.from_json(json.dumps(SETTINGS), exclude_path=str(src.parent / "listed"))
    tables = run_pipeline(spark, str(src), str(out), options)

    got = {r["url"]: r for r in tables["type2"].collect()}
    assert set(got) == {"a.com", "b.com", "c.com"}  # d.com has no link: in the index only
    assert (got["a.com"]["outdeg"], got["a.com"]["indeg"], got["a.com"]["uniqueout"]) == (2, 3, 2)
    index = spark.read.parquet(f"{out}/metrics/type2/node_index")
    assert rows(index) == [(0, "a.com"), (1, "b.com"), (2, "c.com"), (3, "d.com")]
    corrupt = rows(spark.read.parquet(f"{out}/links/link_type=corrupt"), "bad_record", "crawl_file")
    assert [(text, file.rpartition("/")[2]) for text, file in corrupt] == [("{broken", "a.jl")]
    assert {p.name for p in (out / "metrics" / "type2" / "sorted").iterdir()} == {
        f"{f}_non_filtered"
        for f in ("uniqueout uniquein outdeg indeg uin_uout_ratio in_out_ratio pagerank pagerank_noweight").split()
    }
    assert not (out / "metrics" / "type2" / "sorted_filtered").exists()
    assert read_csv(spark, out / "metrics/type2/link_attributes_non_filtered") == ["a.com", "b.com", "c.com"]
    # a.com is the top PageRank, c.com is in the settings, b.com is in the file.
    assert read_csv(spark, out / "metrics/type2/link_attributes_filtered") == []

    brief = Options(write_sorted=False, write_sorted_filtered=False)
    again = run_pipeline(spark, str(src), str(out), brief)
    assert {r["url"]: r["outdeg"] for r in again["type2"].collect()} == {
        "a.com": 2, "b.com": 1, "c.com": 1
    }

    for link_type in ("type1", "type2"):
        verdicts = rows(audit_stage(spark, str(src), str(out), options, link_type=link_type), "crawl_file", "missing_pct")
        assert [(f.rpartition("/")[2], missing) for f, missing in verdicts] == [("a.jl", 0.0), ("b.jl.gz", 0.0)]
    with pytest.raises(ValueError, match="type1"):
        audit_stage(spark, str(src), str(out), replace(options, parse_types=("type2",)))

    # The earlier run may be the one that is written over.
    before = rows(spark.read.parquet(f"{out}/metrics/type2/node_index"))
    run_pipeline(spark, str(src), str(out), replace(brief, previous_run=str(out)))
    assert rows(spark.read.parquet(f"{out}/metrics/type2/node_index")) == before

    (src / "c.jl").write_text(page("http://a-first.com", "http://d.com"))
    run_pipeline(spark, str(src), f"{out}-next", replace(brief, previous_run=str(out)))
    index = spark.read.parquet(f"{out}-next/metrics/type2/node_index")
    assert rows(index) == [(0, "a.com"), (1, "b.com"), (2, "c.com"), (3, "d.com"), (4, "a-first.com")]


def test_extracted_run_by_name(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text(
        "\n".join(json.dumps(p) for p in ({"url": "http://www.a.com", "children": ["http://b.com"]}, {"children": ["/x"]}))
    )
    options = Options(encode_nodes=False, write_sorted=False, write_sorted_filtered=False)
    tables = run_pipeline(spark, str(src), str(tmp_path / "out"), options, extracted=True)
    assert {r["url"] for r in tables["type2"].collect()} == {"www.a.com", "b.com", "www.error.com"}
    verdict = audit_stage(spark, str(src), str(tmp_path / "out"), options, extracted=True).first()
    assert (verdict["n_in"], verdict["n_out"], verdict["missing_pct"]) == (2, 2, 0.0)


@pytest.mark.parametrize("extracted", [False, True])
def test_incremental_run_equals_a_full_one(spark, tmp_path, rows, extracted):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    brief = Options(write_sorted=False, write_sorted_filtered=False)

    def arrive(name, *pages_in):
        made = [{"url": u, "children": list(h)} for u, *h in pages_in]
        lines = [json.dumps(p) for p in made] if extracted else [page(u, *h) for u, *h in pages_in]
        (src / name).write_text("\n".join(lines) + "\n")

    def ids():
        return dict(map(tuple, spark.read.parquet(f"{out}/metrics/type2/node_index").select("name", "id").collect()))

    arrive("a.jl", ("http://b.com", "http://c.com", "/x"), ("http://z.com", "#top"))
    linkrank.run_incremental(spark, str(src), str(out), brief, extracted)
    first = ids()
    assert first == {"b.com": 0, "c.com": 1, "z.com": 2}
    arrive("b.jl", ("http://a.com", "http://c.com"), ("http://b.com", "http://c.com"))
    for _ in range(2):  # the second time nothing is new
        found = linkrank.run_incremental(spark, str(src), str(out), brief, extracted)
        whole = run_pipeline(spark, str(src), str(tmp_path / "whole"), brief, extracted)
        degrees = ("url", "outdeg", "indeg", "uniqueout", "uniquein")
        assert rows(found["type2"], *degrees) == rows(whole["type2"], *degrees)
        assert ids() == first | {"a.com": 3}


def test_an_incremental_run_does_not_read_old_links(spark, tmp_path, rows):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    brief = Options(write_sorted=False, write_sorted_filtered=False, pagerank={"fixed_iters": 1})
    (src / "a.jl").write_text("\n".join([page("http://b.com", "http://c.com"), page("http://z.com/alone", "#top")]))
    linkrank.run_incremental(spark, str(src), str(out), brief)
    old = list((out / "links").rglob("part-*"))
    for part in old:
        part.write_bytes(b"no table")
    (src / "b.jl").write_text("\n".join([page("http://a.com", "http://c.com"), page("http://b.com/more")]))
    found = linkrank.run_incremental(spark, str(src), str(out), brief)
    assert rows(found["type2"], "url", "outdeg", "indeg") == [("a.com", 1, 0), ("b.com", 1, 0), ("c.com", 0, 2)]
    index = spark.read.parquet(f"{out}/metrics/type2/node_index")
    assert rows(index, "id", "name") == [(0, "b.com"), (1, "c.com"), (2, "z.com"), (3, "a.com")]
    assert old and all(part.read_bytes() == b"no table" for part in old)


def test_counting_unparsed_types_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="type2"):
        run_pipeline(spark, str(tmp_path), str(tmp_path), Options(parse_types=("type1",)))


def test_stored_graph(spark, tmp_path):
    stored = {"a.com": {"b.com": 3, "c.com": 1}, "b.com": {"c.com": 2}, "empty.com": {}}
    (tmp_path / "graph.json").write_text(json.dumps(stored))
    table = linkrank.rerank_stored(spark, str(tmp_path / "graph.json"), str(tmp_path / "lists"))
    assert {r["url"]: r["indeg"] for r in table.collect()} == {"a.com": 0, "b.com": 3, "c.com": 3}
    assert read_csv(spark, tmp_path / "lists" / "outdeg") == ["a.com", "b.com", "c.com"]
    linkrank.export_edge_table(spark, str(tmp_path / "graph.json"), str(tmp_path / "edges"))
    exported = spark.read.option("header", True).csv(str(tmp_path / "edges"))
    assert sorted(r["src"] for r in exported.collect()) == ["a.com", "b.com"]


def test_public_names():
    assert all(getattr(linkrank, name) for name in linkrank.__all__)


def test_command_line(spark, crawl, tmp_path):
    src, out = crawl
    settings = {**SETTINGS, "types to parse": ["type3"], "output sorted lists by each attribute": "no"}
    (tmp_path / "settings.json").write_text(json.dumps(settings, indent=1))
    main(["run", str(src), str(out), "--settings", str(tmp_path / "settings.json")])
    assert read_csv(spark, out / "metrics/type3/link_attributes_filtered") == ["b.com"]
    graph = str(out / "metrics/type3/node_connectivity")
    main(["edge-table", graph, str(tmp_path / "edges")])
    assert spark.read.option("header", True).csv(str(tmp_path / "edges")).columns == [
        "src", "dst", "weight", "dstcount"
    ]
