import json

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from linkrank.options import Options
from linkrank.plans import index_versions
from linkrank.plans.full_run import run_incremental, run_pipeline
from linkrank.streaming.ingest import delete_folders, whole_versions

BRIEF = Options(link_types=("type2",), parse_types=("type2",), write_sorted=False, write_sorted_filtered=False)


def arrive(folder, name, *pages):
    (folder / name).write_text("".join(json.dumps({"url": u, "children": list(c)}) + "\n" for u, *c in pages))


def names_of(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def test_versions(spark, tmp_path, rows, monkeypatch):
    folder = str(tmp_path / "index")
    assert index_versions.read_versions(spark, folder) is None
    first = index_versions.extend_versions(names_of(spark, "b", "d", "b"), folder)
    assert rows(first) == [(0, "b"), (1, "d")]
    for new in ("a", "c"):
        found = index_versions.extend_versions(names_of(spark, "d", new), folder)
    known = [(0, "b"), (1, "d"), (2, "a"), (3, "c")]
    assert rows(found) == known
    # An extension writes new names only; one without new names changes nothing.
    assert spark.read.parquet(f"{folder}/delta=2").count() == 1
    assert rows(index_versions.extend_versions(names_of(spark, "a"), folder)) == known
    # Many deltas become a base, and frames of before are still readable.
    monkeypatch.setattr(index_versions, "MOST_DELTAS", 3)
    whole = index_versions.extend_versions(names_of(spark, "e"), folder)
    assert rows(whole) == [*known, (4, "e")] and whole_versions(spark, folder, "base") == [0, 5]
    assert rows(found) == known
    assert rows(index_versions.extend_versions(names_of(spark, "f"), folder))[-1] == (5, "f")
    # A new base replaces what is read, and older bases go.
    assert rows(index_versions.write_base(names_of(spark, "z").selectExpr("0L as id", "name"), folder)) == [(0, "z")]
    assert whole_versions(spark, folder, "base") == [5, 7] and rows(whole) == [*known, (4, "e")]


def test_nothing_to_index(spark, tmp_path):
    assert index_versions.extend_versions(names_of(spark, "a").limit(0), str(tmp_path)).count() == 0
    assert [tuple(r) for r in index_versions.extend_versions(names_of(spark, "a"), str(tmp_path)).collect()] == [(0, "a")]


@pytest.mark.parametrize("place", ["node_index_versions/delta=1", "/node_index", "/attributes"])
@pytest.mark.parametrize("begun", [False, True])
def test_ids_survive_a_run_that_dies(spark, tmp_path, monkeypatch, place, begun):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()

    def ids():
        return dict(spark.read.parquet(f"{out}/metrics/type2/node_index").select("name", "id").toPandas().itertuples(index=False))

    arrive(src, "a.json", ("http://m.com", "http://z.com"))
    run_incremental(spark, str(src), str(out), BRIEF, extracted=True)
    first = ids()
    assert first == {"m.com": 0, "z.com": 1}
    arrive(src, "b.json", ("http://a.com", "http://b.com"))

    write = DataFrameWriter.parquet

    def dies(self, path, *args, **kwargs):
        if path.endswith(place):
            if begun:  # some of its files are there, but not the mark of a whole table
                write(self, path, *args, **kwargs)
                delete_folders(spark, [f"{path}/_SUCCESS"])
            raise RuntimeError("killed")
        write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", dies)
    with pytest.raises(RuntimeError, match="killed"):
        run_incremental(spark, str(src), str(out), BRIEF, extracted=True)
    monkeypatch.undo()
    arrive(src, "c.json", ("http://0.com", "http://a.com"))
    run_incremental(spark, str(src), str(out), BRIEF, extracted=True)
    found = ids()
    assert {n: found[n] for n in first} == first and sorted(found.values()) == list(range(5))


def test_an_unfinished_index_without_versions_is_refused(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    arrive(src, "a.json", ("http://m.com", "http://z.com"))
    run_pipeline(spark, str(src), str(out), BRIEF, extracted=True)
    folder = f"{out}/metrics/type2"
    delete_folders(spark, [f"{folder}/node_index_versions", f"{folder}/node_index/_SUCCESS"])
    with pytest.raises(ValueError, match="not written to the end"):
        run_incremental(spark, str(src), str(out), BRIEF, extracted=True)
