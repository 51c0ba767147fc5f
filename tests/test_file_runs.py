"""Runs that go on after broken files."""

import gzip
import json
import os
import shutil

import pytest

from linkrank.plans import file_runs


def line(url, *links):
    return json.dumps({"url": url, "raw_content": "".join(f'<a href="{x}">x</a>' for x in links)}) + "\n"


def write(path, n, cut=False):
    with gzip.open(path, "wt") as f:
        for i in range(n):
            f.write(line(f"http://{path.stem}.com/{i}", *(f"http://to{i * k}.com/{os.urandom(9).hex()}" for k in range(9))))
    if cut:
        data = path.read_bytes()
        path.write_bytes(data[: len(data) // 2])


@pytest.fixture
def folder(tmp_path):
    src = tmp_path / "crawl"
    (src / "deep").mkdir(parents=True)
    for name in ("a.jl.gz", "b.jl.gz", "c.jl.gz", "deep/d.jl.gz"):
        write(src / name, 300)
    write(src / "cut.jl.gz", 300, cut=True)
    (src / "plain.jl").write_text(line("http://p.com", "http://a.com") + "{broken\n")
    (src / "no-gzip.jl.gz").write_text(line("http://n.com"))
    (src / "processed.txt").write_text("a log")
    return src


def names(rows):
    return sorted(r["path"].rpartition("/")[2] for r in rows.collect())


def test_broken_files_are_withheld_and_taken_when_mended(spark, folder, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    first = file_runs.parse_new_files(spark, str(folder), out)
    assert first.count() == 7
    failed = {r["path"].rpartition("/")[2]: r["reason"] for r in file_runs.failed_files(spark, out).collect()}
    assert set(failed) == {"cut.jl.gz", "no-gzip.jl.gz"}
    assert "EOF" in failed["cut.jl.gz"] and "gzip" in failed["no-gzip.jl.gz"].lower()
    links = file_runs.read_parsed_links(spark, out)
    assert links.filter("link_type = 'type2'").count() == 4 * 300 + 1
    assert names(links.select("crawl_file").distinct().withColumnRenamed("crawl_file", "path")) == [
        "a.jl.gz", "b.jl.gz", "c.jl.gz", "d.jl.gz", "plain.jl"
    ]
    assert links.filter("link_type = 'corrupt'").count() == 1  # a bad line is no bad file
    assert file_runs.parse_new_files(spark, str(folder), out).count() == 0

    write(folder / "cut.jl.gz", 20)
    write(folder / "new.jl.gz", 10)
    # A run that is killed before its ledger rows is done over.
    shutil.rmtree(f"{out}/ledger/run=2", ignore_errors=True)
    written = file_runs.tables.write_page_links

    def killed(rows, path):
        written(rows, path)
        raise RuntimeError("killed")

    monkeypatch.setattr(file_runs.tables, "write_page_links", killed)
    with pytest.raises(RuntimeError, match="killed"):
        file_runs.parse_new_files(spark, str(folder), out)
    assert file_runs.read_parsed_links(spark, out).filter("link_type = 'type2'").count() == 4 * 300 + 1
    monkeypatch.setattr(file_runs.tables, "write_page_links", written)
    assert names(file_runs.parse_new_files(spark, str(folder), out)) == ["cut.jl.gz", "new.jl.gz"]
    assert file_runs.read_parsed_links(spark, out).filter("link_type = 'type2'").count() == 4 * 300 + 1 + 30
    assert names(file_runs.failed_files(spark, out)) == ["no-gzip.jl.gz"]


def test_probe_halves_groups(spark, folder, monkeypatch):
    monkeypatch.setattr(file_runs, "PROBED", 3)
    paths = [str(p) for p in sorted(folder.rglob("*.gz"))]
    assert {os.path.basename(p) for p in file_runs.broken_files(spark, paths)} == {"cut.jl.gz", "no-gzip.jl.gz"}
    assert file_runs.broken_files(spark, []) == {}


def test_pending_files_by_stem(spark, folder, tmp_path):
    done = tmp_path / "done"
    done.mkdir()
    for name in ("a.csv", "deep.csv", "plain.csv"):
        (done / name).write_text("1\n")
    found = file_runs.pending_files(spark, str(folder), str(done)).collect()
    assert sorted(r["file_name"] for r in found) == ["b.jl.gz", "c.jl.gz", "cut.jl.gz", "d.jl.gz", "no-gzip.jl.gz"]
    sizes = {r["file_name"]: r["bytes"] for r in found}
    assert sizes["d.jl.gz"] == (folder / "deep" / "d.jl.gz").stat().st_size
