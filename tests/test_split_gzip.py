"""Gzip files that many tasks read: members, ranges, damaged and foreign files."""

import gzip
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from linkrank.sinks import tables
from linkrank.sources import crawl, split_gzip
from linkrank.sources.split_gzip import MARK, Segments, dealt, lines, member


def read(data: bytes, cuts: list[int]) -> list[list[bytes]]:
    """The lines that each range of a file owns."""
    bounds = [0, *cuts, len(data)]
    return [
        [x for segment in Segments(io.BytesIO(data), "f", a, b) for found in lines(segment) for x in found]
        for a, b in zip(bounds, bounds[1:])
    ]


@pytest.mark.parametrize("seed", range(8))
def test_every_line_has_one_owner(seed):
    draw = random.Random(seed)
    data, wanted = b"", []
    for n in range(draw.randint(1, 12)):
        text = [bytes(draw.choices(b"abc \xc3\xa9", k=draw.randint(0, 40))) for _ in range(draw.randint(1, 30))]
        wanted += text
        joined = b"".join(x + draw.choice([b"\n", b"\r\n"]) for x in text)
        # A member without the mark goes with the one before it.
        data += member(joined) if n == 0 or draw.random() < 0.7 else gzip.compress(joined)
    assert gzip.decompress(data).splitlines() == wanted
    for _ in range(20):
        cuts = sorted(draw.sample(range(1, len(data)), min(draw.randint(0, 9), len(data) - 1)))
        assert [x for part in read(data, cuts) for x in part] == wanted
    every = read(data, list(range(1, len(data))))
    assert [x for part in every for x in part] == wanted


def test_a_line_may_run_over_unmarked_members():
    data = member(b"a\nb") + gzip.compress(b"c\r") + gzip.compress(b"\nd") + member(b"e\n")
    assert read(data, [5]) == [[b"a", b"bc", b"d"], [b"e"]]


def test_files_of_other_programs_have_one_owner():
    plain = gzip.compress(b"a\nb\n") + member(b"c\n")
    assert read(plain, [3, len(plain) - 4]) == [[b"a", b"b", b"c"], [], []]
    assert read(b"", []) == [[]]
    assert read(member(b""), []) == [[]]


@pytest.mark.parametrize("data", [member(b"abc\n" * 99)[:-3], member(b"a\n") + b"xx", member(b"a\n")[:-8] + b"\0" * 8, b"no gzip at all"])
def test_damage_is_an_error(data):
    with pytest.raises(ValueError, match="^f: "):
        read(data, [])


def test_returns_across_chunks():
    assert [x for part in lines(iter([b"a\r", b"\nb", b"\r", b"c\r", b"", b"\r"])) for x in part] == [b"a", b"b", b"c", b""]


def test_small_files_share_a_task():
    found = dealt([("a", 10), ("b", 3), ("c", 4), ("d", 0)], 5)
    assert [t.parts for t in found] == [[("a", 0, 5)], [("a", 5, 10)], [("b", 0, 3)], [("c", 0, 4)]]
    assert [t.parts for t in dealt([("b", 3), ("c", 2)], 5)] == [[("b", 0, 3), ("c", 0, 2)]]


def test_one_file_is_read_by_many_tasks(spark, tmp_path, rows):
    draw = random.Random(3)
    pages = [(f"http://s{i}.com/é", "".join(draw.choices("abcdef<>\"\n", k=300))) for i in range(3000)]
    frame = spark.createDataFrame(pages, "url string, raw_content string").coalesce(1)
    out = str(tmp_path / "crawl")
    tables.write_crawl(frame, out, member_bytes=20_000)
    assert sorted(p.suffix for p in (tmp_path / "crawl").iterdir() if not p.name.startswith(".")) == ["", ".gz"]
    found = crawl.read_pages(spark, out, gzip_range_bytes=30_000)
    tasks = found.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) > 5 and max(r["count"] for r in tasks) < 1000
    usual = crawl.read_pages(spark, out)
    assert rows(found, "url", "raw_content") == rows(usual, "url", "raw_content") == sorted(pages, key=repr)
    name = lambda df: rows(df.select(F.regexp_extract("crawl_file", "[^/]+$", 0)).distinct())
    assert name(found) == name(usual)
    tables.write_crawl(frame.limit(5), out)  # adds a file
    assert crawl.read_pages(spark, out, gzip_range_bytes=30_000).count() == 3005


def test_many_files_for_a_task_and_none_for_no_rows(spark, tmp_path):
    tables.write_crawl(spark.range(2000).select(F.col("id").cast("string").alias("url")).coalesce(1), str(tmp_path / "a"), member_bytes=500, file_bytes=2000)
    assert len(list((tmp_path / "a").glob("*.gz"))) > 5
    assert crawl.read_pages(spark, str(tmp_path / "a"), gzip_range_bytes=1 << 20).distinct().count() == 2000
    tables.write_crawl(spark.range(0).select(F.col("id").cast("string").alias("url")), str(tmp_path / "b"))
    assert crawl.read_pages(spark, str(tmp_path / "b"), gzip_range_bytes=100).count() == 0


def test_odd_lines_are_as_in_the_usual_scan(spark, tmp_path, rows):
    odd = ['{"url": "a", "raw_content": "x"}', "", "  ", "{broken", "[]", '[{"url": "b"}, {"url": "c"}]', "[1", "null", "7", '{"url": 5}', '{"index": 1}']
    with gzip.open(tmp_path / "odd.jl.gz", "wt") as out:
        out.write("\n".join(odd))
    (tmp_path / "marked.jl.gz").write_bytes(member("\r\n".join(odd).encode()))
    (tmp_path / "plain.jl").write_text(json.dumps({"url": "p"}))
    (tmp_path / "empty.jl.gz").write_bytes(b"")
    (tmp_path / "seen.txt").write_text("a log")
    (tmp_path / "a b%41é+&.jl.gz").write_bytes(member(b'{"url": "odd name"}'))
    columns = "url", "raw_content", crawl.CORRUPT_COLUMN, crawl.FILE_COLUMN
    found, usual = (rows(crawl.read_pages(spark, str(tmp_path), gzip_range_bytes=n), *columns) for n in (64, None))
    assert found == usual


def test_a_cut_file_ends_the_job(spark, tmp_path):
    (tmp_path / "cut.jl.gz").write_bytes(member(b'{"url": "a"}\n' * 999)[:-20])
    with pytest.raises(Exception, match="ends within a gzip member"):
        crawl.read_pages(spark, str(tmp_path), gzip_range_bytes=1000).collect()
    assert MARK.startswith(split_gzip.MAGIC)
