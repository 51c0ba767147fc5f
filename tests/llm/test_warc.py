import base64
import hashlib
import random
import zlib

import pytest
from linkrank.llm import warc
from linkrank.operators.staging import scratch_path
from pyspark.sql import functions as F


def expected(rows, least=0):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    keeper = {}
    for i, p in payloads:
        if i is not None and len(p) >= least:
            keeper[p] = max(keeper.get(p, i), i)
    out = []
    for i, p in payloads:
        k = keeper.get(p)
        again = k is not None and (i is None or i < k)
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((i, len(p), digest, "revisit" if again else "response", k if again else None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    magic = "".join(map(chr, draw.choices(range(1, 250), k=5000))) + "\x1f\x08WARC/1.1\r\n\r\n"
    return [
        (1, "http://a", "<p>x</p>"),
        (2, "http://b\r\nWARC-Type: evil", "<p>x</p>"),
        (3, None, "<p>x</p>"),
        (3, None, "<p>x</p>"),
        (4, "http://é", None),
        (5, "", ""),
        (None, "http://n", "<p>x</p>"),
        (None, "http://m", "alone"),
        (6, "http://c", magic),
        (7, "http://d", "漢" * 200_000),
    ]


def test_pages_come_back(spark, rows):
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, refers_to int")
    found = [tuple(r) for r in warc.archive_pages(pages.repartition(3)).collect()]
    assert sorted(found, key=repr) == expected(rows)
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_any_ranges_give_the_same_records(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives = warc.write_archives(pages.coalesce(1), scratch_path(spark, "warc"), least_bytes=5)
    whole = sorted(map(tuple, warc.read_archives(spark, archives).collect()), key=repr)
    assert len(whole) == len(rows)
    for size in (101, 997):
        assert sorted(map(tuple, warc.read_archives(spark, archives, size).collect()), key=repr) == whole
    small = [(r[3], r[1], r[6]) for r in whole if r[4] < 5]
    assert all(kind == "response" and refers is None for _, kind, refers in small)


def test_chance_magic_is_passed_over(spark, tmp_path):
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    member = pack.compress(warc.record(9, "u", b"body", None)) + pack.flush()
    other = zlib.compressobj(6, zlib.DEFLATED, 31)
    no_record = other.compress(b"not a record " * 50) + other.flush()
    data = b"junk" + warc.MAGIC + b"junk" + no_record + member + warc.MAGIC
    (tmp_path / "x.warc.gz").write_bytes(data)
    archives = spark.createDataFrame([(f"file://{tmp_path}/x.warc.gz", len(data))], "path string, bytes long")
    found = warc.read_archives(spark, archives, 7).collect()
    assert [(r.page_id, bytes(r.payload)) for r in found] == [(9, b"body")]


def test_ranges_are_read_by_many_tasks(spark, tmp_path):
    pages = spark.range(200).selectExpr("id AS page_id", "concat('http://a.com/', id) AS url", "repeat(md5(cast(id AS string)), 30) AS html")
    archives = warc.write_archives(pages, str(tmp_path))
    read = warc.read_archives(spark, archives, range_bytes=2_000)
    used = read.select(F.spark_partition_id().alias("p")).distinct().count()
    assert used > 4 and read.count() == 200
