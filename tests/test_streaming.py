import json

import pytest

from linkrank.operators.links import EDGE_KEYS
from linkrank.sources.graph import read_page_links
from linkrank.streaming import ingest


def page(url, *hrefs):
    return json.dumps({"url": url, "raw_content": "".join(f"<a href='{h}'>t</a>" for h in hrefs)})


@pytest.fixture
def arrivals(tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "one.jl").write_text("\n".join([page("http://a.com", "http://b.com", "/x"), "{broken"]) + "\n")
    (src / "ledger.txt").write_text("one.jl")
    return src


def test_second_run_reads_only_new_files(spark, arrivals, tmp_path, rows):
    out, state = str(tmp_path / "links"), str(tmp_path / "state")
    counts, count_state = str(tmp_path / "counts"), str(tmp_path / "count_state")

    def run():
        ingest.ingest_links(
            ingest.stream_pages(spark, str(arrivals), max_files_per_trigger=1), out, state
        ).awaitTermination()
        links = ingest.stream_links(spark, out, ["type2"])
        ingest.ingest_edge_counts(links, counts, count_state).awaitTermination()
        return rows(ingest.read_edge_counts(spark, counts), "src", "dst", "weight")

    first = [("a.com", "a.com", 1), ("a.com", "b.com", 1)]
    assert run() == first
    assert run() == first
    (arrivals / "two.jl").write_text(page("http://a.com/2", "http://b.com") + "\n")
    assert run() == [("a.com", "a.com", 1), ("a.com", "b.com", 2)]
    assert read_page_links(spark, out, ["type2"]).count() == 2
    bad = spark.read.parquet(out).filter("link_type = 'corrupt'")
    assert rows(bad, "bad_record") == [("{broken",)]
    again = [("a.com", "a.com", 1), ("a.com", "b.com", 2)]
    assert rows(ingest.compact_edge_counts(spark, counts), "src", "dst", "weight") == again
    assert [p.name.split("=")[0] for p in (tmp_path / "counts").iterdir() if p.is_dir()] == ["compacted"]
    assert rows(ingest.compact_edge_counts(spark, counts), "src", "dst", "weight") == again
    (arrivals / "three.jl").write_text(page("http://c.com", "http://b.com") + "\n")
    assert run() == [*again, ("c.com", "b.com", 1)]
    files = {p.rpartition("/")[2] for (p,) in rows(spark.read.parquet(out).select("crawl_file").distinct())}
    assert files == {"one.jl", "two.jl", "three.jl"}


def test_a_sum_that_was_cut_short_is_not_read(spark, arrivals, tmp_path, rows):
    counts = tmp_path / "counts"
    schema = "link_type string, src string, dst string, weight bigint"
    for batch in (0, 1):
        spark.createDataFrame([("type2", "a", "b", 1)], schema).write.parquet(f"{counts}/batch={batch}")
    spark.createDataFrame([("type2", "a", "b", 7)], schema).write.parquet(f"{counts}/compacted=1")
    (counts / "compacted=1" / "_SUCCESS").unlink()
    assert rows(ingest.read_edge_counts(spark, str(counts)), "weight") == [(2,)]
    assert rows(ingest.compact_edge_counts(spark, str(counts)), "weight") == [(2,)]


def test_running_counts(spark, arrivals, tmp_path, rows):
    out, counts, state = (str(tmp_path / n) for n in ("links", "running", "state"))

    def run():
        pages = ingest.stream_pages(spark, str(arrivals), max_files_per_trigger=1)
        ingest.ingest_links(pages, out, str(tmp_path / "s")).awaitTermination()
        ingest.keep_running_counts(ingest.stream_links(spark, out), counts, state).awaitTermination()
        kept = ingest.read_running_counts(spark, counts).filter("link_type = 'type2'")
        return rows(kept, *EDGE_KEYS, "weight")

    assert run() == [("type2", "a.com", "a.com", 1), ("type2", "a.com", "b.com", 1)]
    for i in range(3):
        (arrivals / f"{i}.jl").write_text(page("http://a.com", "http://b.com") + "\n")
        assert run() == [("type2", "a.com", "a.com", 1), ("type2", "a.com", "b.com", i + 2)]
    assert len(list((tmp_path / "running").glob("version=*"))) <= 2


@pytest.mark.parametrize("gaps", [False, True])
def test_runs_hold_every_batch_once(gaps):
    import random

    for seed in range(30):
        draw = random.Random(seed)
        fanout, bucket = draw.randint(2, 5), draw.randint(0, 40)
        whole, held = [], {}
        for batch in range(200):
            if gaps and draw.random() < 0.2:
                continue
            first = batch - ingest._span(batch, bucket, fanout)
            older = ingest.live_runs(whole, bucket, fanout, first)
            held[batch] = [batch] + [x for run in older for x in held[run]]
            whole.append(batch)
            live = ingest.live_runs(whole, bucket, fanout)
            assert sorted(x for run in live for x in held[run]) == whole
            if not gaps:
                assert len(live) <= fanout * 8


def test_a_trigger_writes_its_own_rows_not_the_table(spark, tmp_path, rows):
    out, size, batches = str(tmp_path / "running"), 64, 26
    schema = "link_type string, src string, dst string, weight bigint"

    def add(batch):
        # Every pair is new but one.
        pairs = [("type2", f"s{batch}", f"d{i}", 1) for i in range(size)] + [("type2", "hot", "hot", 2)]
        ingest.add_counts(spark.createDataFrame(pairs, schema).coalesce(1), out, batch, buckets=16, fanout=2)

    def hot():
        return rows(ingest.read_running_counts(spark, out).filter("src = 'hot'"), "weight")

    written = []
    for batch in range(batches):
        add(batch)
        folder = f"{out}/runs-16-2/batch={batch}"
        written.append(spark.read.parquet(folder).count())
    assert ingest.read_running_counts(spark, out).count() == batches * size + 1
    assert hot() == [(2 * batches,)]
    # Five levels at most; the table's size alone would be 26 batches' rows.
    assert max(written) < 7 * size and sum(written) < 6 * batches * size
    # A batch that is done again, or that died on its way, changes nothing.
    add(batches - 1)
    assert hot() == [(2 * batches,)]
    (tmp_path / "running" / "runs-16-2" / f"batch={batches - 1}" / "_SUCCESS").unlink()
    assert hot() == [(2 * batches - 2,)]
    add(batches - 1)
    assert hot() == [(2 * batches,)]
    with pytest.raises(ValueError, match="buckets"):
        ingest.add_counts(spark.createDataFrame([], schema), out, batches, buckets=8, fanout=2)


def test_counts_from_before_there_were_buckets_go_on(spark, tmp_path, rows):
    out, schema = str(tmp_path / "old"), "link_type string, src string, dst string, weight bigint"
    assert rows(ingest.read_running_counts(spark, out)) == []
    frame = spark.createDataFrame([("type2", "a", "b", 3)], schema)
    frame.write.parquet(f"{out}/version=0")
    ingest.add_counts(frame, out, 1)
    assert rows(ingest.read_running_counts(spark, out), "src", "dst", "weight") == [("a", "b", 6)]
