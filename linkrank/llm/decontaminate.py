"""Benchmark passages in documents, by a prefix-filtered set join.

A window is a run of ``WINDOW`` words of an item, or the whole item if it is shorter, and is
taken as the set of its short shingles.  A document holds a window only if it holds all its
shingles, so it must hold the rarest: the necessary prefix is one shingle.  So

1. the shingles of the benchmark are counted in all documents; a window with a shingle that
   no document has cannot occur and is dropped,
2. each other window is posted under its rarest shingle,
3. places of these shingles in documents are joined with the posted windows by an equi-join
   that Spark can split, bounded by position and length (the window must begin and end within
   the document), and
4. the words around the place are compared with the window's words.

Nothing of the benchmark is broadcast but a bitmap of fixed size, which keeps other places
of the documents from leaving their task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkrank.llm.shared import bitmap, give_back, in_bitmap, ship
from linkrank.llm.text import FOLD_ALNUM, hashes, pieces, segments, strings, windows, words
from linkrank.operators.staging import stage

WINDOW = 13
SHINGLE = 3
#: Contaminated: n_hit > 0 and SHARE * n_hit >= n_words.
SHARE = 20
#: Bytes of text whose words are held at once.
HELD_BYTES = 2 << 20
#: Bits of the filter of shingles: fixed, half a megabyte.
FILTER_BITS = 1 << 22

_PLACES = "rid long, doc_id long, n_words long, pos long, size int, shingle long, first long, around array<long>"


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def _own_words(column):
    distinct, codes, starts = words(strings(column), FOLD_ALNUM)
    return hashes(distinct)[codes], starts


def _shingles(own: np.ndarray, starts: np.ndarray, size: int):
    """(hash, place) of the shingles of a size that lie within one text."""
    hashed = windows(own, size)
    text = segments(starts)
    place = np.flatnonzero(text[: len(hashed)] == text[size - 1 :])
    return hashed[place], place


def _longs(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def items(benchmark: DataFrame) -> DataFrame:
    """(uid, item_id, size, words, shingles) of each row of (item_id, text) that has words."""
    ship(benchmark.sparkSession)

    def run(batches):
        task, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            own, starts = _own_words(batch.column(1))
            rows = []
            for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
                if b > a:
                    size = min(SHINGLE, b - a)
                    rows.append((i, size, _longs(own[a:b]), _longs(windows(own[a:b], size))))
            index, sizes, lists, shingles = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 40) + count + i for i in index], pa.int64()),
                    batch.column(0).cast(pa.string()).take(pa.array(index, pa.int64())),
                    pa.array(sizes, pa.int32()),
                    pa.array(lists, pa.list_(pa.int64())),
                    pa.array(shingles, pa.list_(pa.int64())),
                ],
                names=["uid", "item_id", "size", "words", "shingles"],
            )
            count += batch.num_rows

    return benchmark.select("item_id", "text").mapInArrow(
        run, "uid long, item_id string, size int, words array<long>, shingles array<long>"
    )


def _filter(spark, shingles: DataFrame):
    slot = F.col("shingle").bitwiseAND(F.lit(FILTER_BITS - 1))
    return spark.sparkContext.broadcast(bitmap(shingles.select(slot.alias("slot")), FILTER_BITS))


def shingle_counts(docs: DataFrame, shingles: DataFrame, sizes: list[int]) -> DataFrame:
    """(shingle, n): how often each of the shingles occurs in all documents, if it does."""
    wanted = _filter(docs.sparkSession, shingles)

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, limit=HELD_BYTES):
                own, starts = _own_words(piece.column("text"))
                found = [h[in_bitmap(wanted.value, _slots(h))] for h, _ in (_shingles(own, starts, s) for s in sizes)]
                distinct, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_longs(distinct)), pa.array(counts.astype(np.int64))], names=["shingle", "n"]
                )
        give_back()

    counted = docs.select("text").mapInArrow(run, "shingle long, n long")
    return counted.groupBy("shingle").agg(F.sum("n").alias("n")).join(shingles, "shingle", "left_semi")


def posted_windows(found: DataFrame, counts: DataFrame) -> DataFrame:
    """(item_id, shingle, size, offset, words): each window that can occur, under its rarest shingle."""
    length = F.least(F.lit(WINDOW), F.size("words"))
    each = found.withColumn("start", F.explode(F.sequence(F.lit(1), F.size("words") - length + 1))).select(
        "uid",
        "start",
        "item_id",
        "size",
        F.slice("words", F.col("start"), length).alias("words"),
        F.slice("shingles", F.col("start"), length - F.col("size") + 1).alias("shingles"),
    )
    entries = each.select("uid", "start", F.size("shingles").alias("of"), F.posexplode("shingles").alias("offset", "shingle"))
    rarest = (
        entries.join(counts, "shingle")
        .groupBy("uid", "start")
        .agg(
            F.min(F.struct("n", "shingle", "offset")).alias("rarest"),
            F.count(F.lit(1)).alias("known"),
            F.first("of").alias("of"),
        )
        .filter("known = of")
        .select("uid", "start", "rarest.shingle", "rarest.offset")
    )
    # Equal windows of one item are one.
    return each.join(rarest, ["uid", "start"]).select("item_id", "shingle", "size", "offset", "words").distinct()


def places(docs: DataFrame, posted: DataFrame, sizes: list[int]) -> DataFrame:
    """A row for each document (pos null), and one for each place that may hold a posted shingle,
    with the words around it."""
    wanted = _filter(docs.sparkSession, posted)

    def run(batches):
        task, count = TaskContext.get().partitionId() << 40, 0
        names = [f.split()[0] for f in _PLACES.split(", ")]
        for batch in batches:
            for piece in pieces(batch, limit=HELD_BYTES):
                own, starts = _own_words(piece.column("text"))
                n = len(starts) - 1
                rid = task + count + np.arange(n)
                count += n
                none = lambda kind: pa.nulls(n, kind)  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid), piece.column("doc_id").cast(pa.int64()), pa.array(np.diff(starts)),
                     none(pa.int64()), none(pa.int32()), none(pa.int64()), none(pa.int64()), none(pa.list_(pa.int64()))],
                    names=names,
                )
                text = segments(starts)
                for size in sizes:
                    hashed, place = _shingles(own, starts, size)
                    hit = in_bitmap(wanted.value, _slots(hashed))
                    hashed, place = hashed[hit], place[hit]
                    for i in range(0, len(place), 4096):
                        at, h = place[i : i + 4096], hashed[i : i + 4096]
                        begin, end = starts[text[at]], starts[text[at] + 1]
                        first = np.maximum(begin, at - WINDOW + 1)
                        last = np.minimum(end, at + WINDOW)
                        bounds = np.concatenate([[0], np.cumsum(last - first)])
                        index = np.repeat(first - bounds[:-1], last - first) + np.arange(bounds[-1])
                        around = pa.ListArray.from_arrays(
                            pa.array(bounds, pa.int32()), pa.array(_longs(own[index]))
                        )
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(rid[text[at]]), pa.nulls(len(at), pa.int64()), pa.array(end - begin),
                             pa.array(at - begin), pa.array(np.full(len(at), size, np.int32)),
                             pa.array(_longs(h)), pa.array(first - begin), around],
                            names=names,
                        )
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, _PLACES)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each row of (doc_id, text).

    Words are the runs of letters (A-Z folded), digits and characters from U+0080 on.  A word
    within any occurrence of a window of a row of ``benchmark`` (item_id, text) is hit.  Null or
    empty texts have no words; items without words have no windows; a null item_id hits words
    but is not counted as an item; rows with one item_id are one item; repeated documents give a
    row each.  Documents and benchmark may be of any size.
    """
    spark = docs.sparkSession
    ship(spark)
    found = stage(items(benchmark), "items")
    sizes = sorted(r["size"] for r in found.select("size").distinct().collect())  # SHINGLE at most
    each = found.select(F.explode("shingles").alias("shingle")).distinct()
    counts = stage(shingle_counts(docs, each, sizes), "shingle-counts")
    posted = stage(posted_windows(found, counts), "posted-windows")
    at = stage(places(docs, posted, sizes), "places")

    start = F.col("pos") - F.col("offset")
    length = F.size("words")
    hits = stage(
        at.filter("pos IS NOT NULL")
        .join(posted.withColumnRenamed("size", "own_size"), "shingle")
        .filter(F.col("size") == F.col("own_size"))
        .filter((start >= 0) & (start + length <= F.col("n_words")))
        .filter(F.slice("around", (start - F.col("first") + 1).cast("int"), length) == F.col("words"))
        .select("rid", start.alias("start"), (start + length).alias("stop"), "item_id")
        .distinct(),
        "hits",
    )
    earlier = Window.partitionBy("rid").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("stop") - F.greatest("start", F.coalesce("before", F.lit(0))), F.lit(0))
    n_hit = (
        hits.select("rid", "start", "stop").distinct()
        .withColumn("before", F.max("stop").over(earlier))
        .groupBy("rid").agg(F.sum(fresh).alias("n_hit"))
    )
    # Grouped by document: at most the items whose windows lie in it.
    of_items = hits.groupBy("rid").agg(F.sort_array(F.collect_set("item_id")).alias("found"))
    none = F.array().cast("array<string>")
    return (
        at.filter("pos IS NULL").select("rid", "doc_id", "n_words")
        .join(n_hit, "rid", "left").join(of_items, "rid", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.size(F.coalesce("found", none)).cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", F.coalesce("found", none)).cast("binary"), 256).alias("items_sha256"),
        )
        .withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))
    )
