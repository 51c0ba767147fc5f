"""Ranked lexical search for many queries at once, with shared partial sums.

The score of an item in a document is a sum over the item's terms.  Items are taken in blocks
of bounded size.  Within a block, terms that occur in the same items are one class, and the
largest sets of classes that two items share are mined, over and over, as nodes of a graph: a node
is the sum of its children, items and nodes use nodes, and each shared set is summed up once
for every document instead of once for every item (common subexpressions).  The steps:

1. ``posting_table``: documents to (doc_id, n, places and counts of the items' terms), one pass;
2. numbers of all documents: N, L and the document frequency of each term;
3. accumulators of classes, nodes and items over blocks of documents, and the best of each task;
4. the best of all tasks for each item.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkrank.llm.mixing import running_total
from linkrank.llm.shared import ship
from linkrank.llm.text import FOLD_ALNUM, flat_ranges, pieces, segments, strings, words
from linkrank.operators.positions import with_position
from linkrank.operators.staging import stage

BEST = 10
#: Pairs of item and term in a block, and items in a block (a longer item is a block of its own).
BLOCK_PAIRS = 1 << 17
BLOCK_ITEMS = 256
#: Blocks that are answered by one pass over the documents.
BLOCKS = 8
#: Numbers in the accumulators of a block of documents.
CELLS = 1 << 22


@dataclass
class Plan:
    """How the items of one block are summed up."""

    items: np.ndarray  # numbers of the items
    terms: list[str]  # distinct terms
    first: np.ndarray  # first leaf of each term, and the total
    times: np.ndarray  # how often an item has the term, by leaf
    cls: np.ndarray  # the class that a leaf adds to
    classes: int
    nodes: list[list[int]]  # children of each node, by number: classes, then nodes
    parts: list[list[int]]  # children of each item


def _bits(mask: int) -> list[int]:
    out = []
    while mask:
        low = mask & -mask
        out.append(low.bit_length() - 1)
        mask ^= low
    return out


def share(rows: list[int], width: int) -> list[int]:
    """Mine shared sets among sets of classes, given as bit masks over ``width`` classes.

    The largest intersection of two sets becomes a node (bit ``width`` + its number) in all sets
    that contain it; nodes are sets too, whose parts can be shared in turn.  Changes ``rows`` in
    place and returns the sets of the nodes.
    """
    sets = rows  # grows by nodes
    queue = [(-(x & y).bit_count(), i, j) for i, x in enumerate(rows) for j, y in enumerate(rows[:i]) if (x & y).bit_count() > 1]
    heapify(queue)
    items = len(rows)
    while queue:
        size, i, j = heappop(queue)
        common = sets[i] & sets[j]
        if common.bit_count() != -size:
            if common.bit_count() > 1:
                heappush(queue, (-common.bit_count(), i, j))
            continue
        # A set inside another one is used as it is, if it is a node.
        whole = next((k for k in (i, j) if k >= items and sets[k] == common), None)
        new = len(sets) if whole is None else whole
        bit = 1 << (width + new - items)
        for k, own in enumerate(sets):
            if k != new and own & common == common:
                sets[k] = own & ~common | bit
        if whole is None:
            sets.append(common)
            for k, own in enumerate(sets[:-1]):
                if (own & common).bit_count() > 1:
                    heappush(queue, (-(own & common).bit_count(), new, k))
        else:
            for k, own in enumerate(sets):
                if k != new and (own & common).bit_count() > 1:
                    heappush(queue, (-(own & common).bit_count(), max(new, k), min(new, k)))
    nodes = sets[items:]
    del sets[items:]
    return nodes


def plan(item: np.ndarray, term: list[str], times: np.ndarray) -> Plan:
    """The plan of a block from its rows (number of the item, term, how often)."""
    items, row = np.unique(item, return_inverse=True)
    leaves: dict[tuple[str, int], list[int]] = {}
    for t, q, r in sorted(zip(term, times.tolist(), row.tolist(), strict=True)):
        leaves.setdefault((t, q), []).append(r)
    classes: dict[tuple[int, ...], int] = {}
    cls = np.array([classes.setdefault(tuple(users), len(classes)) for users in leaves.values()], np.int64)
    sets = [0] * len(items)
    for users, c in classes.items():
        for r in users:
            sets[r] |= 1 << c
    nodes = share(sets, len(classes))
    terms = sorted({t for t, _ in leaves})
    number = {t: i for i, t in enumerate(terms)}
    counts = np.bincount([number[t] for t, _ in leaves], minlength=len(terms))
    return Plan(
        items, terms, np.concatenate([[0], np.cumsum(counts)]), np.array([q for _, q in leaves], np.int64),
        cls, len(classes), [_bits(x) for x in nodes], [_bits(x) for x in sets],
    )


def _in_order(found: Plan) -> list[int]:
    """The nodes, children first."""
    done: dict[int, None] = {}
    for start in range(len(found.nodes)):
        stack = [start]
        while stack:
            top = stack[-1]
            missing = [c - found.classes for c in found.nodes[top] if c >= found.classes and c - found.classes not in done]
            if top in done or not missing:
                done.setdefault(stack.pop())
            else:
                stack += missing
    return list(done)


class Accumulators:
    """Sums of a plan over blocks of documents."""

    def __init__(self, found: Plan, vocabulary: dict[str, int]):
        self.plan = found
        self.order = _in_order(found)
        counts = np.zeros(len(vocabulary), np.int64)
        self.first = np.zeros(len(vocabulary), np.int64)
        place = np.array([vocabulary[t] for t in found.terms], np.int64)
        counts[place], self.first[place] = np.diff(found.first), found.first[:-1]
        self.counts = counts
        self.cells = found.classes + len(found.nodes)

    def totals(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, n: int):
        """(place of the item, its totals over ``n`` documents) of each item."""
        lengths = self.counts[term]
        leaf = flat_ranges(self.first[term], lengths)
        sums = np.zeros((self.cells, n), np.int64)
        place = self.plan.cls[leaf] * n + np.repeat(doc, lengths)
        np.add.at(sums.reshape(-1), place, np.repeat(value, lengths) * self.plan.times[leaf])
        for node in self.order:
            children = self.plan.nodes[node]
            sums[self.plan.classes + node] = sums[children].sum(axis=0)
        for i, parts in enumerate(self.plan.parts):
            yield i, (sums[parts[0]] if len(parts) == 1 else sums[parts].sum(axis=0))


class Best:
    """The best documents of each item so far; equal scores by id, rows without id last."""

    def __init__(self, items: int, best: int):
        self.best = best
        empty = np.zeros(0, np.int64)
        self.kept = [(empty, empty, empty) for _ in range(items)]
        self.least = [1] * items

    def add(self, item: int, totals: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        found = np.flatnonzero(totals >= self.least[item])
        if not len(found):
            return
        if len(found) > 4 * self.best:
            bound = np.partition(totals[found], -self.best)[-self.best]
            found = found[totals[found] >= bound]
        score, doc, none = (np.concatenate(x) for x in zip(self.kept[item], (totals[found], ids[found], missing[found]), strict=True))
        chosen = np.lexsort((doc, none, -score))[: self.best]
        self.kept[item] = score[chosen], doc[chosen], none[chosen]
        if len(chosen) == self.best:
            self.least[item] = int(score[chosen[-1]])


def _numbers(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers, how many in each row) of a column of packed numbers."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(kind) if data else np.zeros(0, kind)
    return flat, np.diff(offsets) // size


def item_terms(items: DataFrame) -> DataFrame:
    """(number, item_id, term, times, block) of the items' distinct terms, stored.

    Rows that share an item_id are one item with the terms of all.  Items without terms have no
    rows.  Blocks hold at most BLOCK_PAIRS rows and BLOCK_ITEMS items beyond their last item.
    """
    ship(items.sparkSession)
    schema = items.select("item_id").schema.add("term", "string")

    def split(batches):
        for batch in batches:
            for piece in pieces(batch):
                distinct, codes, starts = words(strings(piece.column("text")), FOLD_ALNUM)
                rows = pa.array(segments(starts))
                yield pa.RecordBatch.from_arrays([piece.column("item_id").take(rows), distinct.take(pa.array(codes))], names=["item_id", "term"])

    terms = items.select("item_id", "text").mapInArrow(split, schema).groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times"))
    terms = stage(terms, "item-terms")
    cost = F.greatest(F.count(F.lit(1)), F.lit(BLOCK_PAIRS // BLOCK_ITEMS)).alias("cost")
    numbered = with_position(terms.groupBy("item_id").agg(cost), [F.col("item_id").asc_nulls_last()], "number")
    placed = running_total(numbered.withColumn("all", F.lit(0).cast("long")), ["all", "number"], "all", "cost", "end")
    blocks = placed.select(F.col("item_id").alias("its_id"), "number", F.floor((F.col("end") - F.col("cost")) / BLOCK_PAIRS).alias("block"))
    return stage(terms.join(blocks, F.col("item_id").eqNullSafe(F.col("its_id"))).drop("its_id"), "items")


def plans(items: DataFrame) -> DataFrame:
    """(block, plan) of ``item_terms(...)``; a block is bounded, so one task can mine it."""

    def mine(table: pa.Table) -> pa.Table:
        found = plan(table["number"].to_numpy(), table["term"].to_pylist(), table["times"].to_numpy())
        return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int64()), "plan": pa.array([pickle.dumps(found)], pa.binary())})

    rows = items.select("block", "number", "term", "times")
    return stage(rows.groupBy("block").applyInArrow(mine, "block long, plan binary"), "plans")


def posting_table(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, n, terms, counts) of every row of (doc_id, text) with a term, stored.

    ``n`` counts all its terms; ``terms`` and ``counts`` are packed 32-bit places in the vocabulary
    and occurrences, of those that it has.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(vocabulary)

    def post(batches):
        known = pa.array(shared.value, pa.string())
        for batch in batches:
            for piece in pieces(batch):
                distinct, codes, starts = words(strings(piece.column("text")), FOLD_ALNUM)
                place = pc.fill_null(pc.index_in(distinct, known), -1).to_numpy().astype(np.int64)[codes]
                doc, hit = segments(starts), place >= 0
                keys, counts = np.unique(doc[hit] * max(len(known), 1) + place[hit], return_counts=True)
                n = np.diff(starts)
                bounds = np.searchsorted(keys, np.arange(len(n) + 1) * max(len(known), 1)).astype(np.int32) * 4
                packed = [
                    pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(bounds), pa.py_buffer(x.astype("<i4").tobytes())])
                    for x in (keys % max(len(known), 1), counts)
                ]
                out = pa.RecordBatch.from_arrays([piece.column("doc_id").cast(pa.int64()), pa.array(n), *packed], names=["doc_id", "n", "terms", "counts"])
                yield out.filter(pa.array(n > 0))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        post, "doc_id long, n long, terms binary, counts binary"
    )
    return stage(rows, "postings")


def frequencies(postings: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """(documents, their terms, document frequency of each of the vocabulary's ``terms``)."""

    def count(batches):
        found = np.zeros(terms, np.int64)
        for batch in batches:
            found += np.bincount(_numbers(batch.column("terms"), "<i4")[0], minlength=terms)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], names=["term", "df"])

    all_docs = postings.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    df = np.zeros(terms, np.int64)
    counted = postings.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    found = counted.toPandas()  # at most a row for each term of the vocabulary
    df[found["term"].to_numpy(np.int64)] = found["df"].to_numpy(np.int64)
    return all_docs["docs"], all_docs["words"], df


def lengths_factor(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """100 - 75 + ((75 * n * docs) div total), exact also where the product needs more than 64 bits."""
    if int(n.max(initial=0)) * 75 * docs < 1 << 63:
        return 25 + 75 * n * docs // total
    return np.array([25 + 75 * x * docs // total for x in n.tolist()], np.int64)


def _candidates(postings: DataFrame, found: list[Plan], vocabulary: dict[str, int], numbers, best: int) -> DataFrame:
    """The best documents of each task: (number, doc_id, score)."""
    docs, total, df = numbers
    weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    shared = postings.sparkSession.sparkContext.broadcast((found, vocabulary, weight))

    def run(batches):
        plans, words_of, w = shared.value
        sums = [Accumulators(p, words_of) for p in plans]
        kept = [Best(len(p.items), best) for p in plans]
        step = max(1, CELLS // max(x.cells for x in sums))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                term, lengths = _numbers(part.column("terms"), "<i4")
                tf = _numbers(part.column("counts"), "<i4")[0].astype(np.int64)
                doc = np.repeat(np.arange(len(lengths)), lengths)
                m = lengths_factor(part.column("n").to_numpy(), docs, total)
                value = w[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
                missing = part.column("doc_id").is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                ids = pc.fill_null(part.column("doc_id"), 0).to_numpy()
                for own, top in zip(sums, kept, strict=True):
                    for item, totals in own.totals(doc, term, value, len(ids)):
                        top.add(item, totals, ids, missing)
        for p, top in zip(plans, kept, strict=True):
            for item, (score, ids, missing) in zip(p.items.tolist(), top.kept, strict=True):
                if len(score):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(score), item)), pa.array(ids, mask=missing == 1), pa.array(score)],
                        names=["number", "doc_id", "score"],
                    )

    return postings.filter(F.length("terms") > 0).mapInArrow(run, "number long, doc_id long, score long")


def ranked_documents(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` documents of each item, scores above 0.

    A null text has no terms; an item without terms, or whose terms no document has, has no rows.
    Rows that share an item_id are one item, a null item_id is one too.  Rows that repeat a doc_id
    are documents of their own; a null doc_id comes last among equal scores.  Either table may be
    empty.  Other columns are not read.
    """
    spark = docs.sparkSession
    terms = item_terms(items)
    planned = plans(terms)
    last = planned.agg(F.max("block")).first()[0]
    parts = []
    for start in range(0, 0 if last is None else last + 1, BLOCKS):
        chosen = planned.filter(F.col("block").between(start, start + BLOCKS - 1)).orderBy("block")
        found = [pickle.loads(r["plan"]) for r in chosen.collect()]  # BLOCKS plans of bounded size
        if not found:
            continue
        listed = sorted({t for p in found for t in p.terms})
        postings = posting_table(docs, listed)
        numbers = frequencies(postings, len(listed))
        vocabulary = {t: i for i, t in enumerate(listed)}
        parts.append(stage(_candidates(postings, found, vocabulary, numbers, best), "candidates"))
    if not parts:
        return spark.createDataFrame([], items.select("item_id").schema.add("rank", "integer").add("doc_id", "long").add("score", "long"))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    order = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    top = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    names = terms.select("number", "item_id").distinct()
    return top.join(names, "number").select("item_id", "rank", "doc_id", "score")
