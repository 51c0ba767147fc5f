"""A toxicity classifier: a linear model over character n-grams scaled by naive Bayes ratios.

Features are the hashed n-grams of the words of a text, each word between blanks, as present
or absent.  Over a bounded sample of labelled rows, every n-gram gets its log-count ratio
between toxic and other texts.  A logistic model is trained on all of them with the ratios as
feature values; its penalties choose.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.shared import give_back, labelled_sample, remainder, ship
from linkrank.llm.text import FOLD, flat_ranges, pieces, segments, strings, windows, words
from linkrank.operators.staging import stage

#: Labelled rows of each label that the model is fitted on, at most.
SAMPLE = 6_000
SIZES = (3, 4, 5, 6)
BUCKETS = 1 << 20
#: Bytes of text whose n-grams are listed at once.
PIECE_BYTES = 1 << 20
#: Entries of the sparse matrix that are worked on at once.
BLOCK = 1 << 18
#: Parts in which the sample's n-grams come to the driver.
FETCHES = 32
THRESHOLD = 0.5
RIDGE = 1e-6
LASSO = 1e-5
#: Training ends when no column's gradient is further off than this part of the first one, or after ROUNDS
#: rounds of at most STEPS steps over a part of the columns.
TOLERANCE = 1e-3
ROUNDS = 30
STEPS = 100
#: Columns that a round takes in, and as many again as have a weight, twice.
WORKING = 2_048


def word_ngrams(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of the n-grams of ``" " + word + " "``."""
    if not len(distinct):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(distinct)], distinct), " ")[0].as_py()
    letters = np.frombuffer(f" {joined} ".encode("utf-32-le"), "<u4").astype(np.uint64)
    blanks = np.cumsum(letters == 32)
    word, bucket = [], []
    for size in SIZES:
        hashed = windows(letters + np.uint64(size << 32), size)
        start = np.arange(len(hashed))
        inside = start[blanks[start + size - 2] == blanks[start]]
        word.append(blanks[inside] - 1)
        bucket.append((hashed[inside] & np.uint64(BUCKETS - 1)).astype(np.int64))
    return np.concatenate(word), np.concatenate(bucket)


def text_features(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket): the distinct n-grams of each text, of those with ``wanted[bucket]``."""
    distinct, codes, starts = words(texts, FOLD)
    word, bucket = word_ngrams(distinct)
    if wanted is not None:
        kept = wanted[bucket]
        word, bucket = word[kept], bucket[kept]
    order = np.argsort(word, kind="stable")
    bucket = bucket[order]
    counts = np.bincount(word, minlength=len(distinct))
    firsts = np.cumsum(counts) - counts
    text = segments(starts)
    useful = counts[codes] > 0
    text, codes = text[useful], codes[useful].astype(np.int64)
    pairs = np.unique(text * max(len(distinct), 1) + codes)
    text, codes = pairs // max(len(distinct), 1), pairs % max(len(distinct), 1)
    lengths = counts[codes]
    keys = np.unique(np.repeat(text, lengths) * BUCKETS + bucket[flat_ranges(firsts[codes], lengths)])
    return keys // BUCKETS, keys % BUCKETS


@dataclass
class NgramModel:
    weights: np.ndarray  # by bucket, the ratio included
    intercept: float

    def margins(self, texts: pa.Array) -> np.ndarray:
        text, bucket = text_features(texts, self.weights != 0)
        return self.intercept + np.bincount(text, weights=self.weights[bucket], minlength=len(texts))


class _Packed:
    """Whole numbers in half the room: 16 bits of each, and where the rest changes from one to the next.

    It seldom does among ascending numbers, such as a row's columns.  Slices are arrays again.
    """

    def __init__(self, size: int):
        self.low = np.empty(size, np.uint16)
        self.starts, self.high = np.zeros(1, np.int64), np.zeros(1, np.int32)
        self._changes: list[tuple] = []

    def __len__(self) -> int:
        return len(self.low)

    def put(self, at: int, values: np.ndarray) -> None:
        """Store ``values`` from place ``at`` on; places are filled in order and sealed once."""
        self.low[at : at + len(values)] = values & 0xFFFF
        high = (values >> 16).astype(np.int32)
        firsts = np.flatnonzero(high[1:] != high[:-1]) + 1
        firsts = np.concatenate([np.zeros(min(len(values), 1), np.int64), firsts])
        self._changes.append((firsts + at, high[firsts]))

    def seal(self) -> None:
        if self._changes:
            self.starts, self.high = (np.concatenate(x) for x in zip(*self._changes, strict=True))
        self._changes = []

    def __getitem__(self, part: slice) -> np.ndarray:
        start, stop, _ = part.indices(len(self))
        first, last = np.searchsorted(self.starts, start, side="right") - 1, np.searchsorted(self.starts, stop)
        ends = np.append(self.starts[first + 1 : last], stop)
        high = np.repeat(self.high[first:last] << 16, np.diff(np.concatenate([[start], ends])) if last > first else 0)
        return high | self.low[start:stop]


class _Renumbered:
    """The entries of a matrix in the columns ``c`` where ``new[c]`` is not -1, numbered ``new[c]``.

    They are made when whole rows of them are read.
    """

    def __init__(self, bounds, column, new):
        self.whole, self.column, self.new = bounds, column, new
        counts = np.zeros(len(bounds) - 1, np.int64)
        for rows, entries in _blocks(bounds):
            inside = np.concatenate([[0], np.cumsum(new[column[entries]] >= 0)])
            counts[rows] = np.diff(inside[np.append(bounds[rows], entries.stop) - entries.start])
        self.bounds = np.concatenate([[0], np.cumsum(counts)])

    def __len__(self) -> int:
        return int(self.bounds[-1])

    def __getitem__(self, part: slice) -> np.ndarray:
        first, last = np.searchsorted(self.bounds, [part.start, part.stop])
        own = self.new[self.column[self.whole[first] : self.whole[last]]]
        return own[own >= 0]


def _alike(bounds, column, columns: int, blocks) -> tuple[np.ndarray, np.ndarray]:
    """(group of each column, columns of each group): columns in exactly the same rows are one group.

    Rows get two random numbers, whose sums over a column's rows (exact in doubles: at most 2^13 rows
    of 2^39) tell columns apart by 78 bits.
    """
    n = len(bounds) - 1
    bits = 52 - max(n - 1, 1).bit_length()
    draws = np.random.default_rng(1).integers(1, 1 << min(bits, 39), (2, n)).astype(float)
    lengths, sums = np.diff(bounds), np.zeros((2, columns))
    for rows, entries in blocks:
        for draw, total in zip(draws, sums, strict=True):
            total += np.bincount(column[entries], weights=np.repeat(draw[rows], lengths[rows]), minlength=columns)
    order = np.lexsort(sums)
    new = np.any(sums[:, order[1:]] != sums[:, order[:-1]], axis=0)
    group = np.zeros(columns, np.int64)
    group[order] = np.concatenate([[0], np.cumsum(new)]) if columns else group
    return group, np.bincount(group)


def _blocks(bounds) -> list[tuple[slice, slice]]:
    """Whole rows of about BLOCK entries."""
    out, start, n = [], 0, len(bounds) - 1
    while start < n:
        stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + BLOCK, side="right")) - 1)
        out.append((slice(start, stop), slice(int(bounds[start]), int(bounds[stop]))))
        start = stop
    return out


def _restricted(bounds, column, new, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The matrix with the columns ``c`` where ``new[c]`` is not -1, numbered ``new[c]``, of ``size`` entries."""
    counts = np.zeros(len(bounds) - 1, np.int64)
    out, at = np.empty(size, np.uint16 if new.max(initial=0) < 1 << 16 else np.int32), 0
    for rows, entries in _blocks(bounds):
        own = new[column[entries]]
        inside = np.concatenate([[0], np.cumsum(own >= 0)])
        counts[rows] = np.diff(inside[np.append(bounds[rows], entries.stop) - entries.start])
        own = own[own >= 0]
        out[at : at + len(own)] = own
        at += len(own)
    return np.concatenate([[0], np.cumsum(counts)]), out


class _Logistic:
    """The penalised loss over a sparse matrix; the first weight is the intercept.

    Row i has the columns ``column[bounds[i]:bounds[i + 1]]``, each with the column's ``value``.
    """

    def __init__(self, bounds, column, value, ridge, y, share):
        self.bounds, self.column, self.value, self.y, self.share = bounds, column, value, y, share
        self.ridge = np.concatenate([[0.0], ridge])
        self.lengths, self.blocks = np.diff(bounds), _blocks(bounds)
        size = np.abs(value)
        ones = self.backward(share * self.forward(np.ones(len(value) + 1), size), size)
        self.curve = np.maximum(ones / 4 + self.ridge, 1e-12)  # no coordinate bends more

    def forward(self, w, by=None):
        scaled, out = w[1:] * (self.value if by is None else by), np.full(len(self.y), w[0])
        for rows, entries in self.blocks:
            sums = np.concatenate([[0.0], np.cumsum(scaled[self.column[entries]])])
            out[rows] += np.diff(sums[np.append(self.bounds[rows], entries.stop) - entries.start])
        return out

    def backward(self, r, by=None):
        out = np.zeros(len(self.value))
        for rows, entries in self.blocks:
            out += np.bincount(self.column[entries], weights=np.repeat(r[rows], self.lengths[rows]), minlength=len(out))
        return np.concatenate([[r.sum()], out * (self.value if by is None else by)])

    def gradient(self, f, w):
        return self.backward(self.share * (1 / (1 + np.exp(-f)) - self.y)) + self.ridge * w

    def loss(self, f, w):
        return float(self.share @ (np.logaddexp(0, f) - self.y * f)) + float(self.ridge @ (w * w)) / 2

    def solve(self, w, tolerance: float, steps: int):
        """Accelerated proximal steps from ``w`` until no coordinate's gradient would move it by more
        than ``tolerance``: coordinates have steps of their own, scaled together by a line search."""
        z, t, scale = w, 1.0, 1 / 64
        fw = fz = self.forward(w)
        for _ in range(steps):
            gradient, here = self.gradient(fz, z), self.loss(fz, z)
            while True:
                step = 1 / (scale * self.curve)
                new = z - step * gradient
                new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step[1:] * LASSO, 0)
                move, fnew = new - z, self.forward(new)
                if scale >= 1 or self.loss(fnew, new) <= here + gradient @ move + scale / 2 * (self.curve @ (move * move)):
                    break
                scale = min(1.0, scale * 2)
            if (z - new) @ (new - w) > 0:  # the momentum points back
                t = 1.0
            following = (1 + np.sqrt(1 + 4 * t * t)) / 2
            ahead = (t - 1) / following
            z, fz = new + ahead * (new - w), fnew + ahead * (fnew - fw)
            done = np.abs(scale * self.curve * move).max() < tolerance
            w, fw, t, scale = new, fnew, following, scale * 0.9
            if done:
                break
        return w


def _train(bounds, column, value, y, weight, rounds: int = ROUNDS) -> tuple[float, np.ndarray]:
    """Intercept and weights of the penalised weighted logistic loss over a sparse matrix.

    Columns in the same rows have the same value and are trained as one, whose ridge penalty is that
    of its members with equal parts of the weight.  Each round looks at the gradient of all columns
    and solves for those that matter: the ones with a weight and the ones that break the optimum most.
    It ends when no column of all breaks it by more than TOLERANCE of the first gradient.  ``column``
    is an array or ``_Packed``; it is held once, and read in blocks.
    """
    share = weight / weight.sum()
    group, members = _alike(bounds, column, len(value), _blocks(bounds))
    leader = np.zeros(len(members), np.int64)
    leader[group[::-1]] = np.arange(len(value))[::-1]
    new = np.full(len(value), -1, np.int32)
    new[leader] = np.arange(len(members))
    column = _Renumbered(bounds, column, new)
    bounds = column.bounds
    value, ridge = value[leader], RIDGE / members
    whole = _Logistic(bounds, column, value, ridge, y, share)
    entries = whole.backward(np.ones(len(y)), np.ones(len(value)))[1:]
    w, tolerance = np.zeros(len(value) + 1), None
    for _ in range(rounds):
        gradient = whole.gradient(whole.forward(w), w)
        broken = np.where(w[1:] != 0, np.abs(gradient[1:] + LASSO * np.sign(w[1:])), np.maximum(np.abs(gradient[1:]) - LASSO, 0))
        worst = max(float(broken.max(initial=0)), abs(float(gradient[0])))
        tolerance = TOLERANCE * worst if tolerance is None else tolerance
        if worst <= tolerance:
            break
        gain = broken * broken / whole.curve[1:]
        most = min(len(gain), WORKING + 2 * int(np.count_nonzero(w[1:])))
        chosen = np.zeros(len(gain), bool)
        chosen[np.argpartition(-gain, most - 1)[:most]] = True
        chosen |= w[1:] != 0
        number = np.full(len(gain), -1, np.int32)
        number[chosen] = np.arange(np.count_nonzero(chosen))
        part = _Logistic(*_restricted(bounds, column, number, int(entries[chosen].sum())), value[chosen], ridge[chosen], y, share)
        own = part.solve(np.concatenate([w[:1], w[1:][chosen]]), max(tolerance, worst / 10), STEPS)
        del part  # before all columns are looked at again
        w = np.zeros(len(value) + 1)
        w[0], w[1:][chosen] = own[0], own[1:]
    return float(w[0]), (w[1:] / members)[group]


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic") -> NgramModel:
    """A model of ``labels.<target>`` from at most SAMPLE training rows of each label.

    Without both labels it is constant: the only label, or 0 without any.
    """
    spark = docs.sparkSession
    ship(spark)
    chosen = F.broadcast(labelled_sample(labels, target, SAMPLE))
    sample = stage(docs.select("doc_id", "text").join(chosen, "doc_id").dropDuplicates(["doc_id"]), "labelled")
    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return NgramModel(np.zeros(BUCKETS), 20.0 if 1 in totals else -20.0)

    def count(batches):
        for batch in batches:
            for piece in pieces(batch, limit=PIECE_BYTES):
                label = piece.column("label").to_numpy()
                text, bucket = text_features(strings(piece.column("text")))
                both = np.bincount(bucket * 2 + label[text], minlength=2 * BUCKETS).reshape(BUCKETS, 2)
                some = np.flatnonzero(both.sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), pa.array(both[some, 0]), pa.array(both[some, 1])], names=["bucket", "other", "toxic"]
                )
        give_back()

    counted = sample.select("label", "text").mapInArrow(count, "bucket long, other long, toxic long")
    counted = counted.groupBy("bucket").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    ratio = F.log(((F.col("toxic") + 1) / (totals[1] + 2)) / ((F.col("other") + 1) / (totals[0] + 2)))
    found = counted.select("bucket", ratio.alias("ratio")).toArrow()  # at most BUCKETS rows
    known, ratios = found.column("bucket").to_numpy(), np.zeros(BUCKETS)
    ratios[known] = found.column("ratio").to_numpy()
    del found
    known = np.sort(known)
    place = np.zeros(BUCKETS, np.int32)
    place[known] = np.arange(len(known))

    def features(batches):
        for batch in batches:
            for piece in pieces(batch, limit=PIECE_BYTES):
                text, bucket = text_features(strings(piece.column("text")))
                bounds = np.searchsorted(text, np.arange(len(piece) + 1)).tolist()
                bucket = bucket.astype("<i4")
                lists = pa.array([bucket[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
                kept = [piece.column(n) for n in ("doc_id", "label", "weight")]
                yield pa.RecordBatch.from_arrays([*kept, lists], names=["doc_id", "label", "weight", "buckets"])
        give_back()

    rows = stage(
        sample.select(F.col("doc_id").cast("long").alias("doc_id"), "label", "weight", "text")
        .mapInArrow(features, "doc_id long, label int, weight double, buckets binary"),
        "features",
    )
    # At most SAMPLE rows of each label, of BUCKETS numbers each, in one array of counted size and 16
    # bits a number; they come in order of id, one of FETCHES parts at a time.
    entries = rows.agg(F.sum(F.length("buckets"))).first()[0] // 4
    column, ends, y, weight = _Packed(entries), [0], [], []
    parts = rows.repartitionByRange(FETCHES, "doc_id").sortWithinPartitions("doc_id")
    for r in parts.toLocalIterator():
        own = np.frombuffer(r["buckets"], "<i4")
        column.put(ends[-1], place[own])
        ends.append(ends[-1] + len(own))
        y.append(r["label"])
        weight.append(r["weight"])
    bounds, y, weight = np.array(ends), np.array(y, float), np.array(weight)
    column.seal()
    del place
    give_back()
    intercept, w = _train(bounds, column, ratios[known], y, weight)
    del column
    give_back()
    weights = np.zeros(BUCKETS)
    weights[known] = w * ratios[known]
    return NgramModel(weights, intercept)


def scored(docs: DataFrame, model: NgramModel, out: str = "toxicity_score") -> DataFrame:
    """``docs`` with the probability that its text is toxic; other columns may have any name."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c != out]
    schema = docs.select(*[f"`{c}`" for c in rest]).schema.add(out, "double")

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, limit=PIECE_BYTES):
                margin = shared.value.margins(strings(piece.column("text")))
                kept = [piece.column(n) for n in rest]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(1 / (1 + np.exp(-margin)))], names=[*rest, out])
        give_back()

    return docs.select(*[f"`{c}`" for c in rest]).mapInArrow(run, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of (doc_id, text).

    ``score`` is the probability of label 1; a null text scores as the empty one.  Rows of
    ``labels`` (doc_id, toxic) whose id has the remainder 0 are never learned from, and neither
    are ids without text, label or with both labels.  Texts do not move.
    """
    rows = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fit(docs, labels), "score")
    return rows.select(
        "doc_id",
        (remainder("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
