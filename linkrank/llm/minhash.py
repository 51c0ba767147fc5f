"""Near-duplicates by an inverted join of MinHash signature coordinates.

1. Every document becomes its set of word shingles; equal sets form a class, and only classes
   go on.
2. A class is posted under its first ``POSTED`` (coordinate, value) pairs.  Two sets with the
   asked similarity share at least ``COLLISIONS`` of them but for a chance of about 1e-8, so
   pairs that nobody shares are dropped, classes with fewer shared ones than that have no
   partner, and of the rest only the rarest are joined: a prefix that is too long to miss
   ``COLLISIONS`` common entries.  Values of common passages are frequent and stay outside.
3. Members of a posting list skip straight to the full signature: collisions are counted over
   all coordinates and pairs below ``MATCHES`` are dropped (again a chance of about 1e-8).
4. Pairs that remain are confirmed on the full sets, in the task where they meet: the sets of
   posted classes lie in flat files of the shared folder, and a list's entries say where.  So
   only links leave a task, never candidates.

A group of n near copies has n^2 links, which are not needed to know its members.  So in a
first round each member meets one member drawn from each of its lists, and components are
formed; in the second round only pairs of different components are counted and confirmed, and
one link for each pair of components is kept.  No link between components is lost.  A long list
is dealt out in blocks, and pairs of blocks meet in separate tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.llm.components import components
from linkrank.llm.shared import bitmap, file_system, give_back, in_bitmap, ship
from linkrank.llm.text import hashes, mix, pieces, strings, windows, words
from linkrank.operators.staging import scratch_path, stage

SHINGLE = 5
#: Similarity: 100 * intersection >= PERCENT * union.
PERCENT = 75
COORDINATES = 128
POSTED = 32
COLLISIONS = 10
MATCHES = 66
#: Classes of a posting list that meet in one task.
BLOCK = 256
#: Bytes of sets that a task holds at a time, besides those of the pair at hand.
HELD_BYTES = 64 << 20
#: Columns of the matrix by which many pairs are confirmed at once.
COLUMNS = 8192
#: Bits of the filter of documents whose sets are needed again: fixed, a megabyte.
FILTER_BITS = 1 << 23
SEED = 20

_SETS = 8192
#: Fingerprints that a task remembers, to write repeated sets once.
_KNOWN = 200_000


def _factors() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.Generator(np.random.PCG64(SEED))
    a = draw.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, draw.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def signature(shingles: np.ndarray) -> bytes:
    """The smallest value under each hash: 32 bits of the posted coordinates, then the low 16
    of the others, which are only compared."""
    a, b = _factors()
    least = np.full(COORDINATES, 0xFFFFFFFF, dtype=np.uint64)
    for i in range(0, len(shingles), _SETS):
        values = (shingles[i : i + _SETS, None] * a + b) >> np.uint64(32)
        np.minimum(least, values.min(axis=0), out=least)
    return least[:POSTED].astype("<u4").tobytes() + least[POSTED:].astype("<u2").tobytes()


def shingle_sets(texts: pa.Array, size: int = SHINGLE):
    """The sorted distinct shingle hashes of each text.

    Words are the runs between ASCII blanks in lower case (A-Z).  A text with fewer than
    ``size`` words but any is one shingle, its whole sequence.
    """
    distinct, codes, starts = words(texts)
    own = hashes(distinct)[codes]
    hashed = windows(own, size)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(hashed[a : b - size + 1])
        elif b > a:
            yield mix(windows(own[a:b], b - a) + np.uint64(b - a))
        else:
            yield hashed[:0]


def fingerprint(shingles: np.ndarray) -> bytes | None:
    """128 bits that tell sets apart; none for the empty set, which equals nothing."""
    if not len(shingles):
        return None
    return hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=16).digest()


def described(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, fp, sig) of each row of (doc_id, text)."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                counts, prints, sigs = [], [], []
                known: dict[bytes, bytes] = {}
                for shingles in shingle_sets(strings(piece.column("text")), size):
                    fp = fingerprint(shingles)
                    if fp is not None and fp not in known:
                        known[fp] = signature(shingles)
                    counts.append(len(shingles))
                    prints.append(fp)
                    sigs.append(known.get(fp))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id").cast(pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(prints, pa.binary()),
                        pa.array(sigs, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "fp", "sig"],
                )
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, fp binary, sig binary")


def _coordinate(i: int) -> Column:
    return F.xxhash64(F.lit(i), F.substring("sig", 4 * i + 1, 4))


def prefixes(classes: DataFrame) -> DataFrame:
    """(token, i, n, fp, mask): the rare shared coordinates under which each class is joined.

    ``n`` is the length of the token's list, ``mask`` has the bits of the class's tokens.
    """
    posted = classes.select(
        "fp", F.posexplode(F.array(*[_coordinate(i) for i in range(POSTED)])).alias("i", "token")
    )
    shared = posted.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    entries = posted.join(shared, "token").groupBy("fp").agg(
        F.sort_array(F.collect_list(F.struct("n", "token", "i"))).alias("own")
    )
    rare = entries.filter(F.size("own") >= COLLISIONS).select(
        "fp", F.expr(f"slice(own, 1, size(own) - {COLLISIONS - 1})").alias("own")
    )
    bits = F.expr("aggregate(own, 0L, (x, y) -> x | shiftleft(1L, y.i))")
    return rare.select("fp", bits.alias("mask"), F.explode("own").alias("e")).select(
        "e.token", "e.i", "e.n", "fp", "mask"
    )


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _coordinates(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The posted coordinates of each row's signature, and the others."""
    joined = b"".join(batch.column(batch.schema.get_field_index("sig")).to_pylist())
    matrix = np.frombuffer(joined, np.uint8).reshape(len(batch), -1)
    return (
        np.ascontiguousarray(matrix[:, : 4 * POSTED]).view("<u4"),
        np.ascontiguousarray(matrix[:, 4 * POSTED :]).view("<u2"),
    )


def _groups(batches):
    """Batches that hold whole groups; rows of a group (column ``g``) follow each other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        groups = batch.column(batch.schema.get_field_index("g")).to_numpy()
        if held:
            last = held[-1].column(held[-1].schema.get_field_index("g"))[-1].as_py()
            if groups[0] != last:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
        cut = int(np.flatnonzero(groups == groups[-1])[0])
        if cut and held:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks().to_batches()[0]
            held = []
        elif cut:
            yield batch.slice(0, cut)
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _matches(parts, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), dtype=np.int64)
    for i in range(0, len(x), _SETS):
        for part in parts:
            out[i : i + _SETS] += (part[x[i : i + _SETS]] == part[y[i : i + _SETS]]).sum(axis=1)
    return out


class _Sets:
    """The full sets of a batch's rows, read where ``file``, ``first`` and ``size`` say."""

    def __init__(self, folder: str):
        self.folder = folder
        self.files: dict[str, np.ndarray] = {}
        self.held: dict[tuple[str, int], np.ndarray] = {}
        self.bytes = 0

    def __call__(self, name: str, first: int, size: int) -> np.ndarray:
        key = name, first
        if key not in self.held:
            if self.bytes > HELD_BYTES:
                self.held.clear()
                self.bytes = 0
            self.held[key] = self._read(name, first, size)
            self.bytes += 8 * size
        return self.held[key]

    def forget(self) -> None:
        """Let go of sets and mapped files, which count while a worker waits for other stages."""
        self.files, self.held, self.bytes = {}, {}, 0

    def _read(self, name: str, first: int, size: int) -> np.ndarray:
        store, path = file_system(f"{self.folder}/{name}")
        if store.type_name != "local":
            with store.open_input_file(path) as f:
                return np.frombuffer(f.read_at(8 * size, 8 * first), "<u8")
        if name not in self.files:
            self.files[name] = np.memmap(path, dtype="<u8", mode="r")
        return np.array(self.files[name][first : first + size])


def _common(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The sizes of the intersections of pairs of sets."""
    if not len(x):
        return np.zeros(0, np.int64)
    if len(x) < 4 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(x, y, strict=True)], np.int64)
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(codes, kind="stable")
    codes, row = codes[order], row[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, len(values), COLUMNS):
        a, b = np.searchsorted(codes, (start, start + COLUMNS))
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[row[a:b], codes[a:b] - start] = 1
        shared += part @ part.T
    return shared[x, y].astype(np.int64)


def _confirmed(batch: pa.RecordBatch, read: _Sets, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of rows have sets that are similar enough."""
    names, firsts, sizes = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("file", "first", "size"))
    length = np.array(sizes, np.int64)
    good = 100 * np.minimum(length[x], length[y]) >= percent * np.maximum(length[x], length[y])
    rows, inverse = np.unique(np.concatenate([x[good], y[good]]), return_inverse=True)
    sets = [read(names[i], firsts[i], sizes[i]) for i in rows.tolist()]
    half = len(inverse) // 2
    common = _common(sets, inverse[:half], inverse[half:])
    out = good.copy()
    out[good] = 100 * common >= percent * (length[x[good]] + length[y[good]] - common)
    return out


def _links(batch, x, y) -> pa.RecordBatch:
    prints = batch.column(batch.schema.get_field_index("fp"))
    return pa.RecordBatch.from_arrays([prints.take(pa.array(x)), prints.take(pa.array(y))], names=["a", "b"])


_LINK = "a binary, b binary"


def _with_leaders(batches, read: _Sets, percent: int):
    """The links of every member of a group with the first of the group."""
    for batch in _groups(batches):
        parts = _coordinates(batch)
        groups = _column(batch, "g")
        first = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
        leader = np.repeat(first, np.diff([*first, len(groups)]))
        member = np.flatnonzero(leader != np.arange(len(groups)))
        member = member[_matches(parts, member, leader[member]) >= MATCHES]
        member = member[_confirmed(batch, read, member, leader[member], percent)]
        yield _links(batch, member, leader[member])
    read.forget()
    give_back()


def _across(batches, read: _Sets, percent: int):
    """Links within a group between rows of different components (and blocks, if two meet), one
    for each pair of components."""
    for batch in _groups(batches):
        parts = _coordinates(batch)
        groups, comps, blocks, two, masks, coordinate = (
            _column(batch, name) for name in ("g", "component", "block", "two", "mask", "i")
        )
        starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
        for start, stop in zip(starts, [*starts[1:], len(groups)], strict=True):
            found = []
            for step in range(1, stop - start):
                x = np.arange(start, stop - step)
                y = x + step
                wanted = (comps[x] != comps[y]) & (~two[x] | (blocks[x] != blocks[y]))
                x, y = x[wanted], y[wanted]
                if not len(x):
                    continue
                # A pair that meets in several lists is looked at in the first of them only.
                equal = parts[0][x] == parts[0][y]
                equal &= ((masks[x] & masks[y])[:, None] >> np.arange(POSTED)) & 1 == 1
                here = equal.argmax(axis=1) == coordinate[x]
                x, y = x[here], y[here]
                good = _matches(parts, x, y) >= MATCHES
                found.append((x[good], y[good]))
            if not found:
                continue
            x, y = (np.concatenate(side) for side in zip(*found, strict=True))
            good = _confirmed(batch, read, x, y, percent) if len(x) else np.zeros(0, bool)
            x, y = x[good], y[good]
            ends = np.sort(np.stack([comps[x], comps[y]], axis=1), axis=1)
            _, once = np.unique(ends, axis=0, return_index=True)
            yield _links(batch, x[once], y[once])
    read.forget()
    give_back()


def stored_sets(docs: DataFrame, needed: DataFrame, folder: str) -> DataFrame:
    """Write the full sets of the classes in ``needed`` (fp, rep) below ``folder``; returns
    (fp, file, first, size): where each lies, in 64-bit numbers.

    The sets are made again from the texts.  A bitmap of fixed size keeps other texts from being
    cut into shingles.  File names carry the task attempt, and the rows of committed attempts
    alone are read.
    """
    spark = docs.sparkSession
    slot = F.pmod(F.xxhash64("rep"), F.lit(FILTER_BITS))
    wanted = spark.sparkContext.broadcast(bitmap(needed.select(slot.alias("slot")), FILTER_BITS))

    def write(batches):
        task = TaskContext.get()
        name = f"sets-{task.partitionId():06d}-{task.taskAttemptId()}"
        store, root = file_system(folder)
        out, place, known = None, 0, set()
        for batch in batches:
            hit = in_bitmap(wanted.value, batch.column(1).to_numpy())
            for piece in pieces(batch.filter(pa.array(hit))):
                rows = []
                for shingles in shingle_sets(strings(piece.column("text"))):
                    fp = fingerprint(shingles)
                    if fp is None or fp in known:
                        continue
                    if len(known) < _KNOWN:
                        known.add(fp)
                    if out is None:
                        store.create_dir(root, recursive=True)
                        out = store.open_output_stream(f"{root}/{name}")
                    out.write(shingles.astype("<u8").tobytes())
                    rows.append((fp, place, len(shingles)))
                    place += len(shingles)
                prints, firsts, sizes = zip(*rows, strict=True) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prints, pa.binary()), pa.array([name] * len(rows), pa.string()),
                     pa.array(firsts, pa.int64()), pa.array(sizes, pa.int64())],
                    names=["fp", "file", "first", "size"],
                )
        if out is not None:
            out.close()
        give_back()

    own_slot = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(FILTER_BITS))
    rows = docs.select("text", own_slot.alias("slot")).mapInArrow(write, "fp binary, file string, first long, size long")
    # Any document with the fingerprint has the set.
    rows = stage(rows, "sets").groupBy("fp").agg(F.min(F.struct("file", "first", "size")).alias("at"))
    return rows.select("fp", "at.file", "at.first", "at.size")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, fp) of each row of (doc_id, text).

    Documents whose sets have 100 * intersection >= percent * union are linked;
    ``component_id`` is the smallest doc_id that a document can reach and ``kept`` says that it
    is its own.  A null or empty text has no shingles and is linked with nothing.  Rows with
    equal ids are documents of their own; if they are alike and hold the smallest id, all are
    kept.  A null doc_id counts as larger than any and stays null if it is alone.  ``fp`` tells
    sets apart (null for empty ones).  MATCHES and COLLISIONS suit similarities of 0.75 or more.
    """
    if percent < PERCENT:
        raise ValueError("the match thresholds are set for a similarity of 0.75 or more")
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    all_docs = stage(described(docs), "described")
    classes = stage(
        all_docs.filter("fp IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")),
        "classes",
    )
    postings = stage(prefixes(classes), "postings")
    posted = stage(postings.select("fp").distinct().join(classes, "fp"), "posted")
    folder = scratch_path(spark, "set-files")
    signatures = stage(stored_sets(docs, posted, folder).join(posted.select("fp", "sig"), "fp"), "signatures")

    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("fp"), blocks.cast("long")).cast("int")
    dealt = (
        postings.join(signatures, "fp")
        .withColumn("block", block)
        .withColumn("g", F.xxhash64("token", "block"))
        .repartition("g")
        .sortWithinPartitions("g", "token", F.xxhash64("fp", "token"))
    )
    ship(spark)
    led = dealt.select("g", "fp", "sig", "file", "first", "size").mapInArrow(
        lambda batches: _with_leaders(batches, _Sets(folder), percent), _LINK
    )
    first_links = stage(led.distinct(), "first-links")
    first = components(first_links)

    grouped = postings.join(first.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.xxhash64(F.coalesce("root", "fp"))
    )
    grouped = stage(grouped.drop("root"), "grouped")
    mixed = (
        grouped.groupBy("token")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"))
        .filter("least <> most")
        .select("token")
    )
    met = (
        grouped.join(mixed, "token", "left_semi")
        .join(signatures, "fp")
        .withColumn("blocks", blocks)
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("two", F.col("other") != F.col("block"))
        .withColumn("g", F.xxhash64("token", F.least("block", "other"), F.greatest("block", "other")))
        .repartition("g")
        .sortWithinPartitions("g", "token", "fp")
    )
    across = met.select(
        "g", "fp", "sig", "mask", "i", "component", "block", "two", "file", "first", "size"
    ).mapInArrow(lambda batches: _across(batches, _Sets(folder), percent), _LINK)
    found = components(first_links.unionByName(across))

    members = found.join(classes.select(F.col("fp").alias("node"), "rep"), "node")
    smallest = members.groupBy("root").agg(F.min("rep").alias("component"))
    of_linked = found.join(smallest, "root").select(F.col("node").alias("fp"), "component")
    of_class = classes.select("fp", "rep").join(of_linked, "fp", "left").select(
        "fp", F.coalesce("component", "rep").alias("component")
    )
    return (
        all_docs.select("doc_id", "n_shingles", "fp")
        .join(of_class, "fp", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
            "fp",
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", "kept", "fp")
    )
