"""How the tokens of two tokenizers meet: groups, links and the documents that hold each link.

Both tokenizers see the same bytes; where tokens of both end, a group ends, and every token of
one side is linked with every token of the other side in its group.  For each pair of ids and each
slab (some thousand documents of one task) there is a posting: a compressed bitmap of the slab's documents
that hold the pair, and, for documents that hold it several times, multiplicity planes: plane
``k`` has the documents whose number of further links has the bit ``k - 1``.  Slabs are disjoint, so
document counts are sums of bit counts and link counts are sums over planes.  Counts return to
the documents along the same postings.

A text is cut before blanks that follow a letter, digit or mark: no token of either vocabulary goes
across such a place, so each distinct chunk is aligned once.
"""

from __future__ import annotations

import hashlib
import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm import chunks
from linkrank.llm.bpe import byte_characters
from linkrank.llm.shared import ship
from linkrank.llm.text import buffers, flat_ranges, pieces, segments, strings
from linkrank.operators.staging import stage

#: Chunks that a worker remembers; two generations of this size are held at most.
REMEMBERED = 100_000
#: Chunks that go to the libraries in one call: their results take much more room than ids.
JOINED = 1_000
#: Documents of a slab, at most: a place in a slab has 16 bits.
SLAB = 1 << 16
#: Bytes of text that are aligned at once, and that a slab holds.
PIECE_BYTES = 4 << 20
#: A bitmap is written out from one document in this many on, else as places of 16 bits.
DENSE = 16
#: The row of a slab that holds its documents.
DOCUMENTS = -1

POSTING = "slab long, a int, b int, plane int, docs int, dense boolean, bits binary"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_DOCS = pa.schema(
    [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
)


#: After a token's number: another token of its side and group, the other side, another group.
_SIGNS = ",|;"


def _content(table: pa.Array, ids: np.ndarray) -> bytes:
    """The bytes of tokens, one after the other."""
    return buffers(table.take(pa.array(ids)))[1].tobytes()


class Aligner:
    """Aligns chunks that begin with a blank."""

    def __init__(self, byte_level: bytes, pieces_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level.decode())
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.a_bytes = {
            i: s.encode() if s in special else bytes(byte_of[c] for c in s) for s, i in self.a.get_vocab().items()
        }
        self.b = SentencePieceProcessor()
        self.b.LoadFromSerializedProto(pieces_model)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError(f"a piece goes across a blank, so texts cannot be cut there: {piece!r}")
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_sizes = np.zeros(max(self.a_bytes) + 1, np.int64)
        for i, data in self.a_bytes.items():
            self.a_sizes[i] = len(data)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_table = pa.array([self.a_bytes.get(i, b"") for i in range(len(self.a_sizes))], pa.binary())
        self.b_table = pa.array(self.b_bytes, pa.binary())
        numbers = range(max(len(self.a_sizes), len(self.b_sizes)))
        self.texts = pa.array([f"{i}{sign}" for i in numbers for sign in _SIGNS], pa.string())
        if len(self.b_bytes) > 1 << 15 or max(self.a_bytes) >= 1 << 16:
            raise ValueError("a pair of ids does not fit in 31 bits")
        self.remembered = chunks.Remembered(self.align, REMEMBERED)

    def align(self, parts: list[str]) -> list[tuple]:
        """(facts, text of the groups, pairs, how often) of each chunk: facts are the numbers of tokens of A,
        of B, of groups and of links, the first -1 where the tokens do not give the chunk.

        Facts, pairs and numbers are 64-bit integers as bytes, which take less room than lists.
        """
        out: list = [None] * len(parts)
        plain = [i for i, p in enumerate(parts) if "!" <= p[-1] <= "~"]
        for start in range(0, len(plain), JOINED):
            own = plain[start : start + JOINED]
            for i, found in zip(own, self._joined([parts[i] for i in own]), strict=True):
                out[i] = found
        rest = [i for i, found in enumerate(out) if found is None]
        for start in range(0, len(rest), JOINED):
            own = rest[start : start + JOINED]
            first = self.a.encode_batch_fast([parts[i] for i in own], add_special_tokens=False)
            second = self.b.encode([parts[i][1:] for i in own], num_threads=1)
            for i, a, b in zip(own, first, second, strict=True):
                out[i] = self._checked(parts[i].encode(), a.ids, b)
        return out

    def _joined(self, parts: list[str]) -> list[tuple | None]:
        """The same for chunks that end in printable ASCII: no token goes from one into the next, so
        each library takes them as one text.  None for all if the tokens do not give it."""
        text = "".join(parts)
        data = text.encode()
        a = np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
        b = np.array(self.b.encode(text[1:]), np.int64)
        if _content(self.a_table, a) != data or _content(self.b_table, b) != data:
            return [None] * len(parts)
        sizes_a, sizes_b = self.a_sizes[a], self.b_sizes[b]
        lengths = list(map(len, parts)) if len(data) == len(text) else [len(p.encode()) for p in parts]
        bounds, ends_a, ends_b = np.cumsum(lengths), np.cumsum(sizes_a), np.cumsum(sizes_b)
        cut_a, cut_b = np.searchsorted(ends_a, bounds), np.searchsorted(ends_b, bounds)
        if not (sizes_a.all() and sizes_b.all() and np.array_equal(ends_a[cut_a], bounds) and np.array_equal(ends_b[cut_b], bounds)):
            return [None] * len(parts)
        return self._all_groups(a, ends_a, b, ends_b, bounds)

    def _all_groups(self, a, ends_a, b, ends_b, bounds) -> list[tuple]:
        """``_groups`` of chunks that end at ``bounds``, where tokens of both end, all at once."""
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        first_a, first_b = (np.searchsorted(g, np.arange(len(common) + 1)) for g in (group_a, group_b))
        own_a, own_b = np.diff(first_a), np.diff(first_b)
        cut = np.concatenate([[0], np.searchsorted(common, bounds) + 1])  # first group of each chunk, and the total
        chunk = segments(cut)  # of each group
        # The groups as text: a token's number and the sign after it, tokens of A before those of B in a group.
        sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        sign_a[first_a[1:] - 1], sign_b[first_b[1:] - 1] = 1, 2
        tokens = np.empty(len(a) + len(b), np.int64)
        tokens[np.arange(len(a)) + first_b[group_a]] = a * len(_SIGNS) + sign_a
        tokens[np.arange(len(b)) + first_a[group_b + 1]] = b * len(_SIGNS) + sign_b
        offsets, letters = buffers(self.texts.take(pa.array(tokens)))
        letters, at = letters.tobytes(), offsets[(first_a + first_b)[cut]].tolist()
        # All links, then those of a chunk that are the same pair as one.
        wide = own_b[group_a]
        pair = np.repeat(a << 15, wide) | b[flat_ranges(first_b[group_a], wide)]
        key, times = np.unique(np.repeat(chunk[group_a] << 31, wide) | pair, return_counts=True)
        held = (np.searchsorted(key >> 31, np.arange(len(bounds) + 1)) * 8).tolist()
        pair, times = (key & 0x7FFFFFFF).tobytes(), times.astype(np.int64).tobytes()
        links = np.concatenate([[0], np.cumsum(own_a * own_b)])[cut]
        facts = np.diff(np.stack([first_a[cut], first_b[cut], cut, links], axis=1), axis=0).tobytes()
        return [
            (facts[n : n + 32], letters[i : j - 1], pair[k:m], times[k:m])
            for n, i, j, k, m in zip(range(0, len(facts), 32), at[:-1], at[1:], held[:-1], held[1:], strict=True)
        ]

    def _checked(self, data: bytes, a: list[int], b: list[int]) -> tuple:
        first, second = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        if b"".join(first) != data or b"".join(second) != data:
            return array("q", (-1, 0, 0, 0)).tobytes(), b"", b"", b""
        return self._groups(a, [len(x) for x in first], b, [len(x) for x in second])

    def _groups(self, a: list[int], sizes_a: list[int], b: list[int], sizes_b: list[int]) -> tuple:
        groups, found, links = [], {}, 0
        i = j = from_i = from_j = ahead = 0  # bytes that A is ahead of B
        while i < len(a) or j < len(b):
            if ahead <= 0 and i < len(a):
                ahead += sizes_a[i]
                i += 1
            else:
                ahead -= sizes_b[j]
                j += 1
            if ahead:
                continue
            if i - from_i == 1 == j - from_j:
                x, y = a[from_i], b[from_j]
                groups.append(f"{x}|{y}")
                key = x << 15 | y
                found[key] = found.get(key, 0) + 1
                links += 1
            else:
                own_a, own_b = a[from_i:i], b[from_j:j]
                links += len(own_a) * len(own_b)
                groups.append(f"{','.join(map(str, own_a))}|{','.join(map(str, own_b))}")
                for x in own_a:
                    for y in own_b:
                        key = x << 15 | y
                        found[key] = found.get(key, 0) + 1
            from_i, from_j = i, j
        facts = array("q", (len(a), len(b), len(groups), links))
        return facts.tobytes(), ";".join(groups).encode(), array("q", found).tobytes(), array("q", found.values()).tobytes()


_aligners: dict[tuple, Aligner] = {}


def worker_aligner(byte_level: bytes, pieces_model: bytes) -> Aligner:
    key = hash(byte_level), hash(pieces_model)
    if key not in _aligners:
        _aligners[key] = Aligner(byte_level, pieces_model)
    return _aligners[key]


def cut(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct chunks, code of every chunk, first chunk of every text and the total) of texts that
    begin with a blank."""
    offsets, data = buffers(texts)
    padded = np.concatenate([np.zeros(2, np.uint8), data])
    space = np.flatnonzero(data == 32)
    before2, before = padded[space], padded[space + 1]
    # Certainly no white space before: printable ASCII, or a letter of two bytes.
    plain = ((before > 32) & (before < 127)) | ((before >= 128) & (before2 >= 0xC3) & (before2 < 0xE0))
    begins = np.zeros(len(data) + 1, bool)
    begins[space[plain]] = True
    begins[offsets[1:] - 1] = False  # a blank alone would look like an empty text
    begins[offsets] = True
    bounds = np.flatnonzero(begins)
    parts = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), texts.buffers()[2] or pa.py_buffer(b""))
    encoded = parts.dictionary_encode()
    return encoded.dictionary.to_pylist(), encoded.indices.to_numpy(), np.searchsorted(bounds, offsets)


def align_slab(texts: pa.Array, aligner: Aligner):
    """Per text (n_a, n_b, n_groups, n_links, digest); then (pair, text, links) sorted by pair and text."""
    n = len(texts)
    blank = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    distinct, codes, starts = cut(strings(pc.binary_join_element_wise(pa.scalar(" "), texts, "")))
    found = aligner.remembered(distinct)
    facts, fragments, pair, times = zip(*found, strict=True) if found else ((), (), (), ())
    lengths = np.array([len(x) for x in pair], np.int64) // 8
    facts, pair, times = (np.frombuffer(b"".join(x), np.int64) for x in (facts, pair, times))
    facts = facts.reshape(-1, 4)
    wrong = blank.copy()
    doc = segments(starts)
    wrong[doc[facts[codes, 0] < 0]] = True
    sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(facts[codes], axis=0)])[starts]
    totals = np.where(wrong[:, None], 0, np.diff(sums, axis=0))
    listed, bounds = codes.tolist(), starts.tolist()
    digests = [
        "" if bad else hashlib.sha256(b";".join([fragments[c] for c in listed[i:j]])).hexdigest()
        for bad, i, j in zip(wrong.tolist(), bounds[:-1], bounds[1:], strict=True)
    ]
    right = ~wrong[doc]
    held, uses = np.unique(doc[right] * max(len(distinct), 1) + codes[right], return_counts=True)
    doc, code = held // max(len(distinct), 1), held % max(len(distinct), 1)
    entry = flat_ranges((np.cumsum(lengths) - lengths)[code], lengths[code])
    known, number = np.unique(pair, return_inverse=True)
    links = times[entry] * np.repeat(uses, lengths[code])
    key = number[entry] * n + np.repeat(doc, lengths[code])
    order = np.argsort(key, kind="stable")
    key, links = key[order], links[order]
    firsts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    links = np.add.reduceat(links, firsts) if len(firsts) else links
    key = key[firsts]
    return totals, digests, known[key // n] if n else key, key % n if n else key, links


def postings(slab: int, n: int, pair: np.ndarray, doc: np.ndarray, links: np.ndarray):
    """Batches of POSTING rows for the sorted (pair, document, links) of a slab of ``n`` documents."""
    yield from _plane(slab, n, pair, doc, 0)
    further, plane = links - 1, 1
    while further.any():
        odd = further & 1 == 1
        yield from _plane(slab, n, pair[odd], doc[odd], plane)
        further, plane = further >> 1, plane + 1


def _plane(slab: int, n: int, pair: np.ndarray, doc: np.ndarray, plane: int):
    if not len(pair):
        return
    firsts = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    counts = np.diff(np.append(firsts, len(pair)))
    dense = counts * DENSE > n
    if not dense.all():
        kept = np.repeat(~dense, counts)
        bounds = np.concatenate([[0], np.cumsum(counts[~dense])]) * 2
        bits = pa.Array.from_buffers(
            pa.binary(), len(bounds) - 1,
            [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(doc[kept].astype("<u2").tobytes())],
        )
        yield _rows(slab, pair[firsts[~dense]], plane, counts[~dense], False, bits)
    if dense.any():
        packed = []
        for start, count in zip(firsts[dense].tolist(), counts[dense].tolist(), strict=True):
            held = np.zeros(n, bool)
            held[doc[start : start + count]] = True
            packed.append(np.packbits(held, bitorder="little").tobytes())
        yield _rows(slab, pair[firsts[dense]], plane, counts[dense], True, pa.array(packed, pa.binary()))


def _rows(slab: int, pair: np.ndarray, plane: int, counts: np.ndarray, dense: bool, bits: pa.Array) -> pa.RecordBatch:
    size = len(pair)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(size, slab)), pa.array((pair >> 15).astype(np.int32)), pa.array((pair & 0x7FFF).astype(np.int32)),
            pa.array(np.full(size, plane, np.int32)), pa.array(counts.astype(np.int32)), pa.array(np.full(size, dense)), bits,
        ],
        names=["slab", "a", "b", "plane", "docs", "dense", "bits"],
    )


def posting_table(docs: DataFrame, byte_level: str, pieces_model: str) -> DataFrame:
    """POSTING rows of (doc_id, text), stored; a row with a = DOCUMENTS for each slab holds its
    documents with what does not depend on others."""
    spark = docs.sparkSession
    ship(spark)
    files = []
    for path in (byte_level, pieces_model):
        with open(path, "rb") as f:
            files.append(f.read())
    content = spark.sparkContext.broadcast(tuple(files))  # files of fixed size

    def run(batches):
        slab = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, SLAB):
                for piece in pieces(batch.slice(start, SLAB), limit=PIECE_BYTES):
                    aligner = worker_aligner(*content.value)
                    totals, digests, pair, doc, links = align_slab(strings(piece.column("text")), aligner)
                    own = [piece.column("doc_id").cast(pa.int64()), *(pa.array(x) for x in totals.T), pa.array(digests, pa.string())]
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, _DOCS) as stream:
                        stream.write_batch(pa.RecordBatch.from_arrays(own, schema=_DOCS))
                    held = pa.array([sink.getvalue().to_pybytes()], pa.binary())
                    yield _rows(slab, np.array([DOCUMENTS << 15]), 0, np.array([len(piece)]), False, held)
                    yield from postings(slab, len(piece), pair, doc, links)
                    slab += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stage(rows.mapInArrow(run, POSTING), "postings")


def pair_counts(posted: DataFrame) -> DataFrame:
    """(a, b, documents, links, best): how many documents hold each pair of ids and how often they
    do in all, and whether no pair with the same ``a`` is in more documents.  Stored."""
    weight = F.when(F.col("plane") == 0, F.lit(1).cast("long")).otherwise(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.col("plane") - 1)
    )
    counted = stage(
        posted.filter(F.col("a") != DOCUMENTS)
        .groupBy("a", "b")
        .agg(
            F.sum(F.when(F.col("plane") == 0, F.col("docs"))).cast("long").alias("documents"),
            F.sum(F.col("docs") * weight).alias("links"),
        ),
        "pairs",
    )
    highest = counted.groupBy("a").agg(F.max("documents").alias("highest"))
    return stage(
        counted.join(highest, "a").select("a", "b", "documents", "links", (F.col("documents") == F.col("highest")).alias("best")),
        "pair-counts",
    )


class _Slab:
    """Sums over the documents of one slab."""

    def __init__(self, held: bytes):
        self.docs = pa.ipc.open_stream(held).read_all().combine_chunks()
        self.best = np.zeros(len(self.docs), np.int64)
        self.counts = np.zeros(len(self.docs), np.int64)

    def add(self, rows: pa.RecordBatch) -> None:
        plane, count = rows.column("plane").to_numpy(), rows.column("documents").to_numpy()
        best, dense = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("best", "dense"))
        times = np.where(plane == 0, 1, 1 << np.maximum(plane - 1, 0).astype(np.int64))
        bits = rows.column("bits")
        offsets = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset : bits.offset + len(bits) + 1].astype(np.int64)
        data = np.frombuffer(bits.buffers()[2], np.uint8)
        sparse = np.flatnonzero(~dense)
        lengths = (offsets[sparse + 1] - offsets[sparse]) // 2
        docs = data[flat_ranges(offsets[sparse], lengths * 2)].view("<u2")
        np.add.at(self.counts, docs, np.repeat((times * count)[sparse], lengths))
        np.add.at(self.best, docs, np.repeat((times * best)[sparse], lengths))
        for i in np.flatnonzero(dense).tolist():
            held = np.unpackbits(data[offsets[i] : offsets[i + 1]], count=len(self.docs), bitorder="little").astype(bool)
            self.counts[held] += times[i] * count[i]
            if best[i]:
                self.best[held] += times[i]

    def rows(self) -> pa.RecordBatch:
        columns = {n: self.docs.column(n).chunk(0) for n in _DOCS.names}
        columns |= {"n_best": pa.array(self.best), "count_sum": pa.array(self.counts)}
        names = [x.split()[0] for x in RESULT.split(", ")]
        return pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)


def scores(posted: DataFrame, counts: DataFrame) -> DataFrame:
    """RESULT rows: the counts of the pairs return to the documents along the postings.

    Postings meet the counts by pair, then those of a slab meet each other: a task holds one slab.
    """

    def run(batches):
        current, open_slab = None, None
        for batch in batches:
            slabs = batch.column("slab").to_numpy()
            bounds = np.flatnonzero(np.concatenate([[True], slabs[1:] != slabs[:-1], [True]])) if len(slabs) else []
            for i, j in zip(bounds[:-1], bounds[1:], strict=True):
                part = batch.slice(i, j - i)
                if slabs[i] != current:
                    if open_slab is not None:
                        yield open_slab.rows()
                    current, open_slab = slabs[i], _Slab(part.column("bits")[0].as_py())
                    part = part.slice(1)
                if part.num_rows:
                    open_slab.add(part)
        if open_slab is not None:
            yield open_slab.rows()

    # Small counts would be broadcast; shuffled at every size, disk grows as the postings do.
    linked = posted.filter(F.col("a") != DOCUMENTS).join(counts.drop("links").hint("merge"), ["a", "b"])
    columns = ["slab", "a", "plane", "dense", "bits", "documents", "best"]
    held = posted.filter(F.col("a") == DOCUMENTS).withColumns({"documents": F.lit(0).cast("long"), "best": F.lit(False)})
    by_slab = linked.select(columns).unionByName(held.select(columns)).repartition("slab").sortWithinPartitions("slab", "a")
    return by_slab.mapInArrow(run, RESULT)


def aligned(docs: DataFrame, byte_level: str, pieces_model: str) -> DataFrame:
    """RESULT rows, one for each row of (doc_id, text).

    Null and empty texts, and texts that either tokenizer does not give back, have no tokens: zeros
    and an empty digest.  Rows that repeat an id are documents of their own; a null doc_id stays.
    An empty table gives no rows.  Other columns are not read.
    """
    posted = posting_table(docs, byte_level, pieces_model)
    return scores(posted, pair_counts(posted))
