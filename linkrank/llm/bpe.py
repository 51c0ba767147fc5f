"""Byte-level BPE: encoding with a priority queue of merge ranks, and decoding.

A part of the text starts as a doubly linked list with one symbol for each byte.  The queue
holds the rank and the place of every pair that has a merge; the lowest rank is applied, its
neighbours are linked past the merged symbol and the two new pairs are queued.  Entries whose
pair has changed meanwhile are stale and skipped when they come up.  Decoding concatenates
the vocabulary's strings and maps their characters back to bytes.
"""

from __future__ import annotations

import hashlib
import json
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

from linkrank.llm import chunks
from linkrank.llm.shared import give_back, ship
from linkrank.llm.text import PIECE_BYTES, buffers, flat_ranges, pieces, strings

#: Fixed value: the pattern that this vocabulary's texts are cut by before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Texts whose ids are lists at one time, before they become arrays.
JOINED = 5_000
#: Bytes of text that are encoded and decoded at once where both are done.
CHECKED_BYTES = 1 << 20
#: Parts of texts that a worker remembers in a stage between others, beside whose memory they count.
REMEMBERED = 50_000

#: An entry of the queue is rank << _SHIFT | place.
_SHIFT = 40
_PLACE = (1 << _SHIFT) - 1


def byte_characters() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself if it is printable,
    else the next one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(hidden)) for b in range(256)]


class Bpe:
    """An encoder from the text of a tokenizer file; see the module."""

    def __init__(self, tokenizer_json: str, remembered: int = chunks.REMEMBERED):
        described = json.loads(tokenizer_json)
        vocabulary, merges = described["model"]["vocab"], described["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        characters = byte_characters()
        to_byte = {c: b for b, c in enumerate(characters)}
        self.strings = {i: bytes(map(to_byte.__getitem__, s)) for s, i in vocabulary.items()}
        self.strings.update((i, s.encode()) for s, i in self.special.items())
        self.of_byte = [vocabulary[c] for c in characters]
        self.rank_of: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank_of.setdefault((vocabulary[left], vocabulary[right]), rank)
            self.merged.append(vocabulary[left + right])
        self.parts = regex.compile(PATTERN).findall
        self.cut_special = (
            regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split
            if self.special
            else lambda text: [text]
        )
        self.flat = None
        self.words = chunks.Remembered(lambda parts: [tuple(self.merge(p.encode())) for p in parts], remembered)

    def merge(self, part: bytes) -> list[int]:
        symbols = [self.of_byte[b] for b in part]
        n = len(symbols)
        if n < 2:
            return symbols
        rank_of, merged = self.rank_of.get, self.merged
        # The rank of the pair that begins at each place now: entries of the queue that differ
        # from it are stale.
        current = [*map(rank_of, zip(symbols, symbols[1:])), None]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [rank << _SHIFT | i for i, rank in enumerate(current) if rank is not None]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            rank, i = entry >> _SHIFT, entry & _PLACE
            if current[i] != rank:
                continue
            j = after[i]
            symbol = symbols[i] = merged[rank]
            symbols[j], current[j] = -1, None
            k = after[i] = after[j]
            rank = None
            if k < n:
                before[k] = i
                rank = rank_of((symbol, symbols[k]))
                if rank is not None:
                    heappush(queue, rank << _SHIFT | i)
            current[i] = rank
            h = before[i]
            if h >= 0:
                rank = current[h] = rank_of((symbols[h], symbol))
                if rank is not None:
                    heappush(queue, rank << _SHIFT | h)
        return [s for s in symbols if s >= 0]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text; strings of special tokens become their ids."""
        cut = []
        for text in texts:
            parts: list = []
            for piece in self.cut_special(text):
                if piece in self.special:
                    parts.append(self.special[piece])
                elif piece:
                    parts += self.parts(piece)
            cut.append(parts)
        plain = list(dict.fromkeys(p for parts in cut for p in parts if isinstance(p, str)))
        ids = dict(zip(plain, self.words(plain), strict=True))
        out = []
        for parts in cut:
            own: list[int] = []
            for p in parts:
                own += ids[p] if isinstance(p, str) else (p,)
            out.append(own)
        return out

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, how many each text has)."""
        flat, lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for start in range(0, len(texts), JOINED):
            ids = self.encode_all(texts[start : start + JOINED])
            lengths.append(np.array([len(x) for x in ids], np.int64))
            flat.append(np.fromiter((i for x in ids for i in x), np.int32, int(lengths[-1].sum())))
        return np.concatenate(flat), np.concatenate(lengths)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        """The vocabulary's bytes of the ids, one after the other."""
        if self.flat is None:
            known = [self.strings.get(i, b"") for i in range(max(self.strings) + 1)]
            lengths = np.array([len(x) for x in known], np.int64)
            self.flat = np.frombuffer(b"".join(known), np.uint8), np.cumsum(lengths) - lengths, lengths
        data, firsts, lengths = self.flat
        return data[flat_ranges(firsts[ids], lengths[ids])]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.strings.__getitem__, ids))

    def decode(self, ids) -> str:
        """The text of the ids; bytes that are not UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


_encoders: dict[int, tuple] = {}


def worker_encoder(tokenizer_json: bytes) -> tuple[Bpe, chunks.Remembered]:
    """The encoder of this Python worker, with what it remembers of earlier tasks."""
    key = hash(tokenizer_json)
    if key not in _encoders:
        bpe = Bpe(tokenizer_json.decode())

        def encode(new: list[str]) -> list[tuple[int, bytes, bytes]]:
            return [
                (len(ids), ",".join(map(str, ids)).encode(), bpe.decode_bytes(ids))
                for ids in bpe.encode_all(new)
            ]

        _encoders[key] = bpe, chunks.Remembered(encode)
    return _encoders[key]


def _file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _confirm(bpe: Bpe, texts: pa.Array, ids: np.ndarray, bounds: np.ndarray, names: pa.Array) -> None:
    """Raise an error if the decoded ids are not the texts."""
    offsets, data = buffers(texts)
    if np.array_equal(bpe.bytes_of(ids), data[offsets[0] :]):
        return
    for i, name in enumerate(names):
        if not np.array_equal(bpe.bytes_of(ids[bounds[i] : bounds[i + 1]]), data[offsets[i] : offsets[i + 1]]):
            raise ValueError(f"ids do not give the text of doc_id {name.as_py()}")


def encode_table(
    docs: DataFrame, tokenizer: str, text_col: str = "text", out: str = "ids", check: bool = False
) -> DataFrame:
    """``docs`` with a column of token ids (array of int) of the whole text.

    A null text counts as empty and has no tokens.  Other columns, whatever their names, are
    kept; a column named ``out`` is replaced.  ``tokenizer`` is the path of a tokenizer file
    on the driver; its content (a fixed size) goes to the executors with the task.  With ``check``
    the ids are decoded again where they are made, and the job ends if they do not give the text
    (rows are named by ``doc_id``).  An empty table gives no rows, repeated rows give a row each.
    """
    spark = docs.sparkSession
    ship(spark)
    content = spark.sparkContext.broadcast(_file(tokenizer))
    rest = [c for c in docs.columns if c != out]
    schema = docs.select(*[f"`{c}`" for c in rest]).schema.add(out, ArrayType(IntegerType()))

    def encoded(bpe, piece):
        texts = strings(piece.column(text_col))
        chunked, codes, starts = chunks.distinct(texts)
        flat, lengths = bpe.encode_flat(chunked)
        values, bounds = chunks.assemble(flat, lengths, codes, starts)
        if check:
            _confirm(bpe, texts, values, bounds, piece.column("doc_id"))
        column = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))
        kept = [piece.column(piece.schema.get_field_index(c)) for c in rest]
        return pa.RecordBatch.from_arrays([*kept, column], names=[*rest, out])

    def encode(batches):
        bpe = Bpe(content.value.decode(), REMEMBERED)
        for batch in batches:
            for piece in pieces(batch, text_col, CHECKED_BYTES if check else PIECE_BYTES):
                yield encoded(bpe, piece)
        # What is remembered ends with the task: stages that follow use the same workers.
        bpe = batch = piece = None
        give_back()

    return docs.select(*[f"`{c}`" for c in docs.columns]).mapInArrow(encode, schema)


def decode_table(encoded: DataFrame, tokenizer: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its token ids; null ids give the empty text."""
    spark = encoded.sparkSession
    ship(spark)
    content = spark.sparkContext.broadcast(_file(tokenizer))
    rest = [c for c in encoded.columns if c != out]
    schema = encoded.select(*[f"`{c}`" for c in rest]).schema.add(out, "string")

    def decode(batches):
        bpe, _ = worker_encoder(content.value)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col))
            texts = pa.array([bpe.decode(x.as_py() or ()) for x in ids], pa.string())
            kept = [batch.column(batch.schema.get_field_index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays([*kept, texts], names=[*rest, out])

    return encoded.mapInArrow(decode, schema)


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row of (doc_id, text).

    Ids of a text are digested as decimal numbers joined by commas; the decoded text is
    concatenated from the vocabulary strings of those ids and digested in UTF-8.  A null
    text counts as empty, repeated rows give a row each, a null doc_id stays null, and an
    empty table gives no rows.  Rows do not move: there is no shuffle.
    """
    spark = docs.sparkSession
    ship(spark)
    content = spark.sparkContext.broadcast(_file(tokenizer))

    def run(batches):
        bpe, remembered = worker_encoder(content.value)
        marks = chunks.marks_beside(bpe.special)
        for batch in batches:
            for piece in pieces(batch):
                chunked, codes, starts = chunks.distinct(strings(piece.column("text")), marks)
                found = remembered(chunked)
                counts = np.array([x[0] for x in found] or [0], dtype=np.int64)[codes]
                totals = np.concatenate([[0], np.cumsum(counts)])[starts]
                decimal, decoded = [x[1] for x in found], [x[2] for x in found]
                listed = codes.tolist()
                ids_sha, text_sha = [], []
                for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    own = listed[a:b]
                    ids_sha.append(hashlib.sha256(b",".join([decimal[c] for c in own])).hexdigest())
                    text = b"".join([decoded[c] for c in own]).decode("utf-8", "replace")
                    text_sha.append(hashlib.sha256(text.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").cast(pa.int64()), pa.array(np.diff(totals)), pa.array(ids_sha), pa.array(text_sha)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
