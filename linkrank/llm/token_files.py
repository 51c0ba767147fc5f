"""Token ids of a corpus as flat binary files, and their reader.

A shard is three files of little-endian numbers without headers, written by one task from
one range of document ids in ascending order:

``<shard>.bin``  all ids, unsigned 16 bits if the vocabulary fits, else 32
``<shard>.idx``  unsigned 64 bits: where each document begins within the shard, and the end
``<shard>.doc``  signed 64 bits: the document ids (rows without id come first and are counted
                 in the manifest)

The manifest has a row for each shard: its files, counts, and its base, the number of ids in
all shards before it, from a prefix sum over shards.  File names carry the task attempt, and
only attempts that Spark committed reach the manifest, so a lost executor or a repeated task
leaves no trace in what is read.  Readers map the files into memory and touch only the pages
that they need.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkrank.llm import chunks
from linkrank.llm.shared import file_system, ship
from linkrank.llm.text import pieces, strings
from linkrank.operators.staging import scratch_path, write_and_read

END_ID = 0
#: Chunks that go to the library in one call.
JOINED = 1_000
#: Chunks that a worker remembers, see ``chunks.Remembered``.
REMEMBERED = 400_000

#: Bytes of ids for each task that reads them back.
READ_BYTES = 8 << 20

SHARD = "shard int, path string, width int, docs long, null_ids long, tokens long"


def number_type(width: int) -> np.dtype:
    return np.dtype("<u2" if width == 2 else "<u4")


_libraries: dict[int, tuple] = {}


def worker_tokenizer(content: bytes):
    """(encoder of chunks by the tokenizers library, bytes of an id), one for each worker."""
    key = hash(content)
    if key not in _libraries:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(content.decode())
        tokenizer.no_truncation()
        tokenizer.no_padding()
        width = 2 if tokenizer.get_vocab_size() <= 1 << 16 else 4
        added = tokenizer.get_added_tokens_decoder()
        special = {i: t.content for i, t in added.items() if t.special}
        mark, between = next(iter(special.items()), (None, None))
        # A string of this vocabulary has a character for each byte.
        n_bytes = np.zeros(tokenizer.get_vocab_size(), np.int64)
        for string, i in tokenizer.get_vocab().items():
            n_bytes[i] = len(string)

        def ids_of(text: str) -> np.ndarray:
            return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, number_type(width))

        def each(parts: list[str]) -> list[bytes]:
            found = tokenizer.encode_batch_fast(parts, add_special_tokens=False)
            return [np.array(x.ids, number_type(width)).tobytes() for x in found]

        def marked(parts: list[str]) -> list[bytes]:
            """A special token cuts a text for certain: parts joined by it cost one call."""
            if between is None:
                return each(parts)
            text = between.join(parts)
            if text.count(between) != len(parts) - 1 or "" in parts:
                return each(parts)
            ids = ids_of(text)
            cuts = np.flatnonzero(ids == mark).tolist()
            starts, stops = [0, *(c + 1 for c in cuts)], [*cuts, len(ids)]
            return [ids[a:b].tobytes() for a, b in zip(starts, stops, strict=True)]

        def joined(parts: list[str]) -> list[bytes]:
            """Parts that begin with a blank and a sign: their tokens end where they end."""
            text = "".join(parts)
            if any(t.content in text for t in added.values()):
                return each(parts)
            ids = ids_of(text)
            ends, wanted = np.cumsum(n_bytes[ids]), np.cumsum(pc.binary_length(pa.array(parts)).to_numpy())
            stops = np.searchsorted(ends, wanted, side="right")
            if ends[-1] != wanted[-1] or not np.array_equal(ends[stops - 1], wanted):
                return marked(parts)
            raw, stops = ids.tobytes(), (stops * width).tolist()
            return [raw[a:b] for a, b in zip([0, *stops], stops)]

        def in_runs(parts: list[str], run) -> Iterator[bytes]:
            return chain.from_iterable(run(parts[i : i + JOINED]) for i in range(0, len(parts), JOINED))

        def encode(parts: list[str]) -> list[bytes]:
            # The blanks that ``chunks.cut`` cuts before, whatever stands before them.
            plain = [" !" <= p < " \x7f" or " \xc0" <= p < " \u0800" for p in parts]
            some = in_runs([p for p, x in zip(parts, plain, strict=True) if x], joined)
            rest = in_runs([p for p, x in zip(parts, plain, strict=True) if not x], marked)
            return [next(some) if x else next(rest) for x in plain]

        _libraries[key] = chunks.Remembered(encode, REMEMBERED), width
    return _libraries[key]


class _Shard:
    """The open files of one task attempt."""

    def __init__(self, folder: str, name: str):
        self.store, root = file_system(folder)
        self.store.create_dir(root, recursive=True)
        self.path = f"{folder}/{name}"
        self.files = {k: self.store.open_output_stream(f"{root}/{name}.{k}") for k in ("bin", "idx", "doc")}
        self.docs = self.nulls = self.tokens = 0

    def add(self, ids: np.ndarray, firsts: np.ndarray, doc_ids: pa.Array, total: int) -> None:
        self.files["bin"].write(pa.py_buffer(ids))
        self.files["idx"].write((firsts + self.tokens).astype("<u8").tobytes())
        known = doc_ids.drop_null()
        self.files["doc"].write(known.to_numpy().astype("<i8").tobytes())
        self.docs += len(doc_ids)
        self.nulls += len(doc_ids) - len(known)
        self.tokens += total

    def close(self) -> None:
        self.files["idx"].write(np.array([self.tokens], "<u8").tobytes())
        for f in self.files.values():
            f.close()


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Write (doc_id, text) as shards below ``folder`` and return the manifest, sorted by shard.

    Documents are in ascending doc_id order over all shards (rows without id first, rows with
    equal ids in the order of their texts), each followed by ``end_id``.  A null text counts
    as empty.  An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer, "rb") as f:
        described = f.read()
    content = spark.sparkContext.broadcast(described)
    marks = chunks.marks_beside(t["content"] for t in json.loads(described).get("added_tokens", ()))

    def write(batches):
        task = TaskContext.get()
        number = task.partitionId()
        shard = None
        for batch in batches:
            remembered, width = worker_tokenizer(content.value)
            kind = number_type(width)
            if shard is None:
                shard = _Shard(folder, f"shard-{number:06d}-{task.taskAttemptId()}")
            for piece in pieces(batch):
                chunked, codes, starts = chunks.distinct(strings(piece.column("text")), marks)
                found = remembered(chunked)
                lengths = np.array([len(x) for x in found], dtype=np.int64) // width
                # The end of a text is one more chunk, of one id.
                codes = np.insert(codes, starts[1:], len(found))
                starts = starts + np.arange(len(starts))
                flat = np.frombuffer(b"".join([*found, kind.type(end_id).tobytes()]), kind)
                ids, bounds = chunks.assemble(flat, np.append(lengths, 1), codes, starts)
                shard.add(ids, bounds[:-1], piece.column("doc_id").cast(pa.int64()), len(ids))
        if shard is not None:
            shard.close()
            row = [number, shard.path, width, shard.docs, shard.nulls, shard.tokens]
            names = ["shard", "path", "width", "docs", "null_ids", "tokens"]
            kinds = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names
            )

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    shards = write_and_read(ordered.mapInArrow(write, SHARD), f"{folder}/shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each shard: the only window without a key, over the manifest alone.
    bases = shards.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    return write_and_read(bases, f"{folder}/manifest")


def _numbers(path: str, kind: np.dtype, count: int) -> np.ndarray:
    """The file's numbers, mapped into memory if the store is a mounted folder."""
    if not count:
        return np.zeros(0, kind)
    store, inner = file_system(path)
    if store.type_name == "local":
        return np.memmap(inner, dtype=kind, mode="r", shape=(count,))
    with store.open_input_file(inner) as f:
        return np.frombuffer(f.read_buffer(), kind, count)


def read_token_files(spark: SparkSession, folder: str, per_doc) -> DataFrame:
    """Apply ``per_doc(ids)`` to the ids (unsigned 32 bits) of every document of the files.

    Returns doc_id, start (ids of all documents before it), n_tokens and the long ``value``.
    """
    ship(spark)

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n, nulls = row["docs"], row["null_ids"]
                ids = _numbers(row["path"] + ".bin", number_type(row["width"]), row["tokens"])
                bounds = _numbers(row["path"] + ".idx", np.dtype("<u8"), n + 1).astype(np.int64)
                known = _numbers(row["path"] + ".doc", np.dtype("<i8"), n - nulls)
                for a in range(0, n, 8192):
                    b = min(a + 8192, n)
                    cuts = bounds[a : b + 1]
                    values = [
                        per_doc(ids[i:j].astype("<u4"))
                        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
                    ]
                    doc_ids = [None] * max(0, min(nulls, b) - a)
                    doc_ids += known[max(a - nulls, 0) : max(b - nulls, 0)].tolist()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids, pa.int64()),
                            pa.array(cuts[:-1] + row["base"]),
                            pa.array(np.diff(cuts)),
                            pa.array(values, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "value"],
                    )

    manifest = spark.read.parquet(f"{folder}/manifest")
    # A number that is asked for stays: rows of a few bytes would otherwise end up in one task.
    size = manifest.agg(F.sum(F.col("tokens") * F.col("width"))).first()[0] or 0
    return manifest.repartition(1 + size // READ_BYTES).mapInArrow(read, "doc_id long, start long, n_tokens long, value long")


def checksums(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each row of (doc_id, text), from written files."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    write_token_files(docs, tokenizer, folder)
    rows = read_token_files(spark, folder, zlib.crc32)
    return rows.withColumnRenamed("value", "ids_crc32")
