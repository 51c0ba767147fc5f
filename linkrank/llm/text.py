"""Words of whole texts as numpy arrays, without a Python object per word.

Everything here runs inside tasks, on one Arrow batch at a time.  A batch is cut into pieces
of a few megabytes first, so that memory does not depend on how Spark filled the batch; a
text longer than a piece is a piece of its own and is never cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 8 << 20

_BYTES = np.arange(256, dtype=np.uint8)
#: ASCII capitals to small letters.
FOLD = _BYTES.copy()
FOLD[65:91] += 32
#: As FOLD, and every ASCII character that is neither a letter nor a digit to a blank.
FOLD_ALNUM = FOLD.copy()
FOLD_ALNUM[[b for b in range(128) if not chr(b).isalnum()]] = 32

_R = np.uint64(0x9E3779B97F4A7C15)
_R2 = np.uint64(0xC2B2AE3D27D4EB4F)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def strings(column) -> pa.Array:
    """A text column without nulls (null: empty) whose offsets start at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pa.concat_arrays([pc.fill_null(column.cast(pa.string()), "")])


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES):
    """Slices of a batch with at most ``limit`` bytes of text, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start, n = 0, batch.num_rows
    while start < n:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of ``strings(...)``."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[: len(texts) + 1]
    data = texts.buffers()[2]
    return offsets, (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8))[
        : offsets[-1]
    ]


def mapped(texts: pa.Array, table: np.ndarray | None) -> pa.Array:
    """The texts with every byte looked up in a table that leaves bytes from 128 on alone."""
    if table is None or not len(texts):
        return texts
    offsets, data = buffers(texts)
    return pa.StringArray.from_buffers(
        len(texts), pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(table[data])
    )


def words(texts: pa.Array, table: np.ndarray | None = FOLD):
    """(distinct words, code of every word, first word of every text and the total).

    Words are the runs between ASCII blanks (0x20, 0x09-0x0D) after ``table`` was applied.
    """
    lists = pc.ascii_split_whitespace(mapped(texts, table))
    starts = lists.offsets.to_numpy().astype(np.int64)
    encoded = lists.flatten().dictionary_encode()
    codes, distinct = encoded.indices.to_numpy(), encoded.dictionary
    empty = np.flatnonzero(pc.equal(distinct, "").to_numpy(zero_copy_only=False))
    if len(empty):
        real = codes != empty[0]
        kept = np.concatenate([[0], np.cumsum(real)])
        starts, codes = kept[starts], codes[real]
    return distinct, codes, starts


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def hashes(array: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, the same in every process."""
    array = pa.concat_arrays([array])
    if not len(array):
        return np.zeros(0, np.uint64)
    offsets, data = buffers(array)
    offsets = offsets.astype(np.int64)
    lengths = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], lengths)
    values = (data.astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max(initial=0)), _R)[place]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return mix(sums[offsets[1:]] - sums[offsets[:-1]] + lengths.astype(np.uint64))


def windows(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` consecutive entries."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k, factor in enumerate(powers(size + 1, _R2)[1:]):
        out += word_hashes[k : k + n] * factor
    return mix(out)


def segments(starts: np.ndarray) -> np.ndarray:
    """The text that each word belongs to."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def flat_ranges(firsts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """firsts[0], firsts[0]+1, ... (lengths[0] of them), firsts[1], ..."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(firsts - (ends - lengths), lengths) + np.arange(total)
