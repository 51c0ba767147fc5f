"""Encoding many texts through their distinct chunks.

A byte-level BPE of this kind first cuts a text by a fixed pattern in which a blank always
belongs to the word after it, and encodes the parts independently.  A text can therefore be
cut before a blank, unless the blank lies inside a run of white space, without changing a
token.  It can also be cut between a letter or digit and a sign that ends a word or sentence,
and after a line feed that is the only white space there: words with and without a comma are then
one chunk.  Each distinct chunk of a piece is encoded once, and whole texts are put together
from the chunks' ids.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa

from linkrank.llm.text import buffers, flat_ranges

#: Chunks that a worker remembers; two generations of this size are held at most.
REMEMBERED = 200_000


#: Signs that a text can be cut before, if they follow a letter or digit, and the line feed.
MARKS = b",.;:!?)\n"

_LETTERS = np.zeros(256, bool)
_LETTERS[[b for b in range(128) if chr(b).isalnum()]] = True
#: First bytes of two-byte characters that are letters all (Latin, Cyrillic), but for U+00D7 and U+00F7.
_LEADS = np.zeros(256, bool)
_LEADS[[0xC3, 0xC4, 0xC5, 0xD0, 0xD1]] = True


def marks_beside(special: Iterable[str]) -> bytes:
    """Those of ``MARKS`` that are in none of the special tokens."""
    held = "".join(special).encode()
    return bytes(b for b in MARKS if b not in held)


def _at_marks(data: np.ndarray, padded: np.ndarray, marks: bytes) -> np.ndarray:
    """Where texts can be cut at the marks; ``padded`` has two more bytes on either side."""
    known = np.zeros(256, bool)
    known[list(marks)] = True
    found = np.flatnonzero(known[data])
    before2, before, own, after = (padded[found + i] for i in range(4))
    letter = _LETTERS[before] | (_LEADS[before2] & (before >= 128) & ~((before2 == 0xC3) & ((before & 0xDF) == 0x97)))
    alone = ((before > 32) & (before < 127)) | ((before >= 128) & (before2 >= 0xC3) & (before2 < 0xE0))
    alone &= ((after > 32) & (after < 127)) | ((after >= 0xC3) & (after < 0xE0))
    return np.concatenate([found[letter & (own != 10)], found[alone & (own == 10)] + 1])


def cut(texts: pa.Array, marks: bytes = b"") -> tuple[pa.Array, np.ndarray]:
    """(chunks in order, first chunk of every text and the total); see the module.

    Texts are cut at those of ``MARKS`` that are given, besides blanks.  A mark that is part of a
    special token must not be among them.
    """
    offsets, data = buffers(texts)
    padded = np.zeros(len(data) + 4, np.uint8)
    padded[2 : 2 + len(data)] = data
    space = np.flatnonzero(data == 32)
    before2, before, after = padded[space], padded[space + 1], padded[space + 3]
    # Certainly no white space: ASCII other than blanks and controls, or a letter of two bytes.
    plain = ((before > 32) & (before < 127)) | ((before >= 128) & (before2 >= 0xC3) & (before2 < 0xE0))
    plain |= ((after > 32) & (after < 127)) | ((after >= 0xC3) & (after < 0xE0))
    begins = np.zeros(len(data) + 1, bool)
    begins[space[plain]] = begins[offsets] = True
    if marks:
        begins[_at_marks(data, padded, marks)] = True
    bounds = np.flatnonzero(begins)
    chunks = pa.StringArray.from_buffers(
        len(bounds) - 1,
        pa.py_buffer(bounds.astype(np.int32)),
        texts.buffers()[2] or pa.py_buffer(b""),
    )
    return chunks, np.searchsorted(bounds, offsets)


class Remembered:
    """Encodings of chunks, of which the worker keeps the recently used ones."""

    def __init__(self, encode: Callable[[list[str]], list], size: int = REMEMBERED):
        self.encode, self.size = encode, size
        self.young: dict = {}
        self.old: dict = {}

    def __call__(self, chunks: list[str]) -> list:
        young, old = self.young, self.old
        found = [young.get(c) for c in chunks]
        missing = [i for i, x in enumerate(found) if x is None]
        new = [i for i in missing if chunks[i] not in old]
        for i in missing:
            found[i] = old.get(chunks[i])
        for i, value in zip(new, self.encode([chunks[i] for i in new]), strict=True):
            found[i] = value
        if len(young) + len(missing) > self.size:
            self.old, self.young = young, {}
            young = self.young
        for i in missing[: self.size]:
            young[chunks[i]] = found[i]
        return found


def distinct(texts: pa.Array, marks: bytes = b"") -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct chunks, code of every chunk, first chunk of every text and the total)."""
    chunks, starts = cut(texts, marks)
    encoded = chunks.dictionary_encode()
    return encoded.dictionary.to_numpy(zero_copy_only=False).tolist(), encoded.indices.to_numpy(), starts


def assemble(flat: np.ndarray, lengths: np.ndarray, codes: np.ndarray, starts: np.ndarray):
    """(values of whole texts, first value of every text and the total), where chunk ``c`` has
    the next ``lengths[c]`` of ``flat``."""
    if not len(codes):
        return flat[:0], np.zeros(len(starts), np.int64)
    own = lengths[codes]
    firsts = np.cumsum(lengths) - lengths
    bounds = np.concatenate([[0], np.cumsum(own)])[starts]
    return flat[flat_ranges(firsts[codes], own)], bounds
