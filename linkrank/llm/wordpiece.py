"""Numbers of greedy longest-match word pieces, in time linear in the text.

The vocabulary is a trie whose nodes also have a failure link and the number of pieces that
are popped when it is followed.  Walking a word, a missing edge pops the pieces of the node's
link and goes on from there, so no character is looked at twice and no piece is built.

A word starts with the vocabulary's blank; pieces that begin with it can only start a word
and all others only continue one.  A word that cannot be cut into pieces counts as one.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from linkrank.llm import chunks
from linkrank.llm.bpe import byte_characters
from linkrank.llm.shared import ship
from linkrank.llm.text import pieces, strings, words

WORD_START = b" "
ROOT = 0
NONE = -1


class Automaton:
    """Trie over byte strings; ``edge[node << 8 | byte]``, ``link`` and ``popped`` by node."""

    def __init__(self, vocabulary):
        self.edge: dict[int, int] = {}
        final = [False]
        parents: list[tuple[int, int]] = [(NONE, 0)]
        for string in sorted(vocabulary):
            node = ROOT
            for byte in string:
                following = self.edge.get(node << 8 | byte)
                if following is None:
                    following = self.edge[node << 8 | byte] = len(final)
                    final.append(False)
                    parents.append((node, byte))
                node = following
            final[node] = node != ROOT
        depth = [0] * len(final)
        for node in range(1, len(final)):
            depth[node] = depth[parents[node][0]] + 1
        self.link, self.popped = [NONE] * len(final), [0] * len(final)
        for node in sorted(range(1, len(final)), key=depth.__getitem__):
            if final[node]:
                self.link[node], self.popped[node] = ROOT, 1
                continue
            parent, byte = parents[node]
            back, count = self.link[parent], self.popped[parent]
            while back != NONE and back << 8 | byte not in self.edge:
                count += self.popped[back]
                back = self.link[back]
            if back != NONE:
                self.link[node], self.popped[node] = self.edge[back << 8 | byte], count

    def count(self, word: bytes) -> int:
        """Pieces of one word, which includes its blank."""
        edge, link, popped = self.edge.get, self.link, self.popped
        node = total = 0
        for byte in word:
            following = edge(node << 8 | byte)
            while following is None:
                total += popped[node]
                node = link[node]
                if node == NONE:
                    return 1
                following = edge(node << 8 | byte)
            node = following
        while node != ROOT:
            total += popped[node]
            node = link[node]
            if node == NONE:
                return 1
        return total


def byte_vocabulary(tokenizer_json: str) -> set[bytes]:
    """The strings of a byte-level vocabulary file as bytes, without special tokens."""
    to_byte = {c: b for b, c in enumerate(byte_characters())}
    model = json.loads(tokenizer_json)["model"]
    return {bytes(map(to_byte.__getitem__, s)) for s in model["vocab"] if all(c in to_byte for c in s)}


_automata: dict[int, chunks.Remembered] = {}


def _worker_counts(content: bytes) -> chunks.Remembered:
    key = hash(content)
    if key not in _automata:
        automaton = Automaton(byte_vocabulary(content.decode()))
        _automata[key] = chunks.Remembered(
            lambda new: [automaton.count(WORD_START + w.encode()) for w in new], 400_000
        )
    return _automata[key]


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) of each row of (doc_id, text): words of the whole text between
    ASCII blanks, and the greedy longest-match pieces of all of them.

    Null or empty texts have no words; repeated rows give a row each; an empty table gives no
    rows.  Rows do not move.  ``vocabulary`` is the path of a byte-level tokenizer file.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())

    def run(batches):
        counts = _worker_counts(content.value)
        for batch in batches:
            for piece in pieces(batch):
                distinct, codes, starts = words(strings(piece.column("text")), None)
                own = np.array(counts(distinct.to_pylist()) or [0], dtype=np.int64)[codes]
                totals = np.concatenate([[0], np.cumsum(own)])[starts]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").cast(pa.int64()), pa.array(np.diff(starts)), pa.array(np.diff(totals))],
                    names=["doc_id", "n_words", "n_tokens"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_tokens long")
