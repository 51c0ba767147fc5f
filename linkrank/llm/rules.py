"""Quality rules whose thresholds adapt to each language and source.

Every measure is a whole number on a fixed scale, and a group's sketch is its number of
documents at each value: sketches merge by adding, in any order and over any partitions, to
the same counts, and their size is bounded by the scale.  The sketches of the groups add up to
those of the languages and of the corpus.  A group's quantiles, blended with those of its
language and of the corpus, give fences; documents beyond a fence of their own group are
dropped by a join.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkrank.llm.shared import ship
from linkrank.llm.text import buffers, hashes, mix, pieces, segments, strings, windows, words
from linkrank.operators.staging import stage

#: Fixed rules: fewer words, or a larger percentage of words in repeated windows, always fail.
LEAST_WORDS = 20
REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = b"#*$%&|<>"
#: ASCII characters that are no letter, digit or blank.
MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
SCALE = 1000


@dataclass(frozen=True)
class Measure:
    """A whole number from 0 to SCALE for each document, and how far it may go.

    ``levels`` are three quantiles in percent, of all documents or of those ``above_zero``, for
    measures that are 0 nearly everywhere.  The upper fence is the second one plus ``reach`` times
    (its distance from the first one, plus one unit), plus a tenth of it, plus ``floor``; the lower
    one, if ``two_sided``, the mirror image with the third.  Each side has the spread of the other, so
    that not quite half of a group may be junk on one side without moving its fence far.
    """

    sql: str
    levels: tuple[int, int, int] = (25, 50, 75)
    reach: int = 10
    floor: int = 20
    above_zero: bool = False
    two_sided: bool = False


MEASURES = {
    "marks": Measure(f"{SCALE} * n_marks div word_chars"),
    "repeats": Measure(f"{SCALE} * n_repeat_words div n_words", (50, 75, 90), 3, above_zero=True),
    "lines": Measure(f"{SCALE} * n_dup_lines div n_words", (50, 75, 90), 3, above_zero=True),
    # Tenths of a character; words of a hundred characters and longer are alike.
    "length": Measure(f"least({SCALE}, 10 * word_chars div n_words)", floor=0, two_sided=True),
}
#: A blend has the weight of this many documents of the wider group.
PRIOR = 100
#: Documents above zero speak for their group up to this many times the corpus's share of them; the
#: rest of their weight goes to the wider group.
SURPLUS = 2.0

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_COUNTED = f"{COUNTS}, n_marks long"


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[bounds])


def _repeated_words(own: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Words of each text in windows that it holds more than once."""
    text = segments(starts)
    hashed = windows(own, REPEAT_WINDOW)
    place = np.flatnonzero(text[: len(hashed)] == text[REPEAT_WINDOW - 1 :])
    keyed = mix(hashed[place] + mix(text[place].astype(np.uint64) + np.uint64(1)))
    _, inverse, counts = np.unique(keyed, return_inverse=True, return_counts=True)
    again = place[counts[inverse] > 1]
    change = np.zeros(len(own) + 1, dtype=np.int64)
    np.add.at(change, again, 1)
    np.add.at(change, again + REPEAT_WINDOW, -1)
    return _sums(np.cumsum(change[:-1]) > 0, starts)


def _repeated_lines(texts: pa.Array) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier line."""
    lists = pc.split_pattern(texts, "\n")
    bounds = lists.offsets.to_numpy().astype(np.int64)
    lines = lists.flatten().dictionary_encode()
    blank = pc.equal(pc.ascii_trim_whitespace(lines.dictionary), "").to_numpy(zero_copy_only=False)
    codes = lines.indices.to_numpy().astype(np.int64)
    text = segments(bounds)
    real = ~blank[codes]
    codes, text = codes[real], text[real]
    distinct = np.unique(text * (len(blank) + 1) + codes) // (len(blank) + 1)
    n = len(bounds) - 1
    return np.bincount(text, minlength=n) - np.bincount(distinct, minlength=n)


def counted(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, COUNTS and n_marks) of each row."""
    ship(docs.sparkSession)
    blanks, symbols, marks = np.zeros((3, 256), bool)
    blanks[[9, 10, 11, 12, 13, 32]] = True
    symbols[list(SYMBOLS)] = True
    marks[list(MARKS)] = True

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                texts = strings(piece.column("text"))
                offsets, data = buffers(texts)
                distinct, codes, starts = words(texts, None)
                counts = [
                    np.diff(starts),
                    pc.utf8_length(texts).to_numpy().astype(np.int64) - _sums(blanks[data], offsets),
                    _sums(symbols[data], offsets),
                    _repeated_lines(texts),
                    _repeated_words(hashes(distinct)[codes], starts),
                    _sums(marks[data], offsets),
                ]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").cast(pa.int64()), piece.column("lang").cast(pa.string()),
                     piece.column("source").cast(pa.string()), *(pa.array(c.astype(np.int64)) for c in counts)],
                    names=["doc_id", "lang", "source", *(f.split()[0] for f in _COUNTED.split(", "))],
                )

    return docs.select("doc_id", "lang", "source", "text").mapInArrow(
        run, f"doc_id long, lang string, source string, {_COUNTED}"
    )


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, value, n) of documents that pass the fixed rules."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES]))
    passed = measured.filter("NOT base_failed").select("lang", "source", each.alias("m"))
    return passed.groupBy("lang", "source", "m.measure", "m.value").agg(F.count(F.lit(1)).alias("n"))


def _by_measure(pick) -> Column:
    """A constant for each measure."""
    pairs = [F.lit(x) for name, m in MEASURES.items() for x in (name, pick(m))]
    return F.element_at(F.create_map(*pairs), F.col("measure"))


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, total, size, q0, q1, q2): documents, those that count, and their quantiles.

    The windows run over one sketch each, at most SCALE + 1 rows.
    """
    own = Window.partitionBy(*keys, "measure")
    below = own.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = F.when(~_by_measure(lambda m: m.above_zero) | (F.col("value") > 0), F.col("n")).otherwise(0)
    ranked = (
        sketch.withColumn("used", counts)
        .withColumns({"upto": F.sum("used").over(below), "size": F.sum("used").over(own), "total": F.sum("n").over(own)})
    )
    found = []
    for k in range(3):
        reached = (F.col("used") > 0) & (100 * F.col("upto") >= _by_measure(lambda m, k=k: m.levels[k]) * F.col("size"))
        found.append(F.coalesce(F.min(F.when(reached, F.col("value"))), F.lit(0)).cast("long").alias(f"q{k}"))
    return ranked.groupBy(*keys, "measure").agg(F.max("total").alias("total"), F.max("size").alias("size"), *found)


def _blended(own: DataFrame, wider: DataFrame, keys: list[str]) -> DataFrame:
    """``own`` with its quantiles blended with those of ``wider`` (also share, the corpus's part of
    documents that count), which has one row for each measure and ``keys``."""
    renamed = {k: f"w_{k}" for k in [*keys, "measure", "q0", "q1", "q2"]}
    meet = F.col("measure") == F.col("w_measure")
    for k in keys:
        meet &= F.col(k).eqNullSafe(F.col(f"w_{k}"))
    voice = F.least(F.col("size"), F.floor(SURPLUS * F.col("total") * F.col("share")))
    rows = own.join(wider.select(*renamed, "share").withColumnsRenamed(renamed), meet).withColumn("voice", voice)
    both = {f"q{k}": F.expr(f"(voice * q{k} + ({PRIOR} + size - voice) * w_q{k}) div ({PRIOR} + size)") for k in range(3)}
    return rows.withColumns(both).drop("voice", *renamed.values())


def fences(merged: DataFrame) -> DataFrame:
    """(lang, source, low_<measure>, high_<measure>) of each group of the sketches: see Measure.

    A language's quantiles are blended with the corpus's, and a group's with its language's, by the
    number of documents behind them: a small group leans on its language, and so does a group with
    far more documents above zero than the corpus has.  Junk that is most of all the corpus's documents
    above zero does set the fences of such a measure.
    """
    summed = F.sum("n").alias("n")
    corpus = quantiles(merged.groupBy("measure", "value").agg(summed), [])
    corpus = corpus.withColumn("share", F.col("size") / F.col("total"))
    languages = quantiles(merged.groupBy("lang", "measure", "value").agg(summed), ["lang"])
    languages = _blended(languages, corpus, [])
    groups = _blended(quantiles(merged, ["lang", "source"]), languages, ["lang"])
    columns = []
    for name, m in MEASURES.items():
        own_rows, slack = F.col("measure") == name, F.expr("q1 div 10") + m.floor
        low = F.col("q1") - m.reach * (F.col("q2") - F.col("q1") + 1) - slack
        high = F.col("q1") + m.reach * (F.col("q1") - F.col("q0") + 1) + slack
        columns += [
            F.max(F.when(own_rows, low)).alias(f"low_{name}"),
            F.max(F.when(own_rows, high)).alias(f"high_{name}"),
        ]
    return groups.groupBy("lang", "source").agg(*columns)


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, COUNTS, base_failed, kept) of each row of (doc_id, text, lang, source).

    A null text has no words and fails; a null language or source is a group like any other;
    repeated rows give a row each; an empty table gives no rows.  Texts are read once and do
    not move.
    """
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    measured = counted(docs).withColumn("base_failed", failed)
    measured = measured.withColumns(
        {name: F.when(~F.col("base_failed"), F.expr(m.sql).cast("int")) for name, m in MEASURES.items()}
    )
    measured = stage(measured, "measured")
    limits = stage(fences(stage(sketches(measured), "sketches")), "fences").withColumnsRenamed({"lang": "l", "source": "s"})
    within = F.lit(True)
    for name, m in MEASURES.items():
        within &= F.col(name) <= F.col(f"high_{name}")
        if m.two_sided:
            within &= F.col(name) >= F.col(f"low_{name}")
    joined = measured.join(
        limits, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left"
    )
    return joined.select(
        "doc_id",
        *(f.split()[0] for f in COUNTS.split(", ")),
        "base_failed",
        (~F.col("base_failed") & F.coalesce(within, F.lit(False))).alias("kept"),
    )
