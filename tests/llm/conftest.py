import random

import pytest

WORDS = [a + b for a in ("ba", "ko", "ri", "tu", "ße", "né") for b in ("lo", "mi", "nt", "sha", "que", "r")]


@pytest.fixture(scope="session")
def prose():
    """A maker of random texts: prose(seed, number of words)."""

    def make(seed, n):
        draw = random.Random(seed)
        return "".join(draw.choice(WORDS) + draw.choice((" ", " ", " ", ", ", ".\n")) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def odd_rows(prose):
    """(doc_id, text) with nulls, empty, blank, very long, repeated and tied rows."""
    return [
        (None, "no id here"),
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, prose(4, 30_000)),
        (5, prose(5, 60)),
        (5, prose(5, 60)),
        (5, prose(6, 60)),
        (7, "one"),
        (8, "A b c  d　e\r\n f 漢字 😀<|endoftext|> x"),
        (9, "x" * 50_000),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The same rows with columns whose names clash with those of results."""
    rows = [(i, t, None if i in (1, 5) else "en", "s", "clash", 1, True) for i, t in odd_rows]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, ids string, score int, kept boolean"
    ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
