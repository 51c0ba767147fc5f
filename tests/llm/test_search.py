"""Ranked search against scores counted term by term."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from linkrank.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, best=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, query in wanted.items():
        scored = []
        for i, c in held:
            m = 25 + 75 * sum(c.values()) * n_docs // total
            score = sum(
                q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t, q in query.items()
                if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:best])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(odd_rows, prose):
    texts = [prose(5, 60), prose(4, 200), "no NO here", "", None, "zebra", prose(5, 30) + prose(6, 30), "E x 漢字 漢字"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, "one"), (None, "id one")]
    draw = random.Random(2)
    return rows + [(100 + i, " ".join(draw.choice(texts[0].split()) for _ in range(12))) for i in range(40)]


def test_equals_brute_force(spark, odd_docs, odd_rows, items, rows):
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    assert rows(search.ranked_documents(odd_docs, asked)) == brute(odd_rows, items)


def test_small_blocks(spark, odd_docs, odd_rows, items, rows, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_PAIRS", 64)
    monkeypatch.setattr(search, "BLOCK_ITEMS", 4)
    monkeypatch.setattr(search, "CELLS", 1)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert rows(search.ranked_documents(odd_docs, asked, best=3)) == brute(odd_rows, items, 3)


def test_empty_tables(spark, odd_docs, no_docs, items):
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert search.ranked_documents(no_docs, asked).count() == 0
    found = search.ranked_documents(odd_docs, asked.limit(0))
    assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]


def expand(found, part):
    if part < found.classes:
        return Counter([part])
    return sum((expand(found, c) for c in found.nodes[part - found.classes]), Counter())


def test_plan_shares_sets_and_keeps_items():
    draw = random.Random(3)
    phrases = [[f"p{i}w{j}" for j in range(draw.randint(2, 6))] for i in range(12)]
    item, term, times = [], [], []
    for i in range(60):
        own = Counter(t for p in draw.sample(phrases, 4) for t in p) + Counter([f"own{i}"])
        for t in own:
            item.append(i)
            term.append(t)
            times.append(1 + (t == "p0w0" and i % 2))
    found = search.plan(np.array(item), term, np.array(times))
    leaves = {}
    for k, t in enumerate(found.terms):
        for leaf in range(found.first[k], found.first[k + 1]):
            leaves.setdefault(int(found.cls[leaf]), Counter())[t] += int(found.times[leaf])
    for i, parts in zip(found.items.tolist(), found.parts, strict=True):
        classes = sum((expand(found, p) for p in parts), Counter())
        assert set(classes.values()) == {1}
        held = sum((leaves[c] for c in classes), Counter())
        assert held == Counter({t: q for j, t, q in zip(item, term, times, strict=True) if j == i})
    assert len(search._in_order(found)) == len(found.nodes)
    additions = sum(len(x) - 1 for x in [*found.nodes, *found.parts])
    assert additions < 0.7 * sum(len(sum((expand(found, p) for p in parts), Counter())) - 1 for parts in found.parts)


def test_lengths_beyond_64_bits():
    n = np.array([1, 10**9], np.int64)
    assert search.lengths_factor(n, 10**12, 10**15).tolist() == [25 + 75 * x * 10**12 // 10**15 for x in n.tolist()]
