"""Mixing against queues served one after the other."""

import hashlib
import random
import re
from fractions import Fraction

import pytest
from linkrank.llm import mixing


def brute_targets(sizes, budget=None):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, free, target = sum(sizes.values()) if budget is None else budget, set(sizes), {}
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if 3 * sizes[s] < Fraction(left * weight[s], total)}
        if not above:
            return target | {s: Fraction(left * weight[s], total) for s in free}
        target |= {s: Fraction(3 * sizes[s]) for s in above}
        left -= sum(3 * sizes[s] for s in above)
        free -= above
    return target


def brute(rows):
    """(doc_id, size, source size, taken): every queue is served until its target ends in it."""
    sized = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for i, t, s in rows]
    sizes = {}
    for _, n, s in sized:
        sizes[s] = sizes.get(s, 0) + n
    target = brute_targets(sizes)
    out = []
    for source, total in sizes.items():
        key = lambda r: (int(hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest()[:15], 16), r[0] or -1, r[1])
        queue = sorted((r for r in sized if r[2] == source), key=key)
        taken, left = [0] * len(queue), int(target[source])
        for _ in range(3):
            for k, (_, n, _) in enumerate(queue):
                taken[k] += min(n, left)
                left -= min(n, left)
        out += [(i, n, total, t, source) for (i, n, _), t in zip(queue, taken, strict=True)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def sourced(spark, odd_rows, prose):
    draw = random.Random(1)
    rows = [(i, t, draw.choice(["a", "é", None])) for i, t in odd_rows]
    rows += [(100 + i, prose(i, draw.randint(1, 90)), "hot" if i % 3 else draw.choice(["b", "Z", "漢"])) for i in range(300)]
    rows += [(900, "tiny source", "w"), (901, None, "nothing")]
    return rows, spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, target int").repartition(3)


def test_equals_brute_force(sourced, rows):
    listed, docs = sourced
    found = mixing.mixed(docs)
    assert rows(found, "doc_id", "size", "source_size", "taken", "source") == brute(listed)
    sizes = {r["source"]: r["source_size"] for r in found.collect()}
    targets = {r["source"]: r["target"] for r in found.collect()}
    assert targets == pytest.approx({s: float(t) for s, t in brute_targets(sizes).items()})
    assert any(targets[s] == 3 * sizes[s] > 0 for s in sizes)


def test_the_mix_is_whole_and_interleaved(sourced):
    queued = mixing.queues(sourced[1].filter("doc_id >= 100"))  # without the text of 30,000 words
    mix = sorted(mixing.mixture(queued).collect(), key=lambda r: r["mix_start"])
    at = 0
    for r in mix:
        assert r["mix_start"] == at and r["taken"] > 0
        at += r["taken"]
    finish = [r["finish"] for r in mix]
    assert finish == sorted(finish) and finish[-1] <= 1
    # In the first half of the mix every large source has about half of its words.
    whole, half = {}, {}
    for r in mix:
        whole[r["source"]] = whole.get(r["source"], 0) + r["taken"]
        if r["mix_start"] < at / 2:
            half[r["source"]] = half.get(r["source"], 0) + r["taken"]
    assert half["hot"] / whole["hot"] == pytest.approx(0.5, abs=0.1)


def test_budget(sourced):
    found = mixing.mixed(sourced[1], budget=500).collect()
    assert 500 - len({r["source"] for r in found}) <= sum(r["taken"] for r in found) <= 500
    everything = mixing.mixed(sourced[1], budget=10**9).collect()
    assert all(r["taken"] == 3 * r["size"] for r in everything)


def test_reruns_agree_and_seeds_differ(sourced, rows):
    docs = sourced[1]
    assert rows(mixing.mixed(docs)) == rows(mixing.mixed(docs.repartition(7)))
    assert rows(mixing.mixed(docs)) != rows(mixing.mixed(docs, seed="other"))


def test_no_rows_and_no_words(spark, sourced):
    assert mixing.mixed(sourced[1].limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {(r["taken"], r["target"]) for r in mixing.mixed(blank).collect()} == {(0, 0.0)}
