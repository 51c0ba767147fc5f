"""Near-duplicates, decontamination, rules and language model against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from linkrank.llm import decontaminate, lm, minhash, rules
from linkrank.llm.components import components
from linkrank.llm.text import strings
from pyspark.sql import functions as F


def fold(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    own = fold(text)
    return {tuple(own[i : i + 5]) for i in range(max(len(own) - 4, 1))} if own else set()


def groups(rows):
    """component of each row by brute force."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[root(i)].append(doc_id)
    return [
        (d, len(sets[i]), d if not sets[i] else min(ids[root(i)], default=None)) for i, (d, _) in enumerate(rows)
    ]


def edited(text, share, seed):
    draw = random.Random(seed)
    return " ".join(f"w{draw.random()}" if draw.random() < share else w for w in text.split())


@pytest.fixture(scope="module")
def near_rows(prose, odd_rows):
    rows = [r for r in odd_rows if r[0] != 4] + [(100 + i, prose(100 + i, 80)) for i in range(20)]
    base, shared = prose(50, 120), prose(51, 30)
    rows += [(200 + i, edited(base, (i % 12) / 200, i)) for i in range(120)]  # one large, loose group
    rows += [(400 + i, prose(400 + i, 90) + shared) for i in range(40)]  # a common passage
    chain = prose(60, 100)
    for i in range(30):  # linked in a row only
        chain = edited(chain, 0.01, 1000 + i)
        rows.append((600 - i, chain))
    return rows


def test_near_duplicates(spark, near_rows, monkeypatch):
    docs = spark.createDataFrame([(*r, "x") for r in near_rows], "doc_id long, text string, fp string").repartition(4)
    found = minhash.near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == sorted(groups(near_rows), key=repr)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_empty_and_thresholds(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0
    with pytest.raises(ValueError):
        minhash.near_duplicates(no_docs, percent=50)


def test_long_lists_meet_in_blocks(tmp_path):
    """Links of a list that is dealt out in blocks are those of the whole list."""
    own = np.arange(20, dtype="<u8")
    (tmp_path / "sets").write_bytes(own.tobytes() * 50)
    draw = np.random.Generator(np.random.PCG64(1))
    base = draw.integers(0, 2**32, minhash.POSTED, dtype=np.uint64).astype("<u4")
    rest = draw.integers(0, 2**16, minhash.COORDINATES - minhash.POSTED).astype("<u2")
    n = 50

    def batch(blocks):
        rows = [
            (f"g{min(b, o)}{max(b, o)}", bytes([i]), i, b, b != o)
            for i in range(n)
            for b in [i % blocks]
            for o in range(blocks)
        ]
        rows.sort()
        keys = {g: k for k, g in enumerate(sorted({r[0] for r in rows}))}
        return pa.RecordBatch.from_arrays(
            [
                pa.array([keys[r[0]] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.binary()),
                pa.array([base.tobytes() + rest.tobytes()] * len(rows), pa.binary()),
                pa.array([1] * len(rows), pa.int64()),
                pa.array([0] * len(rows), pa.int32()),
                pa.array([r[2] // 2 for r in rows], pa.int64()),
                pa.array([r[3] for r in rows], pa.int32()),
                pa.array([r[4] for r in rows]),
                pa.array(["sets"] * len(rows)),
                pa.array([20 * r[2] for r in rows]),
                pa.array([20] * len(rows)),
            ],
            names=["g", "fp", "sig", "mask", "i", "component", "block", "two", "file", "first", "size"],
        )

    def pairs(blocks, size):
        whole = batch(blocks)
        parts = [whole.slice(i, size) for i in range(0, len(whole), size)]
        out = Counter()
        for b in minhash._across(iter(parts), minhash._Sets(f"file://{tmp_path}"), 75):
            out.update(frozenset(p) for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        return out

    expected = {frozenset((i, j)) for i in range(n // 2) for j in range(i)}  # one for two components
    for found in (pairs(1, 1000), pairs(3, 7)):
        ends = [frozenset(x[0] // 2 for x in p) for p in found]
        assert set(ends) == expected and set(found.values()) == {1}
    assert len(pairs(1, 1000)) == len(expected)


def test_many_intersections_at_once(monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 16)
    draw = np.random.Generator(np.random.PCG64(2))
    sets = [np.unique(draw.integers(0, 90, draw.integers(1, 60)).astype(np.uint64)) for _ in range(12)]
    x, y = np.triu_indices(12, 1)
    expected = [len(set(sets[i].tolist()) & set(sets[j].tolist())) for i, j in zip(x, y, strict=True)]
    assert minhash._common(sets, x, y).tolist() == expected  # many pairs
    assert minhash._common(sets, x[:5], y[:5]).tolist() == expected[:5]  # few

def test_components(spark):
    draw = random.Random(4)
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + draw.randint(1, 60)) for _ in range(50)] + [(7, 7), (300, 200)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a int, b int")).collect()))
    assert {found[i] for i in range(31)} == {0} and found[300] == found[200] == 200
    assert all(found[b] == 100 for a, b in links if a == 100)


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_contamination(docs, items):
    found = []
    spans = set()
    for item, text in items:
        own = item_words(text)
        n = min(13, len(own))
        if n:
            spans |= {(item, tuple(own[i : i + n])) for i in range(len(own) - n + 1)}
    by = defaultdict(set)
    for item, span in spans:
        by[span].add(item)
    lengths = {len(s) for s in by}
    for doc, text in docs:
        own, hit, names = item_words(text), set(), set()
        for n in lengths:
            for i in range(len(own) - n + 1):
                if tuple(own[i : i + n]) in by:
                    hit |= set(range(i, i + n))
                    names |= by[tuple(own[i : i + n])]
        names = sorted(str(x) for x in names if x is not None)
        sha = hashlib.sha256(",".join(names).encode()).hexdigest()
        found.append((doc, len(own), len(hit), len(names), sha, bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(found, key=repr)


def test_contamination(spark, prose, odd_rows, odd_docs, no_docs):
    items = [
        (1, prose(70, 40)), (2, prose(71, 13)), (3, "Ba-Lo, komi"), (4, "one"), (5, None), (6, ""), (7, "!?"),
        (1, prose(72, 20)), (8, prose(71, 13)), (None, prose(73, 15)), (10, "aa aa aa aa aa aa aa aa aa aa aa aa aa aa"),
    ]
    docs = [*odd_rows, (20, "pre " + prose(70, 40) + " post"), (21, prose(71, 13).upper()), (22, prose(74, 30) + prose(73, 15)),
            (23, "aa " * 40), (24, " ".join(prose(70, 40).split()[5:17])), (25, prose(72, 20) * 3 + prose(70, 40))]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, pos int").repartition(3)
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, words int")
    found = sorted((tuple(r) for r in decontaminate.contamination(frame, benchmark).collect()), key=repr)
    assert found == brute_contamination(docs, items)
    none = decontaminate.contamination(frame, benchmark.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.contaminated or r.n_hit for r in none)
    assert decontaminate.contamination(frame.limit(0), benchmark).count() == 0


def brute_counts(text):
    text = text or ""
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(own[i : i + 8]) for i in range(len(own) - 7))
    repeated = {i + k for i in range(len(own) - 7) if seen[tuple(own[i : i + 8])] > 1 for k in range(8)}
    n = (len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
    return (*n, n[0] < 20 or 100 * n[4] > 30 * n[0])


def test_rule_counts(spark, prose, odd_rows, odd_docs, no_docs):
    found = rules.judged(odd_docs).collect()
    expected = [(i, *brute_counts(t)) for i, t in odd_rows]
    assert sorted((tuple(r)[:-1] for r in found), key=repr) == sorted(expected, key=repr)
    assert not any(r.kept and r.base_failed for r in found)
    assert rules.judged(no_docs).count() == 0
    texts = [(i, prose(i, 200)) for i in range(60)] + [(90, "# $ % & | < > " * 40 + prose(90, 100)), (91, (prose(91, 12) + "\n") * 3 + prose(92, 400))]
    rows = spark.createDataFrame([(*t, "fr", None) for t in texts], "doc_id long, text string, lang string, source string")
    judged = {r.doc_id: r for r in rules.judged(rows).collect()}
    assert [tuple(judged[i])[1:-1] for i, _ in texts] == [brute_counts(t) for _, t in texts]
    assert all(judged[i].kept for i in range(60)) and not judged[90].kept


def value_rows(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, base_failed boolean, marks int, repeats int, lines int, length int")


def brute_fences(rows):
    """(lang, source, measure): (low, high), from sorted lists of values."""

    def quantiles(values, m):
        used = sorted(v for v in values if v or not m.above_zero)
        return len(values), len(used), [used[-(-len(used) * p // 100) - 1] if used else 0 for p in m.levels]

    def blend(own, wider, share):
        total, size, q = own
        voice = min(size, math.floor(rules.SURPLUS * total * share))
        return [(voice * a + (rules.PRIOR + size - voice) * b) // (rules.PRIOR + size) for a, b in zip(q, wider, strict=True)]

    out, passed = {}, [r for r in rows if not r[2]]
    for k, (name, m) in enumerate(rules.MEASURES.items(), 3):
        total, size, corpus = quantiles([r[k] for r in passed], m)
        for lang, source in {r[:2] for r in passed}:
            language = blend(quantiles([r[k] for r in passed if r[0] == lang], m), corpus, size / total)
            q = blend(quantiles([r[k] for r in passed if r[:2] == (lang, source)], m), language, size / total)
            slack = q[1] // 10 + m.floor
            out[lang, source, name] = (q[1] - m.reach * (q[2] - q[1] + 1) - slack, q[1] + m.reach * (q[1] - q[0] + 1) + slack)
    return out


def test_sketches_merge_and_fences_equal_brute_force(spark):
    draw = random.Random(5)
    groups = [("en", "a", 400, 30), ("en", "b", 90, 60), ("en", None, 1, 300), ("fr", "a", 200, 45), (None, "a", 40, 10)]
    rows = [
        (lang, source, draw.random() < 0.1, draw.randint(top // 2, top), draw.choice([0] * 9 + [top]), 0, draw.randint(40, top + 40))
        for lang, source, n, top in groups
        for _ in range(n)
    ]
    rows += [("en", "a", False, 5, 6, 7, 8)]
    whole = rules.sketches(value_rows(spark, rows))
    parts = [rules.sketches(value_rows(spark, rows[i::3])) for i in range(3)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("lang", "source", "measure", "value").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    found = {
        (r.lang, r.source, m): (r[f"low_{m}"], r[f"high_{m}"]) for r in rules.fences(merged).collect() for m in rules.MEASURES
    }
    assert found == brute_fences(rows)
    assert rules.fences(whole.limit(0)).count() == 0


def test_fences_move_with_the_group_and_not_with_its_junk(spark):
    draw = random.Random(7)

    def clean(lang, source, n, marks):
        return [
            (lang, source, False, draw.randint(marks - 4, marks + 4), draw.choice([0] * 19 + [40]), draw.choice([0] * 19 + [3]), draw.randint(46, 54))
            for _ in range(n)
        ]

    rows = clean("en", "prose", 600, 30) + clean("en", "code", 600, 200) + clean("en", "mixed", 600, 30) + clean("fr", "prose", 600, 30)
    rows += [("en", "mixed", False, 400, 0, 0, 130)] * 400  # two fifths of the group
    rows += [("fr", "tiny", False, 700, 290, 300, 130)] * 3
    found = {(r.lang, r.source): r for r in rules.fences(rules.sketches(value_rows(spark, rows))).collect()}
    prose, code, mixed, tiny = (found[k] for k in (("en", "prose"), ("en", "code"), ("en", "mixed"), ("fr", "tiny")))
    assert 34 < prose.high_marks < 150 < 204 < code.high_marks
    # Junk in a large group or a small one stays outside, clean rows inside.
    for r in (mixed, tiny):
        assert 34 < r.high_marks < 400 and 54 < r.high_length < 130 and r.low_length < 46
        assert 3 < r.high_lines < 200 and 40 < r.high_repeats < 290


def base_scores(rows):
    counts, total = Counter(), 0
    train = [(i, t) for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    for _, text in train:
        own = [*fold(text), None]
        counts.update(own)
        total += len(own)
    out = []
    for i, text in rows:
        own = [*fold(text), None]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1))) for w in own)
        held = zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
        out.append((i, held, len(own), sum(counts[w] > 0 for w in own), total, round(base, 5)))
    return sorted(out, key=repr)


def test_language_model(spark, prose, odd_rows, odd_docs, no_docs):
    rows = odd_rows + [(100 + i, prose(500 + i, 150)) for i in range(60)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, piece int").repartition(4)
    found = lm.scores(frame).collect()
    own = sorted(((*tuple(r)[:5], round(r.base_score, 5)) for r in found), key=repr)
    assert own == base_scores(rows)
    held = [r for r in found if r.held_out and r.doc_id and r.doc_id >= 100]
    sizes = {i: len(t.encode()) for i, t in rows if t and i and i >= 100}
    bits = sum(-r.score / math.log10(2) for r in held) / sum(sizes[r.doc_id] for r in held)
    assert held and 0.3 < bits < 3.5
    assert all(r.score < 0 for r in found)
    assert lm.scores(no_docs).count() == 0


def test_held_out_text_teaches_nothing(spark, prose):
    rows = [(i, prose(i, 80)) for i in range(30)]
    held = next(i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 1)
    run = lambda rows: {r.doc_id: r for r in lm.scores(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    before, after = run(rows), run([(i, "zzz qqq " * 50 if i == held else t) for i, t in rows])
    for i, _ in rows:
        if i != held:
            assert before[i].base_score == pytest.approx(after[i].base_score, rel=1e-9)
            assert before[i].score == pytest.approx(after[i].score, rel=0.02)


def test_bit_probabilities_are_a_distribution():
    """Over all bytes that can follow, probabilities add up to one at most."""
    tables = [np.zeros(2 << b, np.float32) for b in lm.SLOT_BITS]
    units = pa.array([b"the ", b"then ", b"than ", b"a "], pa.binary())
    lm.count_slots(tables, units, np.array([5, 3, 2, 9]))
    model = lm.Mixture.untrained(tables)
    model.learn(units, np.array([5, 3, 2, 9]), np.zeros((lm.GATES, len(lm.SLOT_BITS))))
    scorer, total = model.frozen(), 0.0
    for b in range(256):
        offsets, data = np.array([0, 3]), np.frombuffer(b"th" + bytes([b]), np.uint8)
        logs = 0.0
        for j, places, bits, slots in lm._bits(data, lm._contexts(offsets, data)):
            p = scorer.probability(j, slots)
            for at, bit, one in zip(np.arange(3)[places], bits, p, strict=True):
                logs += math.log(one if bit else 1 - one) if at == 2 else 0
        total += math.exp(logs)
    # What is missing are the codes of the common bytes behind the escape.
    assert 0.9 < total < 1 + 1e-6


class Frame:
    """A frame that keeps the function that it would run in tasks."""

    sparkSession = None

    def select(self, *_):
        return self

    groupBy = agg = join = select

    def mapInArrow(self, run, _):
        self.run = run
        return self


@pytest.mark.parametrize("step", ["places", "shingle_counts"])
def test_decontamination_holds_little_and_gives_memory_back(spark, monkeypatch, prose, step):
    held, back = [], []
    monkeypatch.setattr(decontaminate, "strings", lambda column: held.append(column.nbytes) or strings(column))
    monkeypatch.setattr(decontaminate, "give_back", lambda: back.append(1), raising=False)
    monkeypatch.setattr(decontaminate, "_filter", lambda *_: SimpleNamespace(value=np.zeros(decontaminate.FILTER_BITS // 64, np.int64)))
    monkeypatch.setattr(decontaminate, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = [prose(1, 20_000)] * 40
    batch = pa.record_batch([pa.array(range(40)), pa.array(texts)], names=["doc_id", "text"])
    frame = getattr(decontaminate, step)(Frame(), Frame(), [3])
    list(frame.run([batch]))
    assert batch.nbytes > 4 << 20 and len(held) > 1 and max(held) < 5 << 19 and back == [1]


@pytest.mark.parametrize("step", ["_with_leaders", "_across"])
def test_sets_of_near_duplicates_end_with_the_task(monkeypatch, step):
    back = []
    monkeypatch.setattr(minhash, "give_back", lambda: back.append(1), raising=False)
    read = minhash._Sets("nowhere")
    read.files["a"], read.held["a", 0] = np.zeros(1), np.zeros(1)
    assert list(getattr(minhash, step)([], read, 75)) == []
    assert not read.files and not read.held and back == [1]
