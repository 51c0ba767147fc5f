import random
import zlib

import numpy as np
import pytest
from linkrank.llm import quality, toxicity
from linkrank.llm.shared import labelled_sample
from pyspark.sql import functions as F


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0


@pytest.fixture(scope="module")
def labelled(spark, prose):
    draw = random.Random(6)
    docs, labels = [], []
    for i in range(600):
        text, bad, toxic = prose(2000 + i, 80), draw.random() < 0.3, draw.random() < 0.2
        if bad:
            text = text.upper().replace(" ", " ### ")
        if toxic:
            own = text.split(" ")
            for word in draw.sample(("gronkeltz", "vorpluntik", "gronkeltzed"), 2):
                own.insert(draw.randint(0, len(own)), word)
            text = " ".join(own)
        docs.append((i, text, "en", "s", 0.5))
        labels.append((i, int(not bad), int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, score double").repartition(3),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


@pytest.mark.parametrize("scores,target,edge", [(quality.quality_scores, "quality", 0.3), (toxicity.toxicity_scores, "toxic", 0.5)])
def test_held_out_accuracy(labelled, scores, target, edge):
    docs, labels = labelled
    rows = scores(docs, labels).toPandas()
    assert list(rows.columns) == ["doc_id", "held_out", "score", "predicted"] and len(rows) == 600
    assert rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= edge)).all()
    assert (rows.held_out == rows.doc_id.map(held)).all()
    both = rows.merge(labels.toPandas(), on="doc_id")
    both = both[both.held_out]
    assert (both[target] == both.predicted).mean() > 0.97


@pytest.mark.parametrize("scores,target", [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_held_out_labels_are_not_read(labelled, scores, target):
    docs, labels = labelled
    turned = labels.withColumn(target, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col(target)).otherwise(F.col(target)))
    run = lambda own: sorted(map(tuple, scores(docs, own).collect()))
    assert run(labels) == run(turned)


@pytest.mark.parametrize("scores,target,default", [(quality.quality_scores, "quality", 1), (toxicity.toxicity_scores, "toxic", 0)])
def test_odd_rows_and_labels(spark, odd_docs, no_docs, labelled, scores, target, default):
    none = spark.createDataFrame([], f"doc_id long, {target} int, text int")
    assert {r.predicted for r in scores(odd_docs, none).collect()} == {default}
    assert scores(no_docs, labelled[1]).count() == 0
    odd = [(None, 1), (1, None), (4, 1), (5, 1), (5, 0), (8, 0), (8, 0), (99, 1), (4, 7)]
    rows = scores(odd_docs, spark.createDataFrame(odd, f"doc_id long, {target} int")).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)


def test_sample_is_bounded(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(500)], "doc_id long, toxic int")
    rows = labelled_sample(labels, "toxic", 50).collect()
    assert len(rows) == 100 and not any(held(r.doc_id) for r in rows)
    usable = sum(not held(i) for i in range(0, 500, 2))
    assert all(r.weight == pytest.approx(usable / 50) for r in rows if r.label == 0)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, labelled_sample(labels.repartition(7), "toxic", 50).collect()))


def test_rules_compile_to_their_meaning(spark):
    draw = np.random.Generator(np.random.PCG64(3))
    x = draw.random((400, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 1] < 0.4)).astype(float)
    rules = quality.tree_rules(x, y, np.ones(400))
    matrix = np.stack([quality.fires(r, x) for r in rules], axis=1).astype(float)
    intercept, weights = quality.lasso(matrix, y, np.ones(400))
    kept = [(r, float(w)) for r, w in zip(rules, weights, strict=True) if w]
    assert 0 < len(kept) < len(rules)  # sparse
    margin = intercept + sum(w * quality.fires(r, x) for r, w in kept)
    assert ((margin > 0) == (y == 1)).mean() > 0.97
    model = quality.RuleModel(["a", "b", "c"], kept, intercept)
    frame = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "i int, a double, b double, c double")
    found = np.array([r.s for r in frame.select("i", model.score().alias("s")).orderBy("i").collect()])
    assert np.allclose(found, 1 / (1 + np.exp(-margin)))


def test_ngrams_of_words():
    import pyarrow as pa
    from linkrank.llm.text import strings

    one = toxicity.text_features(strings(pa.array(["ab cd", "cd AB ab", "", None])))
    first, second = one[1][one[0] == 0], one[1][one[0] == 1]
    assert set(first) == set(second) and len(first) == 2 * 3  # " ab", "ab ", " ab " and those of cd
    assert not (one[0] >= 2).any()


def test_statistics_are_evaluated_once(labelled, capsys):
    docs, labels = labelled
    model = quality.fit(docs, labels)
    quality.scored(docs, model, "q").filter("q >= 0.3").explain("formatted")
    assert capsys.readouterr().out.count("translate(") < 10


def test_rare_toxic_words_are_learned(spark, prose):
    """Each toxic word occurs in a few labelled rows only."""
    draw = random.Random(12)
    lexicon = ["".join(draw.choices("gvwxzkjpd", k=9)) for _ in range(60)]
    docs, labels = [], []
    for i in range(1500):
        own = prose(7000 + i, 40).split(" ")
        if i % 5 == 0:
            own.insert(draw.randint(0, len(own)), lexicon[i // 5 % 60])
        docs.append((i, " ".join(own)))
        labels.append((i, int(i % 5 == 0)))
    seen = {w: sum(i % 5 == 0 and lexicon[i // 5 % 60] == w and not held(i) for i in range(1500)) for w in lexicon}
    assert max(seen.values()) <= 5
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = toxicity.toxicity_scores(frame, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    rows = [r for r in rows if r.held_out and (r.doc_id % 5 or seen[lexicon[r.doc_id // 5 % 60]] > 1)]
    caught = [r.predicted for r in rows if r.doc_id % 5 == 0]
    assert len(caught) > 30 and np.mean(caught) > 0.9
    assert np.mean([r.predicted for r in rows if r.doc_id % 5]) < 0.02


def test_training_reaches_the_optimum():
    """Against the conditions of the optimum on a small dense matrix, with columns that are alike."""
    draw = np.random.default_rng(4)
    n, k = 400, 60
    dense = draw.random((n, k)) < draw.uniform(0.02, 0.5, k)
    dense[:, 50:] = dense[:, :10]
    value = draw.normal(0, 1, k)
    value[50:] = value[:10]
    y = (dense @ (value * draw.normal(0, 1, k)) + draw.normal(0, 1, n) > 0).astype(float)
    weight = np.where(y == 1, 1.0, 2.5)
    bounds, column = np.concatenate([[0], np.cumsum(dense.sum(axis=1))]), np.nonzero(dense)[1].astype(np.int32)
    intercept, w = toxicity._train(bounds, column, value, y, weight)
    share, x = weight / weight.sum(), dense * value
    gradient = lambda i, v: x.T @ (share * (1 / (1 + np.exp(-(i + x @ v))) - y))
    first = np.abs(gradient(0.0, np.zeros(k))).max()
    at = gradient(intercept, w) + toxicity.RIDGE * w
    off = np.where(w != 0, np.abs(at + toxicity.LASSO * np.sign(w)), np.maximum(np.abs(at) - toxicity.LASSO, 0))
    assert off.max() <= 2 * toxicity.TOLERANCE * first
    assert np.allclose(w[:10], w[50:]) and np.count_nonzero(w)


def test_columns_in_the_same_rows_are_one_group():
    dense = np.array([[1, 1, 0, 0, 1], [1, 1, 1, 0, 1], [0, 0, 1, 1, 0]], bool)
    bounds, column = np.concatenate([[0], np.cumsum(dense.sum(axis=1))]), np.nonzero(dense)[1].astype(np.int32)
    group, members = toxicity._alike(bounds, column, 5, toxicity._blocks(bounds))
    assert group[0] == group[1] == group[4] and len(set(group.tolist())) == 3 and sorted(members.tolist()) == [1, 1, 3]


def test_packed_columns_take_half_the_room_and_train_alike():
    """Before, the driver held 32 bits for each n-gram of the sample, and a round's part of them as well."""
    draw = np.random.default_rng(5)
    n, k, own = 300, 150_000, 4_000
    rows = [np.unique(draw.integers(0, k, own) // draw.integers(1, 300, own)).astype(np.int32) for _ in range(n)]
    rows[7] = rows[7][:0]
    bounds, column = np.concatenate([[0], np.cumsum([len(r) for r in rows])]), np.concatenate(rows)
    packed = toxicity._Packed(len(column))
    for at, row in zip(bounds, rows, strict=False):
        packed.put(at, row)
    packed.seal()
    assert packed.low.nbytes + packed.starts.nbytes + packed.high.nbytes < 2.1 * len(column)
    for start, stop in [(0, 0), (0, 1), (9, 9), (bounds[7], bounds[8]), (5, len(column)), *draw.integers(0, len(column), (50, 2))]:
        assert np.array_equal(packed[start:stop], column[start:stop])
    value, y, weight = draw.normal(0, 1, k), (draw.random(n) < 0.3).astype(float), draw.uniform(1, 2, n)
    plain, other = (toxicity._train(bounds, c, value, y, weight) for c in (column, packed))
    assert plain[0] == other[0] and np.array_equal(plain[1], other[1]) and np.count_nonzero(plain[1])
    new = np.where(np.arange(k) % 3, -1, np.arange(k) // 3).astype(np.int32)
    kept = new[column][new[column] >= 0]
    assert np.array_equal(toxicity._restricted(bounds, packed, new, len(kept))[1], kept)
    assert toxicity._restricted(bounds, packed, new, len(kept))[1].dtype == np.uint16


def test_empty_packed_columns():
    packed = toxicity._Packed(0)
    packed.put(0, np.zeros(0, np.int32))
    packed.seal()
    assert len(packed) == 0 and len(packed[0:0]) == 0
