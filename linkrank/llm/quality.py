"""A quality classifier as a sparse ensemble of rules, compiled into column expressions.

Statistics of the text are column expressions.  Boosted shallow trees over the statistics of
a bounded sample of labelled rows give paths; every path from a root is a conjunctive rule.  A
logistic model with lasso weights over the rules keeps few of them, and these become one
column expression: scoring runs in the JVM, in the scan's own stage.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.llm.shared import labelled_sample, remainder

#: Labelled rows of each label that the model is fitted on, at most.
SAMPLE = 8_000
THRESHOLD = 0.3
TREES = 30
DEPTH = 3
LEAF = 10
BINS = 32
SHRINKAGE = 0.3
LASSO = 1e-3
STEPS = 400
SEED = 5

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text that is not null, each 0 for the empty one."""
    length = F.length(text).cast("double")
    count = lambda characters: length - F.length(F.translate(text, characters, ""))
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
    lines, blanks = F.split(text, "\n"), F.split(text, " ")
    return {
        "chars": length,
        "word_chars": share(length, F.size(blanks)),
        "distinct_words": share(F.size(F.array_distinct(blanks)), F.size(blanks)),
        "distinct_lines": share(F.size(F.array_distinct(lines)), F.size(lines)),
        "line_chars": share(length, F.size(lines)),
        "symbols": share(count("#*$%&|<>"), length),
        "marks": share(count("!?"), length),
        "stops": share(count(".,;:"), length),
        "capitals": share(count(_CAPITALS), length),
        "digits": share(count("0123456789"), length),
        "wide": share(F.octet_length(text) - length, length),
    }


Condition = tuple[int, bool, float]  # feature, whether it must exceed the value, value
Rule = tuple[Condition, ...]


def _split(x, codes, edges, residual, rows):
    """The (feature, bin) that lowers the squared error most, or None."""
    best, best_gain = None, 1e-9
    n, total = len(rows), residual[rows].sum()
    for f in range(x.shape[1]):
        m = len(edges[f])
        counts = np.bincount(codes[rows, f], minlength=m + 1)[:m].cumsum()
        sums = np.bincount(codes[rows, f], weights=residual[rows], minlength=m + 1)[:m].cumsum()
        valid = (counts >= LEAF) & (n - counts >= LEAF)
        if not valid.any():
            continue
        left, right = np.maximum(counts, 1), np.maximum(n - counts, 1)
        gain = np.where(valid, sums**2 / left + (total - sums) ** 2 / right - total**2 / n, 0)
        k = int(gain.argmax())
        if gain[k] > best_gain:
            best, best_gain = (f, k), gain[k]
    return best


def tree_rules(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[Rule]:
    """The paths of boosted trees, from the root to every node below it, each once."""
    draw = np.random.Generator(np.random.PCG64(SEED))
    edges = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T]
    codes = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    margin = np.zeros(len(y))
    rules: dict[Rule, None] = {}
    for _ in range(TREES):
        probability = 1 / (1 + np.exp(-margin))
        residual = y - probability
        bag = np.flatnonzero(draw.random(len(y)) < 0.5)

        def grow(rows, everywhere, path, residual=residual, probability=probability):
            found = _split(x, codes, edges, residual, rows) if len(path) < DEPTH and len(rows) >= 2 * LEAF else None
            if found is None:
                curve = (probability[rows] * (1 - probability[rows])).sum()
                margin[everywhere] += SHRINKAGE * np.clip(residual[rows].sum() / max(curve, 1e-6), -4, 4)
                return
            f, k = found
            for above in (False, True):
                own = path + ((f, above, float(edges[f][k])),)
                rules[tuple(sorted(own))] = None
                side = (codes[:, f] > k) == above
                grow(rows[side[rows]], everywhere[side[everywhere]], own)

        if len(bag) >= 2 * LEAF:
            grow(bag, np.arange(len(y)), ())
    return list(rules)


def fires(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, above, value in rule:
        out &= (x[:, f] > value) == above
    return out


def lasso(matrix: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Intercept and weights of the L1-penalised weighted logistic loss, by accelerated
    proximal gradient steps."""
    n, k = matrix.shape
    share = weight / weight.sum()
    full = np.hstack([np.ones((n, 1)), matrix])
    power = np.ones(k + 1)
    for _ in range(30):  # the largest curvature bounds the step
        power = full.T @ (share * (full @ power))
        power /= np.linalg.norm(power)
    step = 4 / max(float(power @ (full.T @ (share * (full @ power)))), 1e-12)
    w = z = np.zeros(k + 1)
    t = 1.0
    for _ in range(STEPS):
        gradient = full.T @ (share * (1 / (1 + np.exp(-(full @ z))) - y))
        new = z - step * gradient
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * LASSO, 0)
        following = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / following * (new - w)
        w, t = new, following
    return float(w[0]), w[1:]


@dataclass
class RuleModel:
    features: list[str]
    rules: list[tuple[Rule, float]]
    intercept: float

    def score(self) -> Column:
        """The probability of label 1 as an expression over the features' columns."""
        margin = F.lit(self.intercept)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for f, above, value in rule:
                column = F.col(self.features[f])
                holds &= (column > value) if above else (column <= value)
            margin += F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-margin))


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality") -> RuleModel:
    """A model of ``labels.<target>`` from the statistics of at most SAMPLE training rows of
    each label.  Without both labels it is constant: the only label, or 1 without any."""
    chosen = F.broadcast(labelled_sample(labels, target, SAMPLE))
    measures = statistics(F.coalesce("text", F.lit("")))
    rows = (
        docs.select("doc_id", "text")
        .join(chosen, "doc_id")
        .select("doc_id", "label", "weight", *[c.alias(n) for n, c in measures.items()])
        .dropDuplicates(["doc_id"])
        .toPandas()
        .sort_values("doc_id")
    )
    names = list(measures)
    y = rows["label"].to_numpy(dtype=float)
    if len(np.unique(y)) < 2:
        return RuleModel(names, [], 20.0 if not len(y) or y[0] == 1 else -20.0)
    x, weight = rows[names].to_numpy(dtype=float), rows["weight"].to_numpy(dtype=float)
    rules = tree_rules(x, y, weight)
    if not rules:
        mean = float((weight * y).sum() / weight.sum())
        return RuleModel(names, [], float(np.log(mean / (1 - mean))))
    matrix = np.stack([fires(r, x) for r in rules], axis=1).astype(float)
    intercept, weights = lasso(matrix, y, weight)
    return RuleModel(names, [(r, float(w)) for r, w in zip(rules, weights, strict=True) if w], intercept)


def scored(docs: DataFrame, model: RuleModel, out: str = "quality_score") -> DataFrame:
    """``docs`` with the score of its text; other columns may have any name.

    The statistics go through a generator: Spark would otherwise write their expressions out
    again at every condition of the rules, and below filters on the score.
    """
    measures = statistics(F.coalesce("text", F.lit("")))
    names = {n: f"__statistic_{n}" for n in model.features}
    features = RuleModel([names[n] for n in model.features], model.rules, model.intercept)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != out]
    once = F.array(F.struct(*[c.alias(names[n]) for n, c in measures.items()]))
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.inline(once)).select(
        *rest, features.score().alias(out)
    )


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of (doc_id, text).

    ``score`` is the probability of label 1; a null text scores as the empty one.  Rows of
    ``labels`` (doc_id, quality) whose id has the remainder 0 are never learned from, and
    neither are ids without text, label or with both labels.  Texts do not move.
    """
    model = fit(docs, labels)
    rows = scored(docs.select("doc_id", "text"), model, "score")
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (remainder("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
