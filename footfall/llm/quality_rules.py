"""Quality by a sparse ensemble of rules over text statistics.

Small trees are boosted on a bounded sample of labelled rows; every path from a root is a rule,
a conjunction of comparisons. A logistic model with a lasso penalty weighs the rules and drops
most of them; what is left becomes one Spark expression over the statistics' columns (Friedman
and Popescu, 2008)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import staged
from footfall.llm.labelled import fold, training_labels
from footfall.llm.text_stats import STATS, text_stats

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
#: Labelled rows to learn from, at most, of each class.
SAMPLE_PER_CLASS = 15_000

TREES, DEPTH, BINS, RATE = 40, 3, 64, 0.3
LASSO, LASSO_STEPS = 2e-4, 400

#: (statistic, "<=" or ">", threshold)
Condition = tuple[str, str, float]


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def score(self) -> Column:
        """The probability of label 1 as an expression over the statistics."""
        total = F.lit(self.intercept)
        for conditions, weight in self.rules:
            tests = [F.col(s) <= t if op == "<=" else F.col(s) > t for s, op, t in conditions]
            total = total + F.when(reduce(Column.__and__, tests), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def tree_rules(x: np.ndarray, y: np.ndarray, weight: np.ndarray, names: list[str]) -> list[tuple[Condition, ...]]:
    """The distinct paths of boosted trees, grown on quantile bins by second-order gains."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T)], 1)
    rng = np.random.default_rng(7)
    total, found = np.zeros(len(y)), {}

    def split(rows: np.ndarray, g: np.ndarray, h: np.ndarray):
        best = (1e-6, None, None)
        whole = g[rows].sum() ** 2 / (h[rows].sum() + 1)
        for f in range(x.shape[1]):
            sums = [np.cumsum(np.bincount(binned[rows, f], v[rows], len(cuts[f]) + 1))[:-1] for v in (g, h)]
            rest = g[rows].sum() - sums[0], h[rows].sum() - sums[1]
            gain = sums[0] ** 2 / (sums[1] + 1) + rest[0] ** 2 / (rest[1] + 1) - whole
            gain[(sums[1] < 1e-3) | (rest[1] < 1e-3)] = -1
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), f, int(gain.argmax()))
        return best[1:]

    for _ in range(TREES):
        p = _sigmoid(total)
        g, h = weight * (y - p), weight * p * (1 - p)
        drawn = rng.random(len(y)) < 0.6
        step = np.zeros(len(y))
        nodes = [((), np.ones(len(y), bool))]
        for depth in range(DEPTH + 1):
            below = []
            for path, inside in nodes:
                rows = np.flatnonzero(inside & drawn)
                f, at = split(rows, g, h) if depth < DEPTH and len(rows) > 20 else (None, None)
                if path:
                    found.setdefault(path)
                if f is None:
                    step[inside] = g[rows].sum() / (h[rows].sum() + 1)
                    continue
                left = binned[:, f] <= at
                threshold = float(cuts[f][at])
                below += [(path + ((names[f], "<=", threshold),), inside & left), (path + ((names[f], ">", threshold),), inside & ~left)]
            nodes = below
        total += RATE * step
    return list(found)


def _matches(x: np.ndarray, names: list[str], rules: list[tuple[Condition, ...]]) -> np.ndarray:
    column = {n: x[:, i] for i, n in enumerate(names)}
    tests = [[column[s] <= t if op == "<=" else column[s] > t for s, op, t in rule] for rule in rules]
    return np.stack([reduce(np.logical_and, t) for t in tests], 1).astype(np.float64) if rules else np.empty((len(x), 0))


def lasso_logistic(r: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, steps: int) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient; the intercept is not penalised."""
    share = weight / weight.sum()
    one = np.c_[np.ones(len(r)), r]
    v = np.ones(one.shape[1])
    for _ in range(20):  # the largest eigenvalue bounds the curvature
        v = one.T @ (share * (one @ v))
        norm = np.linalg.norm(v)
        v /= norm
    rate = 4 / (1.05 * norm)
    b = z = np.zeros(one.shape[1])
    t = 1.0
    for _ in range(steps):
        new = z - rate * (one.T @ (share * (_sigmoid(one @ z) - y)))
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty, 0)
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        z, b = new + (before - 1) / t * (new - b), new
    return float(b[0]), b[1:]


def fit_rules(x: np.ndarray, y: np.ndarray, weight: np.ndarray, names: list[str] = STATS) -> RuleModel:
    """Rules and weights. Without rows the score is one half; with one class only, its rate."""
    if len(set(y.tolist())) < 2:
        return RuleModel(float(np.log((y.sum() + 0.5) / ((1 - y).sum() + 0.5))), ())
    rules = tree_rules(x, y, weight, names)
    intercept, weights = lasso_logistic(_matches(x, names, rules), y, weight, LASSO, LASSO_STEPS)
    kept = tuple((rule, float(w)) for rule, w in zip(rules, weights) if w)
    return RuleModel(intercept, kept)


def learn_quality(stats: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> RuleModel:
    """From the labelled rows of ``stats`` that are not held out."""
    wanted = F.broadcast(training_labels(labels, "quality", FOLDS, HELD_OUT, per_class))  # 2 * per_class rows
    # Sorted, as sums of floats depend on their order; repeated ids beyond the bound are left out.
    rows = stats.join(wanted, "doc_id").orderBy("doc_id", *STATS).limit(2 * per_class).toPandas()
    return fit_rules(rows[STATS].to_numpy(), rows["y"].to_numpy(np.float64), rows["weight"].to_numpy())


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and the statistics of every row of ``docs``.

    A null text is empty, and scored; repeated rows give repeated rows. With no labels at all
    every score is one half."""
    stats = staged(text_stats(docs), "stats")
    model = learn_quality(stats, labels)
    return stats.select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        model.score().alias("score"),
        *STATS,
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
