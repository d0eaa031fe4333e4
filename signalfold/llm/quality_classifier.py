"""Quality classifier: a sparse rule ensemble.

Shallow trees are boosted on labelled documents' statistics. Each path from a root is a rule: a conjunction of
conditions. A logistic model with a lasso penalty weighs the rules and leaves most at zero; the others are compiled
into one Spark column over the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalfold.llm.stats import COUNTS, bounded_sample, document_stats, features
Condition = tuple[int, bool, float]  # feature, whether above (else at most), value


@dataclass(frozen=True)
class Ensemble:
    trees: int = 40
    depth: int = 3
    rate: float = 0.3
    bins: int = 32
    leaf: int = 10  # least rows on either side of a split
    lasso: float = 0.001
    steps: int = 400
    sample: int = 20_000  # labelled rows that reach the driver, drawn by a hash
    seed: int = 5


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def column(self) -> Column:
        """The score as a column over the statistics of ``document_stats``."""
        by = list(features().values())

        def holds(rule: tuple[Condition, ...]) -> Column:
            tests = [by[f] > v if above else by[f] <= v for f, above, v in rule]
            return reduce(lambda a, b: a & b, tests)

        total = reduce(lambda a, b: a + b, [F.when(holds(r), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.rules], F.lit(self.intercept))
        return 1 / (1 + F.exp(-total))


def _split(binned: np.ndarray, gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray, rule: Ensemble) -> tuple[int, int] | None:
    """The (feature, bin) whose split at most / above lowers the loss most."""
    best, found = 1e-6, None
    all_g, all_w = gradient[rows].sum(), weight[rows].sum()
    for f in range(binned.shape[1]):
        own = binned[rows, f]
        g = np.cumsum(np.bincount(own, gradient[rows], rule.bins))[:-1]
        w = np.cumsum(np.bincount(own, weight[rows], rule.bins))[:-1]
        n = np.cumsum(np.bincount(own, minlength=rule.bins))[:-1]
        able = (n >= rule.leaf) & (len(rows) - n >= rule.leaf)
        gain = np.where(able, g**2 / (w + 1) + (all_g - g) ** 2 / (all_w - w + 1) - all_g**2 / (all_w + 1), 0)
        if gain.max() > best:
            best, found = float(gain.max()), (f, int(gain.argmax()))
    return found


def grow_rules(points: np.ndarray, good: np.ndarray, rule: Ensemble) -> list[tuple[Condition, ...]]:
    """The distinct paths of the boosted trees, without the roots."""
    edges = [np.unique(np.quantile(points[:, f], np.linspace(0, 1, rule.bins + 1)[1:-1])) for f in range(points.shape[1])]
    binned = np.column_stack([np.searchsorted(e, points[:, f], side="left") for f, e in enumerate(edges)])
    rng, paths, score = np.random.default_rng(rule.seed), {}, np.zeros(len(points))
    for _ in range(rule.trees):
        chance = 1 / (1 + np.exp(-score))
        gradient, weight = good - chance, chance * (1 - chance)
        drawn = rng.random(len(points)) < 0.5
        todo = [(np.arange(len(points)), ())]
        while todo:
            rows, path = todo.pop()
            inside = rows[drawn[rows]]
            at = _split(binned, gradient, weight, inside, rule) if len(path) < rule.depth and len(inside) else None
            if at is None:
                if len(rows):
                    score[rows] += rule.rate * gradient[rows].sum() / (weight[rows].sum() + 1)
                continue
            f, b = at
            value = float(edges[f][b]) if b < len(edges[f]) else float(points[:, f].max())
            above = points[rows, f] > value
            for side in (True, False):
                longer = (*path, (f, side, value))
                paths[tuple(sorted(longer))] = longer
                todo.append((rows[above == side], longer))
    return list(paths.values())


def applies(points: np.ndarray, rules: list[tuple[Condition, ...]]) -> np.ndarray:
    """One 0/1 column for each rule."""
    table = np.ones((len(points), len(rules)), dtype=np.float64)
    for k, rule in enumerate(rules):
        for f, above, value in rule:
            table[:, k] *= (points[:, f] > value) if above else (points[:, f] <= value)
    return table


def lasso_logistic(table: np.ndarray, good: np.ndarray, rule: Ensemble) -> tuple[float, np.ndarray]:
    """(intercept, weights) of the penalised logistic model, by accelerated proximal gradient steps."""
    n, k = table.shape
    weights, intercept = np.zeros(k), float(np.log((good.sum() + 1) / (n - good.sum() + 1)))
    ahead, ahead_0, pace = weights.copy(), intercept, 1.0
    size = 4 * n / (np.linalg.norm(np.column_stack([table, np.ones(n)]), 2) ** 2)
    for _ in range(rule.steps):
        off = 1 / (1 + np.exp(-(table @ ahead + ahead_0))) - good
        step = ahead - size * (table.T @ off) / n
        new = np.sign(step) * np.maximum(np.abs(step) - size * rule.lasso, 0)
        new_0 = ahead_0 - size * float(off.mean())
        after = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead, ahead_0 = new + (pace - 1) / after * (new - weights), new_0 + (pace - 1) / after * (new_0 - intercept)
        weights, intercept, pace = new, new_0, after
    return intercept, weights


def fit_rules(points: np.ndarray, good: np.ndarray, rule: Ensemble) -> RuleModel:
    """A constant 0.5 without rows; the share of good rows where they all are alike."""
    if not len(points):
        return RuleModel(0.0, ())
    rules = grow_rules(points, good, rule) if 0 < good.sum() < len(good) else []
    if not rules:
        return RuleModel(float(np.log((good.sum() + 1) / (len(good) - good.sum() + 1))), ())
    intercept, weights = lasso_logistic(applies(points, rules), good, rule)
    return RuleModel(intercept, tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6))


def learn_quality(stats: DataFrame, labels: DataFrame, rule: Ensemble = Ensemble()) -> RuleModel:
    """A model from ``stats`` (_id, ``COUNTS``) and ``labels`` (_id, _label); ids with several labels count as the lowest."""
    told = labels.where("_label is not null and _id is not null").groupBy("_id").agg(F.min("_label").alias("_label"))
    drawn = bounded_sample(stats.join(told, "_id"), F.struct("_id", *COUNTS), rule.sample, rule.seed)
    rows = drawn.select((F.col("_label") > 0).cast("double").alias("_good"), *[c.alias(n) for n, c in features().items()])
    drawn = rows.toPandas().to_numpy(dtype=np.float64)
    return fit_rules(drawn[:, 1:], drawn[:, 0], rule)


def score_quality(stats: DataFrame, model: RuleModel) -> DataFrame:
    """``stats`` with the score, in Spark columns."""
    return stats.withColumn("score", model.column())


def quality_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``document_stats`` with the id as ``_id``.

    Null and empty texts have no words and get the score of such texts; texts of any length count whole; repeated rows
    and null ids are rows like any other (a null id has no label); an empty table has no rows.
    """
    return document_stats(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_id", "_text")
