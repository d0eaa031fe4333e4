"""Quality rules: fixed base rules, and an isolation forest over the rule statistics.

A forest of random trees is grown on small random samples of documents: each node splits a random feature at a
random value. A document that random splits set apart after few steps is unlike the others. Its anomaly score is
2 ** (-mean path length / expected path length); the limit is calibrated on labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalfold.llm.components import stored
from signalfold.llm.stats import COUNTS, bounded_sample, document_stats, features

# without log_words and repeats: n_words and n_repeat_words are what the base rules read (README: what they would cost)
FEATURES = ("word_length", "symbols", "dup_lines", "line_words", "upper", "digits", "marks", "bangs", "bars", "short")


def _looked_at() -> list[Column]:
    return [c.alias(n) for n, c in features().items() if n in FEATURES]


@dataclass(frozen=True)
class Forest:
    trees: int = 200
    sample: int = 64  # documents per tree: the sample that defines the method; trees * sample rows reach the driver
    seed: int = 3


@dataclass(frozen=True)
class Limit:
    """The highest share of labelled good documents that the limit may reject, and the steps in which scores are binned."""

    lost: float = 0.005
    bins: int = 2000


def _expected(n: np.ndarray | int) -> np.ndarray:
    """The mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=np.float64)
    big = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(big - 1) + np.euler_gamma) - 2 * (big - 1) / big, np.where(n == 2, 1.0, 0.0))


def grow(points: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """One tree as rows (feature or -1, value or path length, left, right)."""
    deepest = int(np.ceil(np.log2(max(2, len(points)))))
    nodes: list[list[float]] = []
    todo = [(points, 0, -1, 0)]
    while todo:
        own, depth, parent, side = todo.pop()
        me = len(nodes)
        if parent >= 0:
            nodes[parent][2 + side] = me
        spread = np.flatnonzero(np.ptp(own, axis=0) > 0) if len(own) > 1 else np.zeros(0, dtype=int)
        if depth >= deepest or not len(spread):
            nodes.append([-1, depth + float(_expected(len(own))), 0, 0])
            continue
        f = int(rng.choice(spread))
        low, high = own[:, f].min(), own[:, f].max()
        at = rng.uniform(low, high)
        goes = own[:, f] <= at
        nodes.append([f, at, 0, 0])
        todo += [(own[~goes], depth + 1, me, 1), (own[goes], depth + 1, me, 0)]
    return np.array(nodes)


def path_scores(points: np.ndarray, trees: list[np.ndarray], sample: int) -> np.ndarray:
    """Anomaly scores from 0 to 1 of the points; 0.5 without trees."""
    if not trees:
        return np.full(len(points), 0.5)
    total = np.zeros(len(points))
    rows = np.arange(len(points))
    for tree in trees:
        at = np.zeros(len(points), dtype=np.int64)
        while True:
            f = tree[at, 0].astype(np.int64)
            inner = f >= 0
            if not inner.any():
                break
            left = points[rows, np.maximum(f, 0)] <= tree[at, 1]
            at = np.where(inner, np.where(left, tree[at, 2], tree[at, 3]).astype(np.int64), at)
        total += tree[at, 1]
    expected = float(_expected(sample)) or 1.0
    return 2.0 ** (-total / len(trees) / expected)


def fit_forest(stats: DataFrame, rule: Forest) -> list[np.ndarray]:
    """Trees on a sample drawn by a hash of the statistics' row, a bounded number of rows."""
    drawn = bounded_sample(stats, F.struct("_id", *COUNTS), rule.trees * rule.sample, rule.seed)
    drawn = drawn.select(*_looked_at()).toPandas()[list(FEATURES)].to_numpy(dtype=np.float64)
    if len(drawn) < 2:
        return []
    rng = np.random.default_rng(rule.seed)
    drawn = drawn[rng.permutation(len(drawn))]
    # with fewer rows than trees * sample, each tree takes its own random part
    parts = [drawn[k * rule.sample : (k + 1) * rule.sample] for k in range(rule.trees)]
    if len(drawn) < rule.trees * rule.sample:
        parts = [drawn[rng.choice(len(drawn), min(rule.sample, len(drawn)), replace=False)] for _ in range(rule.trees)]
    return [grow(p, rng) for p in parts]


def _scorer(trees: list[np.ndarray], sample: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES]).astype(np.float64)
            rest = [n for n in batch.schema.names if n not in FEATURES]
            yield pa.record_batch([*(batch.column(n) for n in rest), pa.array(path_scores(points, trees, sample))], names=[*rest, "anomaly"])

    return run


def calibrate(scored: DataFrame, labels: DataFrame, limit: Limit) -> float:
    """The lowest score from which on documents are rejected, so that of all labelled documents the share of good ones
    lost stays within ``limit.lost`` and as many bad ones as possible go; above 1 if nothing may go."""
    told = labels.where("_label is not null and _id is not null").groupBy("_id").agg(F.min("_label").alias("_label"))
    bins = scored.join(told, "_id").groupBy(F.floor(F.col("anomaly") * limit.bins).alias("bin"), (F.col("_label") > 0).alias("good")).count().collect()
    good = sum(r["count"] for r in bins if r["good"])
    lost, found = 0, 2.0
    for b in sorted({r["bin"] for r in bins}, reverse=True):
        lost += sum(r["count"] for r in bins if r["bin"] == b and r["good"])
        if lost > limit.lost * good:
            break
        found = b / limit.bins
    return found


def quality_rules(
    docs: DataFrame, labels: DataFrame, forest: Forest = Forest(), limit: Limit = Limit(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """(id, ``COUNTS``, base_failed, anomaly, anomaly_limit, kept) for each row of ``docs``.

    base_failed: fewer than 20 words, or more than 30 % of them in repeated 8-word windows. kept: passed the base
    rules and is below the limit. The forest is fitted on documents that pass the base rules, the limit on those
    of them that have a label. Null texts have no words, so they fail. Without documents to fit on or without labels,
    nothing is rejected but by the base rules. Several labels of an id count as the lowest. Repeated rows and null ids are
    rows like any other; other columns are not read.
    """
    stats = stored(document_stats(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_id", "_text"), "stats")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    passed = stats.where(~failed)
    trees = fit_forest(passed, forest)
    size = min(forest.sample, max((len(t) for t in trees), default=2))
    columns = ["_id", *COUNTS]
    kind = stats.schema["_id"].dataType.simpleString()
    schema = ", ".join([f"_id {kind}", *(f"{c} long" for c in COUNTS), "base_failed boolean", "anomaly double"])
    told = stats.select(*columns, failed.alias("base_failed"), *_looked_at())
    scored = told.mapInArrow(_scorer(trees, size), schema)
    cut = calibrate(scored.where("not base_failed"), labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label")), limit)
    kept = ~F.col("base_failed") & (F.col("anomaly") < cut)
    return scored.select(F.col("_id").alias(id_col), *COUNTS, "base_failed", "anomaly", F.lit(cut).alias("anomaly_limit"), kept.alias("kept"))
