"""Ranked search, resampling and the pivot index against brute force."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalfold.llm import pivot_index, ranked_search as search_module, resampling
from signalfold.llm.pivot_index import Pivots, embedding_near_duplicates, shared_pivots
from signalfold.llm.ranked_search import ranked_search
from signalfold.llm.resampling import Dictionary, feature_buckets, learn_dictionary, resample

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ODD = [None, "", " \t\n", "...", "One one ONE", "été ÉTÉ été", "a\x00b\x01c\x01\x01d", "x" * 300, "w1 " * 5000, "日本語 w1"]


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def texts(seed, n=150):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(3000)]
    found = [" ".join(rng.choices(words, k=rng.choice([1, 3, 19, 20, 40, 200]))) for _ in range(n)]
    return [*ODD, *found, *found[:20], *[found[0].upper()] * 15]


def test_dictionary_composes_checksums():
    rng = random.Random(3)
    words = ["".join(rng.choice("abé0") for _ in range(rng.choice([1, 2, 7, 64, 65, 400]))) for _ in range(120)]
    known = Dictionary([w.encode() for w in words[:70] if len(w.encode()) <= resampling.LONGEST])
    lines = [" ".join(rng.choices(words, k=k)) for k in (0, 1, 2, 3, 50, 0, 9)]
    line = re.sub("  +", " ", " " + " \x01 ".join(lines) + " ")
    text, bucket, _ = feature_buckets(line.encode(), known, 1009)
    expected = []
    for k, line in enumerate(lines):
        w = line.split()
        expected += [(k, zlib.crc32(" ".join(w[i : i + n]).encode()) % 1009) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    assert sorted(zip(text.tolist(), bucket.tolist(), strict=True)) == sorted(expected)


def brute_resample(docs, target, percent, least, buckets=10_000):
    def features(text):
        w = terms(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    s, t = Counter(b for _, x in docs for b in features(x)), Counter(b for x in target for b in features(x))
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for i, x in docs:
        f = features(x)
        weight = sum(math.floor(1000 * math.log((t[b] + 1.0) * (big_s + buckets) / ((s[b] + 1.0) * (big_t + buckets)))) for b in f)
        h = int(sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, len(terms(x))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.mark.parametrize("words", [0, 7, 1 << 17])
def test_resampling_equals_brute_force(spark, words):
    docs = list(enumerate(texts(1))) + [(None, "w1 w2 " * 20)]
    target = ["w1 w2 w3", "w3 W2 w1 w200", None]
    frame = spark.createDataFrame([(i, x, 5, "n") for i, x in docs], "doc_id long, text string, score int, word string")
    found = resample(frame, spark.createDataFrame([(x,) for x in target], "text string"), percent=30, words=words)
    got = sorted((tuple(r) for r in found.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)
    assert got == brute_resample(docs, target, 30, 20)


def test_resampling_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, None)], "doc_id long, text string")
    assert resample(none, some).count() == 0
    rows = resample(some, none, percent=100, least_words=1).collect()
    assert sorted((r.doc_id or 0, r.rank or 0) for r in rows) == [(0, 0), (1, 1), (1, 2)]


def test_dictionary_is_bounded_and_takes_the_most_frequent(spark):
    frame = spark.createDataFrame([(" ".join(f"w{k}" for k in range(100) for _ in range(k + 1)),)], "text string")
    found = learn_dictionary(frame, 20).split()
    assert 0 < len(found) <= 20 and b"w99" in found and b"w3" not in found


def brute_search(items, docs, k=10):
    told = [(i, terms(x)) for i, x in docs]
    told = [(i, w) for i, w in told if w]
    n_docs, length = len(told), sum(len(w) for _, w in told)
    counts = [(i, len(w), Counter(w)) for i, w in told]
    df = Counter(t for _, _, c in counts for t in c)
    out = []
    for item, x in items:
        scored = []
        for i, n, c in counts:
            m = 25 + (75 * n * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(x) if c[t])
            if score:
                scored.append((-score, i is None, i))
        for rank, (score, _, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("leaf", "batch", "group"), [(32, 4096, 1 << 20), (2, 16, 1 << 20), (4, 64, 40)])
def test_search_equals_brute_force(spark, monkeypatch, leaf, batch, group):
    monkeypatch.setattr(search_module, "DOC_LEAF", leaf)
    monkeypatch.setattr(search_module, "BATCH_DOCS", batch)
    docs = list(enumerate(texts(2))) + [(None, "w1 w2 w3")]
    rng = random.Random(4)
    items = [(k, " ".join(rng.choices([f"w{j}" for j in range(200)], k=rng.choice([1, 5, 30])))) for k in range(40)]
    items += [(50, None), (51, ""), (52, "nowhere"), (53, "w1 " * 60), (53, "w1 " * 60), (None, "W2 w7"), (54, "日本語 été")]
    frame = spark.createDataFrame([(i, x, 1, "t") for i, x in docs], "doc_id long, text string, item int, term string").repartition(3)
    asked = spark.createDataFrame([(i, x, 9) for i, x in items], "item_id long, text string, doc_id int")
    found = sorted((tuple(r) for r in ranked_search(asked, frame, group_terms=group).collect()), key=repr)
    assert found == brute_search(items, docs)


def test_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked_search(asked, none).count() == 0
    assert ranked_search(asked.where("false"), asked.withColumnRenamed("item_id", "doc_id")).count() == 0


def test_pruning_leaves_most_pairs_and_loses_none():
    """Documents about one topic each: most pairs of an item and a document are never scored."""
    rng = np.random.default_rng(0)
    topics, per, k = 20, 400, 3
    terms_of = lambda t: t * 50 + rng.integers(0, 50, 12)
    rows = [np.unique(terms_of(d % topics)) for d in range(topics * per)]
    doc, term = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows)
    value = rng.integers(1, 100_000, len(term)).astype(float)
    asked = [np.unique(terms_of(i % topics)) for i in range(100)]
    items = search_module.Items(np.cumsum([0, *[len(a) for a in asked]]), np.concatenate(asked), np.ones(sum(map(len, asked)), dtype=np.int64))
    weights = rng.integers(1, 9000, topics * 50).astype(float)
    tree = search_module.ItemTree(np.arange(100), items, weights)
    best, ids, null = search_module.Best(100, k), np.arange(len(rows)), np.zeros(len(rows), dtype=bool)
    scored = 0
    place = np.full(topics * 50, -1)
    place[tree.columns] = np.arange(len(tree.columns))
    for lo in range(0, len(rows), 2000):
        some = (doc >= lo) & (doc < lo + 2000) & (place[term] >= 0)
        docs = search_module.DocTree(np.arange(len(rows)), doc[some], place[term][some], value[some], tree)
        scored += search_module.search(tree, docs, ids, null, best)
    assert scored < 0.3 * 100 * len(rows)
    dense = np.zeros((len(rows), topics * 50))
    dense[doc, term] = value
    for i, a in enumerate(asked):
        scores = dense[:, a] @ weights[a]
        order = np.lexsort((ids, -scores))[:k]
        assert best.ids[i].tolist() == order.tolist() and best.scores[i].tolist() == scores[order].astype(int).tolist()


def brute_links(rows, threshold=0.95):
    def unit(v):
        if v is None or not len(v) or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v, dtype=np.float64)
        a = a / np.abs(a).max()
        return a / np.sqrt((a * a).sum())

    units = [unit(v) for _, v in rows]
    n, parent = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a is not None and b is not None and len(a) == len(b) and float(a @ b) >= threshold - 1e-12:
                n[i] += 1
                n[j] += 1
                parent[root(i)] = root(j)
    return n, [root(i) for i in range(len(rows))]


def clustered(seed=0, dims=24, hot=300):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(150, dims))
    rows = [b.tolist() for b in base]
    for k, noise in enumerate([0.01, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3] * 20):
        b = base[k % 150]
        rows.append((b + noise * rng.normal(size=dims)).tolist())
    centre = rng.normal(size=dims)
    rows += [(centre + 0.08 * rng.normal(size=dims)).tolist() for _ in range(hot)]  # near copies in one place
    rows += [rows[0]] * 120  # exact copies
    return [(k, r) for k, r in enumerate(rows)]


@pytest.mark.parametrize("block", [1024, 32])
def test_index_finds_the_links(spark, block):
    rows = clustered()
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, node string")
    found = {r.vec_id: r for r in embedding_near_duplicates(frame, block=block).collect()}
    n, group = brute_links(rows)
    got = [found[i].n_links for i, _ in rows]
    assert all(a <= b for a, b in zip(got, n, strict=True))  # none below the threshold
    assert sum(got) >= 0.97 * sum(n)
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        least.setdefault(g, i)
    assert np.mean([found[i].component_id == least[g] for (i, _), g in zip(rows, group, strict=True)]) >= 0.97
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_recall_near_the_threshold(spark, seed):
    """Pairs with cosines from 0.95 on: at least nine of ten are found."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(2000, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    aside = rng.normal(size=base.shape)
    aside -= (aside * base).sum(axis=1)[:, None] * base
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    c = rng.uniform(0.95001, 0.97, len(base))[:, None]
    rows = np.concatenate([base, c * base + np.sqrt(1 - c * c) * aside])
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(rows.tolist())], "vec_id long, embedding array<double>")
    found = embedding_near_duplicates(frame).agg(F.sum("n_links")).first()[0] / 2
    assert 0.9 * len(base) <= found <= ((rows @ rows.T >= 0.95).sum() - len(rows)) / 2


def test_index_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1e-200, 0.0]), (4, [1e200, 1e190]), (5, None), (6, []), (7, [0.0, 0.0]), (8, [nan, 1.0]),
        (9, [inf, 1.0]), (10, [None, 1.0]), (11, [1.0, 0.0, 0.0]), (12, [1.0, 0.0, 0.0]), (13, [0.0, -1.0]), (13, [0.0, -1.0]), (None, [0.0, 1.0]), (None, None),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_near_duplicates(frame).collect()]
    alone = [(i, 0, i, True) for i in (5, 6, 7, 8, 9, 10)]
    together = [(i, 3, 1, i == 1) for i in (1, 2, 3, 4)] + [(11, 1, 11, True), (12, 1, 11, False), (13, 1, 13, True), (13, 1, 13, True)]
    assert sorted(found, key=repr) == sorted([*alone, *together, (None, 0, None, True), (None, 0, None, True)], key=repr)
    assert embedding_near_duplicates(frame.where("false")).count() == 0


def test_pairs_of_a_core_are_links():
    rng = np.random.default_rng(5)
    centre = rng.normal(size=32)
    rows = centre + 0.1 * rng.normal(size=(500, 32))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    _, core = Pivots(rows[:40], 0.95).describe(rows)
    inside = rows[core == 0]
    assert len(inside) > 300 and (inside @ inside.T).min() >= 0.95


def test_first_shared_pivot():
    a, b = np.array([[1, 4, 6], [2, 3, 9]]), np.array([[4, 6, 8], [1, 2, 3]])
    count, first = shared_pivots(a, b)
    assert count.tolist() == [[2, 1], [0, 2]] and first[0].tolist() == [4, 1] and first[1, 1] == 2


def test_hot_place_stays_in_small_tiles(spark, monkeypatch):
    """No tile holds more than two blocks, whatever part of all vectors is in one place."""
    seen = []
    rows = clustered(hot=600)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    real = pivot_index._tiles

    def spied(*args):
        tiles = real(*args)
        seen.append(tiles.groupBy("list", "dims", "lo", "hi").count().agg(F.max("count")).first()[0])
        return tiles

    monkeypatch.setattr(pivot_index, "_tiles", spied)
    embedding_near_duplicates(frame, block=64).count()
    assert seen[0] <= 3 * 64  # blocks are dealt by hash
