"""N-gram Jaccard join, substring dedup and fingerprints against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from llm import brute
from pyspark.sql import functions as F

from signalfold.llm import ngram_join, simhash
from signalfold.llm import substring_dedup as substring_module
from signalfold.llm.components import stored
from signalfold.llm.filters import maybe_in, without
from signalfold.llm.ngram_join import Jaccard, Order, ngram_jaccard_join
from signalfold.llm.substring_dedup import substring_dedup

SCHEMA = "doc_id long, text string, node string, star int, h string"  # the last three clash with inner names


def table(spark, docs):
    return spark.createDataFrame([(i, t, "x", 1, None) for i, t in docs], SCHEMA)


def variants(seed: int, groups: int = 12, copies: int = 8) -> list[tuple[int, str | None]]:
    """Groups of copies with more and more edits, shared passages, copies, and odd texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    docs: list[tuple[int, str | None]] = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.choice([2, 3, 4, 9, 25, 60, 150]))
        for k in range(copies):
            own = list(base)
            for _ in range(k // 2):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            text = " ".join(own)
            if rng.random() < 0.3:
                text += "\n" + passage
            docs.append((len(docs), text.upper() if k == 1 else text))
    docs += [(len(docs) + k, t) for k, t in enumerate([None, "", " \t\n", "One", "one", "été   x", "a a a a a a a a", docs[0][1]])]
    return docs


@pytest.mark.parametrize("rule", [Jaccard(3, 90, 100), Jaccard(5, 80, 100), Jaccard(2, 70, 100)])
@pytest.mark.parametrize("part_shingles", [2_000_000, 1500])
def test_join_equals_brute_force(spark, rule, part_shingles):
    docs = variants(rule.n * 7 + rule.num)
    found = ngram_jaccard_join(table(spark, docs), rule, part_shingles=part_shingles)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute.components(dict(docs), rule.n, rule.num, rule.den)


def test_split_star_loses_no_link(spark):
    """A chain: each text is linked with its neighbours only, all are in one block's star, and parts are tiny."""
    rng = random.Random(5)
    base, docs = [f"b{k}" for k in range(120)], []
    for k in range(30):
        own = list(base)
        own[: 2 * k] = [f"n{j}" for j in range(2 * k)]
        docs.append((k, " ".join(own)))
    rng.shuffle(docs)
    rule = Jaccard(1, 90, 100)
    found = ngram_jaccard_join(table(spark, docs), rule, part_shingles=600)
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: c for i, (_, c) in brute.components(dict(docs), 1, 90, 100).items()}


def test_join_of_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "q r s t u v"), (2, "q r s t u v"), (3, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (9, None)]
    found = sorted(map(tuple, ngram_jaccard_join(table(spark, rows), Jaccard(3, 90, 100)).collect()), key=str)
    assert found == sorted([(1, 4, 1), (1, 4, 1), (2, 4, 1), (3, 4, 1), (None, 4, None), (3, 4, 1), (9, 0, 9)], key=str)


def test_join_of_an_empty_table(spark):
    assert ngram_jaccard_join(table(spark, []), Jaccard()).collect() == []


def test_thresholds_are_checked():
    with pytest.raises(ValueError):
        Jaccard(3, 0, 100)


@pytest.mark.parametrize("rule", [Jaccard(3, 90, 100), Jaccard(5, 80, 100), Jaccard(2, 70, 100)])
def test_prefixes_of_linked_sets_meet(rule):
    """Whatever the classes are taken to be, also with nearly full bitmaps: the first shared n-gram is in both prefixes."""
    rng = np.random.default_rng(rule.num)
    for fill in (0.02, 0.5, 0.98):
        # a bit for every n-gram is what makes it a shared one; the classes above are random
        every = np.full(1 << 17, 255, dtype=np.uint8)
        some = np.packbits(rng.random(1 << 20) < fill)
        order = Order([every, some, some & np.packbits(rng.random(1 << 20) < 0.5)], 64)
        met = 0
        for size in (1, 2, 3, 5, 8, 20, 60, 300, 2000) * 5:
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            gone, more = (rng.integers(0, max(1, (rule.den - rule.num) * size // rule.den + 1)) for _ in range(2))
            b = np.unique(np.concatenate([rng.permutation(a)[gone:], rng.integers(0, 2**63, more, dtype=np.uint64)]))
            same = len(np.intersect1d(a, b))
            if len(b) and rule.den * same >= rule.num * (len(a) + len(b) - same):
                met += 1
                assert len(np.intersect1d(order.prefix(a, rule), order.prefix(b, rule)))
        assert met > 5


def test_texts_that_share_a_passage_do_not_meet(spark):
    """Half of each text is one common passage; the prefixes are the texts' own n-grams, which no other has."""
    rng = random.Random(9)
    passage = " ".join(f"p{k}" for k in range(60))
    docs = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) + " " + passage) for k in range(50)]
    docs.append((50, docs[7][1] + " more"))
    rule, named = Jaccard(5, 80, 100), table(spark, docs).select(F.col("doc_id").alias("id"), "text")
    order = spark.sparkContext.broadcast(ngram_join.gram_order(named, rule))
    said = named.mapInArrow(ngram_join._prefixes(rule, order), "key long, node long, n_shingles long")
    assert said.select("node").distinct().count() == 2


def test_trie_counts_each_overlap():
    rng = np.random.default_rng(1)
    rule = Jaccard(3, 80, 100)
    base = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64))
    sets = [np.unique(np.concatenate([base[rng.random(len(base)) > p], rng.integers(0, 2**63, 5, dtype=np.uint64)])) for p in rng.random(25) / 4]
    part = ngram_join._Part(list(range(25)), sets, rule)
    for i in range(25):
        part.probe(i)
    linked = {(a, b) for a in range(25) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))}
    parent = list(range(25))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in linked:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    assert {(u, v) for u, v in part.links()} == {(i, root(i)) for i in range(25) if root(i) != i}


@pytest.mark.parametrize("limit", [50_000, 300, 30, 1])
def test_dedup_equals_brute_force(spark, limit):
    docs = variants(3) + [(900, "x " * 300), (901, "x " * 180 + "y"), (902, None)]
    found = substring_dedup(table(spark, docs), window=20, gram=7, joined=True, tree_suffixes=limit).collect()
    kept = brute.without_repeats(dict(docs), 20)
    assert {r.doc_id: r.kept_text.split(" ") if r.kept_text else [] for r in found} == kept
    assert {r.doc_id: (r.n_words, r.n_removed) for r in found} == {i: (len(brute.words(t)), len(brute.words(t)) - len(kept[i])) for i, t in docs}


def test_a_hot_prefix_is_lengthened_in_steps(spark, monkeypatch):
    """A common phrase in texts that are otherwise unlike: longer prefixes are enough, no window goes to the aggregate."""
    phrase = " ".join(f"p{k}" for k in range(12))
    docs = [(i, f"{' '.join(f'a{i}x{k}' for k in range(15))} {phrase} {' '.join(f'b{i // 2}x{k}' for k in range(30))}") for i in range(120)]
    steps = []
    real = substring_module._lengthened
    monkeypatch.setattr(substring_module, "_lengthened", lambda window, grams: steps.append(grams) or real(window, grams))
    monkeypatch.setattr(substring_module, "_whole_windows", lambda window: pytest.fail("longer prefixes fit"))
    found = substring_dedup(table(spark, docs), window=20, gram=7, joined=True, tree_suffixes=100).collect()
    kept = brute.without_repeats(dict(docs), 20)
    assert {r.doc_id: r.kept_text.split(" ") if r.kept_text else [] for r in found} == kept
    assert steps == [(10, 14, 17)] and sum(r.n_removed > 0 for r in found) == 60


def test_adjoining_runs_are_one():
    runs = [{"prefix": p, "start": s, "windows": n} for p, s, n in [(1, 3, 2), (1, 0, 3), (2, 5, 1), (1, 6, 1), (1, 8, 1)]]
    found = [(r["prefix"], r["start"], r["windows"]) for r in substring_module._adjoining(runs)]
    assert found == [(1, 0, 5), (2, 5, 1), (1, 6, 1), (1, 8, 1)]


def test_depths_are_common_prefixes():
    words = [b"".join(w.to_bytes(8, "big") for w in s) for s in ([1, 1, 1], [1, 1, 2], [1, 1, 2], [1, 3, 0], [2, 3, 0])]
    assert substring_module._depths(words, 3).tolist() == [0, 2, 3, 1, 0]


def test_dedup_keeps_layout_and_clean_texts(spark):
    passage = " ".join(f"p{k}" for k in range(10))
    docs = [(1, f"A \n {passage}  B"), (2, f"  c\td\n{passage}\n e "), (3, " ä  ß\n"), (4, passage), (5, "")]
    found = {r.doc_id: r.kept_text for r in substring_dedup(table(spark, docs), window=10, gram=4).collect()}
    assert found == {1: docs[0][1], 2: "  c\td\ne ", 3: docs[2][1], 4: "", 5: ""}


def test_dedup_of_repeated_rows_null_ids_and_an_empty_table(spark):
    t = " ".join(f"p{k}" for k in range(30))
    rows = [(2, t), (2, t), (None, t), (1, t + " z"), (2, "other " + t)]
    found = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substring_dedup(table(spark, rows), window=10, gram=4).collect())
    assert found == [("1", 31, 0), ("2", 30, 30), ("2", 30, 30), ("2", 31, 30), ("None", 30, 0)]
    assert substring_dedup(table(spark, [])).collect() == []


def test_fingerprints(spark):
    docs = [(5, "one two three four five six seven eight nine"), (7, None), (6, "short é"), (9, "one two three four five six seven eight nine"), (8, "x" * 5000)]
    rows = {r.doc_id: r for r in simhash.fingerprint_documents(table(spark, docs), partitions=2).collect()}
    order = sorted(docs)
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1] or ""
        text = text or ""
        half = len(text) // 2
        expected = text[: len(text) - half] + after[:half]
        a, b, c = simhash.fingerprints_of([text, expected, after])
        assert rows[i].edited_text == expected and rows[i].n_chars == len(text)
        assert rows[i].fingerprint == a.tobytes().hex() and rows[i].edited_fingerprint == b.tobytes().hex()
        assert (rows[i].near_edited, rows[i].near_next) == (simhash.likeness(a, b), simhash.likeness(a, c))
    assert rows[5].fingerprint == rows[9].fingerprint and rows[7].fingerprint == "0" * 64


def test_fingerprints_of_odd_tables(spark):
    assert simhash.fingerprint_documents(table(spark, [])).collect() == []
    one = simhash.fingerprint_documents(table(spark, [(None, "abcd")])).collect()
    assert [(r.doc_id, r.edited_text, r.near_next) for r in one] == [(None, "abab", 1.0)]
    twice = simhash.fingerprint_documents(table(spark, [(1, "ab"), (1, "ab"), (2, "cd"), (None, "ef")]), partitions=3).collect()
    assert sorted(r.edited_text for r in twice) == ["aa", "ac", "ce", "ea"]


def test_fingerprint_is_a_weighted_vote():
    found = np.array([3, 3, 3, 9, 27], dtype=np.uint64)
    votes = np.zeros(simhash.BITS)
    for term, n in ((3, 3), (9, 1), (27, 1)):
        lanes = simhash.mix(np.uint64(term) * simhash._LANES)
        bits = np.unpackbits(lanes.astype("<u8").view(np.uint8)).astype(float)
        votes += (1 + np.log(n)) * (2 * bits - 1)
    assert np.array_equal(np.unpackbits(simhash.fingerprint(found)), votes > 0)


def test_search_finds_all_within_the_radius(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 256, (6, 32), dtype=np.uint8)
    prints = []
    for b in base:
        for flips in range(8):
            bits = np.unpackbits(b)
            bits[rng.choice(256, flips, replace=False)] ^= 1
            prints.append(np.packbits(bits))
    rows = [(k, p.tobytes().hex()) for k, p in enumerate(prints)] + [(99, rows_hex := prints[0].tobytes().hex()), (100, None)]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint string")
    found = simhash.near_fingerprints(df.where("doc_id % 4 = 0"), df, 3).collect()
    by = {r[0]: r[1] for r in rows if r[1]}
    expected = set()
    for q in (k for k in by if k % 4 == 0):
        for p in set(by.values()):
            d = int(np.bitwise_count(np.frombuffer(bytes.fromhex(by[q]), np.uint8) ^ np.frombuffer(bytes.fromhex(p), np.uint8)).sum())
            if d <= 3:
                expected.add((q, p, d))
    assert rows_hex and {(r.query_id, r.found, r.distance) for r in found} == expected
    counted = {r.doc_id: r.n_near for r in simhash.with_near_counts(df, F.col("doc_id") % 4 == 0, 3).collect()}
    held = Counter(by.values())
    sums = {k: sum(held[p] for q, p, _ in expected if q == k) - 1 for k in by if k % 4 == 0}
    assert counted == {k: sums.get(k) for k, _ in rows}


def edited_pairs(n_pairs: int = 120) -> list[tuple[list[str], list[str]]]:
    """Texts of 40 to 400 words, and each as far edited by changed, lost and new words as 0.8 of the 5-word shingles allow."""
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(3000)]
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    pairs = []
    while len(pairs) < n_pairs:
        base = rng.choices(vocabulary, k=rng.randrange(40, 400))
        near = base
        while True:
            more, k = list(near), rng.randrange(len(near))
            more[k : k + rng.choice([0, 1, 1, 1])] = [rng.choice(vocabulary)] * rng.choice([0, 1, 1, 1])
            a, b = shingles(base), shingles(more)
            if len(a & b) < 0.8 * len(a | b):
                break
            near = more
        if near != base:
            pairs.append((base, near))
    return pairs


def test_near_counts_find_edited_texts(spark):
    """The share of real near copies that is found, against brute force: all pairs are at 5-word Jaccard 0.8 or a little above."""
    pairs = edited_pairs()
    rows = [(100 * k, " ".join(a)) for k, (a, _) in enumerate(pairs)] + [(100 * k + 1, " ".join(b)) for k, (_, b) in enumerate(pairs)]
    prints = stored(simhash.fingerprint_documents(table(spark, rows)).select("doc_id", "fingerprint"), "prints")
    found = {r.doc_id: r.n_near for r in simhash.with_near_counts(prints, F.col("doc_id") % 100 == 0).collect()}
    assert all(found[i] is None for i, _ in rows if i % 100)
    assert np.mean([found[100 * k] == 1 for k in range(len(pairs))]) >= 0.9


@pytest.mark.parametrize("radius", [0, 7, 13, 32, 63])
def test_search_at_any_radius_and_in_parts_equals_brute_force(spark, radius):
    rng = np.random.default_rng(radius)
    prints = []
    for b in rng.integers(0, 256, (5, 32), dtype=np.uint8):
        for flips in [0, 0, *rng.integers(0, radius + 4, 30)]:
            bits = np.unpackbits(b)
            bits[rng.choice(256, flips, replace=False)] ^= 1
            prints.append(np.packbits(bits))
    df = spark.createDataFrame([(k, p.tobytes().hex()) for k, p in enumerate(prints)], "doc_id long, fingerprint string")
    apart = np.array([[int(np.bitwise_count(p ^ q).sum()) for q in prints] for p in prints])
    counted = {r.doc_id: r.n_near for r in simhash.with_near_counts(df, F.col("doc_id") % 2 == 0, radius, most=20).collect()}
    assert counted == {k: int((apart[k] <= radius).sum()) - 1 if k % 2 == 0 else None for k in range(len(prints))}
    pairs = sorted((r.query_id, r.found, r.distance) for r in simhash.near_fingerprints(df.where("doc_id % 2 = 0"), df, radius, most=20).collect())
    texts = [p.tobytes().hex() for p in prints]
    assert pairs == sorted({(k, texts[j], int(apart[k, j])) for k in range(0, len(prints), 2) for j in range(len(prints)) if apart[k, j] <= radius})


def test_filter_has_no_false_negatives(spark):
    wanted = spark.range(0, 3000, 3).select((F.col("id") * 7919).alias("w"))
    frame = spark.range(0, 3000).select((F.col("id") * 7919).alias("x"), F.lit(1).alias("_slot2"))
    tested = maybe_in(frame, F.col("x"), wanted, F.col("w"))
    assert tested.where("_maybe").count() >= 1000 and tested.where("x % 3 = 0 and not _maybe").count() == 0
    assert tested.where("not _maybe").count() > 1900
    assert without(frame, "x", wanted).count() == 2000
    assert without(frame, "x", wanted.limit(0)).count() == 3000
