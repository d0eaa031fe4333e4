"""Language ID, quality rules and classifier, chat formatting, the pipeline, and every registered query."""

import hashlib
import itertools
import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_DIR
from hypothesis import given
from hypothesis import strategies as st
from llm import brute
from oracle_compare import differences
from pyspark.sql import functions as F

from signalfold.llm import chat, langid, quality_classifier, quality_rules, stats
from signalfold.llm.queries import ORACLE, QUERIES
from signalfold.llm.tokens import encoder

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def con():
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "conversations", "labels", "benchmark"):
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def results(spark):
    """Each registered query's rows, once."""
    found = {}

    def get(name):
        if name not in found:
            found[name] = QUERIES[name](spark, SF_DIR).collect()
        return found[name]

    return get


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = [c[0] for c in con.execute(ORACLE[name]).description]
    assert set(columns) == set(df.columns)
    assert differences(df.select(*columns), ORACLE[name], con) == []


def test_registered_queries():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))


# --- language ID ---------------------------------------------------------------


def brute_grams(text):
    """n-grams of one to three letters, words with a separator on either side."""
    text = text.lower()
    found, word = Counter(), ""
    spaced = []
    for c in text + " ":
        if c.isalpha():
            word += c
        elif word:
            spaced.append(word)
            word = ""
    line = "_" + "_".join(spaced) + "_" if spaced else ""
    for n in (1, 2, 3):
        for k in range(len(line) - n + 1):
            g = line[k : k + n]
            if g != "_" and not (n == 3 and g[1] == "_"):
                found[g] += 1
    return found


def code(gram):
    value = 0
    for c in gram:
        value = value << 21 | (langid.GAP if c == "_" else ord(c))
    return value


@pytest.mark.parametrize("text", ["", "a", "Der Hund, der.", "é1é 2", "数据\n数", "--", "a b", "İ ß"])
def test_grams(text):
    expected = Counter({code(g): n for g, n in brute_grams(text).items()})
    assert Counter(langid.gram_codes(text).tolist()) == expected


def test_language_id_equals_brute_force(spark, results, documents):
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in documents}
    counts = {}
    for i, d in documents.items():
        if not held[i]:
            counts.setdefault(d.lang, Counter()).update({code(g): n for g, n in brute_grams(d.text).items()})
    top = lambda c: {g: k for k, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:400])}
    profiles = {lang: top(c) for lang, c in counts.items()}
    rows = results("op6_language_id")
    assert {r.doc_id: r.held_out for r in rows} == held
    for r in rows:
        own = top(Counter({code(g): n for g, n in brute_grams(documents[r.doc_id].text).items()}))
        apart = {lang: sum(abs(p[g] - k) if g in p else 400 for g, k in own.items()) for lang, p in profiles.items()}
        first, second = sorted(apart.items(), key=lambda x: (x[1], x[0]))[:2]
        assert (r.lang_pred, round(r.score, 12)) == (first[0], round(second[1] / (first[1] + second[1]), 12))
    assert np.mean([r.lang_pred == documents[r.doc_id].lang for r in rows if r.held_out]) > 0.98


def test_language_id_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "hello there you", "en", 1), (2, "allô toi là", "fr", 1), (3, None, "en", 1), (4, "12 --", "fr", 1), (5, "là", None, 1), (None, "you", "en", 1), (1, "hello", "en", 1)],
        "doc_id long, text string, lang string, score int",
    )
    rows = langid.predict_language(docs, langid.learn_profiles(docs)).collect()
    assert [(r.doc_id, r.lang_pred) for r in rows] == [(1, "en"), (2, "fr"), (3, "und"), (4, "und"), (5, "fr"), (None, "en"), (1, "en")]
    assert all(0 <= r.score <= 1 for r in rows)
    nothing = langid.learn_profiles(docs.limit(0))
    assert [r.lang_pred for r in langid.predict_language(docs.limit(1), nothing).collect()] == ["und"]
    one = langid.learn_profiles(docs.where("lang = 'en'"))
    assert {r.lang_pred for r in langid.predict_language(docs.where("doc_id = 2"), one).collect()} == {"en"}


# --- quality ---------------------------------------------------------------------


def test_rule_counts_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", "\n\n", "a", "é|é #\n|\n|\n", "x y\nx y\n x y\nX y", "a b c d e f g h " * 5, "\t".join("abc") + "\n" * 3]
    texts += ["".join(rng.choices(["a ", "b ", "c\n", "<d> ", "ü"], k=rng.randrange(200))) for _ in range(40)]
    docs = spark.createDataFrame([(k, t, 5) for k, t in enumerate(texts)], "doc_id long, text string, n_words int")
    for r in stats.document_stats(docs).collect():
        expected = brute.rule_counts(texts[r.doc_id])
        assert {c: r[c] for c in expected} == expected, texts[r.doc_id]
    assert stats.document_stats(docs.limit(0)).collect() == []


def test_quality_rules_equal_brute_force(results, documents):
    rows = results("op7_quality_rules")
    for r in rows:
        expected = brute.rule_counts(documents[r.doc_id].text)
        assert {c: r[c] for c in expected} == expected
        failed = expected["n_words"] < 20 or 100 * expected["n_repeat_words"] > 30 * expected["n_words"]
        assert r.base_failed == failed and r.kept == (not failed and r.anomaly < r.anomaly_limit)


def test_limit_loses_few_good_documents(spark, results):
    told = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    passed = [r for r in results("op7_quality_rules") if not r.base_failed and r.doc_id in told]
    good = [r.kept for r in passed if told[r.doc_id]]
    assert np.mean(good) >= 0.99
    assert np.mean([not r.kept for r in passed if not told[r.doc_id]]) > 1 - np.mean(good)


def walk(tree, point):
    at = 0
    while tree[at, 0] >= 0:
        at = int(tree[at, 2] if point[int(tree[at, 0])] <= tree[at, 1] else tree[at, 3])
    return tree[at, 1]


def test_forest_scores():
    rng = np.random.default_rng(0)
    points = np.vstack([rng.normal(size=(500, 3)), [[9, 9, 9]]])
    trees = [quality_rules.grow(points[rng.choice(501, 64, replace=False)], rng) for _ in range(30)]
    scores = quality_rules.path_scores(points, trees, 64)
    expected = [2 ** (-np.mean([walk(t, p) for t in trees]) / float(quality_rules._expected(64))) for p in points]
    assert np.allclose(scores, expected) and scores.argmax() == 500
    assert np.allclose(quality_rules._expected([1, 2]), [0, 1]) and quality_rules.path_scores(points, [], 2)[0] == 0.5


def test_forest_sees_repeated_lines(spark):
    """Texts in which one short line alternates with unique ones, against texts that differ from them in nothing else that is counted."""
    rng = np.random.default_rng(2)
    short = [" ".join(p) for p in itertools.permutations("Read more about this page".split())]

    def text(repeated: bool) -> str:
        between = [short[0]] * 12 if repeated else [short[k] for k in rng.permutation(len(short))[:12]]
        return "\n".join(f"{line}\n" + " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(9)) for line in between)

    docs = [(k, text(repeated=k < 12)) for k in range(240)]
    labels = [(k, int(k >= 12)) for k in range(240) if k >= 12 or k % 2]
    found = quality_rules.quality_rules(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"))
    rows = {r.doc_id: r for r in found.collect()}
    assert all(len({r[c] for r in rows.values()}) == 1 for c in stats.COUNTS if c != "n_dup_lines")
    assert not any(r.base_failed for r in rows.values())
    assert [k for k in sorted(rows) if not rows[k].kept] == list(range(12))


def test_quality_rules_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b " * 30, 1), (None, None, 1), (1, "w " * 15, 2)], "doc_id long, text string, kept int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 0), (2, None)], "doc_id long, quality int")
    found = sorted((r.n_words, r.base_failed, r.kept) for r in quality_rules.quality_rules(docs, labels).collect())
    assert found == [(0, True, False), (15, True, False), (60, True, False)]
    assert quality_rules.quality_rules(docs.limit(0), labels.limit(0)).collect() == []


def test_classifier_on_held_out_labels(spark, results):
    told = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = results("op9_quality_classifier")
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert {r.doc_id: r.held_out for r in rows} == {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows}
    bad = [r.score for r in rows if r.held_out and told.get(r.doc_id) == 0]
    good = [r.score for r in rows if r.held_out and told.get(r.doc_id) == 1]
    assert np.mean([b < g for b in bad for g in good]) > 0.95


def test_compiled_rules_score_as_the_model(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select(F.col("doc_id").alias("_id"), F.col("quality").alias("_label"))
    table = quality_classifier.quality_stats(docs)
    model = quality_classifier.learn_quality(table, labels)
    assert model.rules and len(model.rules) < 200
    rows = quality_classifier.score_quality(table, model).select("score", *[c.alias(n) for n, c in stats.features().items()]).toPandas()
    applied = quality_classifier.applies(rows[list(stats.FEATURES)].to_numpy(), [r for r, _ in model.rules])
    assert np.allclose(1 / (1 + np.exp(-(model.intercept + applied @ np.array([w for _, w in model.rules])))), rows.score)


def test_classifier_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, None), (None, ""), (1, "x y")], "doc_id long, text string")
    table = quality_classifier.quality_stats(docs)
    none = spark.createDataFrame([], "_id long, _label int")
    assert [r.score for r in quality_classifier.score_quality(table, quality_classifier.learn_quality(table, none)).collect()] == [0.5] * 3
    one = spark.createDataFrame([(1, 1), (None, 0)], "_id long, _label int")
    scores = [r.score for r in quality_classifier.score_quality(table, quality_classifier.learn_quality(table, one)).collect()]
    assert scores == [pytest.approx(0.75)] * 3
    assert quality_classifier.score_quality(table.limit(0), quality_classifier.learn_quality(table, one)).collect() == []


# --- chat --------------------------------------------------------------------------


@given(st.text(alphabet="<\\|imend_start>\nx", max_size=30), st.text(alphabet="<\\|a\nn", max_size=10))
def test_escapes_are_reversible(text, role):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(role)) == role and "\n" not in chat.escape_role(role) and "<|" not in chat.escape_role(role)


def conversation_rows():
    rng = random.Random(4)
    rows = []
    for c in range(40):
        shared = ["hi", "hello <|im_end|>", "how?"]
        for t in range(rng.randrange(1, 7)):
            text = shared[t] if t < 3 and rng.random() < 0.8 else rng.choice(["x", "y <\\|", None, "é\n"])
            rows.append((c, t, "assistant" if t % 2 else rng.choice(["user", "user", "sys\ntem", None]), text, "z"))
    rows += [(c + 100, t, r, x, z) for c, t, r, x, z in rows if c < 5]
    return rows + [(None, 0, "user", "no id", ""), (77, None, "assistant", "no turn", ""), (77, 1, "user", "a", ""), (77, 1, "user", "a", "")]


@pytest.mark.parametrize("pack_chars", [1 << 20, 300])
def test_packs(spark, pack_chars):
    rows = conversation_rows()
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, root string")
    conversations = chat.conversation_table(table)
    packs = chat.format_chats(conversations, PATH, pack_chars).collect()
    codec, whole = encoder(PATH), 0
    for pack in packs:
        tokens = np.frombuffer(bytes(pack.tokens), dtype="<u4")
        seen = set()
        for n in pack.nodes:
            path = chat.path([x.asDict(True) for x in pack.nodes], pack.nodes.index(n))
            key = "".join(pack.text[p["lo"] : p["hi"]] for p in path)
            assert key not in seen  # each shared turn once
            seen.add(key)
            assert codec.ids(pack.text[n.lo : n.hi]).tolist() == tokens[n.token_lo : n.token_hi].tolist()
            inside = [k for s in n.attends for k in range(s.lo, s.hi)]
            assert inside == [k for p in path[:-1] for k in range(p["token_lo"], p["token_hi"])] and n.position == len(inside)
        for c in pack.conversations:
            whole += 1
            texts = chat.path([x.asDict(True) for x in pack.nodes], c.leaf)
            assert all(n["hi"] - n["lo"] > 0 for n in texts)
    assert whole == conversations.select("c1", "c2").distinct().count()
    found = {r.conv_id: r for r in chat.read_back(chat.format_chats(conversations, PATH, pack_chars), conversations).collect()}
    by = {}
    for c, t, r, x, _ in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    assert set(found) == set(by)
    for c, turns in by.items():
        turns = [(r, x) for _, _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected = (len(turns), digest("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), digest(loss))
        assert (found[c].n_turns, found[c].turns_sha256, found[c].loss_chars, found[c].loss_sha256) == expected


def test_no_conversations(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.formatted_digests(table, PATH).collect() == []


# --- pipeline ------------------------------------------------------------------------


def pipeline_docs(spark):
    rng = random.Random(8)
    vocabulary = ["the", "house", "of", "der", "und", "le", "jardin"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    passage = " ".join(rng.choices(vocabulary, k=70))
    base = " ".join(rng.choices(vocabulary, k=300))
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([8, 80, 200]))) for _ in range(40)]
    texts += [base, base, base.replace("house", "huis", 1), texts[0] + " " + passage, texts[1] + "\n" + passage, passage, None, "", "123 --", "w " * 3000, "x"]
    rows = [(k, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), len(t or "")) for k, t in enumerate(texts)]
    rows += [rows[2], (None, "sans id", "fr", "a", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("_row", F.lit("extra"))


def test_pipeline_stages(spark):
    docs = pipeline_docs(spark)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language ID", "n-gram Jaccard join", "substring dedup", "mixing sources to target weights", "packing"]
    known = stages["language ID"](spark, docs.drop("_row"), SF_DIR)
    assert known.columns == docs.columns[:-1]
    lost = set(r.doc_id for r in docs.select("doc_id").subtract(known.select("doc_id")).collect())
    assert lost == {46, 47, 48}
    alone = stages["n-gram Jaccard join"](spark, docs, SF_DIR)
    expected = brute.components({r.doc_id: r.text for r in docs.where("doc_id is not null").collect()}, 5, 80, 100)
    kept = sorted((r.doc_id is None, r.doc_id or 0) for r in alone.collect())
    assert kept == sorted((r.doc_id is None, r.doc_id or 0) for r in docs.collect() if r.doc_id is None or expected[r.doc_id][1] == r.doc_id)
    cut = {(r.doc_id, r.text) for r in stages["substring dedup"](spark, alone, SF_DIR).collect()}
    words = brute.without_repeats({r.doc_id: r.text for r in alone.where("doc_id is not null").collect()}, 50)
    before = {r.doc_id: r.text for r in alone.collect()}
    for i, text in cut:
        if i is not None and words[i] == brute.words(before[i]):
            assert text == before[i]
        elif i is not None:
            assert brute.words(text) == words[i]
    assert {i for i, _ in cut} == {i for i in before if i is None or words[i] or not brute.words(before[i])}
    assert 45 not in {i for i, _ in cut}  # the passage alone has nothing left
    mixed = stages["mixing sources to target weights"](spark, alone, SF_DIR)
    assert mixed.columns == docs.columns and mixed.where("n_chars <> length(text)").count() == 0
    assert stages["packing"](spark, mixed, SF_DIR).agg(F.sum("length")).first()[0] > 0


def test_pipeline_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).collect() == []


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "ids", "sequence_id", "offset", "length"} <= set(out.columns)
    sizes = out.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert sizes.where("n > 2048").isEmpty() and sizes.where("n = 2048").count() > 100
