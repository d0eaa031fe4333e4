"""Token counts and packing against the tokenizer's own library; mixing against its rules."""

import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm import brute
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from signalfold.llm import mixing, packing
from signalfold.llm.mixing import Mix, apportion, mix_counts, mix_sources, mixed_documents, targets
from signalfold.llm.packing import Packing, pack_documents
from signalfold.llm.tokens import PIECE, Encoder, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "  \n ", "a", "<|endoftext|>", "x <|endoftext|> y<|endoftext|", "don't we'll  I'm\t\r\n", "é" * 50, "数据 дом 🙂‍↔️", "\u0085\x1c  x",
    "word " * 40_000, " " * 300_000, "a" * 300_000, "ab  \n" * 30_000, "\x00\x01 ﻿",
]


@pytest.fixture(scope="module")
def full():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return Encoder(PATH)


def table(spark, docs):
    return spark.createDataFrame([(i, t, s, "x", 3) for i, t, s in docs], "doc_id long, text string, source string, length string, id int")


def test_ids_of_odd_texts(full, codec):
    assert codec.rank is not None
    for text in ODD:
        assert codec.ids(text or "").tolist() == full.encode(text or "", add_special_tokens=False).ids, (text or "")[:40]


def test_every_code_point_encodes_as_in_the_library(full, codec):
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for lo in range(0, len(points), 16_384):
        text = "".join(f"a{chr(c)}b {chr(c)} 1{chr(c)}2  {chr(c)}{chr(c)} !{chr(c)}!\n" for c in points[lo : lo + 16_384])
        assert codec.ids(text).tolist() == full.encode(text, add_special_tokens=False).ids, lo


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t'sabcZé1.!<|>endoftx 　")), max_size=60))
def test_pieces_encode_like_the_whole(text):
    codec = Encoder(PATH) if not hasattr(test_pieces_encode_like_the_whole, "codec") else test_pieces_encode_like_the_whole.codec
    test_pieces_encode_like_the_whole.codec = codec
    whole = codec.full.encode(text, add_special_tokens=False).ids
    assert codec.ids(text).tolist() == whole
    long = (text + "x y ") * (1 + 2 * PIECE // (len(text) + 4))
    parts = list(codec.parts(long))
    assert "".join(parts) == long and len(parts) > 1
    assert codec.ids(long).tolist() == codec.full.encode(long, add_special_tokens=False).ids


def test_counts(spark, full):
    docs = [(k, t, None) for k, t in enumerate(ODD)] + [(0, "again", None), (None, "no id", None)]
    found = sorted(((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in token_counts(table(spark, docs), PATH).collect()))
    expected = sorted((i is None, i or 0, len((t or "").encode()), len(full.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in docs)
    assert found == expected
    assert token_counts(table(spark, []), PATH).collect() == []


def test_sentencepiece_counts(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["hello world", "", None, "été 数据", "a  b"]
    found = {r.doc_id: r.n_tokens for r in token_counts(table(spark, [(k, t, None) for k, t in enumerate(texts)]), path).collect()}
    assert found == {k: len(own.encode(t or "")) for k, t in enumerate(texts)}


def checked(rows, docs, full, length):
    """The packing's contract; returns the padding."""
    ids = defaultdict(list)
    for i, t, _ in docs:
        ids[i].append(np.array([*full.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4"))
    sequences, covered = defaultdict(list), defaultdict(int)
    for r in rows:
        assert any(r.doc_tokens == len(own) and own[r.start : r.start + r.length].tobytes() == bytes(r.ids) for own in ids[r.doc_id])
        covered[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    assert covered == {i: sum(map(len, own)) for i, own in ids.items()}
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at and size > 0
            at += size
        assert at <= length
        padding += length - at if at & (at - 1) else 0
    return padding


def test_packing(spark, full):
    rng = random.Random(2)
    docs = [(k, " ".join(rng.choices(["alpha", "beta", "gamma delta"], k=rng.choice([0, 1, 5, 60, 300, 700]))), None) for k in range(120)]
    docs += [(500, None, None), (501, "word " * 9000, None), (3, "again", None), (None, "no id", None)]
    for rule in (Packing(), Packing(length=64, shard_tokens=2000)):
        rows = pack_documents(table(spark, docs).coalesce(2), PATH, rule).collect()
        assert checked(rows, docs, full, rule.length) == 0
    assert rows and pack_documents(table(spark, []), PATH).collect() == []


def test_packing_again_gives_the_same(spark):
    docs = table(spark, [(k, "some words " * (k % 37), None) for k in range(200)]).repartition(3, "doc_id")
    assert sorted(pack_documents(docs, PATH).collect()) == sorted(pack_documents(docs, PATH).collect())


def test_longest_documents_go_to_the_cheapest_sequence():
    rule = Packing(length=10, linear=1.0, quadratic=1.0)
    pieces = [packing.Piece(k, 0, n) for k, n in enumerate([6, 5, 4, 3, 2])]
    placed, left = packing.assign(pieces, np.array([10, 10]), rule)
    # 6 | 5, then 4 to the second (30 < 42), 3 to the first (42 < 50), 2 is cut: 1 and 1
    assert [(p.doc, p.sequence, p.offset, p.length) for p in placed] == [(0, 0, 0, 6), (1, 1, 0, 5), (2, 1, 5, 4), (3, 0, 6, 3), (4, 1, 9, 1), (4, 0, 9, 1)]
    assert not left


def greedy(votes, seats):
    held = [0] * len(votes)
    for _ in range(seats):
        k = max(range(len(votes)), key=lambda k: (Fraction(votes[k]) / (2 * held[k] + 1), -k))
        held[k] += 1
    return held


def test_apportionment_is_sainte_lague():
    rng = random.Random(1)
    for _ in range(200):
        votes = [float(rng.choice([0, 1, 3, 3, 10, 17, 400])) for _ in range(rng.randrange(1, 9))]
        seats = rng.randrange(0, 60)
        if sum(votes):
            assert apportion(votes, seats) == greedy(votes, seats), (votes, seats)
    assert apportion([0.0, 0.0], 5) == [0, 0] and apportion([], 0) == []


def test_targets_stop_at_the_cap():
    rule = Mix()
    assert targets([100, 100, 100], rule) == [200.0, 250 * 2 / 3, 250 / 3]
    assert targets([10, 1000, 10], rule)[0] == 20.0 and sum(targets([10, 1000, 10], rule)) == 1530
    assert targets([0, 5], rule) == [0.0, 7.5] and targets([], rule) == []


def mix_docs():
    rng = random.Random(9)
    docs = [(k, "w " * rng.choice([0, 1, 7, 40, 90]), rng.choice(["a", "a", "a", "b", "ä", None])) for k in range(300)]
    return docs + [(900, None, "b"), (901, " \n", None), (5, "x y z", "a"), (5, "x y z", "a"), (None, "k k", "b"), (902, "v " * 4000, "c")]


@pytest.mark.parametrize("rule", [Mix(), Mix(block=4, shard_words=300), Mix(weights=(1, 9), most=1, share=0.5)])
def test_mix(spark, rule):
    docs = mix_docs()
    rows = mix_counts(table(spark, docs), rule).collect()
    assert sorted(map(str, rows)) == sorted(map(str, mix_counts(table(spark, docs).repartition(5), rule).collect()))
    sizes = defaultdict(int)
    for _, t, s in docs:
        sizes[s] += len(brute.words(t))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = dict(zip(order, targets([sizes[s] for s in order], rule)))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in rows) == sorted((i is None, i or 0, len(brute.words(t))) for i, t, _ in docs)
    assert all(0 <= r.taken <= rule.most * r.size for r in rows)
    by_target = defaultdict(lambda: [0, 0])
    for r in rows:
        by_target[r.target, r.source_size][0] += r.taken
    shards = {s: max(1, -(-sizes[s] // rule.shard_words)) for s in order}
    for s in order:
        assert abs(by_target[wanted[s], sizes[s]][0] - wanted[s]) <= rule.block * (shards[s] + 1)


def test_mixed_texts_have_the_words_taken(spark):
    docs = mix_docs()
    rule = Mix(block=4, shard_words=300)
    df = table(spark, docs)
    mixed = mixed_documents(df, rule)
    assert mixed.columns == df.columns
    got, plan = defaultdict(int), defaultdict(int)
    for r in mixed.collect():
        got[r.doc_id] += len(brute.words(r.text))
        assert brute.words(r.text)
    for r in mix_sources(df, rule).collect():
        plan[r.doc_id] += r._mix.taken
    assert got == {i: n for i, n in plan.items() if n}


def test_mix_of_an_empty_table(spark):
    assert mix_counts(table(spark, [])).collect() == [] and mixed_documents(table(spark, [])).collect() == []
    assert [r.taken for r in mix_counts(table(spark, [(1, None, None)])).collect()] == [0]
    assert mixing.word_count(F.lit("a")) is not None and zlib.crc32(b"") == 0
