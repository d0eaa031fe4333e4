"""Mixing sources to target weights by Sainte-Lague apportionment of equal word blocks.

The words of all documents are the currency. A mix of ``share`` times all words is divided among sources by weight,
with no source above ``most`` times its own words. Blocks of ``block`` words are given to sources one by one,
to the highest quotient target / (2 * blocks + 1), and a source's blocks to its shards in the same way. In a
shard, documents stand in an order fixed by seed, and the shard's quota of blocks is taken from a seeded block on,
around the end, so only the documents at both ends are cut.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalfold.llm.components import stored
from signalfold.llm.text import WORD


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (5, 2, 1)  # of the sources in code-point order, repeating; null last
    share: float = 1.5
    most: int = 2
    block: int = 16
    seed: int = 7
    shard_words: int = 250_000  # a shard's words; grows with the input so that there are at most max_shards more than sources
    max_shards: int = 65_536


def targets(sizes: list[int], rule: Mix) -> list[float]:
    """Words each source should give; what a full source can't give is shared again among the others."""
    weights = [rule.weights[k % len(rule.weights)] for k in range(len(sizes))]
    target: dict[int, float] = {}
    left = rule.share * sum(sizes)
    while len(target) < len(sizes):
        still = [k for k in range(len(sizes)) if k not in target]
        total = sum(weights[k] for k in still)
        part = {k: left * weights[k] / total for k in still}
        full = [k for k in still if part[k] > rule.most * sizes[k]]
        if not full:
            return [target.get(k, part.get(k, 0.0)) for k in range(len(sizes))]
        for k in full:
            target[k] = float(rule.most * sizes[k])
            left -= target[k]
    return [target[k] for k in range(len(sizes))]


def apportion(votes: list[float], seats: int) -> list[int]:
    """Sainte-Lague: each seat to the highest votes / (2 * seats held + 1); ties to the first.

    All seats with a quotient of at least d / 2 are round(votes / d) each, so most are given at once and the rest by a heap.
    """
    total = sum(votes)
    if not total or not seats:
        return [0] * len(votes)
    divisor = total / seats
    held = [int(v / divisor + 0.5) for v in votes]
    while sum(held) > seats:
        divisor *= 1 + (sum(held) - seats) / seats / 2 + 1e-9
        held = [int(v / divisor + 0.5) for v in votes]
    heap = [(-v / (2 * h + 1), k) for k, (v, h) in enumerate(zip(votes, held, strict=True))]
    heapq.heapify(heap)
    for _ in range(seats - sum(held)):
        _, k = heap[0]
        held[k] += 1
        heapq.heapreplace(heap, (-votes[k] / (2 * held[k] + 1), k))
    return held


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _quotas(spark: SparkSession, sizes: DataFrame, rule: Mix) -> tuple[DataFrame, DataFrame]:
    """Per source and per shard tables; the driver sees one number per source and per shard."""
    found = sizes.groupBy("_source").agg(F.sum("_size").alias("words")).collect()
    found = sorted(((r["_source"], r["words"]) for r in found), key=lambda r: (r[0] is None, r[0] or ""))
    wanted = targets([w for _, w in found], rule)
    blocks = apportion(wanted, round(sum(wanted) / rule.block))
    per_shard = max(rule.shard_words, sum(w for _, w in found) // rule.max_shards)
    rows = [(s, w, t, max(1, -(-w // per_shard)), b) for (s, w), t, b in zip(found, wanted, blocks, strict=True)]
    sources = spark.createDataFrame(rows, "_source string, _source_size long, _target double, _shards long, _blocks long")
    dealt = with_shards(sizes, sources).groupBy("_source", "_shard").agg(F.sum("_size").alias("words")).collect()
    words: dict[str | None, dict[int, int]] = {}
    for r in dealt:
        words.setdefault(r["_source"], {})[r["_shard"]] = r["words"]
    quotas = []
    for (source, *_, seats) in rows:
        held = sorted(words[source].items())
        for (shard, w), s in zip(held, apportion([float(w) for _, w in held], seats), strict=True):
            quotas.append((source, shard, w, min(s * rule.block, rule.most * w)))
    return sources, spark.createDataFrame(quotas, "_source string, _shard long, _words long, _quota long")


def with_shards(frame: DataFrame, sources: DataFrame) -> DataFrame:
    same = frame["_source"].eqNullSafe(sources["_source"])
    return frame.join(sources, same, "left").drop(sources["_source"]).withColumn("_shard", F.pmod(F.xxhash64("_id", F.lit(1)), "_shards"))


def mix_sources(docs: DataFrame, rule: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """All columns of ``docs`` and a struct ``_mix``: what the mix takes of each document.

    ``_mix`` has size, source_size, target, taken (words), passes (times the whole document is taken), and the
    word ranges [lo, hi) of at most two further parts: (lo1, hi1) and (lo2, hi2). No document is taken more than
    ``most`` times. Documents without words (null or empty text) have size 0 and nothing is taken of them. A
    null source is a source. Repeated rows are documents of their own; equal ids keep a fixed order
    by size. An empty table gives no rows. Columns of ``docs`` keep their names, but ``_mix`` must be free.
    """
    spark = docs.sparkSession
    base = docs.select(F.struct(*docs.columns).alias("_row"))
    keyed = base.select(
        "_row",
        F.col("_row")[id_col].cast("string").alias("_id"),
        F.col("_row")[source_col].cast("string").alias("_source"),
        word_count(F.col("_row")[text_col]).alias("_size"),
    )
    return _mixed(spark, keyed, stored(keyed.select("_id", "_source", "_size"), "sizes"), rule).select("_row.*", "_mix")


def mix_counts(docs: DataFrame, rule: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``mix_sources`` without the texts: (id, size, source_size, target, taken). Texts are counted once and not moved."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(source_col).cast("string").alias("_source"), word_count(F.col(text_col)).alias("_size"))
    sizes = stored(keyed, "sizes")
    mixed = _mixed(spark, sizes, sizes, rule)
    return mixed.select(F.col("_id").cast(kind).alias(id_col), "_mix.size", "_mix.source_size", "_mix.target", "_mix.taken")


def _mixed(spark: SparkSession, frame: DataFrame, sizes: DataFrame, rule: Mix) -> DataFrame:
    sources, quotas = _quotas(spark, sizes, rule)
    placed = with_shards(frame, sources)
    stream = Window.partitionBy("_source", "_shard").orderBy(F.xxhash64("_id", F.lit(rule.seed)), "_id", "_size").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("_hi", F.sum("_size").over(stream)).withColumn("_lo", F.col("_hi") - F.col("_size"))
    same = placed["_source"].eqNullSafe(quotas["_source"]) & (placed["_shard"] == quotas["_shard"])
    given = placed.join(quotas, same, "left").drop(quotas["_source"], quotas["_shard"])
    passes = F.expr("CASE WHEN _words > 0 THEN _quota DIV _words ELSE 0 END")
    first = F.pmod(F.xxhash64("_source", "_shard", F.lit(rule.seed)), F.greatest(F.col("_words").cast("long") / rule.block, F.lit(1)).cast("long")) * rule.block
    cut = given.withColumns({"_passes": passes, "_from": first}).withColumn("_rest", F.expr("_quota - _passes * _words"))
    # the taken stretch [from, from + rest), and what of it runs over the end and starts again
    ranges = {
        "_lo1": "greatest(_lo, _from)",
        "_hi1": "least(_hi, _from + _rest)",
        "_hi2": "least(_hi, _from + _rest - _words)",
    }
    cut = cut.withColumns({k: F.expr(v) for k, v in ranges.items()})
    one, two = F.greatest(F.col("_hi1") - F.col("_lo1"), F.lit(0)), F.greatest(F.col("_hi2") - F.col("_lo"), F.lit(0))
    taken = F.col("_passes") * F.col("_size") + one + two
    mix = F.struct(
        F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), taken.alias("taken"),
        F.col("_passes").alias("passes"), (F.col("_lo1") - F.col("_lo")).alias("lo1"), (F.col("_lo1") - F.col("_lo") + one).alias("hi1"),
        F.lit(0).cast("long").alias("lo2"), two.alias("hi2"),
    )
    return cut.withColumn("_mix", mix)


def mixed_documents(docs: DataFrame, rule: Mix = Mix(), **columns: str) -> DataFrame:
    """The mix itself: a document taken whole appears once per pass, a part of one appears with the part's words
    joined by one space, and a document the mix leaves out is gone. Same columns as ``docs``."""
    text_col = columns.get("text_col", "text")
    mixed = mix_sources(docs, rule, **columns)
    words = F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0))
    part = lambda lo, hi: F.when(
        F.col(f"_mix.{hi}") > F.col(f"_mix.{lo}"), F.array(F.array_join(F.slice(words, F.col(f"_mix.{lo}") + 1, F.col(f"_mix.{hi}") - F.col(f"_mix.{lo}")), " "))
    ).otherwise(F.array().cast("array<string>"))
    whole = (F.col("_mix.hi1") - F.col("_mix.lo1")) == F.col("_mix.size")
    rest = F.when(whole, F.array(F.col(text_col))).otherwise(F.concat(part("lo1", "hi1"), part("lo2", "hi2")))
    texts = F.concat(F.array_repeat(text_col, F.col("_mix.passes").cast("int")), rest)
    kept = mixed.where("_mix.taken > 0").withColumn("_mix", F.explode(texts))
    return kept.select(*[F.col("_mix").alias(c) if c == text_col else F.col(c) for c in docs.columns])
