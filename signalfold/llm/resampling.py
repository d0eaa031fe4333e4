"""Target-distribution importance resampling over hashed word n-grams, by an Aho-Corasick dictionary.

The dictionary holds distinct words, each between two delimiters, with a payload: CRC-32 with and without the delimiter
after it, and length. One automaton scan over a run of texts emits the payloads. The checksum of ``a b`` follows
from those of its parts: ``a`` and its space are moved on by as many bytes as ``b`` has, and ``b``'s is added. So each word is
hashed once, when the dictionary is made, and n-grams are never spelled out.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalfold.llm.components import stored
from signalfold.llm.terms import MARK, term_lines

BUCKETS = 10_000
DICTIONARY_WORDS = 1 << 17
LONGEST = 64  # bytes of a word of the dictionary
HELD_WORDS = 200_000
STEPS = 8  # levels a doubling of a word's count is divided into


def _move_on() -> np.ndarray:
    """[n, k, byte]: what a byte in place k of a checksum becomes when n zero bytes follow, n up to ``LONGEST`` + 1."""
    # fixed value: the polynomial of CRC-32, bits reversed
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1).astype(np.uint32)
    table = np.empty((LONGEST + 2, 4, 256), dtype=np.uint32)
    for k in range(4):
        table[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, LONGEST + 2):
        table[n] = (table[n - 1] >> np.uint32(8)) ^ one[table[n - 1] & np.uint32(255)]
    return table


_MOVED = _move_on()


def moved_on(crcs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Checksums after as many zero bytes as ``sizes`` says: the part that a text in front adds to a longer one's."""
    crcs, left = crcs.copy(), sizes.copy()
    while True:
        step = np.minimum(left, LONGEST + 1)
        parts = [_MOVED[step, k, (crcs >> np.uint32(8 * k)) & np.uint32(255)] for k in range(4)]
        crcs = parts[0] ^ parts[1] ^ parts[2] ^ parts[3]
        left = left - step
        if not left.any():
            return crcs


class Dictionary:
    """The automaton and the payloads of its words; the last entry is the mark between texts."""

    def __init__(self, words: list[bytes]):
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, word in enumerate([*words, MARK]):
            self.automaton.add_word(f" {word.decode('latin-1')} ", k)
        self.automaton.make_automaton()
        self.mark = len(words)
        self.crc = np.array([zlib.crc32(w) for w in words] + [0], dtype=np.uint32)
        self.spaced = np.array([zlib.crc32(w + b" ") for w in words] + [0], dtype=np.uint32)
        self.size = np.array([len(w) for w in words] + [1], dtype=np.int64)

    def payloads(self, line: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(is mark, CRC, CRC with a space, length) of each word of a line, in order. Words that the dictionary lacks
        are the gaps between emitted ones, and are hashed there."""
        hits = np.fromiter(chain.from_iterable(self.automaton.iter(line.decode("latin-1"))), dtype=np.int64).reshape(-1, 2)
        ends, found = hits[:, 0], hits[:, 1]
        after = np.concatenate([[0], ends])  # the space each gap would start at
        before = np.concatenate([ends - self.size[found] - 1, [len(line) - 1]])
        columns = [found == self.mark, self.crc[found], self.spaced[found], self.size[found]]
        gaps = np.flatnonzero(before > after)
        if not len(gaps):
            return tuple(columns)
        new, at = [], []
        for g, lo, hi in zip(gaps.tolist(), after[gaps].tolist(), before[gaps].tolist(), strict=True):
            for word in line[lo + 1 : hi].split(b" "):
                new.append((zlib.crc32(word), zlib.crc32(word + b" "), len(word)))
                at.append(g)
        crc, spaced, size = zip(*new, strict=True)
        more = [np.zeros(len(new), dtype=bool), np.array(crc, dtype=np.uint32), np.array(spaced, dtype=np.uint32), np.array(size)]
        return tuple(np.insert(c, at, m) for c, m in zip(columns, more, strict=True))


@lru_cache(maxsize=1)
def dictionary(words: bytes) -> Dictionary:
    """One per worker process; ``words`` are joined by spaces."""
    return Dictionary(words.split())


def feature_buckets(line: bytes, words: Dictionary, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number of each feature, bucket of each feature, text number of each word) of a line."""
    marks, crc, spaced, size = words.payloads(line)
    text = np.cumsum(marks)[~marks]
    crc, spaced, size = crc[~marks], spaced[~marks], size[~marks]
    texts, hashes = [text], [crc]
    if len(text) > 1:
        pair = text[1:] == text[:-1]
        texts.append(text[:-1][pair])
        hashes.append((moved_on(spaced[:-1], size[1:]) ^ crc[1:])[pair])
    if len(text) > 2:
        triple = text[2:] == text[:-2]
        opening = moved_on(spaced[:-2], size[1:-1] + 1) ^ spaced[1:-1]
        texts.append(text[:-2][triple])
        hashes.append((moved_on(opening, size[2:]) ^ crc[2:])[triple])
    return np.concatenate(texts), (np.concatenate(hashes) % np.uint32(buckets)).astype(np.int64), text


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()

    def table() -> pa.RecordBatch:
        out = pa.record_batch([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for _, _, line in term_lines(batch.column(0)):
            held.update(line.split())
            if len(held) > HELD_WORDS:
                yield table()
    yield table()


def learn_dictionary(texts: DataFrame, words: int = DICTIONARY_WORDS) -> bytes:
    """The most frequent words of all ``texts`` (one column), at most ``words`` of them and of ``LONGEST`` bytes each, joined by
    spaces: all that occur more often than some count. They are what the driver gets, 8 MB at most."""
    counts = texts.mapInArrow(_word_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(counts.where((F.length("word") <= LONGEST) & (F.col("word") != F.lit(MARK))), "words")
    level = F.floor(F.log2("n") * STEPS).cast("int")
    left, lowest = words, None
    for row in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        left -= row["count"]
        if left < 0:
            break
        lowest = row["level"]
    if lowest is None:
        return b""
    return b" ".join(sorted(bytes(r["word"]) for r in counts.where(level >= lowest).select("word").collect()))


def _bucket_counts(words: bytes, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = dictionary(words), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, line in term_lines(batch.column(0)):
                counts += np.bincount(feature_buckets(line, known, buckets)[1], minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, words: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket; tasks add up what they have, and the driver gets a number per bucket."""
    counts = texts.mapInArrow(_bucket_counts(words, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for row in counts.collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much likelier each bucket is in the target than in the source, each bucket counting one more."""
    t, s = target.astype(np.float64), source.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t))))).astype(np.int64)


def _weights(words: bytes, gains: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, gain = dictionary(words), gains.astype(np.float64)  # whole numbers, whose sums doubles hold
        for batch in batches:
            for row, rows, line in term_lines(batch.column(0)):
                text, bucket, of_word = feature_buckets(line, known, len(gain))
                sums = [np.bincount(of_word, minlength=rows), np.bincount(text, minlength=rows), np.bincount(text, gain[bucket], rows)]
                rest = [c.slice(row, rows) for c in batch.columns[1:]]
                yield pa.record_batch([*rest, *(pa.array(x.astype(np.int64)) for x in sums)], names=[*batch.schema.names[1:], "n_words", "n_features", "weight"])

    return run


def gumbel(key: Column) -> Column:
    """floor(-1000 ln(-ln u)), u being the first 32 bits of the key's SHA-256 plus a half, as a share of all."""
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, order: list[Column], purpose: str) -> DataFrame:
    """``rows`` with ``_place`` (1, 2, 3 ...) in the given order over all rows, without gathering them: ranges of the order are
    sorted and written, and a row's place is that in its range after the sizes of the ranges before. The rows are written
    first, as Spark reads them twice to find the ranges."""
    rows = stored(rows, f"{purpose}-rows")
    number = F.monotonically_increasing_id()  # the range above 33 bits, the place in it below
    ranges = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    put = stored(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_number", number), purpose)
    put = put.withColumn("_range", F.shiftright("_number", 33)).withColumn("_number", F.col("_number").bitwiseAND((1 << 33) - 1))
    before, starts = 0, []
    for row in put.groupBy("_range").count().orderBy("_range").collect():
        starts.append((row["_range"], before))
        before += row["count"]
    offsets = rows.sparkSession.createDataFrame(starts, "_range long, _before long")
    return put.join(F.broadcast(offsets), "_range").withColumn("_place", F.col("_before") + F.col("_number") + 1).drop("_range", "_before", "_number")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42,
    buckets: int = BUCKETS, words: int = DICTIONARY_WORDS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank): the importance of each row of ``docs`` for the distribution of the
    ``target`` texts, and the place of those drawn, by the largest perturbed weights among the rows with ``least_words``
    words or more; others have no rank.

    Counts, weights and the draw cover all rows and whole texts. Three passes read the texts: for the dictionary, the
    bucket counts and the weights. The dictionary is bounded; the words it lacks are hashed where they occur, with the same
    result. Null and empty texts have no features and weight 0. Ties go to the smaller id, null ids last; the key of a null id
    is ``<seed>:``. Repeated rows are rows of their own, each with a rank. Empty tables give no rows; an empty target, a weight for
    each text by the source's counts alone. Other columns are not read.
    """
    texts = docs.select(F.col(text_col).alias("text"))
    known = learn_dictionary(texts, words)
    source = bucket_counts(texts, known, buckets)
    goal = bucket_counts(target.select(F.col(text_col).alias("text")), known, buckets)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    weighed = rows.mapInArrow(_weights(known, bucket_gains(goal, source)), f"id {kind}, n_words long, n_features long, weight long")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    scored = weighed.withColumn("score", F.col("weight") + gumbel(key)).withColumn("_short", F.col("n_words") < least_words)
    placed = ranked(scored, [F.col("_short"), F.desc("score"), F.asc_nulls_last("id")], "ranked")
    drawn = placed.agg(F.floor(F.count_if(~F.col("_short")) * percent / 100).alias("n")).first()["n"]
    rank = F.when(F.col("_place") <= F.lit(drawn), F.col("_place"))
    return placed.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", rank.alias("rank"))
