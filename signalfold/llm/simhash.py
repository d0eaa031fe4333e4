"""Document fingerprints by SimHash, and the search for all fingerprints within a Hamming radius.

The terms of a text are its pairs of neighbouring words (and, in texts of fewer than ``FEW`` words, its runs of four
characters), lower-cased. Each distinct term's hash votes with weight 1 + ln(occurrences) on every bit, for it if
the hash has the bit set and against it if not; a fingerprint has the bits that won.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalfold.llm.text import constants, find_words, mix, window_hashes

BITS = 256
FEW = 8
# Bits within which n_near counts. Of pairs with at least 0.8 of their 5-word shingles in common (README: figures) nearly all are
# as near as that; one changed word in 200 costs about 12 bits.
NEAR = 32
LEAST_BLOCKS = 10  # blocks of at most 26 bits: the bitmap of a table's keys stays below 8 MB
MOST_ASKED = 1 << 18  # asked fingerprints in the tables of one scan
AT_ONCE = 1 << 18  # keys or pairs looked at in one step
_LANES = constants(BITS // 64, 11)


def terms(hashes: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Term hashes of one text: ``hashes`` of its words, ``raw`` its bytes."""
    if len(hashes) >= FEW:
        return window_hashes(hashes, 2)
    found = [hashes, window_hashes(hashes, 2)]
    if len(raw) >= 4:
        wide = raw.astype(np.uint64) + np.uint64(1)
        found.append(window_hashes(wide, 4))
    elif len(raw):
        found.append(window_hashes(raw.astype(np.uint64) + np.uint64(1), len(raw)))
    return np.concatenate(found)


def fingerprint(found: np.ndarray) -> np.ndarray:
    """``BITS // 8`` bytes; all zero for a text without terms."""
    if not len(found):
        return np.zeros(BITS // 8, dtype=np.uint8)
    found = np.sort(found)
    at = np.flatnonzero(np.diff(found, prepend=found[:1] ^ np.uint64(1)))
    n = np.diff(np.append(at, len(found)))
    weight = (1 + np.log(n)).astype(np.float32)
    votes = np.zeros(BITS, dtype=np.float32)
    for lo in range(0, len(at), 4096):
        lanes = mix(found[at[lo : lo + 4096], None] * _LANES[None, :])
        bits = np.unpackbits(lanes.astype("<u8").view(np.uint8), axis=1)
        votes += weight[lo : lo + 4096] @ bits.astype(np.float32)
    return np.packbits(votes * 2 > weight.sum())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal bits."""
    return 1 - int(np.bitwise_count(a ^ b).sum()) / BITS


def fingerprints_of(texts: list[str]) -> list[np.ndarray]:
    """Fingerprints of a few texts at once."""
    raws = [t.encode("utf-8", "replace") for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raws])]).astype(np.int64)
    words = find_words(np.frombuffer(b"".join(raws), dtype=np.uint8), offsets, lower=True)
    return [
        fingerprint(terms(words.hashes[words.first[k] : words.first[k + 1]], words.data[offsets[k] : offsets[k + 1]]))
        for k in range(len(texts))
    ]


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text, own) in order: each own row with its follower; rows that aren't own only follow."""
    open_row: tuple | None = None

    def told(rows: list[tuple]) -> pa.RecordBatch:
        edits = [edited(t, f) for _, t, f in rows]
        prints = fingerprints_of([t for _, t, _ in rows] + edits + [rows[-1][2]])
        n = len(rows)
        return pa.record_batch(
            [
                pa.array([r[0] for r in rows], pa.int64()), pa.array([len(r[1]) for r in rows], pa.int64()), pa.array(edits, pa.string()),
                pa.array([p.tobytes().hex() for p in prints[:n]]), pa.array([p.tobytes().hex() for p in prints[n : 2 * n]]),
                pa.array([likeness(prints[k], prints[n + k]) for k in range(n)]),
                pa.array([likeness(prints[k], prints[k + 1] if k + 1 < n else prints[-1]) for k in range(n)]),
            ],
            names=["id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    for batch in batches:
        rows, size = [], 0
        for id_, text, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = text or ""
            if open_row:
                rows.append((*open_row, text))
                size += len(open_row[1])
            open_row = (id_, text) if own else None
            if size > 1 << 19 or rows and not own:
                yield told(rows)
                rows, size = [], 0
        if rows:
            yield told(rows)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """(id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next) for each row of ``docs``.

    A row's next document follows it in the order (id, text), nulls first, and after the last comes the first; a
    single row follows itself. Null texts are empty and have the all-zero fingerprint. Equal texts have equal
    fingerprints, whatever stands around them.

    Documents are dealt to ranges of ids, and each range ends with a copy of the next one's first row; what
    the driver sees is one id per range.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.coalesce("id", F.lit(-(2**63)))
    quantiles = [k / (3 * n) for k in range(1, 3 * n)]  # several ranges a partition, so that partitions are alike
    cuts = sorted({int(c) for c in rows.select(place.alias("p")).stat.approxQuantile("p", quantiles, 0.1 / n)})
    bucket = F.size(F.filter(F.lit(cuts), lambda c: c <= place)) if cuts else F.lit(0)
    dealt = rows.withColumn("bucket", bucket)
    starts = sorted((r["bucket"], r["p"]) for r in dealt.groupBy("bucket").agg(F.min(place).alias("p")).collect())
    if not starts:
        starts = [(0, 0)]
    before = [(p, starts[k - 1][0], k == 0) for k, (_, p) in enumerate(starts)]
    heads = spark.createDataFrame(before, "p long, bucket int, around boolean")
    firsts = (
        rows.withColumn("p", place).join(F.broadcast(heads), "p")  # one row per range
        .groupBy("p", "bucket").agg(F.min("text").alias("text"), F.first("id").alias("id"))
    )
    chained = dealt.select("bucket", F.lit(True).alias("own"), "id", "text").union(firsts.select("bucket", F.lit(False).alias("own"), "id", "text"))
    ordered = chained.repartition(n, "bucket").sortWithinPartitions("bucket", F.desc("own"), F.asc_nulls_first("id"), "text")
    told = ordered.select("id", "text", "own").mapInArrow(
        _chain, "id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
    return told.withColumnRenamed("id", id_col)


def _blocks(radius: int) -> list[tuple[int, int, int]]:
    """(first bit, bits, tolerance) of the blocks that are keys of a table. Two fingerprints within ``radius`` bits differ in no
    more bits than the tolerance in at least one of them, as else they'd differ in radius + 1 bits."""
    n = max(LEAST_BLOCKS, -(-(radius + 1) // 3))
    cuts = np.linspace(0, BITS, n + 1).astype(int)
    each, more = divmod(radius + 1, n)
    found = [(int(lo), int(hi - lo), each - 1 + (k < more)) for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False))]
    return [b for b in found if b[2] >= 0]


def _flips(bits: int, most: int) -> np.ndarray:
    """All numbers of ``bits`` bits with at most ``most`` (two at the highest) set."""
    one = 1 << np.arange(bits, dtype=np.uint32)
    a, b = np.triu_indices(bits, 1)
    return np.concatenate([np.zeros(1, dtype=np.uint32), *([one] if most > 0 else []), *([one[a] | one[b]] if most > 1 else [])]).astype(np.uint32)


class Tables:
    """The asked fingerprints (rows of ``BITS // 8`` bytes), in a table for each block, in the order of that block."""

    def __init__(self, asked: np.ndarray, radius: int):
        self.radius, self.blocks, self.asked = radius, _blocks(radius), np.ascontiguousarray(asked).view(np.uint64)
        self.keys = self._keys(asked)
        self.order = [np.argsort(k, kind="stable") for k in self.keys]
        self.ordered = [k[o] for k, o in zip(self.keys, self.order, strict=True)]
        self.flips = [_flips(bits, off) for _, bits, off in self.blocks]
        self.held = []  # by block, a bitmap of the keys that are in the table
        for (_, bits, _), k in zip(self.blocks, self.keys, strict=True):
            at = np.zeros(1 << bits, dtype=bool)
            at[k] = True
            self.held.append(np.packbits(at, bitorder="little"))

    def _keys(self, prints: np.ndarray) -> list[np.ndarray]:
        bits = np.unpackbits(prints, axis=1)
        return [bits[:, lo : lo + n].astype(np.uint32) @ (1 << np.arange(n, dtype=np.uint32)) for lo, n, _ in self.blocks]

    def near(self, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(index of an asked fingerprint, index in ``prints``, distance) of all pairs within the radius, each once."""
        keys, whole = self._keys(prints), np.ascontiguousarray(prints).view(np.uint64)
        for k, flips in enumerate(self.flips):
            step = max(1, AT_ONCE // len(flips))
            for top in range(0, len(prints), step):
                tried = keys[k][top : top + step, None] ^ flips
                hit = (self.held[k][tried >> 3] >> (tried & 7).astype(np.uint8)) & 1
                row, column = np.nonzero(hit)
                first = np.searchsorted(self.ordered[k], tried[row, column])
                n = np.searchsorted(self.ordered[k], tried[row, column], side="right") - first
                ends, at = np.cumsum(n), 0
                while at < len(n):
                    stop = max(at + 1, int(np.searchsorted(ends, ends[at] - n[at] + AT_ONCE, side="right")))
                    size = n[at:stop]
                    f = np.repeat(row[at:stop] + top, size)
                    a = self.order[k][np.repeat(first[at:stop] - np.cumsum(size) + size, size) + np.arange(len(f))]
                    apart = np.bitwise_count(self.asked[a] ^ whole[f]).sum(axis=1)
                    new = apart <= self.radius
                    for j in range(k):  # not a pair that an earlier table has
                        new[new] = np.bitwise_count(self.keys[j][a[new]] ^ keys[j][f[new]]) > self.blocks[j][2]
                    yield a[new], f[new], apart[new]
                    at = stop


def _bytes_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, BITS // 8)


def _hex(prints: np.ndarray) -> pa.Array:
    return pa.array([p.tobytes().hex() for p in prints], pa.string())


def _pairs(asked: np.ndarray, radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(asked, radius)
        for batch in batches:
            prints = _bytes_of(batch.column(0))
            for a, f, apart in tables.near(prints):
                yield pa.record_batch([_hex(asked[a]), _hex(prints[f]), pa.array(apart, pa.int32())], names=["fingerprint", "found", "distance"])

    return run


def _sums(asked: np.ndarray, radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, near = Tables(asked, radius), np.zeros(len(asked), dtype=np.int64)
        for batch in batches:
            copies = batch.column(1).to_numpy()
            for a, f, _ in tables.near(_bytes_of(batch.column(0))):
                np.add.at(near, a, copies[f])
        had = np.flatnonzero(near)
        yield pa.record_batch([_hex(asked[had]), pa.array(near[had])], names=["fingerprint", "near"])

    return run


def _searched(queries: DataFrame, rows: DataFrame, told, schema: str, radius: int, most: int) -> DataFrame:
    """``rows`` (binary fingerprint first) through ``told``, once for each part of about ``most`` distinct fingerprints of ``queries``."""
    if not 0 <= radius < BITS // 4:
        raise ValueError(f"the radius must be below {BITS // 4}")
    asked = queries.where("fingerprint is not null").select("fingerprint").distinct()
    parts = -(-asked.count() // most)
    found = rows.sparkSession.createDataFrame([], schema)
    for k in range(parts):
        part = asked.where(F.pmod(F.xxhash64("fingerprint"), F.lit(parts)) == k).select(F.unhex("fingerprint").alias("fingerprint"))
        prints = _bytes_of(part.toArrow().column(0))
        if len(prints):
            found = found.union(rows.mapInArrow(told(prints, radius), schema))
    return found


def near_fingerprints(queries: DataFrame, prints: DataFrame, radius: int, id_col: str = "doc_id", most: int = MOST_ASKED) -> DataFrame:
    """(query_id, fingerprint, found, distance): every fingerprint of ``prints`` within ``radius`` bits of one of ``queries``.

    Both have ``id_col`` and a hexadecimal ``fingerprint``. The search is exact: the bits are cut into blocks, and two
    fingerprints within the radius differ in at most two bits (at a small radius, in none) of at least one block. The asked
    fingerprints are put into a table per block, keyed by it; each task scans its share of ``prints`` and looks up each block
    with every change of so few bits. The tables hold ``most`` asked fingerprints (8 MB); where there are more, ``prints`` is
    scanned again for each further part. Nothing but the found pairs is shuffled.
    Searched are distinct fingerprints; ``found`` is one, and the documents that have it are found by joining
    ``prints`` again, so copies are not multiplied. Rows with a null fingerprint find nothing and aren't found.
    """
    rows = prints.where("fingerprint is not null").select("fingerprint").distinct().select(F.unhex("fingerprint").alias("print"))
    pairs = _searched(queries, rows, _pairs, "fingerprint string, found string, distance int", radius, most)
    return queries.select(F.col(id_col).alias("query_id"), "fingerprint").distinct().join(pairs, "fingerprint").select("query_id", "fingerprint", "found", "distance")


def with_near_counts(prints: DataFrame, asks: Column, radius: int = NEAR, id_col: str = "doc_id", most: int = MOST_ASKED) -> DataFrame:
    """``prints`` with ``n_near``: for rows that ``asks``, how many other rows have a fingerprint within ``radius`` bits; null for the
    others. ``prints`` is read several times, so it should be a stored table. The search is that of ``near_fingerprints``, but
    each task adds up what it finds, so a group of near copies makes a row per task and asked fingerprint."""
    asked = prints.where(asks)
    copies = prints.where("fingerprint is not null").groupBy("fingerprint").agg(F.count("*").alias("copies"))
    found = _searched(asked, copies.select(F.unhex("fingerprint").alias("print"), "copies"), _sums, "fingerprint string, near long", radius, most)
    sums = found.groupBy("fingerprint").agg((F.sum("near") - 1).alias("n_near"))
    near = asked.select(F.col(id_col).alias("_id"), "fingerprint").distinct().join(sums, "fingerprint").withColumnRenamed("fingerprint", "_print")
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("fingerprint") == F.col("_print"))
    return prints.join(near, same, "left").drop("_id", "_print")
