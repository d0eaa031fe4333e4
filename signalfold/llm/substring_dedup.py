"""Substring dedup: words in long passages that an earlier document has too are removed.

A window is ``window`` consecutive words. Its suffix starts at its first word and is looked at to that depth.

1. *Whole copies.* Of documents with the same words, only the first goes on; the others are removed whole.
2. *Prefix partitions.* Each suffix belongs to the partition of its smallest ``gram``-word prefix among those that
   start in the window (its minimizer), which equal windows share. Neighbouring suffixes mostly have the same
   one, so a partition gets one record per run of suffixes. Partitions seen in one document only end here.
3. *Longer prefixes.* A prefix with too many suffixes for one tree is lengthened, for its own suffixes only and in steps: the
   partition is then that of the smallest longer prefix in the window. The first length that fits is taken.
4. *Suffix trees.* A partition is sorted by suffix; neighbours' common prefixes are the depths of the tree's internal nodes.
   Suffixes that agree to the full depth lie below one deep node, a repeat. All but the smallest document's suffixes
   there are marked. Where no length fits, most windows are the same ones: then the whole window is the prefix and the node, and its
   smallest document is an aggregate with a partial step and a join, so no hot passage meets in one task.
5. Marked windows of a document, put together, are its maximal repeats; their words are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalfold.llm.components import stored
from signalfold.llm.filters import maybe_in
from signalfold.llm.grouped import group_runs
from signalfold.llm.text import Words, find_words, mix, sliced, window_hashes, word_runs


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _runs(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, prefix, first window, windows) of each run of windows of one text with the same minimizer."""
    none = np.zeros(0, dtype=np.int64)
    if len(words.hashes) < window:
        return none, none.astype(np.uint64), none, none
    least = _sliding_min(window_hashes(words.hashes, gram), window - gram + 1)
    per = np.maximum(words.counts - window + 1, 0)
    text = np.repeat(np.arange(len(words)), per)
    start = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
    prefix = least[words.first[:-1][text] + start]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (prefix[1:] != prefix[:-1])
    at = np.flatnonzero(new)
    return text[at], prefix[at], start[at], np.diff(np.append(at, len(text)))


def _lists(ends: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _outline(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in word_runs(batch.column(2)):
                n = len(words)
                text, prefix, start, count = _runs(words, window, gram)
                ends = np.searchsorted(text, np.arange(n + 1))
                keys = []
                for lo, hi in zip(words.first[:-1], words.first[1:], strict=True):
                    own = words.hashes[lo:hi]
                    order = np.arange(1, hi - lo + 1, dtype=np.uint64)
                    keys.append(f"{int(np.add.reduce(mix(own + order))):x}-{int(np.add.reduce(mix(own ^ mix(order)))):x}-{hi - lo:x}")
                yield pa.record_batch(
                    [
                        batch.column(0).slice(row, n), batch.column(1).slice(row, n), pa.array(words.counts, pa.int64()), pa.array(keys),
                        _lists(ends, prefix.view(np.int64), pa.int64()), _lists(ends, start.astype(np.int32), pa.int32()), _lists(ends, count.astype(np.int32), pa.int32()),
                    ],
                    names=["id", "h", "n_words", "sequence", "prefix", "start", "windows"],
                )

    return run


def _adjoining(runs: list[dict]) -> list[dict]:
    """Runs of the same prefix that follow each other as one; lengthening cuts runs where any of the lengths has a new prefix."""
    joined: list[dict] = []
    for r in sorted(runs, key=lambda r: r["start"]):
        last = joined[-1] if joined else None
        if last and last["prefix"] == r["prefix"] and last["start"] + last["windows"] == r["start"]:
            last["windows"] += r["windows"]
        else:
            joined.append(dict(r))
    return joined


def _suffixes(window: int):
    """Rows (id, h, text, runs): (prefix, id, h, start, words), the words of a run as 8-byte codes in an order-keeping form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hs, runs = batch.column(0), batch.column(1), batch.column(3).to_pylist()
            for row, words in word_runs(batch.column(2)):
                at, prefix, start, codes = [], [], [], []
                for k in range(len(words)):
                    own = words.hashes[words.first[k] : words.first[k + 1]].astype(">u8").tobytes()
                    for r in _adjoining(runs[row + k]):
                        at.append(row + k)
                        prefix.append(r["prefix"])
                        start.append(r["start"])
                        codes.append(own[8 * r["start"] : 8 * (r["start"] + r["windows"] + window - 1)])
                if at:
                    at = pa.array(at, pa.int64())
                    yield pa.record_batch(
                        [pa.array(prefix, pa.int64()), ids.take(at), hs.take(at), pa.array(start, pa.int32()), pa.array(codes, pa.binary())],
                        names=["prefix", "id", "h", "start", "words"],
                    )

    return run


def _lengthened(window: int, grams: tuple[int, ...]):
    """Rows (id, h, text, runs): (id, h, start, windows, prefix_0, ...) for each run of windows that have the same minimizers of all
    the lengths ``grams``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hs, runs = batch.column(0), batch.column(1), batch.column(3).to_pylist()
            for row, words in word_runs(batch.column(2)):
                least = np.stack([_sliding_min(window_hashes(words.hashes, g), window - g + 1) for g in grams])
                for k in range(len(words)):
                    start = np.sort(np.concatenate([np.arange(r["start"], r["start"] + r["windows"]) for r in runs[row + k]]))
                    prefix = least[:, words.first[k] + start]
                    new = np.ones(len(start), dtype=bool)
                    new[1:] = (np.diff(start) != 1) | (prefix[:, 1:] != prefix[:, :-1]).any(axis=0)
                    first = np.flatnonzero(new)
                    at = pa.array(np.full(len(first), row + k), pa.int64())
                    yield pa.record_batch(
                        [
                            ids.take(at), hs.take(at), pa.array(start[first].astype(np.int32)), pa.array(np.diff(np.append(first, len(start))).astype(np.int32)),
                            *(pa.array(p[first].view(np.int64)) for p in prefix),
                        ],
                        names=["id", "h", "start", "windows", *(f"prefix_{i}" for i in range(len(grams)))],
                    )

    return run


def _whole_windows(window: int):
    """Rows (id, h, text, runs): (node, id, h, start) for each window, the node being the hash of all its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hs, runs = batch.column(0), batch.column(1), batch.column(3).to_pylist()
            for row, words in word_runs(batch.column(2)):
                nodes = window_hashes(words.hashes, window)
                for k in range(len(words)):
                    start = np.concatenate([np.arange(r["start"], r["start"] + r["windows"]) for r in runs[row + k]])
                    at = pa.array(np.full(len(start), row + k), pa.int64())
                    yield pa.record_batch(
                        [pa.array(nodes[words.first[k] + start].view(np.int64)), ids.take(at), hs.take(at), pa.array(start.astype(np.int32))],
                        names=["node", "id", "h", "start"],
                    )

    return run


def _depths(suffixes: list[bytes], window: int) -> np.ndarray:
    """For each sorted suffix, the words it has in common with the one before: the depth of the node where the two part."""
    words = np.frombuffer(b"".join(suffixes), dtype=np.uint64).reshape(len(suffixes), window)
    apart = words[1:] != words[:-1]
    return np.concatenate([[0], np.where(apart.any(axis=1), apart.argmax(axis=1), window)])


def _trees(window: int):
    """Rows (prefix, id, h, start, words), sorted by prefix: (id, h, start, windows), the repeats of a smaller id."""
    depth = 8 * window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in group_runs(batches, 1):
            ids, hs = part.column("id").to_pylist(), part.column("h").to_pylist()
            starts, codes = part.column("start").to_pylist(), part.column("words").to_pylist()
            leaves = [(w[8 * i : 8 * i + depth], ids[r], r, i) for r, w in enumerate(codes) for i in range(len(w) // 8 - window + 1)]
            leaves.sort()  # depth-first order of the subtree; below a node the smallest id comes first
            marked: list[tuple[int, int]] = []
            least = None
            for (_, doc, r, i), common in zip(leaves, _depths([leaf[0] for leaf in leaves], window).tolist(), strict=True):
                if common < window:
                    least = doc  # another leaf or deep node
                elif doc > least:
                    marked.append((r, i))
            marked.sort()
            spans: list[list[int]] = []
            for r, i in marked:
                if spans and spans[-1][0] == r and spans[-1][1] + spans[-1][2] == i:
                    spans[-1][2] += 1
                else:
                    spans.append([r, i, 1])
            if spans:
                yield pa.record_batch(
                    [
                        pa.array([ids[r] for r, _, _ in spans], pa.int64()), pa.array([hs[r] for r, _, _ in spans], pa.int64()),
                        pa.array([starts[r] + i for r, i, _ in spans], pa.int32()), pa.array([n for _, _, n in spans], pa.int32()),
                    ],
                    names=["id", "h", "start", "windows"],
                )

    return run


def _removed_words(words: Words, row: int, whole: list, spans: list, window: int) -> np.ndarray:
    edge = np.zeros(len(words.starts) + 1, dtype=np.int64)
    for k in range(len(words)):
        lo, hi = int(words.first[k]), int(words.first[k + 1])
        if whole[row + k]:
            edge[lo] += 1
            edge[hi] -= 1
        for s in spans[row + k] or ():
            edge[lo + s["start"]] += 1
            edge[min(lo + s["start"] + s["windows"] + window - 1, hi)] -= 1
    return np.cumsum(edge[:-1]) > 0


def _joined(words: Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the kept words of each text, joined by one space."""
    stop = words.ends[kept] + 1
    text = np.searchsorted(words.first, np.flatnonzero(kept), side="right")
    last = np.ones(len(stop), dtype=bool)
    last[:-1] = text[1:] != text[:-1]
    stop[last] -= 1
    edge = np.zeros(len(words.data) + 2, dtype=np.int8)
    edge[words.starts[kept]] += 1
    np.subtract.at(edge, stop, 1)
    inside = np.cumsum(edge[: len(words.data)], dtype=np.int8) > 0
    data = words.data.copy()
    data[stop[~last] - 1] = 32
    return data[inside], np.concatenate([[0], np.cumsum(inside)])[words.offsets]


def _cut(words: Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of each text without its removed words and the space after them; other texts as they are."""
    gone = np.flatnonzero(~kept)
    edge = np.zeros(len(words.data) + 1, dtype=np.int64)
    text = np.searchsorted(words.first, gone, side="right") - 1
    following = np.append(words.starts, len(words.data))[gone + 1]
    np.add.at(edge, words.starts[gone], 1)
    np.subtract.at(edge, np.minimum(following, words.offsets[text + 1]), 1)
    inside = np.cumsum(edge[:-1]) == 0
    return words.data[inside], np.concatenate([[0], np.cumsum(inside)])[words.offsets]


def _removal(window: int, joined: bool):
    """(text, whole, spans): (n_words, n_removed, kept_text)."""

    @F.arrow_udf("n_words long, n_removed long, kept_text string")
    def removed(texts: pa.Array, wholes: pa.Array, found: pa.Array) -> pa.Array:
        whole, spans, parts = wholes.to_pylist(), found.to_pylist(), []
        for row, data, offsets in sliced(texts):
            words = find_words(data, offsets)
            gone = _removed_words(words, row, whole, spans, window)
            data, offsets = (_joined if joined else _cut)(words, ~gone)
            kept = pa.Array.from_buffers(pa.large_string(), len(words), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
            total = np.concatenate([[0], np.cumsum(gone)])
            counts = pa.array(words.counts, pa.int64()), pa.array(np.diff(total[words.first]), pa.int64())
            parts.append(pa.StructArray.from_arrays([*counts, kept.cast(pa.string())], ["n_words", "n_removed", "kept_text"]))
        empty = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])
        return pa.concat_arrays([pa.array([], empty), *parts])

    return removed


def find_repeats(texts: DataFrame, window: int, gram: int, tree_suffixes: int) -> DataFrame:
    """(id, h, spans, whole) of the texts (id, h, text) that lose words: the first word and number of windows of each repeat, or
    all words. Stored in the work folder."""
    outline = stored(
        texts.where("id is not null").mapInArrow(
            _outline(window, gram), "id long, h long, n_words long, sequence string, prefix array<long>, start array<int>, windows array<int>"
        ),
        "outline",
    )
    long = outline.where(F.col("n_words") >= window)
    # what is aggregated is written: Spark splits a hot key of a join only where neither side is an aggregate by that key
    firsts = stored(long.groupBy("sequence").agg(F.min("id").alias("first")), "firsts")
    whole = stored(long.select("id", "h", "sequence").join(firsts, "sequence").where("id > first").select("id", "h").distinct(), "whole")
    heads = long.join(whole, ["id", "h"], "left_anti")
    runs = heads.select("id", "h", F.explode(F.arrays_zip("prefix", "start", "windows")).alias("r")).select("id", "h", "r.*")
    shared = runs.groupBy("prefix").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.sum("windows").alias("load"))
    shared = stored(shared.where("lo < hi").select("prefix", (F.col("load") > tree_suffixes).alias("hot")), "shared")
    wanted = stored(
        runs.join(shared, "prefix").groupBy("id", "h", "hot").agg(F.collect_list(F.struct("prefix", "start", "windows")).alias("runs")), "wanted"
    )

    def sought(own: DataFrame) -> DataFrame:
        near = maybe_in(texts, F.col("id"), own, F.col("id")).where("_maybe").select("id", "h", "text")
        return own.select("id", "h", "runs").hint("merge").join(near, ["id", "h"]).select("id", "h", "text", "runs")

    def listed(found: DataFrame) -> DataFrame:
        return found.groupBy("id", "h").agg(F.collect_list(F.struct("prefix", "start", "windows")).alias("runs"))

    asked, common = wanted.where("not hot").select("id", "h", "runs"), None
    hot = wanted.where("hot")
    if not hot.isEmpty():
        grams = tuple(g for g in (gram * 3 // 2, gram * 2, gram * 5 // 2) if gram < g < window)
        prefixes = "".join(f", prefix_{i} long" for i in range(len(grams)))
        lengthened = "id long, h long, start int, windows int" + prefixes
        left = stored(sought(hot).mapInArrow(_lengthened(window, grams), lengthened), "lengthened") if grams else hot.select("id", "h", F.inline("runs"))
        for i in range(len(grams)):
            left = left.withColumnRenamed(f"prefix_{i}", "prefix")
            load = left.groupBy("prefix").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.sum("windows").alias("load"))
            load = stored(load.where("lo < hi").select("prefix", (F.col("load") <= tree_suffixes).alias("fits")), "loads")
            left = stored(left.join(load, "prefix"), "dealt")
            asked = asked.unionByName(stored(listed(left.where("fits")), "fitting"))
            left = left.where("not fits").drop("prefix", "fits")
            if left.isEmpty():
                break
        else:
            common = stored(left.groupBy("id", "h").agg(F.collect_list(F.struct("start", "windows")).alias("runs")), "common")
        # one row for each text again
        asked = stored(asked.groupBy("id", "h").agg(F.flatten(F.collect_list("runs")).alias("runs")), "asked")
    suffixes = sought(asked).mapInArrow(_suffixes(window), "prefix long, id long, h long, start int, words binary")
    spans = suffixes.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(_trees(window), "id long, h long, start int, windows int")
    if common is not None:
        leaves = stored(sought(common).mapInArrow(_whole_windows(window), "node long, id long, h long, start int"), "leaves")
        nodes = leaves.groupBy("node").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
        # tables of their own: Spark splits a hot node's join only where both sides come straight from a shuffle
        nodes = stored(nodes.select("node", "least"), "nodes")
        marked = stored(leaves.join(nodes, "node").where("id > least").select("id", "h", "start", F.lit(1).alias("windows")), "marked")
        spans = spans.union(marked)
    repeats = spans.groupBy("id", "h").agg(F.collect_set(F.struct("start", "windows")).alias("spans"), F.lit(False).alias("whole"))
    empty = F.array().cast("array<struct<start:int,windows:int>>")
    return stored(repeats.union(whole.select("id", "h", empty.alias("spans"), F.lit(True).alias("whole"))), "repeats")


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, gram: int = 16, joined: bool = False,
    tree_suffixes: int = 50_000, row_col: str | None = None,
) -> DataFrame:
    """(id, n_words, n_removed, kept_text) for each row of ``docs``; with ``row_col``, that column (a struct of others, say)
    in the id's place.

    A word goes if a window over it also starts in a document with a smaller id, as the input has them. What stays
    keeps its layout, or with ``joined`` is the kept words with one space between. Null and empty texts have no
    words and an empty kept_text. Rows that share an id are one document: they don't remove from each other. A
    row without an id is kept whole and removes nothing. Texts of any length are taken whole; other columns are not read.

    ``tree_suffixes`` bounds the suffixes of one tree; the result doesn't depend on it.
    """
    if not 1 <= gram <= window:
        raise ValueError("gram must be between 1 and window")
    name = row_col or id_col
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"), F.col(name).alias("row")
    )
    decided = find_repeats(rows.select("id", "h", "text"), window, gram, tree_suffixes)
    tested = maybe_in(rows, F.col("id"), decided, F.col("id"))
    plain = decided.schema["spans"].dataType
    free = tested.where("not _maybe").select("row", "text", F.lit(False).alias("whole"), F.lit(None).cast(plain).alias("spans"))
    hit = tested.where("_maybe").join(decided.hint("merge"), ["id", "h"], "left")
    hit = hit.select("row", "text", F.coalesce("whole", F.lit(False)).alias("whole"), "spans")
    told = free.union(hit).select(F.col("row").alias(name), _removal(window, joined)("text", "whole", "spans").alias("_told"))
    return told.select(name, "_told.*")
