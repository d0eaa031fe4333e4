"""Ranked lexical search for the k best documents of each item, by two trees.

Documents are points whose coordinates are the impacts of the items' terms; items are points whose coordinates are the
terms' weights. A hierarchy over the items and one over the documents hold the coordinate maxima of what is below each
node, so the product of two nodes bounds the score of every pair below them. A pair of nodes whose bound is less than the
weakest k-th score of the node's items is left, with the whole batch of documents below it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalfold.llm.components import stored
from signalfold.llm.terms import MARK, term_lines

GROUP_TERMS = 1 << 20  # (item, term) pairs of the items that are searched in one pass over the documents
BLOCK_TERMS = 1 << 14  # terms of the items of one hierarchy
BLOCK_ITEMS = 256
BATCH_DOCS = 4096  # documents of one hierarchy
BATCH_TERMS = 1 << 20
ITEM_LEAF, DOC_LEAF, FAN_OUT = 8, 32, 4
WHOLE = float(1 << 53)  # doubles hold all whole numbers below
SALTS = 64


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


@dataclass
class Items:
    """Sparse items: item ``i`` has terms ``terms[first[i]:first[i + 1]]``, each as often as ``times`` says."""

    first: np.ndarray
    terms: np.ndarray
    times: np.ndarray


class ItemTree:
    """A hierarchy over a block of items: halves along the direction they differ most in, down to small leaves."""

    def __init__(self, block: np.ndarray, items: Items, weights: np.ndarray):
        spans = [np.arange(items.first[i], items.first[i + 1]) for i in block]
        at = np.concatenate(spans)
        self.columns, place = np.unique(items.terms[at], return_inverse=True)
        row = np.repeat(np.arange(len(block)), [len(s) for s in spans])
        points = np.zeros((len(block), len(self.columns)))
        points[row, place] = items.times[at] * weights[items.terms[at]]
        self.nodes: list[tuple[int, int, tuple[int, ...]]] = []
        order = self._split(points, np.arange(len(block)))
        self.items, self.points = block[order], points[order]
        self.most = np.stack([self.points[lo:hi].max(axis=0) for lo, hi, _ in self.nodes])
        self.whole = self.points.sum(axis=1).max() * 1e6 < WHOLE

    def _split(self, points: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The rows in the order of the leaves; nodes are numbered from the root, children after their parent."""
        order = np.empty(0, dtype=np.int64)
        todo = [(rows, -1)]
        parts: dict[int, np.ndarray] = {}
        children: dict[int, list[int]] = {}
        while todo:  # depth first, so that leaves come in order
            some, parent = todo.pop()
            node = len(parts)
            parts[node], children[node] = some, []
            if parent >= 0:
                children[parent].append(node)
            if len(some) > ITEM_LEAF:
                centred = points[some] - points[some].mean(axis=0)
                along = centred[np.argmax((centred * centred).sum(axis=1))]
                for _ in range(8):
                    along = (centred @ along) @ centred
                    along /= max(np.linalg.norm(along), 1e-300)
                some = some[np.argsort(centred @ along, kind="stable")]
                half = len(some) // 2
                todo += [(some[half:], node), (some[:half], node)]
            else:
                order = np.concatenate([order, some])
        # a node's items are a run of the order, as they were put there depth first
        place = np.empty(len(rows), dtype=np.int64)
        place[order] = np.arange(len(rows))
        for node, some in parts.items():
            lo = int(place[some].min())
            self.nodes.append((lo, lo + len(some), tuple(children[node])))
        return order


class Best:
    """The k best documents of each item so far: scores descending, ids ascending; score 0 is a free place."""

    def __init__(self, items: int, k: int):
        self.scores = np.zeros((items, k), dtype=np.int64)
        self.ids = np.full((items, k), np.iinfo(np.int64).max)
        self.null = np.zeros((items, k), dtype=bool)

    def weakest(self, items: np.ndarray) -> np.ndarray:
        return self.scores[items, -1]

    def add(self, items: np.ndarray, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """``scores`` has a row per item and a column per document."""
        better = (scores >= np.maximum(self.weakest(items), 1)[:, None]).any(axis=1)
        items, scores = items[better], scores[better]
        if not len(items):
            return
        k = self.scores.shape[1]
        every = np.concatenate([self.scores[items], scores], axis=1)
        names = np.concatenate([self.ids[items], np.broadcast_to(ids, scores.shape)], axis=1)
        nulls = np.concatenate([self.null[items], np.broadcast_to(null, scores.shape)], axis=1)
        order = np.lexsort((nulls, names, -every), axis=-1)[:, :k]
        for held, new in ((self.scores, every), (self.ids, names), (self.null, nulls)):
            held[items] = np.take_along_axis(new, order, axis=1)


class DocTree:
    """A hierarchy over a batch of documents, in the order of the term that weighs most in each."""

    def __init__(self, docs: np.ndarray, doc: np.ndarray, column: np.ndarray, value: np.ndarray, tree: ItemTree):
        """``doc``, ``column`` and ``value`` are the entries of the documents ``docs``, in the order of the documents."""
        at = np.flatnonzero(np.diff(doc, prepend=-1))  # each document's first entry
        sizes = np.diff(np.append(at, len(doc)))
        weight = value * tree.most[0][column]
        peak = np.maximum.reduceat(weight, at)
        top = np.full(len(at), len(tree.columns))
        own = np.repeat(np.arange(len(at)), sizes)
        is_peak = weight == peak[own]
        np.minimum.at(top, own[is_peak], column[is_peak])
        order = np.lexsort((-peak, top))
        self.docs = docs[doc[at]][order]
        self.leaves, maxima = [], []
        for lo in range(0, len(order), DOC_LEAF):
            some = order[lo : lo + DOC_LEAF]
            entries = np.concatenate([np.arange(at[d], at[d] + sizes[d]) for d in some])
            columns, place = np.unique(column[entries], return_inverse=True)
            points = np.zeros((len(some), len(columns)))
            points[np.repeat(np.arange(len(some)), sizes[some]), place] = value[entries]
            self.leaves.append((lo, columns, points))
            most = np.zeros(len(tree.columns))
            most[columns] = points.max(axis=0)
            maxima.append(most)
        self.levels = [np.stack(maxima)]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append(np.stack([below[k : k + FAN_OUT].max(axis=0) for k in range(0, len(below), FAN_OUT)]))


def search(tree: ItemTree, docs: DocTree, ids: np.ndarray, null: np.ndarray, best: Best) -> int:
    """Add the documents of one hierarchy to the best of the items of another; the number of scored pairs."""
    slack = 1.0 if tree.whole else 1 + 1e-9
    scored = 0

    def open_nodes(nodes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        weakest = np.array([best.weakest(tree.items[tree.nodes[n][0] : tree.nodes[n][1]]).min() for n in nodes])
        return (bounds > 0) & (bounds * slack >= weakest)

    def visit(level: int, node: int, items: np.ndarray) -> None:
        nonlocal scored
        most = docs.levels[level][node]
        kept, front = [], items
        while len(front):  # down the item tree, as far as this document node needs
            front = front[open_nodes(front, tree.most[front] @ most)]
            inner = [n for n in front if tree.nodes[n][2]]
            kept += [n for n in front if not tree.nodes[n][2]]
            front = np.array([c for n in inner for c in tree.nodes[n][2]], dtype=np.int64)
        if not kept:
            return
        kept = np.array(kept)
        if level:
            children = np.arange(node * FAN_OUT, min((node + 1) * FAN_OUT, len(docs.levels[level - 1])))
            hopes = (tree.most[kept] @ docs.levels[level - 1][children].T).max(axis=0)
            for c in children[np.argsort(-hopes, kind="stable")]:
                visit(level - 1, int(c), kept)
            return
        rows = np.concatenate([np.arange(*tree.nodes[n][:2]) for n in kept])
        lo, columns, points = docs.leaves[node]
        left = tree.points[np.ix_(rows, columns)]
        if tree.whole:
            scores = (left @ points.T).astype(np.int64)
        else:
            scores = left.astype(np.int64) @ points.T.astype(np.int64)
        scored += scores.size
        some = docs.docs[lo : lo + DOC_LEAF]
        best.add(tree.items[rows], scores, ids[some], null[some])

    visit(len(docs.levels) - 1, 0, np.array([0]))
    return scored


def _blocks(items: Items) -> Iterator[np.ndarray]:
    """Runs of items with a bounded number of terms (a very long item is a run of its own)."""
    sizes, lo = np.diff(items.first), 0
    some = np.flatnonzero(sizes)
    while lo < len(some):
        hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[some[lo : lo + BLOCK_ITEMS]]), BLOCK_TERMS, side="right")))
        yield some[lo:hi]
        lo = hi


def _vectors(words: bytes):
    """Rows (text, id): (id, n, term numbers, occurrences)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {w: k for k, w in enumerate(words.split())}
        wide = max(len(known), 1)
        known[MARK] = -2
        for batch in batches:
            for row, rows, line in term_lines(batch.column(0)):
                found = line.split()
                term = np.fromiter(map(known.get, found, repeat(-1)), dtype=np.int64, count=len(found))
                marks = term == -2
                text = np.cumsum(marks)
                n = np.bincount(text[~marks], minlength=rows)
                hit = term >= 0
                keys, tf = np.unique(text[hit] * wide + term[hit], return_counts=True)
                bounds = np.searchsorted(keys, np.arange(rows + 1) * wide).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x)) for x in ((keys % wide).astype(np.int32), tf.astype(np.int64))]
                yield pa.record_batch([batch.column(1).slice(row, rows), pa.array(n), *lists], names=["id", "n", "terms", "tfs"])

    return run


def _searched(items: Items, weights: np.ndarray, documents: int, length: int, k: int):
    """Rows (id, n, terms, tfs): (item, id, score), the k best of the task for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [ItemTree(block, items, weights) for block in _blocks(items)]
        best = Best(len(items.first) - 1, k)
        place = np.full(len(weights), -1)
        for batch in batches:
            lo = 0
            sizes = np.cumsum(np.diff(batch.column(2).offsets.to_numpy()))
            while lo < batch.num_rows:
                before = sizes[lo - 1] if lo else 0
                hi = min(lo + BATCH_DOCS, max(lo + 1, int(np.searchsorted(sizes, before + BATCH_TERMS, side="right"))))
                ids, n, terms, tfs = (c.slice(lo, hi - lo) for c in batch.columns)
                null, names = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(np.iinfo(np.int64).max).to_numpy()
                doc = np.repeat(np.arange(hi - lo), np.diff(terms.offsets.to_numpy()))
                term, tf = terms.flatten().to_numpy(), tfs.flatten().to_numpy()
                m = 25 + (75 * n.to_numpy() * documents) // max(length, 1)
                value = impact(tf, m[doc]).astype(np.float64)
                for tree in trees:
                    place[tree.columns] = np.arange(len(tree.columns))
                    column = place[term]
                    place[tree.columns] = -1
                    some = column >= 0
                    if some.any():
                        search(tree, DocTree(np.arange(hi - lo), doc[some], column[some], value[some], tree), names, null, best)
                lo = hi
        item, at = np.nonzero(best.scores)
        ids = pa.array(best.ids[item, at], mask=best.null[item, at])
        yield pa.record_batch([pa.array(item), ids, pa.array(best.scores[item, at])], names=["item", "id", "score"])

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, item): (item, term, times)."""
    for batch in batches:
        names = batch.column(1).to_numpy()
        for row, rows, line in term_lines(batch.column(0)):
            found = np.array(line.split(), dtype=object)
            marks = found == MARK
            keys = [f"{t}".encode() + b" " + w for t, w in zip(np.cumsum(marks)[~marks], found[~marks], strict=True)]
            terms, times = np.unique(np.array(keys, dtype=object), return_counts=True) if keys else ([], [])
            parts = [x.split(b" ") for x in terms]
            item = [int(names[row + int(p[0])]) for p in parts]
            yield pa.record_batch([pa.array(item, pa.int64()), pa.array([p[1] for p in parts], pa.binary()), pa.array(times, pa.int64())], names=["item", "term", "times"])


def _best(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id")))
    return rows.withColumn("rank", place).where(F.col("rank") <= k)


def ranked_search(
    items: DataFrame, docs: DataFrame, k: int = 10, item_col: str = "item_id", id_col: str = "doc_id", text_col: str = "text", group_terms: int = GROUP_TERMS
) -> DataFrame:
    """(item, rank, id, score): the ``k`` rows of ``docs`` that score highest for each row of ``items``, exactly.

    Terms, counts and lengths are of all documents and whole texts. Documents are read once for each group of items with
    ``group_terms`` terms, and become vectors over those terms in a table; each task searches its share of it, batch by batch, for
    all items of the group, with the k best per item as its only result. What the driver gets is a group's terms and counts.
    Null and empty texts have no terms and no score; items without any have no rows. Equal scores go to the smaller id,
    null ids last. Repeated documents are ranked each by itself, and repeated items have their rows each. Other columns aren't read.
    """
    spark = docs.sparkSession
    named = stored(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).alias("item_id"), F.col(text_col).alias("text")), "items")
    terms = stored(named.select("text", "item").mapInArrow(_item_terms, "item long, term binary, times long"), "item-terms")
    groups = max(1, -(-terms.count() // group_terms))
    of_group = F.pmod(F.xxhash64("item"), F.lit(groups))
    texts = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("id"))
    found = None
    for g in range(groups):
        asked = terms.where(of_group == g).orderBy("item", "term").toPandas()
        if asked.empty:
            continue
        words, number = np.unique(asked["term"].map(bytes).to_numpy(dtype=object), return_inverse=True)
        known, first = np.unique(asked["item"].to_numpy(), return_index=True)
        sparse = Items(np.append(first, len(asked)), number, asked["times"].to_numpy())
        blob = b" ".join(words)
        vectors = stored(texts.mapInArrow(_vectors(blob), "id long, n long, terms array<int>, tfs array<long>"), "vectors")
        documents, length = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(words))
        for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[row["term"]] = row["count"]
        weights = np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1)))
        near = vectors.where(F.size("terms") > 0).mapInArrow(_searched(sparse, weights, documents, length, k), "item long, id long, score long")
        task = near.withColumn("_salt", F.pmod(F.xxhash64("id", "score"), F.lit(SALTS)))
        few = _best(_best(task, ["item", "_salt"], k).drop("_salt"), ["item"], k)
        real = spark.createDataFrame([(k, int(i)) for k, i in enumerate(known)], "item long, _item long")
        few = few.join(real, "item").select(F.col("_item").alias("item"), "rank", "id", "score")
        found = few if found is None else found.union(few)
    if found is None:
        found = spark.createDataFrame([], "item long, rank int, id long, score long")
    kept = found.join(named.select("item", "item_id"), "item")
    return kept.select(F.col("item_id").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
