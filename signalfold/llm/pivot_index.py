"""Near duplicates among embeddings, by a pivot-permutation index.

A vector is described by its nearest reference points (pivots) in order of distance. Inverted lists hold the vectors that have
a pivot among theirs; vectors that share enough pivots are candidates, and their cosine is then computed in doubles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalfold.llm.components import components, stored
from signalfold.llm.grouped import group_runs

NEAREST = 8  # pivots that describe a vector
SHARED = 3  # pivots that candidates have in common
MOST_PIVOTS = 1 << 15
BLOCK = 1024  # vectors on each side of a tile of a list
CORE_PIVOTS = 8  # pivots close together that make a core
CHUNK = 128


def pivot_count(vectors: int) -> int:
    """Twice the square root: the lists then get as long as there are pivots, but for a constant."""
    return int(min(max(16, 2 * vectors**0.5), MOST_PIVOTS))


def unit_rows(column: pa.Array, dims: int | None = None) -> np.ndarray:
    """The vectors of a list column as unit vectors in doubles; with ``dims``, cut or filled up with zeros to that length."""
    sizes = np.diff(column.offsets.to_numpy())
    width = int(sizes.max(initial=0)) if dims is None else dims
    flat = column.flatten().to_numpy().astype(np.float64)
    rows, first = np.zeros((len(sizes), width)), np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(flat)) - first[row]
    inside = at < width
    rows[row[inside], at[inside]] = flat[inside]
    most = np.abs(rows).max(axis=1, initial=0)
    rows /= np.where(most > 0, most, 1)[:, None]  # squares of what is left neither overflow nor vanish
    norm = np.sqrt((rows * rows).sum(axis=1))
    return rows / np.where(norm > 0, norm, 1)[:, None]


def usable(vector: Column) -> Column:
    """Whether the vector has a direction: some component, none null, NaN or infinite, not all zero."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(whole & F.exists(vector, lambda x: x != 0), F.lit(False))


class Pivots:
    """Unit vectors in the order of the lists that they have, shortest first, and the centres of dense places."""

    def __init__(self, points: np.ndarray, threshold: float):
        near = self._nearest(points, points)
        often = np.bincount(near.ravel(), minlength=len(points))
        self.points = points[np.argsort(often, kind="stable")]
        # two vectors within half the angle of a centre are within the whole of each other
        self.close = np.cos(np.arccos(threshold) / 2) + 1e-9
        self.centres = self._dense(threshold)

    @staticmethod
    def _nearest(points: np.ndarray, pivots: np.ndarray, n: int = NEAREST) -> np.ndarray:
        out = np.empty((len(points), min(n, len(pivots))), dtype=np.int64)
        step = max(1, (1 << 21) // max(len(pivots), 1))
        for lo in range(0, len(points), step):
            like = points[lo : lo + step] @ pivots.T
            out[lo : lo + step] = np.argsort(-like, axis=1, kind="stable")[:, : out.shape[1]]
        return out

    def _dense(self, threshold: float) -> np.ndarray:
        """Means of pivots that are close together: where a large part of all vectors is in one place, so are pivots."""
        degree = np.concatenate([(self.points[lo : lo + 256] @ self.points.T >= threshold).sum(axis=1) for lo in range(0, len(self.points), 256)])
        free, centres = np.ones(len(self.points), dtype=bool), []
        for p in np.argsort(-degree, kind="stable"):
            if degree[p] < CORE_PIVOTS:
                break
            if not free[p]:
                continue
            own = np.flatnonzero(free & (self.points @ self.points[p] >= threshold))
            if len(own) >= CORE_PIVOTS:
                free[own] = False
                mean = self.points[own].mean(axis=0)
                centres.append(mean / np.linalg.norm(mean))
        return np.array(centres).reshape(-1, self.points.shape[1])

    def describe(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the nearest pivots of each row, ascending; the core that each is in, or -1)."""
        near = np.sort(self._nearest(rows, self.points), axis=1)
        core = np.full(len(rows), -1, dtype=np.int64)
        if len(self.centres):
            like = rows @ self.centres.T
            best = like.argmax(axis=1)
            core = np.where(like[np.arange(len(rows)), best] >= self.close, best, -1)
        return near, core


def _described(pivots: Pivots):
    """Rows (vector, node, n): (vector, node, n, dims, pivots, core)."""
    dims = pivots.points.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                some = batch.slice(lo, 4096)
                column = some.column(0)
                sizes = np.diff(column.offsets.to_numpy())
                near, core = pivots.describe(unit_rows(column, dims))
                core[sizes != dims] = -1
                width = near.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(near) * width + 1, width, dtype=np.int32)), pa.array(near.ravel().astype(np.int32)))
                yield pa.record_batch([*some.columns, pa.array(sizes.astype(np.int32)), lists, pa.array(core.astype(np.int32))], names=["vector", "node", "n", "dims", "pivots", "core"])

    return run


def shared_pivots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``a`` and of ``b`` (ascending pivots): how many they share, and the first that they share."""
    count = np.zeros((len(a), len(b)), dtype=np.int8)
    first = np.full((len(a), len(b)), np.iinfo(np.int32).max, dtype=np.int32)
    for i in range(a.shape[1] - 1, -1, -1):
        own = a[:, i][:, None]
        for j in range(b.shape[1]):
            same = own == b[:, j][None, :]
            count += same
            np.copyto(first, own, where=same)
    return count, first


def _forest(u: np.ndarray, v: np.ndarray, nodes: int) -> np.ndarray:
    """The smallest number that each of ``nodes`` reaches by the links (u, v)."""
    label = np.arange(nodes)
    while True:
        low = np.minimum(label[u], label[v])
        after = label.copy()
        np.minimum.at(after, u, low)
        np.minimum.at(after, v, low)
        np.minimum.at(after, label[u], low)
        np.minimum.at(after, label[v], low)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def _tile_links(threshold: float):
    """Sorted rows (list, dims, lo, hi, block, node, n, core, pivots, vector): (node, peer, links). ``peer`` is a node that
    links lead to, so that all of a tile's links are kept as connections; ``links`` counts the vectors that are linked."""

    def tile(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        place, lo, hi = rows["list"][0].as_py(), rows["lo"][0].as_py(), rows["hi"][0].as_py()
        block, n, core = rows["block"].to_numpy(), rows["n"].to_numpy(), rows["core"].to_numpy()
        unit = unit_rows(rows["vector"].combine_chunks())
        width = len(rows["pivots"][0])
        near = rows["pivots"].combine_chunks().flatten().to_numpy().reshape(-1, width)
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        count, us, vs = np.zeros(len(unit), dtype=np.int64), [], []
        for at in range(0, len(left), CHUNK):
            some = left[at : at + CHUNK]
            shared, first = shared_pivots(near[some], near[right])
            pair = (shared >= min(SHARED, width)) & (first == place)
            pair &= (core[some][:, None] != core[right][None, :]) | (core[some] < 0)[:, None]
            if lo == hi:
                pair &= some[:, None] < right[None, :]
            if not pair.any():
                continue
            pair &= unit[some] @ unit[right].T >= threshold
            i, j = np.nonzero(pair)
            np.add.at(count, some[i], n[right[j]])
            np.add.at(count, right[j], n[some[i]])
            us.append(some[i])
            vs.append(right[j])
        label = _forest(np.concatenate(us), np.concatenate(vs), len(unit)) if us else np.arange(len(unit))
        linked = np.flatnonzero(count)
        node = rows["node"].combine_chunks()
        return pa.record_batch([node.take(pa.array(linked)), node.take(pa.array(label[linked])), pa.array(count[linked])], names=["node", "peer", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in group_runs(batches, 4):
            yield tile(rows)

    return run


def _tiles(lists: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """``lists`` (list, dims, core, ...) dealt to tiles of two blocks of one list. The rows of a core that fill blocks are in
    blocks of their own, which meet all others but the core's own; all other rows of a list share its first blocks."""
    full = sizes.where((F.col("core") >= 0) & (F.col("size") >= block))
    pure = full.select("list", "dims", F.col("core").alias("_core"), F.ceil(F.col("size") / block).cast("int").alias("parts"))
    mixed = sizes.where((F.col("core") < 0) | (F.col("size") < block)).groupBy("list", "dims").agg(F.sum("size").alias("size"))
    mixed = mixed.select("list", "dims", F.lit(-1).alias("_core"), F.ceil(F.col("size") / block).cast("int").alias("parts"))
    # the blocks of a list, one row a list: cores with blocks of their own are few, as each fills one
    runs = mixed.union(pure).groupBy("list", "dims").agg(F.array_sort(F.collect_list(F.struct("_core", "parts"))).alias("runs"))
    own = "coalesce(try_element_at(filter(runs, r -> r._core = core), 1), try_element_at(filter(runs, r -> r._core = -1), 1))"
    dealt = lists.join(stored(runs, "runs"), ["list", "dims"])
    dealt = dealt.withColumn("_own", F.expr(own))
    before = F.aggregate(F.filter("runs", lambda r: r["_core"] < F.col("_own._core")), F.lit(0), lambda s, r: s + r["parts"])
    total = F.aggregate("runs", F.lit(0), lambda s, r: s + r["parts"])
    dealt = dealt.withColumn("_lo", before).withColumn("block", F.col("_lo") + F.pmod(F.xxhash64("node"), F.col("_own.parts")).cast("int"))
    others = F.filter(
        F.sequence(F.lit(0), total - 1),
        lambda b: (F.col("_own._core") < 0) | (b < F.col("_lo")) | (b >= F.col("_lo") + F.col("_own.parts")),
    )
    dealt = dealt.withColumn("_other", F.explode(others))
    return dealt.select(
        "list", "dims", F.least("block", "_other").alias("lo"), F.greatest("block", "_other").alias("hi"),
        "block", "node", "n", "core", "pivots", "vector",
    )


def embedding_near_duplicates(
    vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int | None = None, block: int = BLOCK
) -> DataFrame:
    """(id, n_links, component_id, kept) for each row: how many other rows have a cosine of ``threshold`` or more with it, as far
    as the index finds them, and the smallest id that such links reach.

    Equal vectors are one node with a count, whatever their number. The pivots are the nodes of the lowest hashes, twice the square
    root of the nodes' number and ``MOST_PIVOTS`` at most, on which the index is fitted; every node is indexed, by the pivots
    of its ``NEAREST`` that have the shortest lists, as many as two nodes with ``SHARED`` pivots in common can't miss each other in. A
    pair is looked at in the first list that both share. Long lists are cut into blocks, and pairs of blocks are the tasks' units,
    so no list is in one task. Where a large part of all vectors is in one place, several pivots are too; all nodes within half
    the angle of their mean are linked with each other, which is counted without looking at the pairs. No pairs are emitted: a
    tile gives counts and a forest of its links.

    Vectors that are null, empty, zero or with a null or non-finite component, and those of unlike length, aren't linked. Labels and
    other columns are not read. Repeated rows are linked as equal vectors; rows that share an id each have their own. Null ids:
    linked as others, and no smallest id; a component of none but such rows has a null component_id, and they are kept.
    """
    ok = F.col("ok")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.select("id", F.when(usable(F.col("vector")), F.col("vector")).alias("vector")).withColumn("ok", F.col("vector").isNotNull())
    # 128 bits name a vector
    name = F.concat(F.hex(F.xxhash64("vector")), F.lit("-"), F.hex(F.xxhash64(F.lit(17), "vector")))
    rows = rows.withColumn("node", F.when(ok, name))
    nodes = rows.where(ok).groupBy("node").agg(F.first("vector").alias("vector"), F.count("*").alias("n"), F.min("id").alias("least"))
    nodes = stored(nodes, "nodes")
    counted = nodes.count()
    wanted = pivots or pivot_count(counted)
    by_size = nodes.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    found = []
    if by_size:
        share = F.pmod(F.xxhash64("node"), F.lit(1 << 40)) < F.lit(int(min(1.0, wanted / by_size["count"]) * (1 << 40)) + 1)
        sample = nodes.where((F.size("vector") == by_size["dims"]) & share).select("vector").orderBy("node")
        found = [list(r["vector"]) for r in sample.collect()]
    if not found:
        links, shared_core = None, None
    else:
        index = Pivots(unit_rows(pa.array(found)), threshold)
        kind = nodes.schema["vector"].dataType.simpleString()
        shape = f"vector {kind}, node string, n long, dims int, pivots array<int>, core int"
        described = stored(nodes.select("vector", "node", "n").mapInArrow(_described(index), shape), "described")
        width = min(NEAREST, len(found))
        used = max(1, width - min(SHARED, width) + 1)
        lists = described.withColumn("list", F.explode(F.slice("pivots", 1, used)))
        sizes = stored(lists.groupBy("list", "dims", "core").agg(F.count("*").alias("size")), "list-sizes")
        tiles = _tiles(lists, sizes, block).repartition("list", "dims", "lo", "hi").sortWithinPartitions("list", "dims", "lo", "hi")
        links = stored(tiles.mapInArrow(_tile_links(threshold), "node string, peer string, links long"), "links")
        cores = described.where("core >= 0").groupBy("core").agg(F.min("node").alias("peer"), F.sum("n").alias("links"))
        in_core = described.where("core >= 0").join(stored(cores, "cores"), "core")
        shared_core = in_core.select("node", "peer", (F.col("links") - F.col("n")).alias("links"))
    if links is not None:
        links = links.union(shared_core)
        reached = components(links.select(F.col("node").alias("u"), F.col("peer").alias("v")))
        linked = links.groupBy("node").agg(F.sum("links").alias("links"))
        nodes = nodes.drop("vector").join(linked, "node", "left").join(reached.select("node", "component"), "node", "left")
        nodes = stored(nodes.withColumn("component", F.coalesce("component", "node")), "linked")
        smallest = stored(nodes.groupBy("component").agg(F.min("least").alias("component_id")), "smallest")
        nodes = nodes.join(smallest, "component").select("node", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    else:
        nodes = nodes.select("node", (F.col("n") - 1).alias("n_links"), F.col("least").alias("component_id"))
    told = rows.select("id", "ok", "node").join(stored(nodes, "classes"), "node", "left")
    component = F.when(ok, F.col("component_id")).otherwise(F.col("id"))
    told = told.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return told.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
