"""N-gram Jaccard join: which texts share so many word n-grams that their Jaccard similarity reaches a threshold.

Exact, in three steps, none of which emits the pairs of a group:

1. *Prefixes.* N-grams are in one global order: by how many sets have them, roughly, then by hash. Two linked sets share at
   least the threshold's part of either, so the first n-gram that they share is among the first ``size - least overlap + 1``
   of both, the prefixes. Sets meet on these n-grams; those that one set only has are left out, and a set whose
   prefix holds no other can have no partner. A common passage is late in the order, and brings no sets together that
   share little else.
2. *Groups.* Texts that meet, at one remove or more, are a group; a group of bounded size is one part, to which
   each of its texts moves once. In a larger one the texts of an n-gram are dealt to the n-gram's smallest text, its star,
   once for each such star, and stars are split by salt into parts of bounded size.
3. *Tries.* In each part, the ordered sets lie in a trie (sorted sets with the length of their common
   prefix). A set walks the trie with one partial overlap per level, so that a shared prefix is counted once. Where the overlap
   so far plus what can remain is too little, the subtree is left: the sets below it are not entered, as the bound is looked
   at before any of their n-grams. Sets already in the same component aren't compared. What comes out is a
   spanning forest of the part.

Where a star was split, texts that did not end up in the star's component are compared once more with every
part, so that no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalfold.llm.components import components, stored
from signalfold.llm.filters import maybe_in
from signalfold.llm.grouped import group_runs
from signalfold.llm.text import Words, find_words, mix, shingle_sets, sliced, word_runs

HELD_KEYS = 1_000_000
KEY_BYTES = 4  # of a packed n-gram; the part it is in tells more
COMMON = (2, 8, 64)  # sets that have an n-gram of each class of the order, at least
MOST_BITS = 1 << 27  # 16 MB a class; where more n-grams are shared, more are taken for shared ones


@dataclass(frozen=True)
class Jaccard:
    """Linked: ``den * intersection >= num * union``, on sets of distinct ``n``-word shingles of lower-cased words."""

    n: int = 5
    num: int = 80
    den: int = 100

    def __post_init__(self):
        if not 0 < self.num <= self.den or self.n < 1:
            raise ValueError("the threshold must be in (0, 1] and n at least 1")

    def needed(self, a: int, b: int) -> int:
        """The least overlap of two linked sets of these sizes."""
        return -(-self.num * (a + b) // (self.den + self.num))

    def prefix(self, size: int) -> int:
        """How many of a set's first n-grams hold the first that it shares with a linked set."""
        return size - -(-self.num * size // self.den) + 1 if size else 0


class Order:
    """The global order of n-grams: classes of how common they are, from bitmaps, then hashes."""

    def __init__(self, bitmaps: list[np.ndarray], width: int):
        self.bitmaps, self.width = bitmaps, width

    def classes(self, grams: np.ndarray) -> np.ndarray:
        """0 for n-grams that one set only has; some of those may be taken for shared ones."""
        slot = _slots(*_low(grams, self.width))
        found = np.zeros(len(grams), dtype=np.int8)
        for bits in self.bitmaps:
            at = slot % np.uint64(8 * len(bits))
            found += ((bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(np.int8)
        return found

    def prefix(self, ordered: np.ndarray, rule: Jaccard) -> np.ndarray:
        """The n-grams of a set's prefix that others have too; ``ordered`` are all, by hash."""
        classes = self.classes(ordered)
        most = rule.prefix(len(ordered))
        alone = int((classes == 0).sum())
        if alone >= most:
            return ordered[:0]
        return ordered[np.argsort(classes, kind="stable")[alone:most]]


def _sets(words: Words, rule: Jaccard) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The sets of a run of texts, their sizes, and a hash of each whole set."""
    sets = shingle_sets(words, rule.n)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    nodes = np.array([np.add.reduce(mix(s * np.uint64(0x9E3779B97F4A7C15))) for s in sets], dtype=np.uint64)
    return sets, sizes, mix(nodes + sizes.astype(np.uint64)).view(np.int64)


def _sketches(rule: Jaccard):
    """Rows (id, text): (id, n_shingles, node) with the hash of the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in word_runs(batch.column(1), lower=True):
                sets, sizes, nodes = _sets(words, rule)
                yield pa.record_batch([batch.column(0).slice(row, len(sets)), pa.array(sizes), pa.array(nodes)], names=["id", "n_shingles", "node"])

    return run


def _prefixes(rule: Jaccard, order: Broadcast):
    """Rows (id, text): (key, node, n_shingles) for each n-gram of a prefix that others have too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words in word_runs(batch.column(1), lower=True):
                sets, sizes, nodes = _sets(words, rule)
                found = [order.value.prefix(s, rule) for s in sets]
                held = [len(f) for f in found]
                key = np.concatenate([np.zeros(0, dtype=np.uint64), *found]).view(np.int64)
                yield pa.record_batch([pa.array(key), pa.array(np.repeat(nodes, held)), pa.array(np.repeat(sizes, held))], names=["key", "node", "n_shingles"])

    return run


def _low(key: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(part, low bits) of keys: what is kept of them to find the shared ones."""
    return (key >> np.uint64(8 * KEY_BYTES)) % np.uint64(width), key & np.uint64((1 << 8 * KEY_BYTES) - 1)


def _slots(part: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mix(low ^ (part << np.uint64(8 * KEY_BYTES))) >> np.uint64(1)


def _packed(rule: Jaccard, width: int):
    """Rows (id, text): (part, grams, counts), the n-grams of many sets at once, each once with its count, as packed bytes. So a
    common n-gram is no load."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def table() -> pa.RecordBatch:
            part, low = _low(np.concatenate([np.zeros(0, dtype=np.uint64), *held]), width)
            held.clear()
            both, counts = np.unique((part << np.uint64(8 * KEY_BYTES)) | low, return_counts=True)
            bounds = np.searchsorted(both, np.arange(width + 1, dtype=np.uint64) << np.uint64(8 * KEY_BYTES))
            grams = both.astype("<u4").tobytes()
            capped = np.minimum(counts, 255).astype(np.uint8).tobytes()
            some = np.flatnonzero(np.diff(bounds)).tolist()
            spans = [(int(bounds[p]), int(bounds[p + 1])) for p in some]
            return pa.record_batch(
                [pa.array(some, pa.int32()), pa.array([grams[KEY_BYTES * a : KEY_BYTES * b] for a, b in spans], pa.binary()), pa.array([capped[a:b] for a, b in spans], pa.binary())],
                names=["part", "grams", "counts"],
            )

        for batch in batches:
            for _, words in word_runs(batch.column(1), lower=True):
                held += shingle_sets(words, rule.n)
                if sum(map(len, held)) > HELD_KEYS:
                    yield table()
        yield table()

    return run


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, grams, counts), sorted by part: (slot, class) of every n-gram that several sets have."""
    for rows in group_runs(batches, 1):
        part = np.uint64(rows.column("part")[0].as_py())
        low = np.frombuffer(b"".join(rows.column("grams").to_pylist()), dtype="<u4")
        counts = np.frombuffer(b"".join(rows.column("counts").to_pylist()), dtype=np.uint8)
        order = np.argsort(low, kind="stable")
        low, counts = low[order], counts[order].astype(np.int64)
        first = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
        total = np.add.reduceat(counts, first)
        shared = total >= COMMON[0]
        slot = _slots(np.full(int(shared.sum()), part), low[first[shared]].astype(np.uint64))
        kind = np.searchsorted(COMMON, total[shared], side="right")
        yield pa.record_batch([pa.array(slot.view(np.int64)), pa.array(kind.astype(np.int32))], names=["slot", "class"])


def _bitmap(slots: DataFrame) -> np.ndarray:
    """The slots as bits, sixteen to a slot, at most ``MOST_BITS``: all that the driver gets of them, and broadcasts."""
    bits = min(MOST_BITS, 1 << max(20, (16 * slots.count()).bit_length()))
    bit = F.pmod("slot", F.lit(bits)) + 1
    rows = slots.groupBy(F.bitmap_bucket_number(bit).alias("slice")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in rows.toLocalIterator():
        at = (row["slice"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return out


def gram_order(texts: DataFrame, rule: Jaccard) -> Order:
    """The order of the n-grams of ``texts`` (id, text)."""
    width = 4 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = texts.mapInArrow(_packed(rule, width), "part int, grams binary, counts binary").repartition(width, "part").sortWithinPartitions("part")
    common = stored(packed.mapInArrow(_common, "slot long, class int"), "common")
    return Order([_bitmap(common.where(F.col("class") > k)) for k in range(len(COMMON))], width)


class _Part:
    """The ordered sets of one part of a star, as a trie, and the forest of links found in it."""

    BRANCHES = 64

    def __init__(self, ids: list[int], sets: list[np.ndarray], rule: Jaccard):
        # bytes in big-endian order sort as the numbers do: depth-first order of the trie
        order = sorted(range(len(ids)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.ids = [ids[i] for i in order]
        self.sets = [sets[i] for i in order]
        self.sizes = np.array([len(s) for s in self.sets], dtype=np.int64)
        self.rule = rule
        self.shared = [0]  # n-grams that a set shares with the one before it, from the root
        for a, b in zip(self.sets, self.sets[1:], strict=False):
            k = min(len(a), len(b))
            unequal = np.flatnonzero(a[:k] != b[:k])
            self.shared.append(int(unequal[0]) if len(unequal) else k)
        self.branches = np.zeros((len(ids), self.BRANCHES), dtype=np.int32)
        for row, s in zip(self.branches, self.sets, strict=True):
            row += np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=self.BRANCHES).astype(np.int32)
        self.parent = list(range(len(ids)))
        seen: dict[int, int] = {}
        for i, name in enumerate(self.ids):  # an id on several rows is one node
            self.parent[i] = seen.setdefault(name, i)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            if self.ids[b] < self.ids[a]:
                a, b = b, a
            self.parent[b] = a

    def probe(self, i: int) -> None:
        """Walk the trie with set ``i`` and join it with every linked set that isn't in its component yet."""
        mine, size, rule = self.sets[i], len(self.sets[i]), self.rule
        # at the root: a set can't share more than the smaller count in each first-level range
        least = np.minimum(self.branches, self.branches[i]).sum(axis=1)
        needed = -(-rule.num * (self.sizes + size) // (rule.den + rule.num))
        hopeful = np.flatnonzero(least >= needed)
        walked: np.ndarray = np.zeros(1, dtype=np.int64)  # overlap by depth along the last path
        last, depth = -1, 0
        for j in hopeful.tolist():
            if j == i or self.root(j) == self.root(i):
                continue
            other = self.sets[j]
            common = min(self.shared[last + 1 : j + 1], default=0) if 0 <= last < j else 0
            depth = min(depth, common)  # the partial overlaps up to here still hold
            path = [walked[: depth + 1]]
            at, have = depth, int(walked[depth])
            must = int(needed[j])
            if depth:  # the subtree below the shared prefix
                left = size - int(np.searchsorted(mine, other[depth - 1], side="right"))
                if have + min(left, len(other) - depth) < must:
                    walked, last = walked[: depth + 1], j
                    continue
            while at < len(other):
                step = other[at : at + 128]
                found = np.searchsorted(mine, step)
                hit = mine[np.minimum(found, size - 1)] == step
                path.append(have + np.cumsum(hit))
                have = int(path[-1][-1])
                at += len(step)
                left = size - int(np.searchsorted(mine, step[-1], side="right"))
                if have + min(left, len(other) - at) < must:
                    break
            walked, depth, last = np.concatenate(path), at, j
            if at == len(other) and have >= must:
                self.join(i, j)

    def links(self) -> Iterator[tuple[int, int]]:
        for i, node in enumerate(self.ids):
            if (other := self.ids[self.root(i)]) != node:
                yield node, other


def _tries(rule: Jaccard):
    """Rows (star, salt, node, text, probes), sorted by (star, salt): links (u, v) of every part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in group_runs(batches, 2):
            ids, asks, sets = part.column("node").to_pylist(), part.column("probes").to_pylist(), []
            for _, data, offsets in sliced(part.column("text")):
                sets += shingle_sets(find_words(data, offsets, lower=True), rule.n)
            walkers = {i for i, ask in zip(ids, asks, strict=True) if ask}
            trie = _Part(ids, sets, rule)
            # the star's own text first: what it links need not be compared again
            for i in sorted((i for i, x in enumerate(trie.ids) if x in walkers), key=lambda i: trie.ids[i]):
                trie.probe(i)
            links = list(trie.links())
            if links:
                yield pa.record_batch([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["u", "v"])

    return run


def _named_texts(rule: Jaccard):
    """Rows (id, text): (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in word_runs(batch.column(1), lower=True):
                nodes = _sets(words, rule)[2]
                yield pa.record_batch([pa.array(nodes), batch.column(1).slice(row, len(nodes))], names=["node", "text"])

    return run


def _compare(parts: DataFrame, nodes: DataFrame, texts: DataFrame, rule: Jaccard) -> DataFrame:
    """Links (u, v) of nodes within each part; ``parts`` has (star, salt, node, probes), ``nodes`` an id of a text for each node."""
    placed = parts.join(nodes.select("node", "id"), "node")
    near = maybe_in(texts, F.col("id"), placed, F.col("id")).where("_maybe").select("id", "text")
    # one text for each node, whatever its copies; the grouping is by the join's key, so texts move once
    near = near.mapInArrow(_named_texts(rule), "node long, text string").groupBy("node").agg(F.first("text").alias("text"))
    full = parts.hint("merge").join(near, "node").select("star", "salt", "node", "text", "probes")
    dealt = full.repartition("star", "salt").sortWithinPartitions("star", "salt")
    return dealt.mapInArrow(_tries(rule), "u long, v long")


def ngram_jaccard_join(
    docs: DataFrame, rule: Jaccard = Jaccard(), id_col: str = "doc_id", text_col: str = "text", part_shingles: int = 1_000_000
) -> DataFrame:
    """(id, n_shingles, component_id) for each row of ``docs``: the size of its set, and the smallest id that links reach.

    Repeated rows and equal sets are linked (similarity 1). Texts without words (null, empty, spaces) have the
    empty set and no links. A row without an id can't be named: it has n_shingles, and a null component_id.
    Rows that share an id are one document with several sets.
    Very long texts are taken whole. Other columns of ``docs`` are not read, whatever their names.

    A set is named by a 64-bit hash (the node), which copies share. ``part_shingles``: about so many n-grams lie in
    a trie at once; larger stars are split by salt.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    named = texts.where("id is not null")
    sketches = stored(texts.mapInArrow(_sketches(rule), "id long, n_shingles long, node long"), "sketches")
    filled = sketches.where("n_shingles > 0 and id is not null")
    nodes = stored(filled.groupBy("node").agg(F.min("id").alias("id")), "nodes")

    # copies of a set have its n-grams; one of them says them
    speakers = maybe_in(named, F.col("id"), nodes, F.col("id")).where("_maybe").select("id", "text")
    order = docs.sparkSession.sparkContext.broadcast(gram_order(speakers, rule))
    shared = stored(speakers.mapInArrow(_prefixes(rule, order), "key long, node long, n_shingles long"), "prefixes")
    meets = shared.groupBy("key").agg(F.min("node").alias("star"), F.max("node").alias("last")).where("star < last").select("key", "star")
    spokes = stored(shared.join(stored(meets, "meets"), "key").select("star", "node", "n_shingles").distinct(), "stars")
    order.unpersist()

    # groups of texts that meet
    met = components(spokes.select(F.col("star").alias("u"), F.col("node").alias("v")))
    group = spokes.join(met, "node", "left").select("star", "node", "n_shingles", F.coalesce("component", "node").alias("group"))
    group = stored(group, "groups")
    members = group.select("group", "node", "n_shingles").distinct()
    loads = members.groupBy("group").agg(F.sum("n_shingles").alias("load"), F.count("*").alias("texts"))
    fits = (F.col("load") <= part_shingles) & (F.col("texts") <= part_shingles // 500)
    fitting = stored(loads.select("group", fits.alias("fits")), "fitting")
    whole = members.join(fitting.where("fits"), "group").select(F.col("group").alias("star"), F.lit(0).alias("salt"), "node", F.lit(True).alias("probes"))

    # stars of the others
    large = group.join(fitting.where("not fits").select("group"), "group").select("star", "node", "n_shingles")
    loads = large.groupBy("star").agg(F.sum("n_shingles").alias("load"), F.count("*").alias("texts"))
    salts = F.greatest(F.ceil(F.col("load") / part_shingles), F.ceil(F.col("texts") / (part_shingles // 500))).cast("int")
    sized = large.join(stored(loads.select("star", salts.alias("salts")), "loads"), "star")
    dealt = stored(sized.select("star", F.pmod(F.xxhash64("node", "star"), "salts").cast("int").alias("salt"), "node", "salts"), "dealt")
    stars = dealt.where("node = star").select("star", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "node")
    parts = stars.union(dealt.where("node <> star").select("star", "salt", "node")).withColumn("probes", F.lit(True))
    links = stored(_compare(stored(parts.union(whole.select(parts.columns)), "parts"), nodes, named, rule), "found")

    if not dealt.where("salts > 1").isEmpty():
        links = stored(links.union(_across(dealt.where("salts > 1"), links, nodes, named, rule, part_shingles)), "found")

    # an id with several sets links them
    several = filled.groupBy("id").agg(F.min("node").alias("u"), F.max("node").alias("v")).where("u < v")
    chained = filled.join(several, "id").where("node <> u").select("node", F.col("u").alias("v")).select(F.col("node").alias("u"), "v")
    joined = components(links.union(chained))
    labels = nodes.join(joined, "node", "left").select("node", "id", F.coalesce("component", "node").alias("component"))
    least = stored(labels.groupBy("component").agg(F.min("id").alias("component_id")), "least")
    found = stored(labels.join(least, "component").select("node", "component_id"), "components")
    told = sketches.join(found, "node", "left")
    own = F.when(F.col("id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")))
    return told.select(F.col("id").alias(id_col), "n_shingles", own.alias("component_id"))


def _across(split: DataFrame, found: DataFrame, nodes: DataFrame, texts: DataFrame, rule: Jaccard, part_shingles: int) -> DataFrame:
    """Links between the parts of split stars.

    Two linked texts of a star that aren't connected yet are not both in the star's component. So each text outside
    it is sent to every part, in portions of bounded size, and only those texts walk the tries.
    """
    joined = components(found).withColumnRenamed("node", "named")
    label = F.coalesce("component", "node").alias("label")
    labelled = split.join(joined, F.col("node") == F.col("named"), "left").select("star", "salt", "node", "salts", label)
    # sides that are aggregated or cut are written first: Spark splits a hot key of a join only where it reads both as they are
    hubs = stored(labelled.where("node = star").select("star", F.col("label").alias("hub")), "hubs")
    rest = labelled.join(hubs, "star").where("label <> hub").select("star", "node", "salts")
    portions = stored(rest.groupBy("star").agg(F.ceil(F.count("*") / (part_shingles // 500)).cast("int").alias("portions")), "portions")
    rest = stored(rest.join(portions, "star"), "rest")
    slot = (F.col("salt") * F.col("portions") + F.col("portion")).cast("int").alias("salt")
    sent = (
        rest.withColumn("portion", F.pmod(F.xxhash64("node"), "portions").cast("int"))
        .select("star", "node", "portions", "portion", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        .select("star", slot, "node", F.lit(True).alias("probes"))
    )
    still = (
        split.join(portions, "star")
        .select("star", "salt", "node", "portions", F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("portion"))
        .select("star", slot, "node", F.lit(False).alias("probes"))
    )
    return _compare(sent.union(still), nodes, texts, rule)
