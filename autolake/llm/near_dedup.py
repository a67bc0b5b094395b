"""Near-duplicate classes by a multi-index Hamming join of b-bit MinHash signatures.

1. Every whole text becomes its set of word shingles; rows with equal sets (by a 128-bit
   sum hash over the distinct shingles and their number) are one class, kept as one node.
2. A class has a signature of ``SIGNATURE`` MinHash values of 16 bits. Two sets at the
   similarity threshold differ in more than ``distance`` values with probability below
   ``MISS``. Signatures are split into chunks; by the pigeonhole principle two signatures
   within ``distance`` agree on some chunk but for ``distance // chunks`` values, so every
   chunk is entered under all subsets of its values with so many left out.
3. Each entry's members are compared with the entry's smallest member; components follow after
   the round, and entries whose members are all together are done. Of the others, those of at
   most ``BLOCK`` members are compared in one task. A larger one keeps only what can still be
   near: with ``far`` the least distance from the smallest member to one that is not together
   with it, members closer to it than ``far - distance`` are out (the triangle inequality). What
   is left and still too large is entered again under chunks of the values that its members need
   not share yet, for which the pigeonhole holds again; the round repeats on these entries.
4. Within the clusters so found, whose every link between different texts both lie in one
   cluster, full shingle sets are intersected: clusters of at most ``GROUP`` in one task; larger
   ones against their smallest member and in groups of ``GROUP``, and only members that then lie
   outside their cluster's largest component meet the other groups.

Nothing is capped, and rows grow with the members of a group, not with their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from autolake.llm import key_filter, words
from autolake.llm.stored import stored

SHINGLE = 5
PERCENT = 80                # default similarity threshold
SIGNATURE = 64
MISS = 1e-8
BLOCK = 2048                # signatures compared in one task
EDGES = 1_000_000           # thinned out at once inside a task
ENTRY_BITS = 10             # of a key: at most so many entries of one signature
GROUP = 512                 # shingle sets of one side compared in one task

_SEEDS = words.mix(np.arange(1, SIGNATURE + 1, dtype=np.uint64)) | np.uint64(1)


def max_distance(percent: int, size: int = SIGNATURE, miss: float = MISS) -> int:
    """Values in which two signatures at the threshold differ at most, but for probability ``miss``."""
    p, tail, d = 1 - percent / 100, 1.0, -1
    while tail > miss and d < size:
        d += 1
        tail -= comb(size, d) * p ** d * (1 - p) ** (size - d)
    return d


def chunk_entries(size: int, distance: int) -> list[tuple[int, tuple[int, ...]]]:
    """(chunk, places whose values make a key) of all index entries of a signature of ``size`` values.

    With distance // 2 + 1 chunks, one chunk at least has at most distance // chunks differing values."""
    n_chunks = distance // 2 + 1
    out = []
    for c, chunk in enumerate(np.array_split(np.arange(size), n_chunks)):
        allowed = min(distance // n_chunks, len(chunk) - 1)
        out += [(c, kept) for kept in combinations(chunk.tolist(), len(chunk) - allowed)] if len(chunk) else []
    return out


def chunk_keys(signatures: np.ndarray, distance: int) -> np.ndarray:
    """Keys of all index entries of each signature (rows); the low ENTRY_BITS bits are the entry's number."""
    wide = signatures.astype(np.uint64)
    out = []
    for n, (_, kept) in enumerate(chunk_entries(signatures.shape[1], distance)):
        key = np.full(len(wide), n + 1, np.uint64)
        for k in kept:
            key = words.mix(key ^ wide[:, k])
        out.append(_numbered(key, n))
    return np.stack(out, 1) if out else np.zeros((len(wide), 0), np.uint64)


def _numbered(key: np.ndarray, n) -> np.ndarray:
    return key << np.uint64(ENTRY_BITS) | np.uint64(n)


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts in a row (sorted within each), and each text's bounds.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A text of fewer words than
    ``size``, but not none, is one shingle.
    """
    hashes, bounds = words.word_hashes(texts, words.LOWER)
    n_words = np.diff(bounds)
    at = words.window_starts(bounds, size)
    values = words.window_hashes(hashes, size)[at] if len(hashes) >= size else np.zeros(0, np.uint64)
    doc = np.searchsorted(bounds, at, "right") - 1
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        whole = np.full(len(short), 0x5EED, np.uint64)
        for k in range(size - 1):
            has = n_words[short] > k
            whole[has] = words.mix(whole[has] ^ hashes[bounds[short[has]] + k])
        values, doc = np.r_[values, whole], np.r_[doc, short]
    order = np.lexsort((values, doc))
    values, doc = values[order], doc[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    values, doc = values[first], doc[first]
    return values, np.searchsorted(doc, np.arange(len(texts) + 1))


def _set_hashes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two 64-bit sum hashes of every set."""
    sums = np.zeros((2, len(bounds) - 1), np.uint64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        for k in (0, 1):
            sums[k, full] = np.add.reduceat(words.mix(values ^ _SEEDS[k]), bounds[full])
    return sums


def _sketch(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in words.slices(batch, "text"):
            values, bounds = shingles(rows.column("text"), size)
            n = np.diff(bounds)
            full = np.flatnonzero(n)
            signature = np.zeros((len(n), SIGNATURE), "<u2")
            sums = _set_hashes(values, bounds)
            if len(full):
                begins = bounds[full]
                for k, seed in enumerate(_SEEDS):
                    low = np.minimum.reduceat(values * seed, begins)
                    signature[full, k] = (words.mix(low) & np.uint64(0xFFFF)).astype("<u2")
            raw = signature.tobytes()
            yield pa.RecordBatch.from_pydict({
                "id": rows.column("id"), "n": pa.array(n.astype(np.int64)),
                "h1": pa.array(sums[0].view(np.int64)), "h2": pa.array(sums[1].view(np.int64)),
                "signature": pa.array([raw[2 * SIGNATURE * i:2 * SIGNATURE * (i + 1)] for i in range(len(n))], pa.binary())})


def _signatures(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, SIGNATURE)


def _enter(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Index entries (key, node, used) of the signatures' values outside ``used``, a mask of places that
    all members of the entry ``key`` share already. ``_used_after`` tells the mask of a new entry."""
    for batch in batches:
        if not batch.num_rows:
            continue
        signatures, used = _signatures(batch.column("signature")), batch.column("used").to_numpy().view(np.uint64)
        parent, node = batch.column("key").to_numpy().view(np.uint64), batch.column("node").to_numpy()
        for mask in np.unique(used).tolist():
            rows = np.flatnonzero(used == mask)
            free = _free(mask)
            if len(free) <= distance:       # all pairs are near: the smallest member has met them
                continue
            keys = chunk_keys(signatures[rows][:, free], distance)
            number = keys & np.uint64((1 << ENTRY_BITS) - 1)
            keys = _numbered(words.mix(keys ^ words.mix(parent[rows])[:, None]), 0) | number
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(keys.ravel().view(np.int64)), "node": pa.array(np.repeat(node[rows], keys.shape[1])),
                "used": pa.array(np.full(keys.size, mask, np.uint64).view(np.int64))})


def _free(mask: int) -> np.ndarray:
    return np.array([k for k in range(SIGNATURE) if not mask >> k & 1], np.int64)


def _used_after(mask: int, key: int, distance: int) -> int:
    """The places that the members of an entry share: those of its parent, and the entry's own."""
    free = _free(mask)
    _, kept = chunk_entries(len(free), distance)[key & ((1 << ENTRY_BITS) - 1)]
    return mask | sum(1 << int(free[k]) for k in kept)


def _go_deeper(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Entries with ``used`` brought up to date."""
    for batch in batches:
        pairs = list(zip(batch.column("used").to_pylist(), batch.column("key").to_pylist()))
        number = (1 << ENTRY_BITS) - 1
        known = {(u, k & number): np.uint64(_used_after(u % (1 << 64), k, distance)) for u, k in pairs}
        used = np.array([known[u, k & number] for u, k in pairs], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("node"), batch.column("signature"), pa.array(used)],
                                         names=["key", "node", "signature", "used"])


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            differ = (_signatures(batch.column("sa")) != _signatures(batch.column("sb"))).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(differ.astype(np.int32))], names=["a", "b", "d"])


class Forest:
    """Union-find over 0..n-1; keeps the edges that joined two trees."""

    def __init__(self, n: int):
        self._up = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self._up[i] != i:
            self._up[i] = i = self._up[self._up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self._up[max(a, b)] = min(a, b)
            self.edges.append((i, j))


def _edge_table(nodes: np.ndarray, forest: Forest) -> pa.Table:
    pairs = np.array(forest.edges, np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(nodes[pairs[:, 0]]), "b": pa.array(nodes[pairs[:, 1]])})


def _start(clusters: np.ndarray) -> tuple[Forest, np.ndarray]:
    """A forest in which members of one cluster are together, and the places outside the largest cluster:
    every pair of different clusters has a side there."""
    forest = Forest(len(clusters))
    _, code, sizes = np.unique(clusters, return_inverse=True, return_counts=True)
    heads = np.full(len(sizes), -1)
    for i, c in enumerate(code.tolist()):
        if heads[c] < 0:
            heads[c] = i
        else:
            forest.join(int(heads[c]), i)
    forest.edges.clear()
    return forest, np.flatnonzero(code != sizes.argmax())


def _near_in_entry(table: pa.Table, distance: int) -> pa.Table:
    """Spanning edges of an entry's pairs of different clusters within the signature distance."""
    nodes, cluster = table.column("node").to_numpy(), table.column("cluster").to_numpy()
    signature = _signatures(table.column("signature"))
    forest, outside = _start(cluster)
    for i in outside.tolist():
        differ = (signature != signature[i]).sum(1)
        found = np.flatnonzero((differ <= distance) & (cluster != cluster[i]))
        for j in found[np.unique(cluster[found], return_index=True)[1]].tolist():       # one of each cluster is enough
            forest.join(i, j)
    return _edge_table(nodes, forest)


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets at ``left`` with those at ``right``."""
    n = np.array([len(s) for s in sets])
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[code] > 1
    renumbered = np.cumsum(times > 1) - 1
    row, col = np.repeat(np.arange(len(sets)), n)[shared], renumbered[code[shared]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    common = np.zeros((len(left), len(right)), np.float32)
    place_l, place_r = np.full(len(sets), -1), np.full(len(sets), -1)
    place_l[left], place_r[right] = np.arange(len(left)), np.arange(len(right))
    width = 4096
    for a in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        lo, hi = np.searchsorted(col, [a, a + width])
        r, c = row[lo:hi], col[lo:hi] - a
        ml, mr = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        inl, inr = place_l[r] >= 0, place_r[r] >= 0
        ml[place_l[r[inl]], c[inl]] = 1
        mr[place_r[r[inr]], c[inr]] = 1
        common += ml @ mr.T
    return common.astype(np.int64)


def _linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``left`` and ``right`` of the pairs whose full sets reach the threshold."""
    n = np.array([len(s) for s in sets])
    common = _common(sets, left, right)
    union = n[left][:, None] + n[right][None, :] - common
    i, j = np.nonzero((100 * common >= percent * union) & (left[:, None] != right[None, :]))
    return left[i], right[j]


def _links_in_group(table: pa.Table, percent: int) -> pa.Table:
    """Spanning edges of a group's links. Column ``side``: 2 all pairs; else the pairs of a 0 and a 1
    that lie in different components (column ``cluster``)."""
    nodes, first = np.unique(table.column("node").to_numpy(), return_index=True)       # rows that repeat an id
    table = table.take(pa.array(first))
    sets = [np.frombuffer(s, "<u8") for s in table.column("shingles").to_pylist()]
    side = table.column("side").to_numpy()
    forest = Forest(len(nodes))
    if (side == 2).all():
        # most of a group of copies is linked with its first member
        near_first, _ = _linked(sets, np.arange(len(nodes)), np.array([0]), percent)
        for i in near_first.tolist():
            forest.join(0, i)
        roots = np.array([forest.root(i) for i in range(len(nodes))])
        _, outside = _start(roots)
        left, right = outside, np.arange(len(nodes))
    else:
        part = table.column("part").to_numpy()
        forest, _ = _start(part)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if len(left) and len(right):
        for i, j in zip(*(x.tolist() for x in _linked(sets, left, right, percent))):
            forest.join(i, j)
    return _edge_table(nodes, forest)


def _linked_with_leader(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        own, other = (batch.column(c).to_pylist() for c in ("shingles", "leader_set"))
        linked = []
        for x, y in zip(own, other):
            a, b = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            common = len(np.intersect1d(a, b, assume_unique=True))
            linked.append(100 * common >= percent * (len(a) + len(b) - common))
        yield pa.RecordBatch.from_arrays([batch.column("cluster"), batch.column("node")], names=["a", "b"]).filter(pa.array(linked))


def _spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of every ``EDGES`` edges (a, b), each node on the smallest node of its tree."""
    held, n = [], 0

    def forest() -> pa.RecordBatch:
        ends = np.concatenate(held).reshape(2, -1) if len(held) == 1 else np.concatenate([h.reshape(2, -1) for h in held], 1)
        nodes, code = np.unique(ends, return_inverse=True)
        code = code.reshape(2, -1)
        trees = Forest(len(nodes))
        for i, j in zip(code[0].tolist(), code[1].tolist()):
            trees.join(i, j)
        root = np.array([trees.root(i) for i in range(len(nodes))], np.int64)
        own = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_pydict({"a": pa.array(nodes[own]), "b": pa.array(nodes[root[own]])})

    for batch in batches:
        held.append(np.concatenate([batch.column("a").to_numpy(), batch.column("b").to_numpy()]))
        n += batch.num_rows
        if n >= EDGES:
            yield forest()
            held, n = [], 0
    if n:
        yield forest()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b).

    Edges are thinned out to spanning forests inside the tasks; then large-star and small-star
    steps alternate until no edge changes. Each step is stored, its edges summed in the same job.
    """
    own = Window.partitionBy("u")       # one shuffle; a node's neighbours pass its task as a stream

    def star(pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("m", F.least(F.min("v").over(own), F.col("u")))

    def settled(pairs: DataFrame) -> tuple[DataFrame, tuple]:
        seen = Observation()
        now = stored(pairs.where("a != b").distinct().observe(
            seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")), "near-edges")
        return now, (seen.get["n"], seen.get["h"])

    now, mark = settled(edges.select("a", "b").mapInArrow(_spanning, "a long, b long"))
    while mark[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(now.select(F.col("b"), F.col("a")))
        large = star(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        # every edge now points down; a node and its smaller neighbours hang on the smallest of them
        small = star(large).select(F.explode(F.array(F.col("u"), F.col("v"))).alias("a"), F.col("m").alias("b"))
        before = mark
        now, mark = settled(small)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        now.select("b", "b").distinct())


def _united(edges: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, [e.select("a", "b") for e in edges])


def _clusters(nodes: DataFrame, distance: int, block: int) -> DataFrame:
    """(node, cluster) of the components of all pairs of (node, signature) within the distance."""
    edges: list[DataFrame] = []
    none = F.lit(0).cast("long")
    entered, top = nodes.select(none.alias("key"), none.alias("used"), "node", "signature"), True
    by_key = Window.partitionBy("key").orderBy("node")
    while True:
        entries = entered.mapInArrow(partial(_enter, distance=distance), "key long, node long, used long")
        if top:     # nothing is shared yet: a column less to shuffle
            entries = entries.drop("used")
        # entries with one member go; the smallest member stands before the others
        found = (entries.withColumn("leader", F.first("node").over(by_key)).withColumn("next", F.lead("node").over(by_key))
                 .where("node <> leader or next is not null").drop("next"))
        members = stored(found.withColumn("used", none) if top else found, "near-members")
        pairs = members.where("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
        side = lambda n: nodes.select(F.col("node").alias(n), F.col("signature").alias(f"s{n}")).hint("merge")
        apart = stored(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_distances, "a long, b long, d int"), "near-pairs")
        edges.append(apart.where(F.col("d") <= distance))
        now = stored(components(_united(edges)), "near-first")
        edges = [now.select(F.col("node").alias("a"), F.col("component").alias("b"))]      # the same trees, as stars

        own = F.coalesce("component", "node").alias("cluster")
        placed = stored(members.join(now.hint("merge"), "node", "left").select("key", "used", "node", "leader", own), "near-placed")
        split = stored(placed.groupBy("key").agg(F.min("cluster").alias("lo"), F.max("cluster").alias("hi"), F.count("*").alias("size"))
                       .where("lo < hi").select("key", "size"), "near-split")
        open_ = stored(placed.join(split.hint("merge"), "key"), "near-open")
        near = lambda t: _near_in_entry(t, distance)
        compared = lambda rows: (rows.select("key", "node", "cluster").join(nodes.hint("merge"), "node")
                                 .groupBy("key").applyInArrow(near, "a long, b long"))
        edges.append(stored(compared(open_.where(F.col("size") <= block)), "near-found"))
        large = open_.where(F.col("size") > block)
        if large.isEmpty():
            if edges[-1].isEmpty():
                return now.withColumnRenamed("component", "cluster")
            break
        # what a large entry's members that are not together with its smallest one can still be near to
        head = now.select(F.col("node").alias("leader"), F.col("component").alias("head"))
        from_leader = apart.select(F.col("a").alias("leader"), F.col("b").alias("node"), "d")
        measured = stored(large.join(head, "leader", "left").join(from_leader, ["leader", "node"], "left")
                          .select("key", "used", "node", "cluster", F.coalesce("d", F.lit(0)).alias("d"),
                                  (F.col("cluster") != F.coalesce("head", "leader")).alias("away")), "near-measured")
        far = measured.where("away").groupBy("key").agg((F.min("d") - distance).alias("least"))
        left = stored(measured.join(far, "key").where("d >= least").drop("d", "least", "away"), "near-left")
        sizes = stored(left.groupBy("key").agg(F.count("*").alias("size")), "near-sizes")
        left = left.join(sizes, "key")
        edges.append(stored(compared(left.where(F.col("size") <= block)), "near-found"))
        deeper = left.where(F.col("size") > block)
        if deeper.isEmpty():
            break
        deeper = deeper.select("key", "used", "node").join(nodes, "node").select("key", "node", "signature", "used")
        entered = stored(deeper.mapInArrow(partial(_go_deeper, distance=distance), deeper.schema), "near-deeper")
        top = False
    return components(_united(edges)).withColumnRenamed("component", "cluster")


def _links(base: DataFrame, reps: DataFrame, clusters: DataFrame, percent: int, size: int, group: int) -> list[DataFrame]:
    """Edges that span the links between the clusters' classes, confirmed on full sets."""
    sizes = stored(clusters.groupBy("cluster").agg(F.count("*").alias("members")), "near-cluster-sizes")
    wanted = stored(reps.select("node", "least", "h1", "h2").join(clusters, "node").join(sizes, "cluster"), "near-wanted")
    kind = "node long, cluster long, members long, shingles binary"
    # a class is found again by its smallest id; of an id's several texts the one with the class's sets counts
    holds = base.sparkSession.sparkContext.broadcast(key_filter.build(wanted.select(F.xxhash64("least").alias("h")), "h"))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:       # texts of no cluster stay where they are
            yield batch.filter(pa.array(holds.value(batch.column("h").to_numpy().view(np.uint64)))).select(["id", "text"])

    texts = base.withColumn("h", F.xxhash64("id")).mapInArrow(held, base.schema)
    full = lambda rows: (texts.join(rows.withColumnRenamed("least", "id").hint("merge"), "id")
                         .mapInArrow(partial(_sets, size=size), kind))
    linked = lambda t: _links_in_group(t, percent)
    whole = full(wanted.where(F.col("members") <= group)).withColumn("side", F.lit(2))
    edges = [stored(whole.groupBy("cluster").applyInArrow(linked, "a long, b long"), "near-links")]
    if wanted.where(F.col("members") > group).isEmpty():
        return edges

    large = stored(full(wanted.where(F.col("members") > group)).dropDuplicates(["node"]), "near-large")
    leaders = stored(large.where("node = cluster").select("cluster", F.col("shingles").alias("leader_set")), "near-leaders")
    edges.append(stored(large.join(leaders, "cluster").mapInArrow(partial(_linked_with_leader, percent=percent), "a long, b long"), "near-links"))
    dealt = large.withColumn("blocks", F.ceil(F.col("members") / group).cast("int")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    edges.append(stored(dealt.withColumn("side", F.lit(2)).groupBy("cluster", "block").applyInArrow(linked, "a long, b long"), "near-links"))
    # members outside their cluster's largest component meet the other groups
    now = stored(components(_united(edges[1:])), "near-parts")
    part = stored(large.select("node", "cluster").join(now, "node", "left").select("cluster", "node", F.coalesce("component", "node").alias("part")), "near-part")
    top = part.groupBy("cluster", "part").agg(F.count("*").alias("n")).groupBy("cluster").agg(F.max_by("part", F.struct("n", "part")).alias("main"))
    top = stored(top, "near-main")
    stray = stored(part.join(top, "cluster").where("part != main").select("cluster", "node", "part"), "near-stray")
    strays = stored(stray.groupBy("cluster").agg(F.ceil(F.count("*") / group).cast("int").alias("batches")), "near-strays")
    placed = dealt.join(part.select("node", "part"), "node").join(strays, "cluster")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    ones = placed.withColumn("side", F.lit(1)).select("cluster", "block", each("batches").alias("batch"), "node", "part", "side", "shingles")
    zeros = (placed.join(stray.select("node"), "node").withColumn("side", F.lit(0))
             .withColumn("batch", F.pmod(F.xxhash64("node", F.lit(3)), F.col("batches")).cast("int"))
             .select("cluster", each("blocks").alias("block"), "batch", "node", "part", "side", "shingles"))
    meet = zeros.unionAll(ones).groupBy("cluster", "block", "batch")
    edges.append(stored(meet.applyInArrow(lambda t: _stray_links(t, percent), "a long, b long"), "near-links"))
    return edges


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
            size: int = SHINGLE, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """Per row: id, n_shingles (set size), component_id (smallest id reachable), kept (id is that).

    Rows are linked if 100 * intersection >= percent * union of their shingle sets. Null, empty
    and wordless texts have an empty set and no links. Rows of one id count as one document,
    whatever their texts: all of them have one component. A null id is linked with nothing:
    component_id null, kept. Ids may be of any type with an order. An empty table gives no rows.
    Other columns of ``docs`` are not read.
    """
    distance = max_distance(percent)
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketched = stored(base.mapInArrow(partial(_sketch, size=size), f"id {kind}, n long, h1 long, h2 long, signature binary"), "near-sketch")
    sets = ["h1", "h2", "n"]
    usable = sketched.where("n > 0 and id is not null")
    # a class's number is fixed by the write
    reps = stored(usable.groupBy(*sets).agg(F.min("id").alias("least"), F.first("signature").alias("signature"))
                  .withColumn("node", F.monotonically_increasing_id()), "near-reps")
    owners = stored(usable.select("id", *sets).distinct().join(reps.select(*sets, "node"), sets).select("id", "node"), "near-owners")
    clusters = stored(_clusters(reps.select("node", "signature"), distance, block), "near-clusters")
    links = _links(base, reps, clusters, percent, size, group)

    # an id's classes are one document
    several = owners.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("top")).where("a < top").drop("top")
    links.append(owners.join(several, "id").select("a", F.col("node").alias("b")))
    found = stored(components(_united(links)), "near-classes")
    labelled = stored(reps.select("node", "least").join(found, "node", "left").select("node", "least", F.coalesce("component", "node").alias("part")), "near-labelled")
    lowest = stored(labelled.groupBy("part").agg(F.min("least").alias("component_id")), "near-lowest")
    by_node = labelled.join(lowest, "part").select("node", "component_id")
    by_id = stored(owners.join(by_node, "node").groupBy("id").agg(F.min("component_id").alias("component_id")), "near-by-id")
    out = sketched.select("id", "n").join(by_id, "id", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return (out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
               .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))


def _stray_links(table: pa.Table, percent: int) -> pa.Table:
    """Links of one batch of strays (side 0) with one group (side 1); a stray of that group is on both sides."""
    zeros = table.filter(pa.array(table.column("side").to_numpy() == 0))
    ones = table.filter(pa.array(table.column("side").to_numpy() == 1))
    if not zeros.num_rows or not ones.num_rows:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    again = np.isin(zeros.column("node").to_numpy(), ones.column("node").to_numpy())
    return _links_in_group(pa.concat_tables([ones, zeros.filter(pa.array(~again))]), percent)


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Full sets of the classes, each once per task; rows whose set is not the class's go."""
    seen: set = set()
    for batch in batches:
        for rows in words.slices(batch, "text"):
            new = [n not in seen for n in rows.column("node").to_pylist()]
            rows = rows.filter(pa.array(new))
            if not rows.num_rows:
                continue
            values, bounds = shingles(rows.column("text"), size)
            h1, h2 = _set_hashes(values, bounds)
            same = (h1.view(np.int64) == rows.column("h1").to_numpy()) & (h2.view(np.int64) == rows.column("h2").to_numpy())
            raw = values.astype("<u8", copy=False).tobytes()
            sets = [raw[8 * a:8 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            out = pa.RecordBatch.from_pydict({c: rows.column(c) for c in ("node", "cluster", "members")} | {"shingles": pa.array(sets, pa.binary())})
            out = out.filter(pa.array(same))
            seen.update(out.column("node").to_pylist())
            yield out
