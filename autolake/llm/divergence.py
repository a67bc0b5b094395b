"""Source divergence audit: how far each source's words are from its language and from other sources.

1. Terms of whole texts are counted per (lang, source) inside the tasks, then by aggregates
   that combine map-side; terms in too few documents of their language go.
2. Part `term`, count-cell ranking: the terms of a group fall into cells of equal (group count,
   language count), which decide the score. The score is evaluated once per cell, equal values
   are merged, the best values are kept by cumulative multiplicity, and only their cells are
   expanded into terms, in UTF-8 order.
3. Part `pair`: the sources of a language are cut into blocks; every pair of blocks gets its
   terms dealt over many buckets, and a task sums the score of each pair of sources over its
   bucket's terms. Terms in neither source are one more cell, counted and not looked at.

All arithmetic is exact: integers, and decimals where a product exceeds 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from autolake.functions.joins import bounded_broadcast
from autolake.llm import words
from autolake.llm.stored import stored

MIN_DOCS = 10
RANKS = 10
SCALE = 10 ** 9
# Sources of one side of a block pair, and terms a task looks at in one step.
BLOCK = 256
TERMS = 512

# Letters A-Z lower-cased, a-z and all bytes of other than ASCII characters stay, the rest is blank.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term per group, slice by slice."""
    for batch in batches:
        for rows in words.slices(batch, "text", 8 << 20):
            lang, source = rows.column("lang").dictionary_encode(), rows.column("source").dictionary_encode()
            wide = len(source.dictionary)
            group = lang.indices.to_numpy().astype(np.int64) * wide + source.indices.to_numpy()
            raw, begins = words.joined(rows.column("text"), _TERM_BYTES)
            starts, ends, bounds = words.word_spans(raw, begins)
            if not len(starts):
                continue
            at = np.r_[0, np.cumsum(ends - starts)]
            letters = raw[words._IN_WORD[raw] == 1]
            terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(letters)])
            coded = terms.dictionary_encode()
            many = len(coded.dictionary)
            doc = np.repeat(np.arange(rows.num_rows), np.diff(bounds))
            per_doc, n = np.unique(doc * many + coded.indices.to_numpy(), return_counts=True)
            key = group[per_doc // many] * many + per_doc % many
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            key, docs = key[first], np.diff(np.r_[first, len(key)])
            yield pa.RecordBatch.from_pydict({
                "lang": lang.dictionary.take(pa.array(key // many // wide)), "source": source.dictionary.take(pa.array(key // many % wide)),
                "term": coded.dictionary.take(pa.array(key % many)).cast(pa.binary()).cast(pa.string()),
                "n": pa.array(np.add.reduceat(n, first)), "docs": pa.array(docs)})


def share(n: Column, size: Column) -> Column:
    """p = 1 + floor(SCALE * (n + 2) / size), exact; null for an empty vocabulary."""
    size = F.nullif(size, F.lit(0)).cast("decimal(20,0)")
    product = F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    return _quotient(product, size) + 1


def _quotient(a: Column, b: Column) -> Column:
    """Whole quotient of two whole decimals; without its remainder the division has no fraction to round."""
    return ((a - a % b) / b).cast("decimal(38,0)").cast("long")


def score(p: Column, q: Column) -> Column:
    """f = floor((p - q)^2 / (p + q)) of two shares (at most SCALE + 1: products fit 64 bits)."""
    square = (p - q) * (p - q)
    return _quotient(square.cast("decimal(20,0)"), (p + q).cast("decimal(20,0)"))


def _shares(n: np.ndarray, size: np.ndarray) -> np.ndarray:
    """p of counts, by long division in steps of 1000: sizes up to 9 * 10**15 words stay within 64 bits."""
    left, out = n + 2, np.zeros(np.broadcast(n, size).shape, np.int64)
    whole, left = np.divmod(left, size)
    out += whole
    for _ in range(3):
        whole, left = np.divmod(left * 1000, size)
        out = out * 1000 + whole
    return out + 1


def _scores(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class _Tile:
    """Sums of the score over one bucket's terms, for all pairs of the sources of two blocks."""

    def __init__(self, key: tuple, block: int, step: int):
        self.lang, self.left, self.right, _ = key
        self._block, self._step = block, step
        self._index: list[int] = []
        self._size: list[int] = []
        self._cells: list[tuple] = []       # (term number, source number, count)
        self._term, self._terms, self.seen, self._sum = None, 0, 0, None

    def _ready(self) -> None:
        if self._sum is None:
            self.sources = np.array(self._index, np.int64)
            size = np.array(self._size, np.int64)
            self._order = np.argsort(self.sources)
            self.sources, self._size = self.sources[self._order], size[self._order]
            self._a = np.flatnonzero(self.sources // self._block == self.left)
            self._b = np.flatnonzero(self.sources // self._block == self.right)
            self._sum = np.zeros((len(self._a), len(self._b)), np.int64)

    def add(self, term: str | None, source: int, n: int, size: int) -> None:
        if term is None:        # a source of the tile: these come before all terms
            self._index.append(source)
            self._size.append(size)
            return
        if term != self._term:
            if self._terms == self._step:
                self._flush()
            self._term, self._terms = term, self._terms + 1
        self._cells.append((self._terms - 1, source, n))

    def _flush(self) -> None:
        self._ready()
        if self._terms:
            row, source, n = np.array(self._cells, np.int64).T
            counts = np.zeros((self._terms, len(self.sources)), np.int64)
            counts[row, np.searchsorted(self.sources, source)] = n
            p = _shares(counts, self._size)
            right = p[:, self._b]
            for i, a in enumerate(self._a):
                self._sum[i] += _scores(p[:, a, None], right).sum(0)
            self.seen += self._terms
        self._cells, self._terms, self._term = [], 0, None

    def rows(self) -> dict:
        self._flush()
        a, b = np.repeat(self.sources[self._a], len(self._b)), np.tile(self.sources[self._b], len(self._a))
        ordered = a < b
        n = int(ordered.sum())
        return {"lang": [self.lang] * n, "a": a[ordered], "b": b[ordered], "value": self._sum.ravel()[ordered],
                "seen": np.full(n, self.seen, np.int64)}


def _sum_tiles(batches: Iterator[pa.RecordBatch], block: int, step: int) -> Iterator[pa.RecordBatch]:
    now, key = None, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("lang", "left", "right", "bucket", "term", "number", "n", "size")]
        for lang, left, right, bucket, *cell in zip(*columns):
            if (lang, left, right, bucket) != key:
                if now:
                    yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in now.rows().items()}, schema=_TILE_ROWS)
                key = (lang, left, right, bucket)
                now = _Tile(key, block, step)
            now.add(*cell)
    if now:
        yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in now.rows().items()}, schema=_TILE_ROWS)


_TILE_ROWS = pa.schema([("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("value", pa.int64()), ("seen", pa.int64())])


def _pairs(kept: DataFrame, groups: DataFrame, buckets: int, block: int, step: int) -> DataFrame:
    """lang, source, item, value: the summed score of every two sources of a language."""
    blocks = groups.withColumn("block", F.floor(F.col("number") / block).cast("int"))
    blocks = blocks.withColumn("blocks", (F.max("block").over(Window.partitionBy("lang")) + 1))
    tile = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ends = (F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    heads = (blocks.where("sources > 1").select("*", tile)
             .select("lang", *ends, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"),
                     F.lit(None).cast("string").alias("term"), "number", F.lit(0).cast("long").alias("n"), "size"))
    own = blocks.where("sources > 1").select("lang", "source", "number", "size", "block", "blocks")
    cells = (kept.join(bounded_broadcast(own), ["lang", "source"]).select("*", tile)
             .select("lang", *ends, F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket"), "term", "number", "n", "size"))
    order = ["lang", "left", "right", "bucket"]
    sums = (heads.unionAll(cells).repartition(*order).sortWithinPartitions(*order, F.col("term").asc_nulls_first())
            .mapInArrow(partial(_sum_tiles, block=block, step=step), "lang string, a long, b long, value long, seen long"))
    total = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    side = lambda x: groups.select("lang", F.col("number").alias(x), F.col("source").alias(f"source_{x}"), F.col("zero").alias(f"zero_{x}"), "kept")
    both = (total.join(bounded_broadcast(side("a")), ["lang", "a"]).join(bounded_broadcast(side("b").drop("kept")), ["lang", "b"]))
    unseen = F.coalesce((F.col("kept") - F.col("seen")) * score(F.col("zero_a"), F.col("zero_b")), F.lit(0))
    value = F.col("value") + unseen
    way = F.explode(F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
                            F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item"))))
    return both.select("lang", value.alias("value"), way.alias("way")).select("lang", "way.*", "value")


def _terms(kept: DataFrame, groups: DataFrame, ranks: int) -> DataFrame:
    """lang, source, item, value, rank: the best ``ranks`` terms of every group."""
    group = ["lang", "source"]
    cells = kept.groupBy(*group, "n", "lang_n").agg(F.count("*").alias("terms"))
    sizes = bounded_broadcast(groups.select(*group, "size", "lang_size"))
    p, q = share(F.col("n"), F.col("size")), share(F.col("lang_n"), F.col("lang_size"))
    valued = cells.join(sizes, group).withColumn("p", p).withColumn("q", q).where("p > q")
    valued = stored(valued.select(*group, "n", "lang_n", "terms", score(F.col("p"), F.col("q")).alias("value")), "divergence-cells")
    best = Window.partitionBy(*group).orderBy(F.desc("value"))
    # a value has one term at least, so no more than `ranks` values of a group can matter
    top = (valued.groupBy(*group, "value").agg(F.sum("terms").alias("terms"))
           .withColumn("place", F.row_number().over(best)).where(F.col("place") <= ranks))
    before = F.coalesce(F.sum("terms").over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    top = top.withColumn("before", before).where(F.col("before") < ranks).select(*group, "value")
    chosen = valued.join(bounded_broadcast(top), [*group, "value"]).select(*group, "n", "lang_n", "value")
    expanded = kept.join(bounded_broadcast(chosen), [*group, "n", "lang_n"]).select(*group, F.col("term").alias("item"), "value")
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("value"), "item"))
    return expanded.withColumn("rank", place).where(F.col("rank") <= ranks)


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          min_docs: int = MIN_DOCS, ranks: int = RANKS, block: int = BLOCK, step: int = TERMS) -> DataFrame:
    """Rows lang, source, part, item, value, rank of both parts of the audit.

    `pair`: every other source of the language with the summed score, all ranks. `term`: the best
    ``ranks`` terms that the group uses more than its language. Ranks go by value descending,
    then item in UTF-8 order.

    Null lang, source and text read as ''. Every row is a document, repeated rows too. A language
    without kept terms has pairs of value 0 and no terms; a language of one source has no pairs.
    An empty table gives no rows. Other columns of ``docs`` are not read. ``block`` sources of either
    side and ``step`` terms are what a task holds at once.
    """
    read = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    base = docs.select(read(lang_col).alias("lang"), read(source_col).alias("source"), read(text_col).alias("text"))
    group = ["lang", "source"]
    counted = base.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    counts = stored(counted.groupBy(*group, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
    terms = stored(counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
                   .where(F.col("docs") >= min_docs).drop("docs"), "divergence-terms")
    kept = stored(counts.drop("docs").join(terms, ["lang", "term"]), "divergence-kept")

    langs = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = kept.groupBy(*group).agg(F.sum("n").alias("total"))
    none = lambda c: F.coalesce(c, F.lit(0))
    groups = base.select(*group).distinct().join(totals, group, "left").join(langs, "lang", "left")
    groups = groups.select(*group, none("kept").alias("kept"), (none("total") + 2 * none("kept")).alias("size"),
                           (none("lang_total") + 2 * none("kept")).alias("lang_size"))
    groups = stored(groups.withColumn("number", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long"))
                    .withColumn("sources", F.count("*").over(Window.partitionBy("lang")))
                    .withColumn("zero", share(F.lit(0).cast("long"), F.col("size"))), "divergence-groups")

    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = _pairs(kept, groups, buckets, block, step)
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("part", F.lit("pair")).withColumn("rank", place).select(*columns)
            .unionAll(_terms(kept, groups, ranks).withColumn("part", F.lit("term")).select(*columns)))
