"""Benchmark decontamination with suffix arrays over the training text.

Every task turns slices of its documents into shards: the words of the benchmark's own
vocabulary become codes, any other word a zero that ends a match. A shard's suffix array holds
the positions that can begin a benchmark passage (their first word pair is one of the
benchmark's), sorted by the words that follow. Every benchmark suffix is binary-searched in
every shard; the matching range gives all places where its window occurs, and windows that
follow each other on one diagonal join to the longest verbatim match. Documents are not
shuffled.

The benchmark side is shipped to the tasks in blocks of at most ``BLOCK_BYTES`` of text; a
larger benchmark takes one pass per block over the rows already annotated, stored between.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from autolake.llm import words
from autolake.llm.stored import stored

WINDOW = 13
# A document is contaminated if at least one in this many of its words is hit.
HIT_SHARE = 20
# Benchmark text in one shipped block (a single longer item is a block of its own).
BLOCK_BYTES = 4 << 20


class Suffixes:
    """The suffixes of one benchmark block, ready for binary search.

    ``items``: (item id as string, text). Codes 1.. are the block's words in the order of
    their hashes; 0 is any other word. An item of fewer than ``window`` words, but not none,
    is one window.
    """

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.window = window
        self.ids = [i for i, _ in items]
        hashes, bounds = words.word_hashes(pa.array([t for _, t in items], pa.string()), words.ALNUM)
        self.vocabulary = np.unique(hashes)
        self.codes = self.encode(hashes)
        self.bounds = bounds
        size = np.diff(bounds)
        at, item = [], []
        for i, (a, n) in enumerate(zip(bounds[:-1].tolist(), size.tolist())):
            k = max(n - window + 1, 1) if n else 0
            at.append(np.arange(a, a + k))
            item.append(np.full(k, i))
        self.at = np.concatenate(at) if at else np.zeros(0, np.int64)
        self.item = np.concatenate(item) if item else np.zeros(0, np.int64)
        self.length = np.minimum(size, window)[self.item]
        self.end = bounds[1:][self.item]
        # first pairs (or the single word of one-word windows) at which any window begins
        nxt = np.where(self.length > 1, self.codes[np.minimum(self.at + 1, max(len(self.codes) - 1, 0))], 0)
        self.first = np.unique(self.codes[self.at] * self._base + nxt)
        self.single = np.unique(self.codes[self.at[self.length == 1]])
        self.keys = _keys(self.codes, self.at, window, self.length)

    @property
    def _base(self) -> int:
        return len(self.vocabulary) + 1

    def encode(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        where = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[where] == hashes, where + 1, 0)

    def candidates(self, codes: np.ndarray) -> np.ndarray:
        """Positions of a shard whose first pair begins a benchmark window."""
        at = np.flatnonzero(codes[:-1])
        if not len(self.first) or not len(at):
            return at[:0]
        pair = codes[at] * self._base + codes[at + 1]
        where = np.minimum(np.searchsorted(self.first, pair), len(self.first) - 1)
        keep = self.first[where] == pair
        if len(self.single):
            keep |= np.isin(codes[at], self.single)
        return at[keep]


def _keys(codes: np.ndarray, at: np.ndarray, window: int, length: np.ndarray | None = None) -> np.ndarray:
    """Fixed-size sort keys: the next ``window`` codes of each position, big-endian, cut at ``length``."""
    padded = np.r_[codes, np.zeros(window, codes.dtype)]
    rows = padded[at[:, None] + np.arange(window)].astype(">u4")
    if length is not None:
        rows[np.arange(window)[None, :] >= length[:, None]] = 0
    return np.ascontiguousarray(rows).view(f"V{4 * window}").ravel()


class Shard:
    """Suffix array of one slice of documents."""

    def __init__(self, texts: pa.Array, suffixes: Suffixes):
        hashes, self.bounds = words.word_hashes(texts, words.ALNUM)
        codes = suffixes.encode(hashes)
        # a zero between documents ends every match there
        n = len(texts)
        self.n_words = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(n), self.n_words)
        self.place = np.arange(len(codes)) + self.doc
        self.codes = np.zeros(len(codes) + n + 1, np.int64)
        self.codes[self.place] = codes
        self.begins = self.bounds[:-1] + np.arange(n)
        at = suffixes.candidates(self.codes)
        keys = _keys(self.codes, at, suffixes.window)
        order = np.lexsort(keys.view(">u4").reshape(len(at), -1).T[::-1]) if len(at) else np.zeros(0, np.int64)
        self.array, self.keys = at[order], keys[order]

    def search(self, suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
        """Each benchmark window's range in the suffix array."""
        if not len(self.array) or not len(suffixes.keys):
            z = np.zeros(len(suffixes.keys), np.int64)
            return z, z
        # a window's matches lie from its key (zero-filled) up to its key filled with the largest code
        low = suffixes.keys
        high = low.copy().view(">u4").reshape(len(low), -1)
        high[np.arange(suffixes.window)[None, :] >= suffixes.length[:, None]] = 0xFFFFFFFF
        high = np.ascontiguousarray(high).view(low.dtype).ravel()
        return _search(self.keys, low, "left"), _search(self.keys, high, "right")


def _search(keys: np.ndarray, wanted: np.ndarray, side: str) -> np.ndarray:
    """np.searchsorted for byte-wise ordered rows (void types have no order of their own)."""
    rows, want = keys.view(">u4").reshape(len(keys), -1), wanted.view(">u4").reshape(len(wanted), -1)
    lo, hi = np.zeros(len(want), np.int64), np.full(len(want), len(rows), np.int64)
    while (lo < hi).any():
        mid = (lo + hi) // 2
        probe = rows[np.minimum(mid, len(rows) - 1)]
        differ = probe != want
        first = differ.argmax(1)
        pick = np.arange(len(want))
        a, b = probe[pick, first], want[pick, first]
        less = (a < b) | ((side == "right") & ~differ.any(1))
        open_ = lo < hi
        lo = np.where(open_ & less, mid + 1, lo)
        hi = np.where(open_ & ~less, mid, hi)
    return lo


class _blocks:
    """The benchmark's items in blocks of bounded text, one empty block if there is no item.

    The text's total size alone is looked at first; a block is read when its turn comes. The
    length counts the blocks dealt to, of which empty ones are left out.
    """

    def __init__(self, benchmark: DataFrame, item_col: str, text_col: str):
        self._items = (benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t"))
                       .where(F.col("i").isNotNull() & F.col("t").isNotNull()))
        total = self._items.agg(F.sum(F.octet_length("t")).alias("n")).first()["n"] or 0
        n_blocks = max(1, -(-total // BLOCK_BYTES))
        self._n = 2 * n_blocks if n_blocks > 1 else 1

    def __len__(self) -> int:
        return self._n

    def __iter__(self) -> Iterator[list[tuple[str, str]]]:
        block, empty = F.pmod(F.xxhash64("i", "t"), F.lit(self._n)), True
        for b in range(self._n):
            rows = self._items.where(block == b).orderBy("i", "t").collect()
            if rows:
                empty = False
                yield [(r["i"], r["t"]) for r in rows]
        if empty:
            yield []


def annotate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
             item_text_col: str = "text", window: int = WINDOW, out: str = "found") -> DataFrame:
    """All columns of ``docs`` and struct ``out``: n_words, n_hit, n_items, items, spans, longest.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. ``spans`` are the
    [first, last + 1) word ranges under any occurrence of a benchmark window, ``items`` the
    sorted ids (strings) of items with an occurring window, ``longest`` the words of the
    longest verbatim match. ``out`` must not be a column of ``docs`` already.

    Null or wordless texts: no words, no hits. Null items are skipped; items without words
    have no window; repeated items count once, by id. Repeated rows are each annotated. Empty
    tables on either side are fine.
    """
    if out.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"column {out} is taken")
    sc = docs.sparkSession.sparkContext
    kind = "struct<n_words:bigint,spans:array<struct<a:bigint,b:bigint>>,items:array<string>,longest:bigint>"
    names = []
    for k, items in enumerate(_blocks(benchmark, item_col, item_text_col)):
        if k:       # one pass runs at a time: a task never holds more than one block, the driver two
            docs = stored(docs, "decontaminate-pass")
            shipped.destroy()
        shipped = sc.broadcast(Suffixes(items, window))
        names.append(out if not k else f"{out}_{k}")
        docs = _pass(docs, text_col, names[-1], kind, shipped)
    spans = lambda c: F.col(c)["spans"]
    all_spans = F.array_sort(F.flatten(F.array(*[spans(c) for c in names])))
    merged = F.aggregate(all_spans, F.array().cast("array<struct<a:bigint,b:bigint>>"), _merge)
    items_all = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(c)["items"] for c in names]))))
    result = F.struct(
        F.col(out)["n_words"].alias("n_words"),
        F.aggregate(F.col(f"{out}_merged"), F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"]).alias("n_hit"),
        F.size(items_all).cast("long").alias("n_items"), items_all.alias("items"),
        F.col(f"{out}_merged").alias("spans"),
        F.greatest(*[F.col(c)["longest"] for c in names], F.lit(0)).alias("longest"))
    keep = [c for c in docs.columns if c not in names]
    return docs.withColumn(f"{out}_merged", merged).select(*keep, result.alias(out))


def _merge(done: Column, span: Column) -> Column:
    """Fold step: join a span to the last one if they touch (spans come sorted)."""
    last = F.element_at(done, -1)
    joined = F.struct(last["a"].alias("a"), F.greatest(last["b"], span["b"]).alias("b"))
    return (F.when(F.size(done) == 0, F.array(span))
            .when(span["a"] <= last["b"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)))
            .otherwise(F.concat(done, F.array(span))))


def _pass(docs: DataFrame, text_col: str, out: str, kind: str, shipped) -> DataFrame:
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DataType.fromDDL(kind))])
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes = shipped.value
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, [f"c{i}" for i in range(len(names))])
            for rows in words.slices(batch, f"c{at}"):
                found = pa.array(find(rows.column(at), suffixes), _FOUND)
                yield pa.RecordBatch.from_arrays(rows.columns + [found], names + [out])

    return docs.mapInArrow(run, schema)


_FOUND = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                    ("items", pa.list_(pa.string())), ("longest", pa.int64())])


def find(texts: pa.Array, suffixes: Suffixes) -> list[dict]:
    """Per text its words, hit spans, items found and longest match, by one shard of these texts."""
    shard = Shard(texts, suffixes)
    low, high = shard.search(suffixes)
    out = [{"n_words": int(n), "spans": [], "items": [], "longest": 0} for n in shard.n_words]
    count = high - low
    window = np.repeat(np.arange(len(count)), count)
    if not len(window):
        return out
    rank = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    place = shard.array[low[window] + rank]
    doc = np.searchsorted(shard.begins, place, "right") - 1
    a = place - shard.begins[doc]
    b = a + suffixes.length[window]
    # items and merged spans of each document
    pairs = np.unique(np.stack([doc, suffixes.item[window]]), axis=1)
    for d, i in pairs.T.tolist():
        out[d]["items"].append(suffixes.ids[i])
    order = np.lexsort((b, a, doc))
    for d, x, y in zip(doc[order].tolist(), a[order].tolist(), b[order].tolist()):
        spans = out[d]["spans"]
        if spans and x <= spans[-1]["b"]:
            spans[-1]["b"] = max(spans[-1]["b"], y)
        else:
            spans.append({"a": x, "b": y})
    # longest match: windows of one item that follow each other along one diagonal
    item = suffixes.item[window]
    offset = suffixes.at[window] - suffixes.bounds[:-1][item]
    order = np.lexsort((a, a - offset, item, doc))
    d, i, g, x, y = doc[order], item[order], (a - offset)[order], a[order], b[order]
    fresh = np.r_[True, (d[1:] != d[:-1]) | (i[1:] != i[:-1]) | (g[1:] != g[:-1]) | (x[1:] != x[:-1] + 1)]
    begin = x[fresh]
    finish = y[np.r_[np.flatnonzero(fresh)[1:] - 1, len(x) - 1]]
    best = np.zeros(len(out), np.int64)
    np.maximum.at(best, d[fresh], finish - begin)
    for row, n in zip(out, best.tolist()):
        row["longest"] = n
        row["items"] = sorted(set(row["items"]))
    return out


def contaminated(found: Column | str) -> Column:
    """n_hit > 0 and at least one in HIT_SHARE words hit."""
    found = F.col(found) if isinstance(found, str) else found
    return (found["n_hit"] > 0) & (HIT_SHARE * found["n_hit"] >= found["n_words"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, that are not contaminated."""
    name = "found"
    while name in (c.lower() for c in docs.columns):
        name += "_"
    found = annotate(docs, benchmark, text_col, out=name)
    return found.where(~contaminated(name)).drop(name)
