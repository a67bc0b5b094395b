"""Best-fit packing of a whole corpus: best-fit decreasing over the lengths of all documents.

1. Every document is encoded; one of more than ``window`` ids is cut into full windows, the
   shorter piece first. Pieces are numbered per length inside each partition and stored.
2. Best-fit decreasing looks at nothing but lengths, and there are at most ``window`` of them.
   So the pieces are counted per length, and runs of equal pieces go into runs of equally
   filled sequences: the longest first, always into the open sequences with the tightest
   sufficient remaining capacity, which a segment tree over the capacities finds in logarithmic
   time. The result is the packing that best-fit decreasing gives for all pieces at once,
   as a table of runs whose size depends on ``window`` alone, not on the documents.
3. A piece's number among all pieces of its length (its number in its partition, and the counts
   of earlier partitions) selects its run by binary search, and so its sequence and offset.

Padding does not depend on how the documents are partitioned. Only the counts per length reach
the driver; pieces are shuffled, texts and ids never.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from autolake.functions.joins import bounded_broadcast
from autolake.llm import tokens, words
from autolake.llm.stored import stored

WINDOW = 1024


class Capacities:
    """Which remaining capacities (0..window) have open sequences; a segment tree over them."""

    def __init__(self, window: int):
        self._half = 1 << window.bit_length()
        self._any = np.zeros(2 * self._half, bool)

    def mark(self, capacity: int, has: bool) -> None:
        node = capacity + self._half
        self._any[node] = has
        while node > 1:
            node >>= 1
            self._any[node] = self._any[2 * node] or self._any[2 * node + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest marked capacity of at least ``length``."""
        node = length + self._half
        if self._any[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self._any[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return None
        while node < self._half:
            node = 2 * node if self._any[2 * node] else 2 * node + 1
        return node - self._half


def plan(counts: dict[int, int], window: int) -> np.ndarray:
    """Best-fit decreasing of ``counts[length]`` pieces of each length, as rows of runs.

    A row (length, first piece of that length, pieces, first sequence, pieces in each sequence,
    offset of the first of them) places consecutive pieces of one length: ``each`` of them in a
    row in every one of consecutive sequences.
    """
    open_: dict[int, list[tuple[int, int]]] = {}        # remaining capacity: runs (first sequence, sequences)
    tree, used, rows = Capacities(window), 0, []

    def put(capacity: int, first: int, n: int) -> None:
        if capacity and n:
            open_.setdefault(capacity, []).append((first, n))
            tree.mark(capacity, True)

    for length in sorted(counts, reverse=True):
        left, at = counts[length], 0
        while left:
            capacity = tree.tightest(length)
            if capacity is None:        # as many new sequences as the rest needs
                capacity, first, n = window, used, -(-left // (window // length))
                used += n
            else:
                first, n = open_[capacity].pop()
                if not open_[capacity]:
                    tree.mark(capacity, False)
            # a sequence with room for more pieces of this length stays the tightest one
            each = capacity // length
            whole = min(n, left // each)
            if whole:
                rows.append((length, at, whole * each, first, each, window - capacity))
                at, left = at + whole * each, left - whole * each
                put(capacity - each * length, first, whole)
                first, n = first + whole, n - whole
            if n and left:              # left < each: the last of them take one more sequence
                rows.append((length, at, left, first, left, window - capacity))
                put(capacity - left * length, first, 1)
                at, left, first, n = at + left, 0, first + 1, n - 1
            put(capacity, first, n)
    return np.array(rows, np.int64).reshape(-1, 6)


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary, window: int, end: int, special: bool) -> Iterator[pa.RecordBatch]:
    enc = tokens.encoder(vocabulary.value, special)
    part = TaskContext.get().partitionId()
    seen = np.zeros(window + 1, np.int64)
    for batch in batches:
        for rows in words.slices(batch, "text"):
            ids, bounds = enc.encode(rows.column("text"), end)
            size = np.diff(bounds)
            count = -(-size // window)
            row = np.repeat(np.arange(len(size)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            # the first piece holds what full windows leave over
            short = size - (count - 1) * window
            start = np.where(piece > 0, short[row] + (piece - 1) * window, 0)
            length = np.where(piece > 0, window, short[row])
            begins = bounds[row] + start
            data = ids.astype("<u4", copy=False)
            crc = [zlib.crc32(data[a:a + n]) for a, n in zip(begins.tolist(), length.tolist())]
            # number among the partition's pieces of the same length
            order = np.argsort(length, kind="stable")
            run = np.searchsorted(length[order], length[order])
            number = np.empty(len(length), np.int64)
            number[order] = np.arange(len(length)) - run + seen[length[order]]
            seen += np.bincount(length, minlength=window + 1)
            yield pa.RecordBatch.from_pydict({
                "doc": rows.column("doc").take(pa.array(row)), "piece": pa.array(piece.astype(np.int32)), "start": pa.array(start),
                "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64()), "part": pa.array(np.full(len(row), part, np.int32)),
                "number": pa.array(number)})


def _place(batches: Iterator[pa.RecordBatch], runs, big: int) -> Iterator[pa.RecordBatch]:
    rows, keys = runs.value
    for batch in batches:
        length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
        run = rows[np.searchsorted(keys, length * big + number, "right") - 1]
        at = number - run[:, 1]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc", "piece", "start", "length", "ids_crc32")),
             pa.array(run[:, 3] + at // run[:, 4]), pa.array(run[:, 5] + at % run[:, 4] * length)],
            names=["doc", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         end: int = 2, special: bool = False) -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence.

    Columns: ``id_col``, piece (from 0 within its document), start (ids of the document before
    it), length, ids_crc32 (of its ids as little-endian unsigned 32-bit), sequence_id (from 0,
    without gaps), offset (without gaps from 0 in its sequence). Documents of at most ``window``
    ids stay whole; of longer ones only the first piece may be shorter than ``window``.
    ``vocabulary`` is the JSON text of a tokenizers file; ``end`` closes every document. With
    ``special``, special-token strings in a text become their ids.

    Null or empty text: the end id alone. Null ids and repeated rows are packed like any other
    row, each row a document of its own. Which of several pieces of one length goes where
    follows their place in the input. An empty table gives no rows. Other columns of ``docs``
    are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    shipped = spark.sparkContext.broadcast(vocabulary)
    base = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    pieces = stored(base.mapInArrow(lambda b: _pieces(b, shipped, window, end, special),
                                    f"doc {kind}, piece int, start long, length long, ids_crc32 long, part int, number long"), "bestfit-pieces")
    # one row per partition and length; the pieces of one length in earlier partitions
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    chunks = stored(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "bestfit-chunks")
    offsets = chunks.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in chunks.groupBy("length").agg(F.sum("n").alias("n")).collect()}      # at most `window` rows
    runs = plan(counts, window)
    big = max(counts.values(), default=0) + 1
    keys = runs[:, 0] * big + runs[:, 1]
    order = np.argsort(keys)
    table = spark.sparkContext.broadcast((runs[order], keys[order]))
    numbered = (pieces.join(bounded_broadcast(offsets), ["length", "part"])
                .select("doc", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("before")).alias("number")))
    placed = numbered.mapInArrow(lambda b: _place(b, table, big),
                                 f"doc {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return placed.withColumnRenamed("doc", id_col)
