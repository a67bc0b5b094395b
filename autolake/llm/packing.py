"""Packing documents into fixed windows: best-fit decreasing over a segment tree.

Each task packs the documents of its own input partition, so packing needs no shuffle and
no state beyond one row per piece of that partition: a document of more than ``window`` ids
is first cut into full windows, each a sequence of its own; the remainders go, longest
first, into the open window with the tightest sufficient remaining capacity, which a segment
tree indexed by remaining capacity finds. Only one window per partition can stay badly
filled, so padding shrinks as partitions grow.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autolake.llm import tokens, words

WINDOW = 2048
# sequence_id = partition number << PARTITION_SHIFT | number within the partition
PARTITION_SHIFT = 36


class OpenWindows:
    """Open windows by remaining capacity; a segment tree counts them over the capacities."""

    def __init__(self, window: int):
        self._leaves = 1 << window.bit_length()
        self._count = [0] * (2 * self._leaves)
        self._stacks: list[list[int]] = [[] for _ in range(self._leaves)]

    def add(self, capacity: int, number: int) -> None:
        self._stacks[capacity].append(number)
        self._change(capacity, 1)

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self._leaves
        while node:
            self._count[node] += by
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return (capacity, number) of the tightest window with room for ``length``."""
        node = length + self._leaves
        if not self._count[node]:
            # climb to the first subtree on the right that holds a window, then go down left
            while node > 1 and (node & 1 or not self._count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self._leaves:
                node = 2 * node if self._count[2 * node] else 2 * node + 1
        capacity = node - self._leaves
        number = self._stacks[capacity].pop()
        self._change(capacity, -1)
        return capacity, number


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Window number and offset of each length (all at most ``window``), and the windows used."""
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_, used = OpenWindows(window), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = open_.take(n)
        if found is None:
            found, used = (window, used), used + 1
        capacity, number[i] = found
        offset[i] = window - capacity
        if capacity > n:
            open_.add(capacity - n, int(number[i]))
    return number, offset, used


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, end: int = 1, with_ids: bool = False, special: bool = False) -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence.

    Columns: ``id_col``, start (ids of the document before the piece), length, ids_crc32 (of
    the piece's ids as little-endian unsigned 32-bit), doc_tokens, sequence_id, offset, and,
    with ``with_ids``, ids (array of the piece's ids) from which ``sequences`` fills windows.
    ``vocabulary`` is the JSON text of a tokenizers file; ``end`` closes every document.
    With ``special``, special-token strings in a text become their ids.

    Null or empty text: the end id alone. Null ids and repeated rows are packed like any
    other row, each row a document of its own. Ties in length keep input order. An empty
    table gives no rows. Other columns of ``docs`` are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = (f"doc {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long" + (", ids array<int>" if with_ids else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(shipped.value, special)
        base = TaskContext.get().partitionId() << PARTITION_SHIFT
        full, done = [], []     # full windows go out at once, remainders at the end
        sequences = 0
        for batch in batches:
            for part in words.slices(batch, "text"):
                ids, bounds = enc.encode(part.column("text"), end)
                pieces = _cut(ids, bounds, window)
                row = pieces.pop("row")
                pieces["doc"] = part.column("doc").take(pa.array(row))
                whole = pieces["length"] == window
                if whole.any():
                    n = int(whole.sum())
                    yield _piece_batch(pieces, whole, base + sequences + np.arange(n), np.zeros(n, np.int64), ids, with_ids)
                    sequences += n
                if not whole.all():
                    full.append(_kept(pieces, ~whole, ids, with_ids))
        for pieces in full:
            done.append(pieces["length"])
        if done:
            number, offset, _ = best_fit_decreasing(np.concatenate(done), window)
            at = 0
            for pieces in full:
                n = len(pieces["length"])
                yield _piece_batch(pieces, np.ones(n, bool), base + sequences + number[at:at + n], offset[at:at + n],
                                   pieces.get("ids"), with_ids)
                at += n

    out = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).mapInArrow(run, schema)
    return out.withColumnRenamed("doc", id_col)


def _cut(ids: np.ndarray, bounds: np.ndarray, window: int) -> dict:
    """Pieces of every document: full windows and one remainder."""
    size = np.diff(bounds)
    count = -(-size // window)
    row = np.repeat(np.arange(len(size)), count)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = k * window
    length = np.minimum(size[row] - start, window)
    first = bounds[row] + start
    data = ids.astype("<u4", copy=False)
    crc = np.array([zlib.crc32(data[a:a + n]) for a, n in zip(first.tolist(), length.tolist())], np.int64)
    return {"row": row, "start": start, "length": length, "ids_crc32": crc, "doc_tokens": size[row], "first": first}


def _kept(pieces: dict, mask: np.ndarray, ids: np.ndarray, with_ids: bool) -> dict:
    out = {k: v[mask] for k, v in pieces.items() if k != "doc"}
    out["doc"] = pieces["doc"].filter(pa.array(mask))
    if with_ids:
        out["ids"] = tokens._ranges(ids, out["first"], out["length"])
        out["first"] = np.cumsum(out["length"]) - out["length"]
    return out


def _piece_batch(pieces: dict, mask: np.ndarray, sequence: np.ndarray, offset: np.ndarray,
                 ids: np.ndarray | None, with_ids: bool) -> pa.RecordBatch:
    cols = {"doc": pieces["doc"].filter(pa.array(mask))}
    cols |= {k: pa.array(pieces[k][mask]) for k in ("start", "length", "ids_crc32", "doc_tokens")}
    cols |= {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
    if with_ids:
        length = pieces["length"][mask]
        flat = tokens._ranges(ids, pieces["first"][mask], length).astype(np.int32)
        cols["ids"] = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length)].astype(np.int32)), pa.array(flat))
    return pa.RecordBatch.from_pydict(cols)


def sequences(pieces: DataFrame, window: int = WINDOW, pad: int = 0) -> DataFrame:
    """Filled windows from ``pack(..., with_ids=True)``: sequence_id, n_ids, ids padded to the window.

    A sequence whose ids number a power of two is not padded. A group has at most ``window``
    pieces, so no group is unbounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.flatten(F.transform(parts, lambda p: p["ids"]))
    n = F.size("ids")
    power = F.bit_count(n) == 1
    return (pieces.groupBy("sequence_id").agg(ids.alias("ids"))
            .select("sequence_id", n.cast("long").alias("n_ids"),
                    F.when(power, F.col("ids"))
                    .otherwise(F.concat("ids", F.array_repeat(F.lit(pad), F.lit(window) - n))).alias("ids")))
