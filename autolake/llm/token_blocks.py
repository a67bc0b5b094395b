"""Token-id files of patched frame-of-reference blocks.

A shard folder holds files of segments in ascending document order. A segment carries the
ids of some whole documents, cut into blocks of ``BLOCK`` ids (the last may be shorter):

    magic "PFB1" | head (``_HEAD``): partition, number in it, ids of the partition before it,
    documents, ids, blocks, exceptions, payload bytes
    per document: id (int64), id is null (uint8), n_tokens (int64)
    per block (the index): first payload byte (int64), minimum (uint32), first exception
    (uint32), width in bits (uint8)
    exceptions: place in the block (uint16), bits above the width (uint32)
    payload: per block its ids less the minimum, low ``width`` bits each, most significant
    bit first, filled up to a whole byte
    trailer ``TRAILER``

A block's width is the one that holds ``COVER`` of its ids; the others' high bits are
exceptions. Spark's text writer writes the segments (so commits, retries and the file
system are Spark's), its line separator being the trailer; the binaryFile source reads them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autolake.llm import tokens, words

BLOCK = 256
COVER = 0.9                 # share of a block's ids that its width holds
BLOCKS_AT_ONCE = 256        # blocks whose ids are spread out to bits at a time: bounds a task's memory
SEGMENTS_PER_FILE = 8       # bounds a file; one segment is SLICE_BYTES of text or one document
MAGIC = b"PFB1"
TRAILER = "\nPFB-END\n"

_HEAD = struct.Struct("<qqqqqqqq")
_BITS = 33                  # bit lengths of uint32 values: 0 to 32


def _widths(delta: np.ndarray) -> np.ndarray:
    """Per row the bits that hold COVER of the row's values."""
    at = min(delta.shape[1] - 1, int(np.ceil(COVER * delta.shape[1])) - 1)
    top = np.partition(delta, at, axis=1)[:, at]
    return np.ceil(np.log2(top.astype(np.float64) + 1)).astype(np.uint8)


def _blocks(ids: np.ndarray) -> list[np.ndarray]:
    """Rows of BLOCK ids, and the shorter last row if there is one."""
    whole = len(ids) // BLOCK * BLOCK
    return [p for p in (ids[:whole].reshape(-1, BLOCK), ids[whole:].reshape(1, -1)) if p.size]


def _runs(blocks: np.ndarray) -> Iterator[np.ndarray]:
    """The blocks' places, at most BLOCKS_AT_ONCE at a time."""
    for a in range(0, len(blocks), BLOCKS_AT_ONCE):
        yield blocks[a:a + BLOCKS_AT_ONCE]


def encode_segment(part: int, number: int, before: int, doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of one segment (without trailer)."""
    minima, widths, sizes, payloads, where, high, excepted = [], [], [], [], [], [], []
    for rows in _blocks(ids):
        low = rows.min(axis=1)
        delta = rows - low[:, None]
        width = _widths(delta)
        over = delta >> np.minimum(width, 31)[:, None].astype(np.uint32)
        over[width >= 32] = 0
        r, c = np.nonzero(over)
        where.append(c.astype("<u2"))
        high.append(over[r, c].astype("<u4"))
        excepted.append(np.bincount(r, minlength=len(rows)))
        size = (width.astype(np.int64) * rows.shape[1] + 7) // 8
        out = np.zeros(size.sum(), np.uint8)
        at = np.cumsum(size) - size
        for w in np.unique(width[width > 0]):
            for pick in _runs(np.flatnonzero(width == w)):
                # a value's bytes, most significant first, as bits: the last w are kept
                bits = np.unpackbits(delta[pick].astype(">u4").view(np.uint8), axis=1).reshape(len(pick), -1, 32)[:, :, 32 - int(w):]
                packed = np.packbits(bits.reshape(len(pick), -1), axis=1)
                out[at[pick][:, None] + np.arange(packed.shape[1])] = packed
        minima.append(low.astype("<u4"))
        widths.append(width)
        sizes.append(size)
        payloads.append(out.tobytes())
    join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
    size, count = join(sizes, "<i8"), join(excepted, "<i8")
    payload = b"".join(payloads)
    return b"".join((
        MAGIC, _HEAD.pack(part, number, before, len(doc_ids), len(ids), len(size), int(count.sum()), len(payload)),
        np.array([0 if i is None else i for i in doc_ids], "<i8").tobytes(),
        np.array([i is None for i in doc_ids], np.uint8).tobytes(), counts.astype("<i8").tobytes(),
        (np.cumsum(size) - size).astype("<i8").tobytes(), join(minima, "<u4").tobytes(),
        (np.cumsum(count) - count).astype("<u4").tobytes(), join(widths, np.uint8).tobytes(),
        join(where, "<u2").tobytes(), join(high, "<u4").tobytes(), payload))


def decode_segments(data: bytes | memoryview) -> Iterator[tuple[tuple[int, int, int], list, np.ndarray, np.ndarray]]:
    """((partition, number, ids before), document ids, n_tokens, ids) of every segment of a file."""
    at, trailer = 0, TRAILER.encode()
    view = memoryview(data)

    def take(n: int, kind: str) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(view, kind, n, at)
        at += out.nbytes
        return out

    while at < len(data):
        if data[at:at + 4] != MAGIC:
            raise ValueError("not a token block file")
        part, number, before, n_docs, n_ids, n_blocks, n_except, n_bytes = _HEAD.unpack_from(view, at + 4)
        at += 4 + _HEAD.size
        docs, null, counts = take(n_docs, "<i8"), take(n_docs, "u1"), take(n_docs, "<i8")
        first, minima, first_except, width = take(n_blocks, "<i8"), take(n_blocks, "<u4"), take(n_blocks, "<u4"), take(n_blocks, "u1")
        where, high = take(n_except, "<u2"), take(n_except, "<u4")
        payload = take(n_bytes, "u1")
        ids = np.empty(n_ids, np.uint32)
        n_whole = n_ids // BLOCK
        for blocks, rows in zip((slice(0, n_whole), slice(n_whole, n_blocks)), (ids[:n_whole * BLOCK].reshape(-1, BLOCK), ids[n_whole * BLOCK:].reshape(1, -1))):
            if not rows.size:
                continue
            w_all = width[blocks]
            for w in np.unique(w_all):
                if not w:
                    rows[w_all == w] = 0
                    continue
                size = (int(w) * rows.shape[1] + 7) // 8
                for pick in _runs(np.flatnonzero(w_all == w)):
                    bits = np.unpackbits(payload[first[blocks][pick][:, None] + np.arange(size)], axis=1)
                    bits = bits[:, :int(w) * rows.shape[1]].reshape(len(pick), rows.shape[1], int(w))
                    value = np.zeros(bits.shape[:2], np.uint32)
                    for b in range(int(w)):
                        value = (value << np.uint32(1)) | bits[:, :, b]
                    rows[pick] = value
        count = np.diff(np.r_[first_except, n_except].astype(np.int64))
        block = np.repeat(np.arange(n_blocks), count)
        ids[block * BLOCK + where] |= high << width[block].astype(np.uint32)
        ids += np.repeat(minima, np.minimum(BLOCK, n_ids - np.arange(n_blocks) * BLOCK))
        if data[at:at + len(trailer)] != trailer:
            raise ValueError("broken token block segment")
        at += len(trailer)
        yield (part, number, before), [None if z else int(d) for d, z in zip(docs, null)], counts, ids


def write(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
          end: int = 1, special: bool = False) -> None:
    """Encode every whole text, close it with ``end`` and write the ids in ascending id order.

    With ``special``, special-token strings in a text become their ids.

    Rows are range-partitioned on (id, hash of the text), so that even one id on many rows
    spreads; each task sorts its range and writes its segments. Null text: the end id alone.
    Null ids come first; rows of equal id lie in the order of their texts' hashes; repeated
    rows are written as often as they occur. An empty table makes a folder without segments.
    Other columns of ``docs`` are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)
    tie = F.xxhash64("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(shipped.value, special)
        part, number, before = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for rows in words.slices(batch, "text"):
                ids, bounds = enc.encode(rows.column("text"), end)
                segment = encode_segment(part, number, before, rows.column("doc").to_pylist(), np.diff(bounds), ids)
                yield pa.RecordBatch.from_pydict({"value": pa.array([segment], pa.binary())})
                number, before = number + 1, before + len(ids)

    (docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
         .withColumn("tie", tie)
         .repartitionByRange("doc", "tie").sortWithinPartitions("doc", "tie").select("doc", "text")
         .mapInArrow(run, "value binary")
         .select(F.col("value").cast("string").alias("value"))
         .write.option("lineSep", TRAILER).option("maxRecordsPerFile", SEGMENTS_PER_FILE).mode("overwrite").text(path))


def read(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per document of the files: id, part, start_in_part, n_tokens, ids_crc32 (and ids).

    ids_crc32 is that of the document's ids as little-endian unsigned 32-bit integers.
    """
    schema = f"{id_col} long, part long, start_in_part long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for (part, _, before), docs, counts, ids in decode_segments(memoryview(content.as_buffer())):
                    bounds = np.r_[0, np.cumsum(counts)]
                    data = ids.astype("<u4", copy=False)
                    crc = [zlib.crc32(data[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                    cols = {id_col: pa.array(docs, pa.int64()), "part": pa.array([part] * len(docs), pa.int64()),
                            "start_in_part": pa.array(before + bounds[:-1]), "n_tokens": pa.array(counts),
                            "ids_crc32": pa.array(crc, pa.int64())}
                    if with_ids:
                        cols["ids"] = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(data.astype(np.int32)))
                    yield pa.RecordBatch.from_pydict(cols)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def with_starts(table: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``read``'s rows with ``start``: the ids of all documents before it over all partitions.

    ``table`` should be stored: it is read twice. One total per written partition (a bounded
    list, a row per range) is summed up in order and joined back.
    """
    totals = sorted((r["part"], r["n"]) for r in
                    table.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    base = np.cumsum([0] + [n for _, n in totals]).tolist()
    schema = "part long, base long"
    parts = table.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(totals, base)], schema)
    return (table.join(F.broadcast(parts), "part")
            .withColumn("start", F.col("base") + F.col("start_in_part")).drop("base", "start_in_part", "part"))
