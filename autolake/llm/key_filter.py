"""A Bloom filter over 64-bit keys, built by Spark and tested in numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autolake.llm import words

PROBES = 4
BITS_PER_KEY = 12
# 16 MB are the most that is ever shipped to tasks. A filter of more keys than these bits are made for
# lets more other keys pass, in the end all of them; it never fails one of its own.
MAX_BITS = 1 << 27

_SEEDS = words.mix(np.arange(101, 101 + PROBES, dtype=np.uint64))


class KeyFilter:
    def __init__(self, bits: np.ndarray):
        self._bits, self._mask = bits, np.uint64(8 * len(bits) - 1)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Mask of the keys that may be in the filter (all that are, few others)."""
        out = np.ones(len(keys), bool)
        for p in _positions(keys, self._mask):
            out &= (self._bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
        return out


def _positions(keys: np.ndarray, mask: np.uint64) -> Iterator[np.ndarray]:
    for seed in _SEEDS:
        yield (words.mix(keys ^ seed) & mask).astype(np.int64)


def build(keys: DataFrame, col: str, max_bits: int = MAX_BITS) -> KeyFilter:
    """The filter of a stored table's long column, of at most ``max_bits`` bits (a power of two)."""
    n_bits = min(max_bits, 1 << max(15, int(keys.count() * BITS_PER_KEY - 1).bit_length()))
    mask = np.uint64(n_bits - 1)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for p in _positions(values, mask):
                yield pa.RecordBatch.from_pydict({"p": pa.array(p + 1)})

    rows = (keys.select(F.col(col).alias("k")).where("k is not null").mapInArrow(probe, "p long")
                .groupBy(F.bitmap_bucket_number("p").alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect())
    bits = np.zeros(n_bits // 8, np.uint8)
    for r in rows:      # one row per 32,768 bits
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        at = (r["bucket"] - 1) * 4096
        bits[at:at + 4096] = part[:len(bits) - at]
    return KeyFilter(bits)
