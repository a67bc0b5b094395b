"""Words of whole texts as 64-bit hashes, and rolling hashes over word windows.

Everything here works on one Arrow batch at a time inside a task. Splitting, hashing and
windows are numpy operations over a whole slice; Python touches no single word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Bytes of text handled at once inside a task; a longer single text is a slice of its own.
SLICE_BYTES = 4 << 20

# A-Z lower-cased, all other bytes kept.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text: digits, a-z and every byte of a
# non-ASCII character stay, anything else becomes a blank.
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))

# Words of more bytes than this are hashed by one call each instead of eight bytes at a time.
LONG_WORD = 4096

_IN_WORD = np.ones(256, np.int8)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = 0
_LOW_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)

# Odd multiplier of the rolling window hash and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def slices(batch: pa.RecordBatch, col: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in row ranges of at most ``limit`` text bytes (one row at least)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // limit
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    for a, b in zip(starts, np.r_[starts[1:], len(sizes)]):
        yield batch.slice(a, b - a)


def joined(texts: pa.Array, table: bytes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes (null: empty) mapped through ``table``, a blank after each, and where each begins."""
    parts = pc.fill_null(texts.cast(pa.large_binary()), b"").to_pylist()
    begins = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=begins[1:])
    raw = b" ".join(parts) + b" " * 9       # room to read eight bytes from any word's start
    return np.frombuffer(raw if table is None else raw.translate(table), np.uint8), begins


def word_spans(raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and each text's first and last word number.

    Words are runs of bytes other than blank, tab, LF, VT, FF and CR.
    """
    edge = np.flatnonzero(np.diff(_IN_WORD[raw], prepend=np.int8(0)))
    starts, ends = edge[::2], edge[1::2]
    return starts, ends, np.searchsorted(starts, begins)


def hashed(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, eight bytes at a time over all ranges at once."""
    eight = np.ndarray(len(raw) - 7, "<u8", raw.data, strides=(1,))
    size = ends - starts
    out = mix(size.astype(np.uint64) + np.uint64(_BASE))
    left = np.arange(len(starts))
    at, rest = starts, size
    while len(left):
        if rest.max() > LONG_WORD:          # very long words: one call each
            long = rest > LONG_WORD
            for i, a, n in zip(left[long], at[long], rest[long]):
                out[i] = np.uint64(xxhash.xxh3_64_intdigest(raw[a:a + n].tobytes(), seed=int(out[i])))
            left, at, rest = left[~long], at[~long], rest[~long]
            continue
        chunk = eight[at] & _LOW_BYTES[np.minimum(rest, 8)]
        if len(left) == len(out):
            out = mix(out ^ chunk)
        else:
            out[left] = mix(out[left] ^ chunk)
        more = rest > 8
        left, at, rest = left[more], at[more] + 8, rest[more] - 8
    return out


def word_hashes(texts: pa.Array, table: bytes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and each text's word bounds."""
    raw, begins = joined(texts, table)
    starts, ends, bounds = word_spans(raw, begins)
    return hashed(raw, starts, ends), bounds


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    if n:
        out[0] = 1
        filled = 1
        while filled < n:
            step = min(filled, n - filled)
            out[filled:filled + step] = out[:step] * np.uint64(pow(base, filled, 1 << 64))
            filled += step
    return out


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` word hashes (crossing text bounds: the caller masks)."""
    n = len(h)
    if n < size:
        return np.zeros(0, np.uint64)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(h * _powers(_BASE, n), out=prefix[1:])
    return mix((prefix[size:] - prefix[:-size]) * _powers(_INVERSE, n - size + 1))


def window_starts(bounds: np.ndarray, size: int) -> np.ndarray:
    """Positions at which a whole window of ``size`` words lies inside one text."""
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    return np.repeat(bounds[:-1] - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Mask of the positions under any window of ``size`` beginning at ``starts``."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + size, n), -1)
    return np.cumsum(edge[:-1]) > 0
