"""Numpy helpers over the buffers of an Arrow text column.

A batch's texts are one byte buffer plus offsets, so tokenising, hashing and
windowing run as array operations over all documents of a block at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK_BYTES = 2 << 20  # text bytes handled at once; one longer document is a block of its own
AT_ONCE = 1 << 18  # as above, where many arrays are made of them: these stay in the processor's cache

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
WORD = ~SPACE

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.RandomState(20240229)
# One odd 64-bit value per byte, and an odd base: words hash to sums of
# value * base^position, taken modulo 2^64 from one running sum.
BYTE_VALUE = _rng.randint(0, 2**63 - 1, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0 .. base^n and their inverses modulo 2^64 (grown as needed)."""
    have = _powers.get("pow")
    if have is None or len(have) <= n:
        size = max(n + 1, BLOCK_BYTES + 1)
        base = np.full(size, BASE, dtype=np.uint64)
        inv = np.full(size, pow(BASE, -1, 1 << 64), dtype=np.uint64)
        base[0] = inv[0] = 1
        _powers["pow"] = np.multiply.accumulate(base)
        _powers["inv"] = np.multiply.accumulate(inv)
    return _powers["pow"], _powers["inv"]


def neutral(df: DataFrame, *used: str) -> tuple[DataFrame, list[str]]:
    """``df`` with columns ``_in0``, ``_in1``, ..., and the new names of ``used``: an
    operator that carries its caller's columns along adds its own without meeting theirs.
    ``toDF(*df.columns)`` on the result's first columns gives the names back."""
    names = [f"_in{i}" for i in range(len(df.columns))]
    return df.toDF(*names), [names[df.columns.index(c)] for c in used]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets (from 0) of a text column; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset: col.offset + n + 1]
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def blocks(off: np.ndarray, limit: int = BLOCK_BYTES):
    """Runs ``(i, j)`` of documents with at most ``limit`` bytes (or one document)."""
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, off: np.ndarray, word: np.ndarray = WORD):
    """Start and end of each word, and for each document the index of its first
    word (n+1 values).  A word never crosses documents."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    w = word[data]
    first = w.copy()
    first[1:] &= ~w[:-1]
    last = w.copy()
    last[:-1] &= ~w[1:]
    edge = np.unique(off[(off > 0) & (off < n)])
    first[edge] = w[edge]
    last[edge - 1] = w[edge - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, off)


def running(data: np.ndarray, value: np.ndarray = BYTE_VALUE) -> np.ndarray:
    """P with P[j]-P[i] = sum of value[data[t]] * base^t for t in [i, j)."""
    pw, _ = powers(len(data))
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    own = out[1:]
    np.take(value, data, out=own, mode="clip")  # bytes: none is clipped, but "raise" would copy
    own *= pw[: len(data)]
    np.cumsum(own, out=own)
    return out


def slice_hash(p: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each [start, end), equal for equal bytes."""
    _, inv = powers(len(p))
    return mix((p[ends] - p[starts]) * inv[starts])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return slice_hash(running(data), starts, ends)


def window_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes (len(h)-n+1 values;
    runs that cross documents are the caller's to mask)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    for i in range(n):
        out = out * np.uint64(BASE) + h[i: i + m]
    return mix(out)


def packbits64(bits: np.ndarray) -> np.ndarray:
    """Rows of 64 booleans (bit 0 first) to unsigned 64-bit values."""
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
