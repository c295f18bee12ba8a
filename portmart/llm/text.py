"""Vectorised words and word windows of Arrow text columns.

Texts are handled as the bytes of a whole batch. Words are runs of bytes other than
``\\x20\\x09-\\x0D``. Hashes are polynomial, taken from running sums (so a window costs the
same whatever its length), and mixed; ``base`` picks one of a family of functions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

M64 = (1 << 64) - 1
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xA24BAED4963EE407, 0x9FB21C651E98DF25)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
BLOCK = 1 << 20


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows (one more than rows); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.chunked_array([c.cast(pa.large_binary()) for c in column.chunks], pa.large_binary()).combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes each (one row may be longer)."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, min(end, n)
        at = end


@lru_cache(maxsize=8)
def _grown(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    one = np.ones(1, np.uint64)
    return tuple(np.concatenate([one, np.cumprod(np.full(size - 1, b, np.uint64))]) for b in (base, inverse))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return _grown(base, max(1 << 16, 1 << (int(n) - 1).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def running(values: np.ndarray, base: int) -> np.ndarray:
    """Running polynomial sums, for ``between``."""
    up, _ = _powers(base, len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=out[1:])
    return out


def between(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[start:end]`` for each pair, the same wherever those values stand."""
    _, down = _powers(base, len(sums))
    return (sums[end] - sums[start]) * down[start]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte ranges of all words, and the index of each row's first word."""
    gap = SPACE[data]
    inner = offsets[1:-1]
    before = np.ones(len(data), bool)
    before[1:] = gap[:-1]
    before[inner[inner < len(data)]] = True
    after = np.ones(len(data), bool)
    after[:-1] = gap[1:]
    after[inner[(inner > 0) & (inner <= len(data))] - 1] = True
    text = ~gap
    starts, ends = np.flatnonzero(text & before), np.flatnonzero(text & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    sums = running(data.astype(np.uint64) + np.uint64(1), base)
    return mix(between(sums, starts, ends, base) + (ends - starts).astype(np.uint64) * np.uint64(BASES[1]))


def window_hashes(hashes: np.ndarray, first: np.ndarray, k: int, base: int = BASES[2]) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of every run of ``k`` words that lies in one row."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    row_end = np.repeat(first[1:], np.diff(first))
    at = np.flatnonzero(np.arange(n) + k <= row_end)
    return at, mix(between(running(hashes, base), at, at + k, base) + np.uint64(k))
