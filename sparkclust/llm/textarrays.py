"""NumPy views of Arrow text columns: prefix polynomial hashes, word spans, bounded slices.

The functions run inside tasks on slices of a record batch whose text is
bounded by ``SLICE_BYTES`` (one longer text forms a slice by itself).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once.
SLICE_BYTES = 8 << 20
BASE = 0x9E3779B97F4A7C15 | 1
M64 = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: One pseudo-random value per byte, and which bytes separate words.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
IS_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i mod 2**64 for i < n at least; the longest pair made so far is kept."""
    if not _POWERS or _POWERS[0].size < n:
        size = -(-n >> 18 << 18) if n > 1 << 18 else 1 << 18
        base, inverse = np.full(size, BASE, np.uint64), np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
        base[0] = inverse[0] = 1
        _POWERS[:] = np.cumprod(base, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """H with H[e] - H[s] = sum of value(data[i]) * BASE**i over s <= i < e (mod 2**64)."""
    up, _ = powers(data.size + 1)
    out = np.empty(data.size + 1, np.uint64)
    out[0] = 0
    np.cumsum(BYTE_VALUES[data] * up[: data.size], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans, equal for equal bytes wherever they stand."""
    _, down = powers(prefix.size)
    return (prefix[end] - prefix[start]) * down[start]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows with about ``limit`` bytes; null counts as empty."""
    col = batch.column(column)
    if not pa.types.is_large_binary(col.type):
        col = col.cast(pa.large_string() if not pa.types.is_binary(col.type) else pa.large_binary())
    if col.null_count:
        col = col.fill_null("" if pa.types.is_large_string(col.type) else b"")
    n = len(col)
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + n + 1]
    body = col.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.empty(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of every word, in order; a word never crosses rows."""
    if data.size == 0:
        e = np.empty(0, np.int64)
        return e, e, e
    solid = ~IS_BLANK[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < data.size)]
    first[cuts] = solid[cuts]
    last[cuts - 1] = solid[cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return np.searchsorted(offsets, start, side="right") - 1, start, end


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if ends.size else 0) + np.repeat(start - (ends - size), size)
