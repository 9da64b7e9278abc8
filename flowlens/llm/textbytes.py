"""Vectorised work on the UTF-8 bytes of an Arrow string column (inside tasks).

Memory is bounded by windows of ``WINDOW`` bytes, also within one long text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WINDOW = 1 << 20
_MULT = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


_SYSTEM = ctypes.CDLL(None)


def give_back() -> None:
    """Return freed memory to the system. A worker serves many tasks, one after
    another, and the C library would keep the pages of the largest of them."""
    pa.default_memory_pool().release_unused()
    if hasattr(_SYSTEM, "malloc_trim"):
        _SYSTEM.malloc_trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random 64-bit value for each byte (fixed: the same in every task).
BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class SpanHasher:
    """64-bit hashes of byte spans: a polynomial over random byte values, scrambled."""

    def __init__(self):
        self._grow(WINDOW + 1)

    def _grow(self, n: int) -> None:
        self.up = _powers(_MULT, n)
        self.down = _powers(pow(_MULT, -1, 1 << 64), n)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of data[starts[i]:ends[i]]; spans in order, not overlapping."""
        out = np.zeros(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            lo = int(starts[i])
            j = max(i + 1, int(np.searchsorted(ends, lo + WINDOW, "right")))
            hi = int(ends[j - 1])
            if hi - lo + 1 > len(self.up):
                self._grow(hi - lo + 1)
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(BYTE_VALUES[data[lo:hi]] * self.up[:hi - lo], out=sums[1:])
            a, b = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = mix64((sums[b] - sums[a]) * self.down[a] + (b - a).astype(np.uint64))
            i = j
        return out


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = 2 * WINDOW) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes, or a single row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words; words end at the end of a text."""
    solid = ~SPACE[data]
    if not len(solid):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.concatenate([[False], solid[:-1]])
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False
    after = np.concatenate([solid[1:], [False]])
    after[inner - 1] = False
    return np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
