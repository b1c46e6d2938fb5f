"""Words and word n-grams of Arrow text columns as numpy arrays, some hundred kilobytes of text at a time.

Words are runs of bytes of a class. Both classes used here treat every byte from 0x80 on as part of a
word, so cutting UTF-8 bytes gives the same words as cutting code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Text that is held as per-byte arrays at once; a longer document is one slice of its own.
SLICE_BYTES = 1 << 18

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_LANE = 0xC2B2AE3D27D4EB4F


def _byte_class(inside) -> np.ndarray:
    return np.array([inside(b) for b in range(256)])


#: Letters a-z, digits and everything that is not ASCII.
ALNUM = _byte_class(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
#: Everything but ASCII white space.
SOLID = _byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (splitmix64 finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64."""
    up, down = np.full(size, _BASE, U), np.full(size, pow(_BASE, -1, 1 << 64), U)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


@dataclass
class Words:
    """Words of consecutive rows: byte spans into ``data`` and the index of each row's first word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word."""
        size = 1 << max(19, int(len(self.data)).bit_length())
        up, down = _powers(size)
        sums = np.zeros(len(self.data) + 1, U)
        np.cumsum((self.data.astype(U) + U(1)) * up[: len(self.data)], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * down[self.start] + (self.end - self.start).astype(U))

    def row_words(self, row: int) -> list[bytes]:
        """The words of one row as bytes."""
        lo, hi = self.first[row], self.first[row + 1]
        if lo == hi:
            return []
        base = self.start[lo]
        blob = self.data[base : self.end[hi - 1]].tobytes()
        return [blob[a:b] for a, b in zip(self.start[lo:hi] - base, self.end[lo:hi] - base)]


def grams(words: np.ndarray, size: int, lane: int = 0) -> np.ndarray:
    """Hash of the ``size`` words from each position on, for all positions that have so many words."""
    count = len(words) - size + 1
    if count <= 0:
        return words[:0]
    base, total = U(_LANE if lane else _BASE), np.zeros(count, U)
    for i in range(size):
        total = total * base + words[i : i + count]
    return mix(total + U(lane))


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest of the ``size`` values from each position on."""
    count = len(values) - size + 1
    if count <= 0:
        return values[:0]
    width, best = 1, values
    while width * 2 <= size:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    return np.minimum(best[:count], best[size - width : size - width + count])


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges with at most ``limit`` bytes of text, one row at least."""
    column = pa.array(column, pa.large_string()) if not isinstance(column, pa.Array) else column.cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def cut(column: pa.Array, kind: np.ndarray, lower: bool = False) -> Words:
    """Words of every row; a null row has none."""
    column = column.fill_null("").cast(pa.large_string())
    rows = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, rows + 1, column.offset * 8) if rows else np.zeros(1, np.int64)
    blob = column.buffers()[2] if rows else None
    data = np.frombuffer(blob, np.uint8, offsets[-1] - offsets[0], offsets[0]) if blob and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    bounds = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    inside = kind[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    before[inner], after[inner - 1] = False, False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return Words(data, start, end, np.searchsorted(start, bounds))
