"""Hashed words and byte n-grams of whole Arrow text columns, by numpy.

Texts are taken half a megabyte at a time. A longer text is cut at white space, at
places that depend on that text alone, so results don't depend on its neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes worked on at a time; numpy needs some fifty times as many.
PIECE = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def held_out(key: Column) -> Column:
    """True for the fifth of the rows that labels are never learnt from."""
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins and ends; NULL counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return held[offsets[0]:offsets[-1]], offsets - offsets[0]


NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True


def pieces(
    held: np.ndarray, offsets: np.ndarray, most: int = PIECE, at_bytes: np.ndarray = SPACE
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of texts; one text may come as several pieces of one row.

    Long texts are cut before one of ``at_bytes``; a stretch without any stays whole.
    """
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        if offsets[last] - offsets[first] <= most:
            yield first, held[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        else:
            at, end = int(offsets[first]), int(offsets[last])
            while at < end:
                cut = min(at + most, end)
                while cut < end:
                    blank = np.flatnonzero(at_bytes[held[cut:min(cut + 4096, end)]])
                    if len(blank):
                        cut += int(blank[0])
                        break
                    cut = min(cut + 4096, end)
                yield first, held[at:cut], np.array([0, cut - at])
                at = cut
        first = last


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.ones(n, np.uint64), np.ones(n, np.uint64)
    up[1:] = _BASE
    down[1:] = pow(_BASE, -1, 1 << 64)
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Hashes:
    """Hashes of any spans of a piece, from one running sum."""

    def __init__(self, held: np.ndarray) -> None:
        n = len(held)
        up, self.down = _powers(1 << max(16, n.bit_length()))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((held.astype(np.uint64) + np.uint64(1)) * up[:n], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self._mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def grams(self, n: int) -> np.ndarray:
        """Of every n bytes."""
        size = max(0, len(self.sums) - n)
        return self._mixed((self.sums[n:] - self.sums[:size]) * self.down[:size])

    @staticmethod
    def _mixed(h: np.ndarray) -> np.ndarray:
        h ^= h >> np.uint64(32)
        h *= _MIX
        h ^= h >> np.uint64(29)
        return h


def word_spans(
    held: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the words: runs of letters, digits and bytes beyond ASCII, or of the bytes ``inside``."""
    if inside is None:
        inside = WORD[held]
    begins = np.zeros(len(held) + 1, bool)
    begins[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | begins[1:-1]
    last[:-1] &= ~inside[1:] | begins[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def gram_rows(offsets: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For n-grams by position: first positions of the texts that have any, and a mask of those across texts."""
    across = np.zeros(size, bool)
    for i in range(1, n):
        at = offsets[1:-1] - i
        across[at[(at >= 0) & (at < size)]] = True
    return offsets[:-1], across


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values at the positions of each text."""
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[np.minimum(offsets[1:], len(values))] - total[np.minimum(offsets[:-1], len(values))]
