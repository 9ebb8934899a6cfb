"""Array helpers for text columns inside Spark tasks.

A text column arrives as one buffer of UTF-8 bytes with row offsets.  Everything here works on
such buffers as a whole, a bounded number of bytes at a time, instead of on single strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text is worked on alone.
CHUNK_BYTES = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets and bytes of a text or binary column; a null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    rows = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return rows, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def chunks(
    rows: np.ndarray, limit: int = CHUNK_BYTES, most_rows: int = 1 << 12
) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``most_rows`` rows of at most ``limit`` bytes together, or of one longer row."""
    first, last = 0, len(rows) - 1
    while first < last:
        after = int(np.searchsorted(rows, rows[first] + limit, "right")) - 1
        after = min(max(after, first + 1), first + most_rows, last)
        yield first, after
        first = after


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE)]), dtype=np.uint64)
        down = np.cumprod(
            np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE_INVERSE)]), dtype=np.uint64
        )
    return up, down


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to size-1 of the rolling hash's base modulo 2**64, and their inverses."""
    up, down = _powers(1 << max(16, (size - 1).bit_length()))
    return up[:size], down[:size]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose results look random (the splitmix64 finalizer)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Rolling:
    """Rabin-Karp hashes, modulo 2**64, of any slice of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        up, self._down = powers(max(1, len(values)))
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self._sums[1:])

    def windows(self, length: int) -> np.ndarray:
        """The hash of each slice of ``length`` values."""
        n = len(self._sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self._sums[length:] - self._sums[:n]) * self._down[:n]

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self._sums[ends] - self._sums[starts]) * self._down[starts]


#: ASCII white space: tab, line feed, vertical tab, form feed, carriage return, space.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


class Words:
    """Words of a range of rows: where each starts and ends in ``data``, and which row has it.

    ``separator`` tells for each byte value whether it stands between words.
    """

    def __init__(self, rows: np.ndarray, data: np.ndarray, separator: np.ndarray = SPACE):
        base = int(rows[0])
        self.data = data[base : int(rows[-1])]
        self.rows = rows - base
        inside = ~separator[self.data]
        before = np.zeros(len(inside), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(inside), bool)
        after[:-1] = inside[1:]
        edges = self.rows[:-1][self.rows[:-1] < len(inside)]
        before[edges] = False
        ends = self.rows[1:]
        after[ends[ends > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        #: Index of the first word of each row, and one past the last.
        self.first = np.searchsorted(self.starts, self.rows)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        rolled = Rolling(self.data.astype(np.uint64) + np.uint64(1))
        return mixed(rolled.slices(self.starts, self.ends))


def last_starts(first: np.ndarray, length: int) -> np.ndarray:
    """For each position of a concatenation of rows: whether ``length`` values from there on
    belong to the same row.  ``first`` holds the rows' first positions and the end."""
    total = int(first[-1])
    room = np.repeat(first[1:], np.diff(first)) - np.arange(total)
    return room >= length


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each slice of ``width`` values."""
    reach, best = 1, values
    while reach * 2 <= width:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(best[: len(best) - rest], best[rest:]) if rest else best
