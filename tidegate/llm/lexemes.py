"""Words and shingles of a batch of texts as flat numpy arrays.

A word is a run of bytes other than ``\\x20`` and ``\\x09``-``\\x0D``; none of those occurs
inside a longer UTF-8 sequence, so words are found on bytes. Hashes are 64 bits: a
polynomial over the bytes (so every word costs one subtraction), then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20  # texts worked on at once; a longer single text is one slice
WIDTH = 5  # words of a shingle

_BASE = 0x9E3779B97F4A7C15  # odd, so powers can be undone modulo 2^64
_STEP = np.uint64(0xD1B54A32D192ED03)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.empty(n, np.uint64), np.empty(n, np.uint64)
    up[0] = down[0] = 1
    up[1:], down[1:] = np.uint64(_BASE), np.uint64(inverse)
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n-1 of the base and of its inverse."""
    size = 1 << max(int(n - 1).bit_length(), 21)
    up, down = _powers(size)
    return up[:n], down[:n]


def text_slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``size`` bytes; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, marks, data = column.buffers()
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(marks, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    a = 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


class Spans:
    """Runs of bytes cut out of texts: where they start and end, and which are of which text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
        n = len(data)
        start = inside.copy()
        end = inside.copy()
        if n:
            start[1:] &= ~inside[:-1]
            end[:-1] &= ~inside[1:]
            bounds = offsets[(offsets > 0) & (offsets < n)]
            start[bounds] = inside[bounds]
            end[bounds - 1] = inside[bounds - 1]
        self.data, self.offsets = data, offsets
        self.start = np.flatnonzero(start)
        self.end = np.flatnonzero(end) + 1
        self.bounds = np.searchsorted(self.start, offsets)  # spans of text i: bounds[i]..bounds[i+1]
        self.counts = np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray) -> Spans:
    return Spans(data, offsets, ~SPACE[data])


def shingle_hashes(hashes: np.ndarray, counts: np.ndarray, width: int = WIDTH):
    """Hashes of all runs of ``width`` words, and how many each text has.

    A text with fewer words has one shingle of all its words; a text without words has none.
    """
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.cumsum(counts) - counts
    start = np.repeat(first - (np.cumsum(made) - made), made) + np.arange(made.sum())
    length = np.repeat(np.minimum(counts, width), made)
    out = np.zeros(len(start), np.uint64)
    for i in range(width):
        use = start + i if i == 0 else np.minimum(start + i, max(len(hashes) - 1, 0))
        step = hashes[use] if len(hashes) else out
        out = out * _STEP + (step if i == 0 else np.where(i < length, step, np.uint64(i)))
    return mixed(out), made


def distinct_parts(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct values of each text."""
    out, a = [], 0
    for n in counts.tolist():
        part = np.sort(values[a : a + n])
        a += n
        if n > 1:
            part = part[np.concatenate(([True], part[1:] != part[:-1]))]
        out.append(part)
    return out
