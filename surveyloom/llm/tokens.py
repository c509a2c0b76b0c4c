"""Word hashes of whole Arrow batches, computed with numpy over the raw bytes.

Used inside Arrow tasks. A batch is worked in slices of whole texts, about ``SLICE_BYTES`` at a time, so memory
does not depend on how many rows a batch has; a longer text is a slice of its own. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


#: Separators of words ``[^\x20\x09-\x0D]+``, and of lower-cased words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
SPACES = byte_table((0x20, 0x20), (0x09, 0x0D))
NON_ALNUM = byte_table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
NEWLINE = byte_table((0x0A, 0x0A))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_ODD = 0x9E3779B97F4A7C15
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + SLICE_BYTES // 4)
        up, down = np.full(size, _ODD, np.uint64), np.full(size, pow(_ODD, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Slice:
    """Bytes of consecutive texts. ``starts`` has one entry more than there are texts."""

    def __init__(self, first: int, data: np.ndarray, starts: np.ndarray):
        self.first, self.data, self.starts = first, data, starts

    def __len__(self) -> int:
        return len(self.starts) - 1

    def spans(self, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every word, and for each text the number of words before it (one entry more)."""
        n = len(self.data)
        inside = np.zeros(n + 2, bool)
        np.logical_not(separators[self.data], out=inside[1:-1])
        edge = self.starts
        begins = inside[1:-1] & ~inside[:-2]
        ends = inside[1:-1] & ~inside[2:]
        cut = edge[edge < n]
        begins[cut] |= inside[1:-1][cut]
        last = edge[edge > 0] - 1
        ends[last] |= inside[1:-1][last]
        start = np.flatnonzero(begins)
        return start, np.flatnonzero(ends) + 1, np.searchsorted(start, edge)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans."""
        up, down = powers(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], out=sums[1:])
        own = (sums[end] - sums[start]) * down[start]
        return mix(own + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def words(self, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word, and the text bounds in that array."""
        start, end, bounds = self.spans(separators)
        return self.hashes(start, end), bounds

    def counts(self, marked: np.ndarray) -> np.ndarray:
        """Per text, the number of bytes for which ``marked`` (a table, or a flag per byte) holds."""
        flags = marked[self.data] if len(marked) == 256 and marked.dtype == bool and len(self.data) != 256 else marked
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[self.starts[1:]] - sums[self.starts[:-1]]


def chain(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words, by position of the first; the last n-1 entries are left out."""
    size = max(0, len(hashes) - n + 1)
    out = hashes[:size].copy()
    for k in range(1, n):
        out = mix(out * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[k : k + size])
    return out


def slices(column: pa.Array, lower: bool = True, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column into slices of whole texts; A-Z become a-z unless ``lower`` is false."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, side="right")) - 1)
        last = min(last, len(column))
        own = raw[bounds[first] : bounds[last]]
        yield Slice(first, LOWER[own] if lower else own, bounds[first : last + 1] - bounds[first])
        first = last


def shingle_sets(column: pa.Array, words: int, separators: np.ndarray = SPACES) -> Iterator[np.ndarray]:
    """Per text, its sorted distinct shingle hashes. A text with fewer words has one shingle of them all; none without words."""
    for part in slices(column):
        hashes, bounds = part.words(separators)
        runs = chain(hashes, words)
        for i in range(len(part)):
            a, b = bounds[i], bounds[i + 1]
            if b - a >= words:
                yield np.unique(runs[a : b - words + 1])
            elif b > a:
                yield mix(chain(hashes[a:b], int(b - a)) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)
