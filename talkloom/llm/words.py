"""Words and windows of whole texts as numpy arrays, for use inside tasks.

Texts come as Arrow batches. A batch is worked on in slices of half a megabyte,
so memory stays bounded however many rows a batch holds; a single text is never
cut. A word is a maximal run of bytes other than space and \\t \\n \\v \\f \\r, which
in UTF-8 is the same as the pattern ``[^\\x20\\x09-\\x0D]+`` on characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 19
WORD = r"[^\x20\x09-\x0D]+"

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)


def version(text: str) -> Column:
    """128 bits that tell apart the texts of rows that share an id; null has its own."""
    return F.coalesce(F.unhex(F.md5(F.col(text))), F.lit(b""))


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, as many as asked for so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            many = max(n, SLICE_BYTES + (1 << 16))
            inverse = pow(_BASE, -1, 1 << 64)
            self.up, self.down = (
                np.concatenate(
                    ([np.uint64(1)], np.cumprod(np.full(many - 1, base, dtype=np.uint64)))
                )
                for base in (_BASE, inverse)
            )
        return self.up[:n], self.down[:n]


_powers = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


class SpanHash:
    """Hashes of any spans of one sequence of symbols in constant time each."""

    def __init__(self, symbols: np.ndarray) -> None:
        up, self.down = _powers(len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
        np.cumsum(symbols * up[:-1], out=self.sums[1:])

    def __call__(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, k: int) -> np.ndarray:
        """Of every run of ``k`` symbols."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n])


@dataclass
class Slice:
    """Some whole texts of a batch, joined by line feeds."""

    first: int  # row of the first text in the batch
    data: np.ndarray  # bytes
    starts: np.ndarray  # of each text in ``data``
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def codes(self) -> np.ndarray:
        return _CODES[self.data]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a text column into slices; null counts as empty."""
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset :][: n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    lengths = np.diff(offsets)
    if column.null_count:
        lengths = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, lengths)
    sizes = np.cumsum(lengths + 1)
    row = 0
    while row < n:
        done = sizes[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(sizes, done + limit, side="right")))
        ends = np.cumsum(lengths[row:end] + 1) - 1
        starts = ends - lengths[row:end]
        joined = np.full(int(ends[-1]) + 1, 0x0A, dtype=np.uint8)
        for i in range(end - row):
            joined[starts[i] : ends[i]] = data[offsets[row + i] : offsets[row + i] + lengths[row + i]]
        yield Slice(row, joined, starts, ends)
        row = end


@dataclass
class Words:
    """The words of a slice: byte spans, the text each is in, and hashes."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    counts: np.ndarray  # words of each text
    first: np.ndarray  # index of each text's first word
    hash: np.ndarray | None


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words(piece: Slice, hashed: bool = True) -> Words:
    """Find the words of a slice."""
    blank = _BLANK[piece.data]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(blank) and not blank[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]  # the last byte is a line feed, so every word ends
    text = np.searchsorted(piece.starts, start, side="right") - 1
    counts = np.bincount(text, minlength=len(piece))
    first = np.cumsum(counts) - counts
    found = SpanHash(_CODES[piece.data])(start, end) if hashed else None
    return Words(start, end, text, counts, first, found)
