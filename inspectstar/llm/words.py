"""Words of whole texts as numpy arrays, one slice of a batch at a time.

A word is a maximal run of bytes other than space and \\t..\\r, so it is the same run of
code points. Every word gets a 64-bit hash of its bytes that does not depend on the
document, the slice or the machine: it serves as the word's id in shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Text bytes handled at once; a longer document is a slice of its own.
SLICE_BYTES = 2_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


_BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * _BASE)


class _Powers:
    """Powers of the hash base and of its inverse, as many as the longest slice needs."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, min(2 * len(self.up), SLICE_BYTES + 1))
            with np.errstate(over="ignore"):
                self.up = np.full(n, _BASE)
                self.down = np.full(n, _BASE_INVERSE)
                self.up[0] = self.down[0] = 1
                np.multiply.accumulate(self.up, out=self.up)
                np.multiply.accumulate(self.down, out=self.down)


_powers = _Powers()


@dataclass
class Slice:
    """Some consecutive documents of a batch.

    ``first`` and ``last`` bound their rows in the batch; ``data`` holds the bytes of their
    texts, document i from ``bounds[i]`` to ``bounds[i + 1]``.
    """

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return self.last - self.first

    def lowered(self) -> Slice:
        """A-Z in lower case; other characters stay."""
        return Slice(self.first, self.last, _LOWER[self.data], self.bounds)

    def words(self) -> Words:
        return Words(self)


class Words:
    """Word positions of a slice: ``start``, ``end`` in bytes; ``offset`` by document."""

    def __init__(self, piece: Slice):
        self.piece = piece
        data, bounds = piece.data, piece.bounds
        solid = ~_IS_SPACE[data]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        stops = solid.copy()
        stops[:-1] &= ~solid[1:]
        inner = bounds[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        begins[inner] |= solid[inner]
        stops[inner - 1] |= solid[inner - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(stops) + 1
        self.offset = np.searchsorted(self.start, bounds)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word."""
        return span_hashes(self.piece.data, self.start, self.end)

    def counts(self) -> np.ndarray:
        return np.diff(self.offset)

    def document(self) -> np.ndarray:
        """For each word, its document's position in the slice."""
        return np.repeat(np.arange(len(self.piece)), self.counts())

    def text(self, i: int) -> str:
        return self.piece.data[self.start[i] : self.end[i]].tobytes().decode("utf-8")


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span of ``data``."""
    _powers.grow(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        codes = _BYTE_CODES[data]
        codes *= _powers.up[: len(data)]
        np.cumsum(codes, out=total[1:])
        return mix64((total[end] - total[start]) * _powers.down[start])


def distinct_counts(hashes: np.ndarray, document: np.ndarray, n: int) -> np.ndarray:
    """The number of different hashes of each of ``n`` documents."""
    with np.errstate(over="ignore"):
        keys = mix64(hashes + document.astype(np.uint64) * _BASE)
    _, first = np.unique(keys, return_index=True)
    return np.bincount(document[first], minlength=n)


def slices(texts: pa.Array | pa.ChunkedArray, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """``texts`` in slices of about ``size`` bytes; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    buffers = texts.buffers()
    ends = np.frombuffer(buffers[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(buffers[2] or b"", dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(ends, ends[first] + size, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield Slice(first, last, raw[ends[first] : ends[last]], ends[first : last + 1] - ends[first])
        first = last


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for every ``width`` consecutive entries of ``hashes`` (documents not kept apart)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            total = total * _BASE + hashes[i : i + n]
    return mix64(total)


def within(offset: np.ndarray, width: int) -> np.ndarray:
    """Start positions of runs of ``width`` words that lie inside one document."""
    n = int(offset[-1]) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    inside = np.ones(n, dtype=bool)
    for shift in range(1, width):
        cut = offset[1:-1] - shift
        cut = cut[(cut >= 0) & (cut < n)]
        inside[cut] = False
    return np.flatnonzero(inside)
