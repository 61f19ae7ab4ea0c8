"""Vectorised word, shingle and hash kernels over Arrow text columns.

A *word* is a maximal run of characters other than the ASCII white space
``\\x20 \\x09-\\x0D``; on UTF-8 bytes that is the same as on code points. Every
function works on a block of whole documents: one byte array and the documents'
offsets in it, so that numpy does the work and Python loops over blocks only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Blocks of whole documents hold about so many bytes; a longer document is a
# block by itself.
BLOCK_BYTES = 1 << 20

SHINGLE_WORDS = 5

_U64 = np.uint64
# The multiplier of the polynomial hash and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, applied to each element."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=_U64) * _U64(0xD1342543DE82EF95))
_SLOT_FACTORS = mix(np.arange(1, 65, dtype=_U64)) | _U64(1)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[ord("A") : ord("Z") + 1] += 32


class _Powers:
    """Powers of the hash's multiplier, grown to the longest block seen."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES + 1)
            with np.errstate(over="ignore"):
                self.up = np.multiply.accumulate(np.r_[_U64(1), np.full(size - 1, _BASE, _U64)])
                self.down = np.multiply.accumulate(
                    np.r_[_U64(1), np.full(size - 1, _INVERSE, _U64)]
                )
        return self.up, self.down


_POWERS = _Powers()


class SpanHasher:
    """Hashes of byte spans of one block, each in constant time."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = _POWERS.upto(len(data) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(data) + 1, _U64)
            np.cumsum(_BYTE_VALUES[data] * self.up[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            raw = (self.sums[end] - self.sums[start]) * self.down[start]
            return mix(raw + (end - start).astype(_U64) * _U64(_INVERSE))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes end to end, and each row's offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole documents: first row, last row + 1, bytes, offsets."""
    data, at = text_bytes(column)
    first, n = 0, len(at) - 1
    while first < n:
        last = int(np.searchsorted(at, at[first] + block_bytes, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


@dataclass
class Words:
    """The words of a block: byte spans, and the document each is in."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # of each document, its first word's number; one more at the end

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)


def find_words(data: np.ndarray, at: np.ndarray) -> Words:
    inside = ~IS_SPACE[data]
    n = len(data)
    begins, ends = inside.copy(), inside.copy()
    if n:
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = at[(at > 0) & (at < n)]  # a word ends with its document
        begins[cuts] = inside[cuts]
        ends[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, at)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(first))
    return Words(start, end, doc, first)


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` consecutive values."""
    if len(values) < size:
        return np.zeros(0, _U64)
    n = len(values) - size + 1
    total = np.full(n, size, _U64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total += values[k : k + n] * _SLOT_FACTORS[k]
    return mix(total)


def windows_in_documents(doc: np.ndarray, size: int) -> np.ndarray:
    """Which windows lie in one document; for ``window_hashes`` of all words."""
    if len(doc) < size:
        return np.zeros(0, bool)
    return doc[: len(doc) - size + 1] == doc[size - 1 :]


def shingle_sets(
    data: np.ndarray, at: np.ndarray, size: int = SHINGLE_WORDS
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each document, sorted, and the documents' offsets.

    A-Z count as a-z. A document with fewer words than ``size`` has its whole
    sequence as its one shingle; one without words has none.
    """
    data = ASCII_LOWER[data]
    words = find_words(data, at)
    values = SpanHasher(data)(words.start, words.end)
    every = window_hashes(values, size)
    count = words.count
    sets = []
    for d in range(len(at) - 1):
        a, n = words.first[d], int(count[d])
        if n >= size:
            sets.append(np.unique(every[a : a + n - size + 1]))
        else:
            sets.append(window_hashes(values[a : a + n], n) if n else every[:0])
    offsets = np.zeros(len(at), np.int64)
    np.cumsum([len(s) for s in sets], out=offsets[1:])
    return (np.concatenate(sets) if sets else every[:0]), offsets


def as_long(values: np.ndarray) -> pa.Array:
    """Unsigned hashes as Arrow longs with the same bits."""
    return pa.array(values.view(np.int64))
