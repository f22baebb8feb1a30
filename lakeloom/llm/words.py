"""Words of Arrow text columns as numpy arrays.

A word is a maximal run of bytes other than ``\\x20`` and ``\\x09``–``\\x0D``
(``[^\\x20\\x09-\\x0D]+``); in UTF-8 those six bytes occur only as themselves,
so byte runs and code-point runs are the same. Everything here runs inside a
Spark task on one slice of a batch: ``slices`` keeps the slices small, so that
memory follows the slice and the longest single text, not the partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
SLICE_BYTES = 1 << 20
_LONG = 256  # bytes; longer words are hashed one by one

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(WORD_SPACE)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], dtype=np.uint64)

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise on uint64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of ``n_rows`` texts: ``data[start[i]:end[i]]`` is word i, of text ``row[i]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    n_rows: int

    def first(self) -> np.ndarray:
        """Index of each text's first word (n_rows + 1 entries, the last one the total)."""
        return np.searchsorted(self.row, np.arange(self.n_rows + 1))


def text_bytes(arr) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their bounds (n + 1); null texts are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if isinstance(arr, pa.ChunkedArray):  # an empty column keeps no chunk
        arr = pa.array([], pa.large_string())
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    bufs = arr.buffers()
    bounds = np.frombuffer(bufs[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in row ranges of about ``limit`` text bytes (one row at least)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    if not len(sizes):
        return
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def find_words(arr, lower: bool = False) -> Words:
    data, bounds = text_bytes(arr)
    if lower:
        data = _LOWER[data]
    word = ~_IS_SPACE[data]
    n_rows = len(bounds) - 1
    starts, ends = word.copy(), word.copy()
    if len(data):
        starts[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        heads = bounds[:-1][bounds[:-1] < bounds[1:]]
        starts[heads] = word[heads]
        tails = bounds[1:][bounds[:-1] < bounds[1:]] - 1
        ends[tails] = word[tails]
    start = np.flatnonzero(starts)
    end = np.flatnonzero(ends) + 1
    row = np.searchsorted(bounds, start, "right") - 1
    return Words(data, start, end, row, n_rows)


def hash_words(w: Words, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    h = np.full(len(w.start), np.uint64((seed * 0x632BE59BD9B4E019 + 0x1F83D9ABFB41BD6B) & 0xFFFFFFFFFFFFFFFF))
    if not len(h):
        return h
    size = w.end - w.start
    h ^= size.astype(np.uint64) * _GOLD
    padded = np.concatenate([w.data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    short = size <= _LONG
    live = np.flatnonzero(short)
    at = 0
    while len(live):
        part = eight[w.start[live] + at] & _KEEP[np.minimum(size[live] - at, 8)]
        h[live] = mix((h[live] ^ part) * _GOLD + np.uint64(seed + 1))
        at += 8
        live = live[size[live] > at]
    for i in np.flatnonzero(~short):
        key = hashlib.blake2b(w.data[w.start[i]:w.end[i]].tobytes(), digest_size=8, key=seed.to_bytes(8, "little"))
        h[i] = int.from_bytes(key.digest(), "little")
    return h


def hash_windows(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and a hash of each run of ``k`` words of one text."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    acc = h[:n].copy()
    for j in range(1, k):
        acc *= _GOLD
        acc += h[j:n + j]
    at = np.flatnonzero(row[:n] == row[k - 1:])
    return at, mix(acc[at])


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Index of the first of each run of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1])
