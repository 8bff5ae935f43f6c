"""Words of many texts at once: boundaries and 64-bit hashes, by numpy inside tasks.

Texts are handled as UTF-8 bytes. A class of word bytes that takes all bytes from
0x80 up, or none, splits bytes exactly where a pattern over code points would
split characters. Only A-Z is lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once inside a task; a longer text makes a chunk of its own.
CHUNK_BYTES = 2 << 20

#: Words ``[^\x20\x09-\x0D]+``: all but ASCII white space.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Words of digits, letters and all bytes above ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below n, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 2 * CHUNK_BYTES:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two hashes in order."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + b)


@dataclass
class Words:
    """Words of consecutive texts: byte range in ``data``, text number and hash of each."""

    data: np.ndarray      # bytes as given
    bounds: np.ndarray    # n + 1 byte offsets of the texts in data
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """n + 1 numbers of the first word of each text."""
        return np.searchsorted(self.doc, np.arange(len(self.bounds)))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of rows of at most ``size`` bytes, or one row: first, last + 1, bytes, offsets."""
    data, offsets = raw(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield at, to, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def words(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray = SPACED) -> Words:
    """Split texts into maximal runs of word bytes and hash each run, lower-cased."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return Words(data, bounds, none, none, none, none.astype(np.uint64))
    inside = kind[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = False, inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    values = _BYTES[LOWER[data]]
    values[~inside] = 0
    values *= powers(_BASE, len(data))
    hashed = np.zeros(0, dtype=np.uint64)
    if len(start):
        hashed = mix(np.add.reduceat(values, start) * powers(_INVERSE, len(data))[start])
    doc = np.searchsorted(bounds, start, side="right") - 1
    return Words(data, bounds, start, end, doc, hashed)


def of_column(column: pa.Array, kind: np.ndarray = SPACED, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """Words of a string column, a bounded chunk of rows at a time."""
    for at, to, data, bounds in chunks(column, size):
        yield at, to, words(data, bounds, kind)
