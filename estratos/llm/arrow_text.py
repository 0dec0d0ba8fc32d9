"""Texts of an Arrow batch as one byte buffer: words, word hashes and n-gram hashes without a loop over words.

The functions here run inside `mapInArrow` tasks. A batch is worked through in chunks of whole documents, so memory
is bounded by `CHUNK_BYTES` or by the longest single document. A null text counts as an empty one.

Hashes are polynomials modulo 2^64 over the bytes, read off prefix sums and mixed afterwards. Equal words have equal
hashes in every process; two different ones collide with a probability of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

#: True for the bytes that end a word: space, tab, line feed, vertical tab, form feed, carriage return.
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

#: Byte table that lower-cases A-Z and leaves the rest.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, dtype=np.uint64), _INVERSE: np.ones(1, dtype=np.uint64)}


class Chunk(NamedTuple):
    """Documents `first` to `first + len(bounds) - 2` of a batch; document i is data[bounds[i]:bounds[i + 1]]."""

    first: int
    data: np.ndarray
    bounds: np.ndarray


class Words(NamedTuple):
    """Byte ranges of words; the words of document i are those from `offsets[i]` up to `offsets[i + 1]`."""

    start: np.ndarray
    end: np.ndarray
    offsets: np.ndarray


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of a column in chunks of at most `limit` bytes, or of one longer document."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1)
        own = bounds[first : last + 1]
        yield Chunk(first, data[own[0] : own[-1]], own - own[0])
        first = last


def words(chunk: Chunk, ends: np.ndarray = BLANK) -> Words:
    """The maximal runs of bytes for which `ends` is false; a run never crosses two documents."""
    inside = ~ends[chunk.data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    cuts = chunk.bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(stops) + 1, np.searchsorted(start, chunk.bounds))


def _power(base: int, n: int) -> np.ndarray:
    known = _powers[base]
    if len(known) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash for each range [start, end) of `values`, which are bytes or 64-bit hashes."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(values)), out=sums[1:])
    own = (sums[end] - sums[start]) * _power(_INVERSE, len(values) + 1)[start]
    return mix(own ^ ((end - start).astype(np.uint64) << np.uint64(48)))


def word_hashes(chunk: Chunk, found: Words) -> np.ndarray:
    return range_hashes(chunk.data, found.start, found.end)


def document_of(offsets: np.ndarray) -> np.ndarray:
    """The number of the document of each word or window, from offsets."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def windows(offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows of `size` words within one document, and the windows' own offsets by document."""
    counts = np.maximum(np.diff(offsets) - size + 1, 0)
    own = np.concatenate(([0], np.cumsum(counts)))
    starts = np.arange(own[-1]) + np.repeat(offsets[:-1] - own[:-1], counts)
    return starts, own


def window_hashes(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The hash of each window of `size` words."""
    return range_hashes(hashes, starts, starts + size)


def signed(x: np.ndarray) -> np.ndarray:
    """Hashes as the signed numbers Spark stores."""
    return x.view(np.int64)
