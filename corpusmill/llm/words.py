"""Words of a batch of texts as 64-bit numbers, worked out for the whole batch at once.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return,
which is the same in UTF-8 bytes as in code points. Words, their prefixes and n-grams are told apart by a
64-bit polynomial hash with a final mixing step; two different words share a number with probability
2**-64, so that among 10**9 distinct words a clash is expected with probability 0.03.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BREAKS = np.zeros(256, bool)
BREAKS[[0x20, *range(0x09, 0x0E)]] = True
# Texts are worked on in slices of about this many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 21

_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finaliser of SplitMix64)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


with np.errstate(over="ignore"):
    _BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))
_LOWER_BYTES = _BYTES.copy()
_LOWER_BYTES[ord("A"):ord("Z") + 1] = _BYTES[ord("a"):ord("z") + 1]

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grow_powers(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, SLICE_BYTES + 1)
        steps = np.full(size, _MULTIPLIER, np.uint64)
        back = np.full(size, pow(_MULTIPLIER, -1, 1 << 64), np.uint64)
        steps[0] = back[0] = 1
        _powers, _inverses = np.multiply.accumulate(steps), np.multiply.accumulate(back)


@dataclass
class Words:
    """The words of n texts: byte spans, hashes, and bounds[i]:bounds[i + 1] as the words of text i."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray
    sums: np.ndarray

    @property
    def n_texts(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), self.counts)

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return span_hash(self.sums, start, end)

    @property
    def hashes(self) -> np.ndarray:
        return self.span_hash(self.start, self.end)

    def prefix_hashes(self, n_bytes: int) -> np.ndarray:
        """Hashes of the first bytes of each word."""
        return self.span_hash(self.start, np.minimum(self.end, self.start + n_bytes))


def prefix_sums(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Sums from which span_hash takes the hash of any run of these bytes."""
    n = len(data)
    _grow_powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.multiply((_LOWER_BYTES if lower else _BYTES)[data], _powers[:n], out=sums[1:])
    return np.cumsum(sums, out=sums)


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * _inverses[start])


def string_column(column: pa.Array) -> pa.Array:
    """Null texts as empty ones, with 64-bit offsets."""
    return column.cast(pa.large_string()).fill_null("")


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a large_string column without nulls."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if offsets else np.zeros(len(texts) + 1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def find_words(texts: pa.Array, lower: bool = False) -> Words:
    """The words of a large_string column; with `lower`, A-Z count as a-z."""
    data, offsets = text_bytes(texts)
    n = len(data)
    inside = ~BREAKS[data]
    before = np.zeros(n, bool)
    after = np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    before[edges] = False
    after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets), prefix_sums(data, lower))


def ngram_hashes(hashes: np.ndarray, text_of: np.ndarray, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position of the first word) of every run of n words within a text."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(text_of[:m] == text_of[n - 1:n - 1 + m])
    total = np.full(len(first), (seed * 2 + 1) * _MULTIPLIER & _MASK, np.uint64)
    for k in range(n):
        total = (total + hashes[first + k]) * np.uint64(0xD6E8FEB86659FD93)
    return mix(total), first


def run_hashes(hashes: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """The hash of the run of n words from each start, however long, from sums over all words."""
    _grow_powers(len(hashes) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers[:len(hashes)])])
    return span_hash(sums, start, start + n)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch cut into runs of rows with about `most` bytes of text, nulls of that column filled."""
    at = batch.schema.get_field_index(column)
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0)
    offsets = np.concatenate([[0], np.cumsum(np.asarray(sizes), dtype=np.int64)])
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1)
        part = batch.slice(low, high - low)
        yield part.set_column(at, column, string_column(part.column(at)))
        low = high


def per_text(bounds: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of per-word values for each text."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def binary_rows(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary column whose row i holds values[bounds[i]:bounds[i + 1]]."""
    flat = np.ascontiguousarray(values)
    offsets = (np.asarray(bounds, np.int64) * flat.itemsize)
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())])
