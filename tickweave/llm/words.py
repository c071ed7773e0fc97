"""Words of a batch of texts and their 64-bit hashes, found with numpy over Arrow buffers.

Operators call these inside Spark tasks. A batch is handled in row slices of bounded bytes, so memory
follows the slice and the longest single text, never the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 512 << 10
HASH_BYTES = 512 << 10
U64 = np.uint64

_generator = np.random.Generator(np.random.PCG64(20240607))
_BYTE_VALUES = _generator.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def not_in(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of the bytes that belong to words: all but those of the ranges."""
    table = np.ones(256, dtype=bool)
    for first, last in ranges:
        table[first : last + 1] = False
    return table


#: The separators of the contracts.
SPACED = not_in((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = not_in((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def mix(value: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all bits."""
    value = value ^ (value >> U64(32))
    value = value * U64(0xD6E8FEB86659FD93)
    value = value ^ (value >> U64(32))
    value = value * U64(0xD6E8FEB86659FD93)
    return value ^ (value >> U64(32))


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < size:
        size = max(size, HASH_BYTES)
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _powers[:] = tables
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of consecutive texts: word ``i`` is ``data[start[i]:end[i]]``; text ``t`` has words
    ``first[t]`` up to ``first[t + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        """A polynomial hash of each word's bytes, mixed; equal words hash alike in every batch."""
        out = np.empty(len(self.start), dtype=np.uint64)
        at = 0
        while at < len(out):
            low = self.start[at]
            stop = max(at + 1, int(np.searchsorted(self.end, low + HASH_BYTES, side="right")))
            high = self.end[stop - 1]
            forward, back = _power_tables(int(high - low))
            terms = _BYTE_VALUES[self.data[low:high]]
            terms *= forward[: high - low]
            sums = np.empty(len(terms) + 1, dtype=np.uint64)
            sums[0] = 0
            np.cumsum(terms, out=sums[1:])
            begin = self.start[at:stop] - low
            out[at:stop] = (sums[self.end[at:stop] - low] - sums[begin]) * back[begin]
            at = stop
        return mix(out)

    def spelled(self, index: np.ndarray) -> list[bytes]:
        """The bytes of some words."""
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.start[index].tolist(), self.end[index].tolist())]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its offsets into them; null counts as empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, places, data = column.buffers()
    if places is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray, lower: bool = True) -> Words:
    """Maximal runs of the bytes marked in ``letters``, never across two texts."""
    if lower:
        data = LOWER[data]
    inside = letters[data]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    opening = inside.copy()
    opening[1:] &= ~inside[:-1]
    opening[edges] = inside[edges]
    closing = inside.copy()
    closing[:-1] &= ~inside[1:]
    before = edges[edges > 0] - 1
    closing[before] = inside[before]
    start = np.flatnonzero(opening)
    end = np.flatnonzero(closing) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows whose texts take about ``limit`` bytes; a longer text is alone."""
    _, offsets = buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        stop = min(max(at + 1, stop), batch.num_rows)
        yield batch.slice(at, stop - at)
        at = stop


def batch_words(batch: pa.RecordBatch, column: str, letters: np.ndarray) -> Words:
    return split(*buffers(batch.column(column)), letters)


def sequences(words: Words, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``length`` words and their texts. A text of fewer words, but not none,
    gives its whole sequence as one."""
    counts = words.counts()
    total = len(hashes)
    value = np.zeros(max(total - length + 1, 0), dtype=np.uint64)
    for step in range(length):
        value = mix(value + hashes[step : step + len(value)] * U64(2 * step + 3))
    owner = words.owner()
    whole = owner[: len(value)] == owner[length - 1 :] if len(value) else np.zeros(0, bool)
    value, owner = value[whole], owner[: len(whole)][whole]
    short = np.flatnonzero((counts > 0) & (counts < length))
    if len(short):
        extra = np.zeros(len(short), dtype=np.uint64)
        for step in range(length):
            more = counts[short] > step
            at = words.first[short[more]] + step
            extra[more] = mix(extra[more] + hashes[at] * U64(2 * step + 3))
        extra = mix(extra + counts[short].astype(np.uint64))
        value, owner = np.concatenate([value, extra]), np.concatenate([owner, short])
    return value, owner


def distinct(value: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text, ascending, and the places where each text's values begin."""
    by = np.argsort(value, kind="stable")
    by = by[np.argsort(owner[by], kind="stable")]
    value, owner = value[by], owner[by]
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[fresh], owner[fresh]
    return value, np.searchsorted(owner, np.arange(texts + 1))


def binary(parts: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary column of the pieces ``parts[bounds[i]:bounds[i + 1]]``."""
    size = parts.dtype.itemsize
    offsets = pa.py_buffer((bounds * size).astype(np.int64).tobytes())
    data = pa.py_buffer(np.ascontiguousarray(parts).tobytes())
    wide = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, offsets, data])
    return wide.cast(pa.binary())
