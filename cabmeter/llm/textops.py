"""Vectorised word work on Arrow batches, shared by the Python operators.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, which is the
same as ``[^\\x20\\x09-\\x0D]+`` on the decoded text. All functions take a
chunk of texts as one byte buffer with offsets, so the cost per text is small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text handled at once; bounds the memory of the work arrays (about
# sixty bytes for each byte of text). A longer single text is a chunk alone.
CHUNK_BYTES = 1 << 19

_U = np.uint64
_WS = np.zeros(256, bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (constants of the published generator)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_FOLDED = _BYTE.copy()
_FOLDED[0x41:0x5B] = _BYTE[0x61:0x7B]  # A-Z as a-z
_power = np.ones(64, _U)


def _powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd multiplier modulo 2**64."""
    global _power
    while len(_power) < n:
        step = np.full(len(_power), 0x9E3779B97F4A7C15 | 1, _U)
        last = _power[-1:]
        _power = np.concatenate([_power, np.multiply.accumulate(np.concatenate([last, step]))[1:]])
    return _power


_power = np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(63, 0x9E3779B97F4A7C15 | 1, _U)]))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is an empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batches, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
        sizes = np.diff(np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1])
        ends = np.cumsum(sizes)
        i = 0
        while i < batch.num_rows:
            base = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(i, j - i)
            i = j


def segment_hash(data: np.ndarray, inside: np.ndarray, size: np.ndarray, fold: bool = False) -> np.ndarray:
    """Hashes of segments of ``data``: those bytes where ``inside`` holds, cut
    into pieces of the given sizes (none empty). ``fold`` takes A-Z as a-z."""
    if not len(size):
        return np.zeros(0, _U)
    base = np.cumsum(size) - size
    place = np.arange(base[-1] + size[-1]) - np.repeat(base, size)
    parts = (_FOLDED if fold else _BYTE)[data[inside]] * _powers(int(size.max()))[place]
    return mix(np.add.reduceat(parts, base) + size.astype(_U) * _U(0xD6E8FEB86659FD93))


class Words:
    """The words of a chunk: ``hash``, ``doc`` (row in the chunk), ``start``
    and ``end`` (bytes in the chunk), and ``first`` (the index of each row's
    first word; one more entry than rows)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, fold: bool = False):
        n = len(data)
        word = ~_WS[data]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        stops = word.copy()
        stops[:-1] &= ~word[1:]
        filled = offsets[:-1] < offsets[1:]
        head = offsets[:-1][filled]
        begins[head] = word[head]
        tail = offsets[1:][filled] - 1
        stops[tail] = word[tail]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.hash = segment_hash(data, word, self.end - self.start, fold)
        assert n == 0 or self.first[-1] == len(self.start)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``n`` consecutive words and their first word's index;
        windows do not cross rows."""
        total = len(self.hash)
        if total < n:
            return np.zeros(0, _U), np.zeros(0, np.int64)
        at = np.flatnonzero(self.doc[:total - n + 1] == self.doc[n - 1:])
        return chain(self.hash, n)[at], at


def chain(hashes: np.ndarray, n: int) -> np.ndarray:
    """Order-dependent hash of every ``n`` consecutive entries."""
    size = len(hashes) - n + 1
    out = np.zeros(max(size, 0), _U)
    for k in range(n):
        out *= _U(0x9E3779B97F4A7C15)
        out += hashes[k:k + size]
    return mix(out)


def words_of(batch: pa.RecordBatch, column: str = "text", fold: bool = False) -> Words:
    return Words(*text_buffer(batch.column(batch.schema.get_field_index(column))), fold)


def packed(arrays: list[np.ndarray]) -> pa.Array:
    """A binary column whose entries are the bytes of the arrays."""
    return pa.array([np.ascontiguousarray(a).tobytes() for a in arrays], pa.binary())
