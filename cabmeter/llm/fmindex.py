"""An FM-index of a sequence of numbers: backward search over a wavelet matrix.

The index holds the Burrows-Wheeler transform of many segments as one wavelet
matrix: bit vectors with a count for every 512 bits and a short one within them
for every 64. The suffix array is not kept: of every segment the first and each ``SAMPLE``-th place are marked,
and a row's segment is found by steps to the left until a marked one is met.
All searches of a shard run side by side, one vectorised step per symbol and bit.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
SAMPLE = 8  # every which place of a segment is marked


class _Bits:
    """A bit vector with rank support."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        words = np.zeros(n // 64 + 1, _U)
        raw = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[:len(raw)] = raw
        self.words = words
        counts = np.bitwise_count(words).astype(np.int64)
        before = np.cumsum(counts) - counts
        self.block = before[::8].copy()
        self.inner = (before - np.repeat(self.block, 8)[:len(before)]).astype(np.uint16)
        self.zeros = n - int(counts.sum())

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        word = i >> 6
        mask = (_U(1) << (i & 63).astype(_U)) - _U(1)
        return self.block[word >> 3] + self.inner[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(_U)) & _U(1) == 1


def _sorted_suffixes(text: np.ndarray, ends: np.ndarray, less: np.ndarray) -> np.ndarray:
    """The order of the suffixes, an end of a segment being smaller than that of
    a later one. A suffix's rank is how many are smaller by the symbols compared
    so far, twice as many each round; only tied ones are compared again."""
    n = len(text)
    rank = np.where(ends, np.cumsum(ends) - 1, less[text])
    tied, width = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1), 1
    while len(tied):
        key = rank[tied] * (n + 1) + rank[tied + width]
        by = np.argsort(key)
        tied, key = tied[by], key[by]
        new = np.append(True, key[1:] != key[:-1])
        group = np.append(True, np.diff(rank[tied]) != 0)
        place = np.arange(len(tied))
        head = lambda flags: np.maximum.accumulate(np.where(flags, place, 0))
        rank[tied] += head(new) - head(group)
        tied = tied[~(new & np.append(new[1:], True))]
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


class FMIndex:
    """Index of ``text``, symbols from 0 to ``sigma`` - 1. 0 ends segments, and
    the text ends with it."""

    def __init__(self, text: np.ndarray, sigma: int):
        n, top = len(text), sigma
        ends = text == 0
        counts = np.bincount(text, minlength=top)
        self.less = np.cumsum(counts) - counts
        order = _sorted_suffixes(text, ends, self.less)
        bwt = text[order - 1] if n else text
        # Segments and places in them, for the rows that are marked.
        segment = np.cumsum(ends) - ends
        begin = np.concatenate([[0], np.flatnonzero(ends) + 1])
        place = np.arange(n) - begin[segment]
        marked = (place % SAMPLE == 0)[order]
        self.marks = _Bits(marked)
        self.sampled = segment[order][marked].astype(np.int32)
        self.levels, cur = [], bwt.astype(np.int64)
        start = np.zeros(top, np.int64)
        symbols = np.arange(top)
        for bit in range(max(1, int(top - 1).bit_length()) - 1, -1, -1):
            on = ((cur >> bit) & 1).astype(bool)
            level = _Bits(on)
            self.levels.append((bit, level))
            cur = np.concatenate([cur[~on], cur[on]])
            start = self._down(level, (symbols >> bit) & 1, start)
        self.start = start
        self.size = n

    @staticmethod
    def _down(level: _Bits, bit: np.ndarray, i: np.ndarray) -> np.ndarray:
        ones = level.rank(i)
        return np.where(bit, level.zeros + ones, i - ones)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: the interval of ``symbol`` + pattern from the
        interval [lo, hi) of each pattern."""
        both = np.concatenate([lo, hi])
        twice = np.concatenate([symbol, symbol])
        for bit, level in self.levels:
            both = self._down(level, (twice >> bit) & 1, both)
        both += (self.less - self.start)[twice]
        return both[:len(lo)], both[len(lo):]

    def segments(self, rows: np.ndarray) -> np.ndarray:
        """The segments, numbered from 0, to which the suffixes of ``rows``
        belong: at most ``SAMPLE`` - 1 steps to the left each."""
        out = np.zeros(len(rows), np.int64)
        live, at = np.arange(len(rows)), np.asarray(rows, np.int64)
        while len(live):
            there = self.marks.get(at)
            out[live[there]] = self.sampled[self.marks.rank(at[there])]
            live, at = live[~there], self._left(at[~there])
        return out

    def _left(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that begins one symbol earlier."""
        symbol = np.zeros(len(row), np.int64)
        for bit, level in self.levels:
            on = level.get(row)
            symbol |= on.astype(np.int64) << bit
            row = self._down(level, on, row)
        return row + (self.less - self.start)[symbol]

    def search(self, text: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics, cut at ``length``, of the positions before
        ``ends`` in ``text``: how many symbols to the left of each end match
        somewhere in the index in at least two places, and the interval of
        those that reach ``length`` (else empty)."""
        lo = np.zeros(len(ends), np.int64)
        hi = np.full(len(ends), self.size)
        matched = np.zeros(len(ends), np.int64)
        live = np.arange(len(ends))
        for k in range(1, length + 1):
            a, b = self.extend(text[ends[live] - k], lo[live], hi[live])
            on = b - a > 1
            live = live[on]
            lo[live], hi[live] = a[on], b[on]
            matched[live] = k
        short = matched < length
        hi[short] = lo[short]
        return matched, lo, hi
