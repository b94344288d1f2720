"""A compressed full-text index over word sequences, built and searched with NumPy inside a task.

The Burrows-Wheeler transform of the sequences is kept as a wavelet matrix: one packed bit vector for each bit of the
alphabet, with counts of ones before each machine word. Backward search extends many patterns at once, a symbol at a
time, by two rank queries each.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with ranks: packed words and the ones before each of them."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]])
        self.zeros = len(bits) - int(bits.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class FmIndex:
    """Index over a text of symbols 0 to symbols - 1, sorted to a depth: patterns of at most that length can be searched.

    Symbol 0 separates sequences and is in no pattern. ``suffixes`` holds the text place of each row.
    """

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        rank, reach = text.astype(np.int64), 1
        while True:  # rank orders the suffixes by their first ``reach`` symbols
            key = rank * (len(text) + symbols + 1)
            key[:-reach] += rank[reach:] + 1
            order = np.argsort(key, kind="stable")
            reach *= 2
            if reach >= depth:
                break
            rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) > 0)])
        self.suffixes = order
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        left = text[order - 1]
        self.levels: list[tuple[int, Bits]] = []
        for shift in reversed(range(max(1, int(symbols - 1).bit_length()))):
            bit = ((left >> shift) & 1).astype(np.uint8)
            self.levels.append((shift, Bits(bit)))
            left = np.concatenate([left[bit == 0], left[bit == 1]])
        every = np.arange(symbols)
        self.shift = self.first[:-1] - self._walk(every, np.zeros(symbols, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> shift) & 1, bits.zeros + ones, at - ones)
        return at

    def start(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows (from, to) of patterns of one symbol."""
        return self.first[symbol], self.first[symbol + 1]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of the patterns with a symbol put before each."""
        shift = self.shift[symbol]
        return shift + self._walk(symbol, low), shift + self._walk(symbol, high)


def matching_statistics(index: FmIndex, text: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each end (last place of a pattern in text): how far back, up to ``most``, the text also occurs elsewhere in
    the index, and the rows (from, to) of that match. The text is part of the index, so a match of one row is its own."""
    length = np.zeros(len(ends), np.int64)
    low, high = index.start(text[ends])
    live = np.flatnonzero(high - low > 1)
    length[live] = 1
    for back in range(1, most):
        live = live[text[ends[live] - back] > 0]
        lo, hi = index.extend(text[ends[live] - back], low[live], high[live])
        more = hi - lo > 1
        live = live[more]
        low[live], high[live], length[live] = lo[more], hi[more], back + 1
        if not len(live):
            break
    return length, low, high
