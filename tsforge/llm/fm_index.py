"""An FM-index over whole numbers: wavelet-matrix ranks, backward search, sampled suffix positions.

The text is a sequence of runs of symbols 1, 2, ...; each run is closed by a separator of its
own, so suffixes never compare beyond their run. All queries are arrays: one step serves all
phrases, or all occurrences, at once.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """Packed bits with counts of ones per 64-bit word."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & low)

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class Wavelet:
    """Ranks of symbols by one level of packed bits for each binary digit."""

    def __init__(self, symbols: np.ndarray, size: int) -> None:
        self.levels: list[tuple[int, Bits, int]] = []
        start = np.zeros(size, np.int64)
        every = np.arange(size)
        for digit in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            ones = (symbols >> digit) & 1 == 1
            level, zeros = Bits(ones), int(len(symbols) - ones.sum())
            start = np.where((every >> digit) & 1 == 1, zeros + level.rank(start), start - level.rank(start))
            self.levels.append((digit, level, zeros))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self.start = start  # where a symbol's own stretch begins on the last level

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``i``."""
        for digit, level, zeros in self.levels:
            ones = level.rank(i)
            i = np.where((symbol >> digit) & 1 == 1, zeros + ones, i - ones)
        return i - self.start[symbol]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at ``i`` and its rank there."""
        symbol = np.zeros(len(i), np.int64)
        for digit, level, zeros in self.levels:
            one, ones = level.at(i), level.rank(i)
            symbol |= one.astype(np.int64) << digit
            i = np.where(one, zeros + ones, i - ones)
        return symbol, i - self.start[symbol]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; zeros are separators, each smaller than the next and than all symbols."""
    n = len(text)
    gaps = text == 0
    rank = np.where(gaps, np.cumsum(gaps), text + int(gaps.sum()))
    _, rank = np.unique(rank, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    width = 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: n - width] = rank[width:] if width < n else 0
        key = rank * (n + 1) + ahead
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.r_[True, key[1:] != key[:-1]]
        rank[order] = np.cumsum(new)
        if new.all():
            return order
        width *= 2


class FMIndex:
    """Where phrases occur in ``text``: symbols from 1 up, zeros closing each run."""

    def __init__(self, text: np.ndarray, sample: int = 8) -> None:
        self.size = len(text)
        order = suffix_array(text)
        before = text[order - 1]
        before[order == 0] = 0
        symbols = int(text.max(initial=0)) + 1
        self.wavelet = Wavelet(before, symbols)
        self.first = np.zeros(symbols + 1, np.int64)  # rows of suffixes that begin with a smaller symbol
        np.cumsum(np.bincount(text, minlength=symbols), out=self.first[1:])
        kept = (order % sample == 0) | (before == 0)  # run starts, so a walk never crosses a separator
        self.sampled, self.samples = Bits(kept), order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of each phrase, a row of symbols right-aligned after zeros; 0, 0 if it is nowhere."""
        n, width = phrases.shape
        low = np.zeros(n, np.int64)
        high = np.where((phrases < len(self.first) - 1).all(axis=1), self.size, 0)
        for j in range(width - 1, -1, -1):
            live = np.flatnonzero((phrases[:, j] > 0) & (high > low))
            symbol = phrases[live, j]
            low[live] = self.first[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.wavelet.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by walking back to the nearest sampled one."""
        found = np.zeros(len(rows), np.int64)
        left, walked = np.arange(len(rows)), 0
        while len(left):
            done = self.sampled.at(rows)
            found[left[done]] = self.samples[self.sampled.rank(rows[done])] + walked
            left, rows, walked = left[~done], rows[~done], walked + 1
            symbol, rank = self.wavelet.access(rows)
            rows = self.first[symbol] + rank
        return found
