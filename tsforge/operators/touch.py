"""Questions about stretches of an ordered array, answered for all rows at once in logarithmic steps.

First touches by sparse tables of maxima over powers of two, order statistics by a wavelet matrix of
ranks, chains by pointer doubling.
"""

from __future__ import annotations

import numpy as np


class Maxima:
    """Maxima of any stretch of an array; NaN counts as never high enough."""

    def __init__(self, values: np.ndarray) -> None:
        first = np.where(np.isnan(values), -np.inf, values.astype(float))
        self.size, self.levels = len(first), [first]
        while 2 << (len(self.levels) - 1) <= self.size:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.maximum(last[:-half], last[half:]))

    def first_at_least(self, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The first place from ``start`` on whose value is at least ``bound``; the length if there is none."""
        at = np.minimum(start, self.size).astype(np.int64)
        bound = np.where(np.isnan(bound), np.inf, bound)
        for k in range(len(self.levels) - 1, -1, -1):
            fits = at + (1 << k) <= self.size
            below = fits & (self.levels[k][np.where(fits, at, 0)] < bound) if len(self.levels[k]) else fits
            at[below] += 1 << k
        return at

    def over(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Maximum of [low, high); -inf where that is empty."""
        out = np.full(len(low), -np.inf)
        size = high - low
        level = np.frexp(np.maximum(size, 1).astype(float))[1] - 1
        for k in np.unique(level[size > 0]):
            own = (level == k) & (size > 0)
            out[own] = np.maximum(self.levels[k][low[own]], self.levels[k][high[own] - (1 << k)])
        return out


def first_at_most(minima: Maxima, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """As :meth:`Maxima.first_at_least` over the negated array: the first value not above ``bound``."""
    return minima.first_at_least(start, -bound)


def reached(start: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Which places a chain meets: from ``start`` on along ``following`` (the length ends it), by pointer doubling."""
    n = len(following)
    seen = np.zeros(n + 1, bool)
    seen[start] = True
    step = np.r_[following, n]
    for _ in range(max(1, n.bit_length())):
        seen[step[seen]] = True
        step = step[step]
    return seen[:n]


def last_of_chain(following: np.ndarray) -> np.ndarray:
    """The last place of the chain from each place, by pointer doubling."""
    n = len(following)
    step = np.where(following < n, following, np.arange(n))
    for _ in range(max(1, n.bit_length())):
        step = step[step]
    return step


class OrderStatistics:
    """The k-th smallest value of any stretch of an array without NaN, by one level per binary digit of its ranks."""

    def __init__(self, values: np.ndarray) -> None:
        order = np.argsort(values, kind="stable")
        self.sorted = values[order]
        ranks = np.empty(len(values), np.int32)
        ranks[order] = np.arange(len(values), dtype=np.int32)
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for digit in range(max(1, (len(values) - 1).bit_length()) - 1, -1, -1):
            zero = (ranks >> digit) & 1 == 0
            before = np.zeros(len(ranks) + 1, np.int32)
            np.cumsum(zero, out=before[1:])
            self.levels.append((digit, before, int(before[-1])))
            ranks = np.concatenate([ranks[zero], ranks[~zero]])

    def kth(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Value number ``k`` from 0 of each sorted stretch [low, high); 0 <= k < high - low."""
        rank = np.zeros(len(low), np.int64)
        for digit, before, zeros in self.levels:
            a, b = before[low], before[high]
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            low, high = np.where(one, zeros + low - a, a), np.where(one, zeros + high - b, b)
            rank |= one.astype(np.int64) << digit
        return self.sorted[rank]

    def quantile(self, low: np.ndarray, high: np.ndarray, q: float) -> np.ndarray:
        """The linearly interpolated quantile of each stretch; stretches must not be empty."""
        at = q * (high - low - 1)
        whole = np.floor(at).astype(np.int64)
        part = at - whole
        near = self.kth(low, high, whole)
        return near + (self.kth(low, high, np.minimum(whole + 1, high - low - 1)) - near) * part
