"""An FM-index over a sequence of numbers, in numpy: many patterns are searched at once."""

from __future__ import annotations

import numpy as np

# Every so many positions are kept; a walk to a kept one takes fewer steps.
SAMPLE = 16


class _Bits:
    """A bit array with the count of ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, bool)
        padded[: len(bits)] = bits
        self._words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self._words).astype(np.int64)
        self._before = np.concatenate([[0], np.cumsum(counts)])[:-1]

    def ones_before(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self._words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self._before[word] + np.bitwise_count(below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self._words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletTree:
    """Ranks of symbols in a sequence, one bit array per binary digit of the symbols."""

    def __init__(self, symbols: np.ndarray, digits: int):
        self._levels = []
        for shift in reversed(range(digits)):
            bits = (symbols >> shift) & 1 == 1
            self._levels.append((shift, _Bits(bits), int((~bits).sum())))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self._levels:
            ones = bits.ones_before(at)
            at = np.where((symbol >> shift) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often the symbol occurs before the place."""
        return self._down(symbol, at) - self._down(symbol, np.zeros_like(at))

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for shift, bits, zeros in self._levels:
            one, ones = bits.get(at), bits.ones_before(at)
            symbol |= one.astype(at.dtype) << shift
            at = np.where(one, zeros + ones, at - ones)
        return symbol


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by prefix doubling; 0s are all different."""
    n = len(symbols)
    breaks = symbols == 0
    rank = symbols.astype(np.int64) + int(breaks.sum())
    rank[breaks] = np.arange(int(breaks.sum()))
    step = 0
    while True:
        key = rank
        if step:
            key = rank * (n + 2)
            key[:-step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step = step * 2 or 1


class FmIndex:
    """Occurrences of patterns in a sequence of symbols 1..n; 0 is a break that none crosses.

    The sequence must end with a break.
    """

    def __init__(self, symbols: np.ndarray, largest: int):
        symbols = symbols.astype(np.int64)
        order = suffix_order(symbols)
        last = symbols[order - 1]  # what stands before each suffix; a break before the first
        self._tree = WaveletTree(last, max(1, int(largest).bit_length()))
        self._smaller = np.concatenate(
            [[0], np.cumsum(np.bincount(symbols, minlength=largest + 1))]
        )
        # A walk to the left ends at a break at the latest, so what follows one is kept.
        kept = (order % SAMPLE == 0) | (last == 0)
        self._kept, self._positions, self._size = _Bits(kept), order[kept], len(symbols)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last row of each pattern's suffixes; patterns are aligned to the right."""
        first = np.zeros(len(patterns), np.int64)
        last = np.full(len(patterns), self._size)
        open_ = np.arange(len(patterns))
        for back in range(1, patterns.shape[1] + 1):
            open_ = open_[(lengths[open_] >= back) & (first[open_] < last[open_])]
            if not len(open_):
                break
            symbol = patterns[open_, -back].astype(np.int64)
            for bound in (first, last):
                bound[open_] = self._smaller[symbol] + self._tree.rank(symbol, bound[open_])
        return first, last

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in these rows, by steps to the left up to a kept one."""
        rows, found = rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        steps = 0
        while len(open_):
            at = rows[open_]
            kept = self._kept.get(at)
            done = open_[kept]
            found[done] = self._positions[self._kept.ones_before(at[kept])] + steps
            open_, at = open_[~kept], at[~kept]
            symbol = self._tree.access(at)
            rows[open_] = self._smaller[symbol] + self._tree.rank(symbol, at)
            steps += 1
        return found
