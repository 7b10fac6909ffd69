"""FM-index over a collection of symbol sequences: backward search through wavelet-matrix ranks.

Symbol 0 ends a sequence. Each 0 counts as a symbol of its own, ordered by position, so suffixes differ at
their first 0 at the latest and sorting never looks past it.
"""

from __future__ import annotations

import numpy as np

from .wavelet import WaveletMatrix


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order. The text must end with 0.

    Prefix doubling; from round to round only groups of suffixes that are still equal are sorted again.
    """
    n = len(text)
    order = np.argsort(text, kind="stable")
    place = np.arange(n)
    ends = int(np.count_nonzero(text == 0))
    ordered = text[order]
    first = np.empty(n, bool)
    first[:1] = True
    first[1:] = ordered[1:] != ordered[:-1]
    first[:ends] = True
    group = np.maximum.accumulate(np.where(first, place, 0))
    rank = np.empty(n, np.int64)
    rank[order] = group
    single = first & np.append(first[1:], True)
    open_ = order[~single]
    step = 1
    while len(open_):
        old, key = rank[open_], rank[open_] * n + rank[open_ + step]
        by = np.argsort(key, kind="stable")
        open_, old, key = open_[by], old[by], key[by]
        m = np.arange(len(open_))
        old_first = np.append(True, old[1:] != old[:-1])
        new_first = np.append(True, key[1:] != key[:-1])
        old_start = np.maximum.accumulate(np.where(old_first, m, 0))
        new_start = np.maximum.accumulate(np.where(new_first, m, 0))
        order[old + m - old_start] = open_
        rank[open_] = old + new_start - old_start
        open_ = open_[~(new_first & np.append(new_first[1:], True))]
        step *= 2
    return order


class FMIndex:
    """Counts and locates phrases of symbols above 0."""

    def __init__(self, text: np.ndarray, symbols: int, every: int = 16):
        """text: integers below symbols, the last of them 0. Every every-th text position is kept to locate by."""
        order = suffix_array(text)
        before = text[order - 1]
        self.bwt = WaveletMatrix.build(before.astype(np.uint32), max(1, int(symbols - 1).bit_length()))
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))
        self.sampled = (order % every == 0) | (before == 0)
        self.samples = order[self.sampled]
        self.sample_at = np.cumsum(self.sampled) - 1

    def ranges(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each phrase; phrases is a matrix, a phrase a row."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.starts[-1])
        live = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[live, column]
            ranks = self.bwt.rank(np.concatenate((symbol, symbol)), np.concatenate((low[live], high[live])))
            low[live] = self.starts[symbol] + ranks[: len(live)]
            high[live] = self.starts[symbol] + ranks[len(live) :]
            live = live[high[live] > low[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step back until a sampled row, then add the steps."""
        rows = np.array(rows, np.int64)
        out, steps, left = np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        while len(left):
            found = self.sampled[rows[left]]
            out[left[found]] = self.samples[self.sample_at[rows[left[found]]]] + steps
            left = left[~found]
            symbol = self.bwt.access(rows[left])
            rows[left] = self.starts[symbol] + self.bwt.rank(symbol, rows[left])
            steps += 1
        return out
