"""A full-text index of one shard of word symbols.

Symbols are words of the test phrases (1..sigma); 0 separates runs of them.  Every
separator counts as different, so suffixes compare within their run only.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Prefix doubling; separators rank below all symbols, by position."""
    n = len(text)
    rank = np.zeros(n + 1, np.int64)
    gaps = text == 0
    m = int(gaps.sum())
    rank[:n][gaps] = np.arange(1, m + 1)
    rank[:n][~gaps] = text[~gaps].astype(np.int64) + m
    step = 1
    while True:
        later = np.zeros(n, np.int64)
        if step < n:
            later[: n - step] = rank[step:n]
        later[gaps] = 0  # a separator is unique: nothing after it matters
        key = rank[:n] * (2 * n + int(text.max(initial=0)) + 2) + later
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.ones(n, np.int64)
        new[1:] += np.cumsum(key[1:] != key[:-1])
        rank[order] = new
        if n == 0 or new[-1] == n:
            return order
        step *= 2


class WaveletMatrix:
    """rank(c, i): how often c stands before position i, for arrays of c and i."""

    def __init__(self, values: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(self.bits - 1, -1, -1):
            bit = (values >> level) & 1
            ones = np.zeros(len(values) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(values) - int(ones[-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        low = np.zeros(len(c), np.int64)
        i = i.astype(np.int64)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = (c >> (self.bits - 1 - level)) & 1 == 1
            up, down = ones[i], ones[low]
            i = np.where(bit, zeros + up, i - up)
            low = np.where(bit, zeros + down, low - down)
        return i - low


class FMIndex:
    def __init__(self, text: np.ndarray, sigma: int):
        n = len(text)
        rows = suffix_array(text)
        before = text[rows - 1]
        before[rows == 0] = 0
        self.bwt = before
        self.tree = WaveletMatrix(before, sigma)
        counts = np.bincount(text, minlength=sigma + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        # every SAMPLE-th position, and each start of a run: no step goes back over a separator
        self.sampled = np.where((rows % SAMPLE == 0) | (before == 0), rows, -1)
        self.n = n

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row interval of each phrase; phrases are rows of symbols, right-aligned."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        width = phrases.shape[1]
        alive = np.arange(len(phrases))
        for back in range(width):
            alive = alive[(back < lengths[alive]) & (low[alive] < high[alive])]
            if not len(alive):
                break
            c = phrases[alive, width - 1 - back]
            low[alive] = self.first[c] + self.tree.rank(c, low[alive])
            high[alive] = self.first[c] + self.tree.rank(c, high[alive])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, walking back to the nearest sampled one."""
        place = np.zeros(len(rows), np.int64)
        steps = np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        rows = rows.copy()
        while len(open_):
            known = self.sampled[rows[open_]]
            done = known >= 0
            place[open_[done]] = known[done] + steps[open_[done]]
            open_ = open_[~done]
            c = self.bwt[rows[open_]]
            rows[open_] = self.first[c] + self.tree.rank(c, rows[open_])
            steps[open_] += 1
        return place
