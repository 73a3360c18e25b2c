"""FM-index over a sequence of small integers: wavelet-matrix ranks, backward search, sampled positions.

Everything is vectorised over the patterns, so a batch of patterns costs one pass of array operations for
each symbol and bit level.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; symbol 0 separates, and each separator sorts as a symbol of its own."""
    n = len(symbols)
    rank = symbols.astype(np.int64)
    gaps = np.flatnonzero(symbols == 0)
    rank += len(gaps)
    rank[gaps] = np.arange(len(gaps))
    k = 1
    while True:
        key = rank * (int(rank.max()) + 2)
        key[:n - k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        key = key[order]
        new[order] = np.cumsum(np.r_[0, key[1:] != key[:-1]])
        if int(new[order[-1]]) == n - 1:
            return order
        rank, k = new, 2 * k


class _Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class FMIndex:
    """Index of ``symbols`` (values 0 .. ``top``; 0 separates and is never searched for)."""

    def __init__(self, symbols: np.ndarray, top: int, every: int = 16) -> None:
        sa = suffix_array(symbols)
        bwt = symbols[sa - 1]  # the last symbol must be a separator, which precedes the first one
        counts = np.bincount(symbols, minlength=top + 2)
        self.first = np.r_[0, np.cumsum(counts)]  # rows that start with a smaller symbol
        self.levels = []
        seq = bwt
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            b = ((seq >> bit) & 1).astype(np.uint8)
            self.levels.append((bit, _Bits(b), int(len(b) - b.sum())))
            seq = np.concatenate([seq[b == 0], seq[b == 1]])
        # positions are kept for every ``every``-th symbol and wherever a separator precedes
        kept = (sa % every == 0) | (bwt == 0)
        self.kept, self.positions = _Bits(kept), sa[kept]

    def _rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Times that symbol c stands before row i of the transform."""
        lo = np.zeros_like(i)
        for bit, bits, zeros in self.levels:
            one = ((c >> bit) & 1).astype(bool)
            a, b = bits.rank(lo), bits.rank(i)
            lo, i = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, i - b)
        return i - lo

    def _symbol(self, i: np.ndarray) -> np.ndarray:
        c = np.zeros_like(i)
        for _, bits, zeros in self.levels:
            one, ones = bits.get(i).astype(bool), bits.rank(i)
            c = (c << 1) | one
            i = np.where(one, zeros + ones, i - ones)
        return c

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of equally long patterns, one a row of the matrix, by backward search."""
        c = patterns[:, -1]
        lo, hi = self.first[c], self.first[c + 1]
        live = np.arange(len(patterns))
        for k in range(patterns.shape[1] - 2, -1, -1):
            live = live[hi[live] > lo[live]]
            c = patterns[live, k]
            lo[live] = self.first[c] + self._rank(c, lo[live])
            hi[live] = self.first[c] + self._rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of rows: step back to a row with a kept position."""
        out = np.empty(len(rows), np.int64)
        at, i, steps = np.arange(len(rows)), rows, 0
        while len(at):
            kept = self.kept.get(i).astype(bool)
            out[at[kept]] = self.positions[self.kept.rank(i[kept])] + steps
            at, i = at[~kept], i[~kept]
            c = self._symbol(i)
            i = self.first[c] + self._rank(c, i)
            steps += 1
        return out
