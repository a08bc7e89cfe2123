"""A compressed FM-index over word symbols, for one shard (numpy, inside a task).

The Burrows-Wheeler transform is held as a wavelet tree in matrix form: one packed
bit vector and one rank directory a level. A backward step asks it twice for a
rank. Patterns are short, so suffixes are sorted by their first 16 symbols only;
ranks over that order are exact for patterns of up to 16 symbols.
"""

from __future__ import annotations

import numpy as np

#: Suffixes are told apart by this many symbols; no pattern may be longer.
CONTEXT = 16


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, bits: int):
        self.n, self.levels = len(symbols), []
        rest = symbols
        for level in range(bits - 1, -1, -1):
            bit = ((rest >> level) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.pad(packed, (0, 8 - len(packed) % 8 + 8)).view("<u8")
            before = np.zeros(len(packed) + 1, np.int64)
            np.cumsum(np.bitwise_count(packed), out=before[1:])
            zeros = self.n - int(bit.sum())
            self.levels.append((level, packed, before, zeros))
            rest = np.concatenate([rest[~bit], rest[bit]])

    def place(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where position ``i`` of a symbol's path ends; differences are ranks."""
        for level, packed, before, zeros in self.levels:
            word, bit = i >> 6, (i & 63).astype(np.uint64)
            ones = before[word] + np.bitwise_count(packed[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            i = np.where((symbol >> level) & 1, zeros + ones, i - ones)
        return i


class FMIndex:
    """Over texts of symbols 1..sigma; 0 parts the texts and never occurs in a pattern."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, threshold: int):
        if not 2 <= threshold <= CONTEXT:
            raise ValueError(f"threshold must be 2 to {CONTEXT}")
        self.threshold = threshold
        n = len(symbols) + len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        text[inside] = symbols
        owner = np.repeat(np.arange(len(lengths)), lengths + 1)
        order, ranks = self._suffix_order(text)
        self.owner = owner[order]
        bwt = text[order - 1]
        sigma = int(text.max(initial=0))
        self.tree = WaveletMatrix(bwt, max(1, sigma.bit_length()))
        self.below = np.zeros(sigma + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=sigma + 1), out=self.below[1:])
        every = np.arange(sigma + 1)
        self.base = self.tree.place(every, np.zeros(sigma + 1, np.int64))
        self._parents(order, ranks)

    @staticmethod
    def _suffix_order(text: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Prefix doubling up to CONTEXT symbols; the ranks by 1, 2, 4 and 8 symbols too."""
        rank, width, ranks, order = text, 1, {1: text}, np.argsort(text, kind="stable")
        while width < CONTEXT:
            key = rank * (int(rank.max(initial=0)) + 2)
            key[: len(text) - width] += rank[width:] + 1
            order = np.argsort(key, kind="stable")
            held = key[order]
            new = np.zeros(len(text), np.int64)
            new[order[1:]] = np.cumsum(held[1:] != held[:-1])
            rank, width = new, 2 * width
            ranks[width] = rank
        return order, ranks

    def _parents(self, order: np.ndarray, ranks: dict[int, np.ndarray]) -> None:
        """For each row, the interval that shares its first ``threshold - 1`` symbols."""
        width, at = self.threshold - 1, 0
        new = np.zeros(len(order), bool)
        new[:1] = True
        for power in (8, 4, 2, 1):
            if width & power:
                padded = np.concatenate([ranks[power], np.full(CONTEXT, -1)])
                held = padded[order + at]
                new[1:] |= held[1:] != held[:-1]
                at += power
        first = np.flatnonzero(new)
        block = np.cumsum(new) - 1
        self.parent_start = first[block]
        self.parent_end = np.append(first[1:], len(order))[block]

    def step(self, symbol: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with ``symbol`` put before them."""
        base = self.base[symbol]
        low = self.below[symbol] - base
        return low + self.tree.place(symbol, start), low + self.tree.place(symbol, end)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search for a matrix of patterns, one a row; empty intervals have start >= end."""
        start = np.zeros(len(patterns), np.int64)
        end = np.full(len(patterns), len(self.owner), np.int64)
        for column in range(patterns.shape[1] - 1, -1, -1):
            start, end = self.step(patterns[:, column], start, end)
        return start, end

    def matching_statistics(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of each window of ``threshold`` symbols in streamed texts.

        A text is read from its end. The interval of one window is widened to its
        parent, which forgets the last symbol, and one backward step gives the
        next; where a window was not found, the next is searched from anew.
        Returns starts and ends, window by window in the order of the texts.
        """
        k = self.threshold
        windows = np.maximum(lengths - k + 1, 0)
        offset = np.cumsum(windows) - windows
        first = np.cumsum(lengths) - lengths
        out_start = np.zeros(int(windows.sum()), np.int64)
        out_end = np.zeros(len(out_start), np.int64)
        span = np.arange(k)
        alive = np.flatnonzero(windows)
        at = windows[alive] - 1
        start, end = self.search(symbols[(first[alive] + at)[:, None] + span]) if len(alive) else (np.empty(0, np.int64),) * 2
        while len(alive):
            out_start[offset[alive] + at], out_end[offset[alive] + at] = start, end
            more = at > 0
            alive, at, start, end = alive[more], at[more] - 1, start[more], end[more]
            found = start < end
            row = np.where(found, start, 0)
            start, end = self.step(symbols[first[alive] + at], self.parent_start[row], self.parent_end[row])
            if len(lost := np.flatnonzero(~found)):
                start[lost], end[lost] = self.search(symbols[(first[alive[lost]] + at[lost])[:, None] + span])
        return out_start, out_end

    def least_owner(self, start: np.ndarray, end: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The least ``value`` of the texts in each interval; intervals are equal or disjoint, none is empty."""
        if not len(start):
            return np.empty(0, value.dtype)
        low, back = np.unique(start, return_inverse=True)
        high = np.zeros(len(low), np.int64)
        high[back] = end
        held = np.append(value[self.owner], np.iinfo(np.int64).max)
        return np.minimum.reduceat(held, np.column_stack([low, high]).ravel())[::2][back]
