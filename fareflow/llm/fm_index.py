"""A compressed full-text index of word sequences: an FM-index over a wavelet matrix.

Sequences of word numbers lie one after another, each closed by the number 0. The suffixes are sorted by
their first ``depth`` words, which is all that searches for patterns of up to ``depth`` words need; the column before
the sorted suffixes is kept in a wavelet matrix, one packed bit vector for each bit of a word number.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A packed bit vector; how many ones lie before a position."""

    def __init__(self, bits: np.ndarray) -> None:
        raw = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(raw)] = raw
        self.before = np.append(0, np.cumsum(np.bitwise_count(self.words)))[:-1].astype(np.int64)

    def ones(self, upto: np.ndarray) -> np.ndarray:
        word, bit = upto >> 6, (upto & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))


class WaveletMatrix:
    """How often a number occurs before a position of a sequence of numbers below ``width``."""

    def __init__(self, numbers: np.ndarray, width: int) -> None:
        self.levels: list[tuple[Bits, int]] = []
        self.shifts = range(max(1, int(width - 1).bit_length()) - 1, -1, -1)
        own, first = numbers, np.arange(width)
        starts = np.zeros(width, np.int64)
        for shift in self.shifts:
            bits = (own >> shift) & 1 == 1
            level = Bits(bits)
            zeros = int(len(own) - bits.sum())
            self.levels.append((level, zeros))
            ones = level.ones(starts)
            starts = np.where((first >> shift) & 1 == 1, zeros + ones, starts - ones)
            own = np.concatenate([own[~bits], own[bits]])
        #: Where a number's occurrences start once all levels have moved them together.
        self.starts = starts

    def rank(self, numbers: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Occurrences of each number before each position."""
        at = upto
        for (level, zeros), shift in zip(self.levels, self.shifts, strict=True):
            ones = level.ones(at)
            at = np.where((numbers >> shift) & 1 == 1, zeros + ones, at - ones)
        return at - self.starts[numbers]


class FMIndex:
    """Sequences of word numbers (1 and up), each followed by 0; patterns have up to ``depth`` words."""

    def __init__(self, text: np.ndarray, depth: int) -> None:
        self.depth, n = depth, len(text)
        width = int(text.max(initial=0)) + 1
        order, rank, span = np.argsort(text, kind="stable"), text.astype(np.int64), 1
        while span < depth:
            # Ranks by the first words, doubled; the text is a ring.
            key = rank * (n + 1) + np.roll(rank, -span)
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1]))
            span *= 2
        #: Text position of each sorted suffix.
        self.places = order
        self.before = WaveletMatrix(np.roll(text, 1)[order], width)
        self.starts = np.append(0, np.cumsum(np.bincount(text, minlength=width)))
        #: First words that a sorted suffix shares with the one before it, ``depth`` at most.
        self.shared = np.zeros(n, np.int8)
        same = np.ones(max(n - 1, 0), bool)
        for k in range(depth):
            there = np.roll(text, -k)[order]
            same &= there[1:] == there[:-1]
            self.shared[1:] += same
        self.edges: dict[int, np.ndarray] = {}

    def extended(self, words: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: from the rows first … last - 1 of some patterns to those of a word and the pattern."""
        base = self.starts[words]
        return base + self.before.rank(words, first), base + self.before.rank(words, last)

    def within(self, row: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows around a row that agree with it in their first ``length`` words."""
        if length not in self.edges:
            inner = np.flatnonzero(self.shared[1:] < length) + 1
            self.edges[length] = np.concatenate([[0], inner, [len(self.shared)]])
        at = np.searchsorted(self.edges[length], row, side="right")
        return self.edges[length][at - 1], self.edges[length][at]

    def matching(self, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of streamed sequences, cut at ``depth`` words, from the right end to the left.

        ``text``: the sequences' word numbers; 0 for a word the index does not know. Gives each place where a match of
        ``depth`` words starts, and the first and last row + 1 of its occurrences. A match that the word before it cannot
        extend loses words on its right until it can.
        """
        found: list[tuple[np.ndarray, ...]] = []
        live = np.flatnonzero(sizes > 0)
        at = starts[live] + sizes[live] - 1
        first, last = np.zeros(len(live), np.int64), np.full(len(live), len(self.places))
        length = np.zeros(len(live), np.int64)
        while len(live):
            words = text[at]
            open_ = np.arange(len(live))
            cut = np.flatnonzero(length == self.depth)
            while True:
                for n in np.unique(length[cut]).tolist():
                    own = cut[length[cut] == n]
                    first[own], last[own] = self.within(first[own], n - 1)
                length[cut] -= 1
                a, b = self.extended(words[open_], first[open_], last[open_])
                fits = (a < b) & (words[open_] > 0)
                done = open_[fits]
                first[done], last[done] = a[fits], b[fits]
                length[done] += 1
                open_ = open_[~fits]
                open_ = cut = open_[length[open_] > 0]
                if not len(open_):
                    break
            hit = length == self.depth
            found.append((at[hit], first[hit], last[hit]))
            more = at > starts[live]
            live, at, first, last, length = live[more], at[more] - 1, first[more], last[more], length[more]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3
