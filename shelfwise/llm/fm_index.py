"""A compressed full-text index over sequences of words: BWT in a wavelet matrix.

The sequences of one shard are joined with separators and their suffixes sorted to a depth beyond
the longest pattern. What is kept: the BWT as one bit vector per binary digit of the symbols, with
counts every 64 bits, and for each suffix the class of suffixes that share its first ``threshold``
words. Patterns are matched backward, many at a time: one step prepends one word to every pattern
by two rank queries in the wavelet matrix.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), dtype=np.uint32)
        np.cumsum(np.bitwise_count(self.words)[:-1], out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class WaveletMatrix:
    """Symbols of 0 to ``size`` - 1 with rank: one bit vector per binary digit, highest first."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.digits = max(1, int(size - 1).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for digit in range(self.digits - 1, -1, -1):
            bits = ((symbols >> digit) & 1).astype(np.uint8)
            self.levels.append((Bits(bits), int(len(bits) - bits.sum())))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])
        # Where the run of each symbol starts below the last level.
        counts = np.bincount(symbols, minlength=size)
        order = np.zeros(size, dtype=np.int64)
        reverse = np.zeros(size, dtype=np.int64)
        for digit in range(self.digits):
            reverse |= ((np.arange(size) >> digit) & 1) << (self.digits - 1 - digit)
        by_reverse = np.argsort(reverse)
        order[by_reverse] = np.concatenate([[0], np.cumsum(counts[by_reverse])[:-1]])
        self.run_start = order

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before its place."""
        place = at.astype(np.int64)
        for digit, (bits, zeros) in zip(range(self.digits - 1, -1, -1), self.levels):
            ones = bits.rank(place).astype(np.int64)
            place = np.where((symbols >> digit) & 1, zeros + ones, place - ones)
        return place - self.run_start[symbols]


class FMIndex:
    """The index of one shard.

    ``words`` holds 64-bit codes of the words of all sequences, ``starts`` where each begins (and
    the end), ``owners`` a number per sequence. No sequence or pattern may exceed ``DEPTH`` words.
    """

    DEPTH = 128

    def __init__(self, words: np.ndarray, starts: np.ndarray, owners: np.ndarray, threshold: int):
        lengths = np.diff(starts)
        if len(lengths) and lengths.max() >= self.DEPTH:
            raise ValueError(f"sequences must be shorter than {self.DEPTH} words")
        self.threshold = threshold
        self.codes, dense = np.unique(words, return_inverse=True)
        # Symbol 0 closes every sequence.
        owner_of = np.repeat(np.arange(len(lengths)), lengths)
        symbols = np.zeros(len(words) + len(lengths), dtype=np.int64)
        symbols[np.arange(len(words)) + owner_of] = dense.reshape(-1) + 1
        owner_of = np.repeat(np.arange(len(lengths)), lengths + 1)
        order, classes = self._sorted(symbols)
        self.size = len(self.codes) + 1
        self.n = len(symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=self.size))])[:-1]
        self.bwt = WaveletMatrix(symbols[order - 1], self.size)
        # The smallest owner among the suffixes of each class.
        first = np.flatnonzero(np.diff(classes, prepend=-1))
        self.class_of = classes.astype(np.int32)
        self.least = np.minimum.reduceat(owners[owner_of[order]], first) if self.n else owners[:0]

    def _sorted(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix order to ``DEPTH`` words by doubling, and classes by the first ``threshold``."""
        n = len(symbols)
        rank, depth, kept = symbols, 1, None
        while True:
            if depth <= self.threshold < 2 * depth:
                kept = rank, depth
            if depth >= self.DEPTH:
                break
            after = np.full(n, -1, dtype=np.int64)
            after[: max(n - depth, 0)] = rank[depth:]
            pair = rank * (n + 2) + after + 1
            order = np.argsort(pair)
            ordered = pair[order]
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.cumsum(np.diff(ordered, prepend=ordered[:1]) != 0)
            depth *= 2
        # Two overlapping stretches of ``depth`` words make the first ``threshold`` words.
        rank, depth = kept
        shifted = np.full(n, -1, dtype=np.int64)
        step = self.threshold - depth
        shifted[: max(n - step, 0)] = rank[step:]
        a, b = rank[order], shifted[order]
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return order, np.cumsum(fresh) - 1

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """Symbols of word codes; 0 for words that the index does not hold."""
        if not len(self.codes):
            return np.zeros(len(words), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.codes, words), len(self.codes) - 1)
        return np.where(self.codes[at] == words, at + 1, 0)

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prepend a symbol to each pattern: its new interval of suffixes."""
        both = self.bwt.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        start = self.before[symbol]
        return start + both[: len(symbol)], start + both[len(symbol) :]

    def matching_statistics(
        self, words: np.ndarray, starts: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """For each word of the streamed texts, how many words from there on the index holds in a
        row (``threshold`` standing for any more), and the least owner that holds the first
        ``threshold`` of them (-1 where fewer match).

        Texts are read from their ends, in step. Where a word cannot be prepended, the match gives
        up its last word and is tried again.
        """
        symbols = self.symbols(words)
        length = np.zeros(len(words), dtype=np.int32)
        least = np.full(len(words), -1, dtype=np.int64)
        begin, end = starts[:-1].astype(np.int64), starts[1:].astype(np.int64)
        at, stop = end - 1, end.copy()  # next word to prepend, end of the match
        done = end.copy()  # words from here on have their answer
        low, high = np.zeros(len(begin), dtype=np.int64), np.full(len(begin), self.n)
        live = np.flatnonzero(at >= begin)
        while len(live):
            here = at[live]
            symbol = symbols[here]
            new_low, new_high = self.step(symbol, low[live], high[live])
            good = (symbol > 0) & (new_low < new_high)
            hit = live[good]
            low[hit], high[hit] = new_low[good], new_high[good]
            fresh = at[hit] < done[hit]
            at_fresh, row = at[hit][fresh], hit[fresh]
            matched = stop[row] - at_fresh
            length[at_fresh] = np.minimum(matched, self.threshold)
            long = matched >= self.threshold
            least[at_fresh[long]] = self.least[self.class_of[low[row[long]]]]
            done[row] = at_fresh
            at[hit] -= 1
            miss = live[~good]
            alone = stop[miss] - 1 <= at[miss]
            nothing = miss[alone]  # not even one word: it is answered with 0
            done[nothing] = np.minimum(done[nothing], at[nothing])
            stop[nothing] = at[nothing]
            at[nothing] -= 1
            again = miss[~alone]
            stop[again] -= 1
            at[again] = stop[again] - 1
            # Nearly longer than the index tells apart: go on with a shorter match.
            full = hit[stop[hit] - at[hit] > self.DEPTH]
            stop[full] = at[full] + 1 + self.threshold
            at[full] = stop[full] - 1
            afresh = np.concatenate([miss, full])
            low[afresh], high[afresh] = 0, self.n
            live = live[at[live] >= begin[live]]
        return length, least
