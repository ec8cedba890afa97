"""A compressed full-text index of word sequences: suffix order, Burrows-Wheeler transform, wavelet matrix, backward search.

Texts are sequences of symbols from 1 on, each ended by a 0. Suffixes are sorted as far as the longest question needs
(``depth`` symbols), which is enough for backward search of that length. The transform is kept as a wavelet matrix: one row of
packed bits for each bit of a symbol, with a running count for every 64 of them, so the index takes about
``1.5 * bits per symbol`` bits for each symbol. All questions are asked together, one numpy step for each word and bit.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """Packed bits that count the ones before any place."""

    def __init__(self, values: np.ndarray):
        padded = np.zeros((len(values) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(values)] = values
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.uint32 if len(values) < 2**32 else np.int64)
        self.zeros = int(len(values) - counts.sum())

    def ones(self, places: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block = places >> 6
        low = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block].astype(np.int64) + np.bitwise_count(self.words[block] & low)


class WaveletMatrix:
    """Symbols by their bits, the highest first, each level ordered by the bit of the level above."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels: list[tuple[int, Bits]] = []
        for shift in range(max(1, int(largest).bit_length()) - 1, -1, -1):
            bit = (symbols >> shift) & 1
            self.levels.append((shift, Bits(bit)))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        every = np.arange(largest + 1)
        self.begins = self._down(every, np.zeros(largest + 1, dtype=np.int64))

    def _down(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.ones(places)
            places = np.where((symbols >> shift) & 1, bits.zeros + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self._down(symbols, places) - self.begins[symbols]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, sorted by their first ``depth`` symbols at least (prefix doubling)."""
    rank, width = text.astype(np.int64) + 1, 1
    order = np.argsort(rank, kind="stable")
    while width < depth:
        after = np.zeros_like(rank)
        after[:-width] = rank[width:]
        pairs = rank * (rank.max(initial=0) + 1) + after
        order = np.argsort(pairs, kind="stable")
        sorted_pairs = pairs[order]
        fresh = np.ones(len(text), dtype=np.int64)
        fresh[1:] = sorted_pairs[1:] != sorted_pairs[:-1]
        rank[order] = np.cumsum(fresh)
        width *= 2
    return order


class FMIndex:
    """Index of ``text`` (symbols, every sequence ended by 0) for questions of up to ``depth`` symbols."""

    def __init__(self, text: np.ndarray, depth: int):
        largest = int(text.max(initial=0))
        self.text = text
        self.order = suffix_order(text, depth)
        self.tree = WaveletMatrix(text[self.order - 1], largest)  # the symbol before the first is the last: a 0
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=largest + 1))])

    def matches(self, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of the words ``starts .. starts + length`` of the index's own text.

        Searched backward from the last word: how many of them (up to ``length``) occur a second time in the text as a
        sequence, and the interval of the suffix order at the last step. A sequence that is down to one occurrence, its
        own, is not searched further.
        """
        symbols = self.text[starts + length - 1]
        low, high = self.first[symbols], self.first[symbols + 1]
        statistic = (high - low > 1).astype(np.int64)
        live = np.flatnonzero(statistic)
        for back in range(2, length + 1):
            if not len(live):
                break
            symbols = self.text[starts[live] + length - back]
            low[live] = self.first[symbols] + self.tree.rank(symbols, low[live])
            high[live] = self.first[symbols] + self.tree.rank(symbols, high[live])
            live = live[high[live] - low[live] > 1]
            statistic[live] = back
        return statistic, low, high

    def least(self, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest of the ``values`` (one for each text place) in intervals that are equal or disjoint."""
        distinct, first, back = np.unique(low, return_index=True, return_inverse=True)
        if not len(distinct):
            return np.zeros(0, dtype=values.dtype)
        edges = np.stack([distinct, high[first]], axis=1).ravel()
        ordered = np.append(values[self.order], np.iinfo(values.dtype).max)
        return np.minimum.reduceat(ordered, edges)[::2][back]
