"""A compressed FM-index over sequences of words, searched backward for many queries side by side.

The Burrows-Wheeler transform is held in a wavelet tree, stored level by level: one packed bit
vector with counts per level, as many levels as a word number has bits. Beside it stand common
prefixes of neighbouring suffixes, a byte each; the suffixes themselves are not kept.
"""

from __future__ import annotations

import numpy as np

KNOWN = 63  # common prefixes are known up to this length; a greater one counts as this
STEPS = (32, 16, 8, 4, 2, 1)


class Bits:
    """A bit vector with the number of ones before every 64th place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, dtype=np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, place: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = place >> 6
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletTree:
    def __init__(self, symbols: np.ndarray, depth: int):
        self.levels = []
        for shift in range(depth - 1, -1, -1):
            bits = (symbols >> shift & 1).astype(np.uint8)
            zeros = len(bits) - int(bits.sum())
            self.levels.append((shift, Bits(bits), zeros))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def leaf(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where the symbol's occurrences before ``place`` end in the order of the leaves."""
        for shift, bits, zeros in self.levels:
            ones = bits.ones(place)
            place = np.where(symbol >> shift & 1, zeros + ones, place - ones)
        return place


def sorted_suffixes(text: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Suffixes in order, and for each step the ranks of all suffixes by so many symbols. Zeros
    end a sequence: each differs from every other, and they come first, in order of place."""
    size = len(text)
    ends = text == 0
    rank = text + int(ends.sum())
    rank[ends] = np.arange(int(ends.sum()))
    ranks, step = {1: rank}, 1
    while True:
        following = np.zeros(size, dtype=np.int64)
        following[:max(0, size - step)] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + following
        order = np.argsort(key)
        held = key[order]
        new = np.empty(size, dtype=np.int64)
        new[order] = np.cumsum(np.concatenate([[0], held[1:] != held[:-1]]))
        rank, step = new, 2 * step
        if step in STEPS:
            ranks[step] = rank
        if int(rank.max()) == size - 1 and step > STEPS[0]:
            return order, ranks


class FMIndex:
    """Of words numbered from 1; sequences end in 0."""

    def __init__(self, text: np.ndarray):
        size = self.size = len(text)
        order, ranks = sorted_suffixes(text)
        common = np.zeros(size + 1, dtype=np.uint8)
        left, right = order[:-1].copy(), order[1:].copy()
        for step in STEPS:
            known = np.append(ranks[step], [-1, -2])
            same = known[np.minimum(left, size)] == known[np.where(right < size, right, size + 1)]
            common[1:size] += (same * step).astype(np.uint8)
            left[same] += step
            right[same] += step
        self.common = [common]
        while 2 ** len(self.common) <= size + 1:
            below, half = self.common[-1], 2 ** (len(self.common) - 1)
            self.common.append(np.minimum(below[:-half], below[half:]))
        transform = text[order - 1]
        counts = np.bincount(text)
        self.tree = WaveletTree(transform, max(1, int(text.max()).bit_length()))
        symbols = np.arange(len(counts))
        # From a place among the leaves to the place among the suffixes.
        self.first = (np.concatenate([[0], np.cumsum(counts)[:-1]])
                      - self.tree.leaf(symbols, np.zeros_like(symbols)))

    def extended(self, word: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Intervals of the suffixes that begin with a word and go on as those of the intervals."""
        both = np.concatenate([low, high])
        found = self.tree.leaf(np.concatenate([word, word]), both)
        found += np.tile(self.first[word], 2)
        return found[:len(low)], found[len(low):]

    def shortened(self, low: np.ndarray, high: np.ndarray):
        """The intervals with the fewest words less that hold more suffixes, and their length."""
        depth = np.maximum(self.common[0][low], self.common[0][high])
        low, high = low.copy(), high.copy()
        for level in range(len(self.common) - 1, -1, -1):
            least, width = self.common[level], 1 << level
            at = np.minimum(high, len(least) - 1)
            go = (high + width <= self.size + 1) & (least[at] >= depth) & (high < self.size)
            high[go] += width
            at = np.maximum(low - width + 1, 0)
            go = (low - width >= 0) & (least[np.minimum(at, len(least) - 1)] >= depth)
            low[go] -= width
        return low, high, depth.astype(np.int64)

    def matching_statistics(self, text: np.ndarray, begins: np.ndarray, ends: np.ndarray,
                            least: int = 2) -> np.ndarray:
        """For each place of the queries ``text[begin:end]``, how many words from there on, up to
        the query's end, occur at least ``least`` times in the index. Lengths above ``KNOWN`` may
        come out shorter, but never below it."""
        lengths = np.zeros(len(text), dtype=np.int64)
        place, stop = ends.copy(), begins.copy()
        low, high = np.zeros_like(place), np.full_like(place, self.size)
        depth = np.zeros_like(place)
        live = place > stop
        while True:
            if not live.all():
                place, stop, low, high, depth = (
                    x[live] for x in (place, stop, low, high, depth))
            if not len(place):
                return lengths
            new_low, new_high = self.extended(text[place - 1], low, high)
            met = new_high - new_low >= least
            low[met], high[met] = new_low[met], new_high[met]
            short = ~met & (depth > 0)
            if short.any():
                low[short], high[short], depth[short] = self.shortened(low[short], high[short])
                # With no word left every suffix fits.
                none = short & (depth == 0)
                low[none], high[none] = 0, self.size
            moved = ~short
            depth[met] += 1
            place[moved] -= 1
            lengths[place[moved]] = depth[moved]
            live = place > stop
