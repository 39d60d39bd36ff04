"""A compressed FM-index over word numbers: suffix order, wavelet tree of the Burrows-Wheeler transform, backward search."""

from __future__ import annotations

import numpy as np


class WaveletTree:
    """Rank of a symbol in a sequence; one bit vector per bit of the symbols, kept level by level (a wavelet matrix)."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.bits, self.before, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (sequence >> level & 1).astype(np.uint8)
            packed = np.packbits(np.concatenate([bit, np.zeros(64 + -len(bit) % 64, np.uint8)]), bitorder="little").view(np.uint64)
            self.bits.append(packed)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]).astype(np.int32))
            zero = bit == 0
            self.zeros.append(int(zero.sum()))
            sequence = np.concatenate([sequence[zero], sequence[~zero]])
        self.first = self._descend(np.arange(1 << self.levels), np.zeros(1 << self.levels, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            below = (np.uint64(1) << bit) - np.uint64(1)
            ones = self.before[i][word] + np.bitwise_count(self.bits[i][word] & below)
            at = np.where(symbol >> level & 1, self.zeros[i] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._descend(symbol, at) - self.first[symbol]


class RangeMinimum:
    """Minimum of a range of an array: a sparse table over blocks, and the ends looked at directly."""

    BLOCK = 16

    def __init__(self, values: np.ndarray):
        self.values = values
        least = np.minimum.reduceat(values, np.arange(0, len(values), self.BLOCK))
        self.table = [least]
        while 2 ** len(self.table) <= len(least):
            low, half = self.table[-1], 2 ** (len(self.table) - 1)
            self.table.append(np.minimum(low[:-half], low[half:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out = self.values[low].copy()
        first, last = -(-low // self.BLOCK), high // self.BLOCK
        span = np.maximum(last - first, 0)
        for level in np.unique(np.frexp(span[span > 0])[1] - 1):
            own = np.flatnonzero((span >= 2**level) & (span < 2 ** (level + 1)))
            row = self.table[level]
            out[own] = np.minimum(out[own], np.minimum(row[first[own]], row[last[own] - 2**level]))
        # The first and the last BLOCK places of each range.
        step = np.arange(self.BLOCK)
        for place in (low[:, None] + step, high[:, None] - 1 - step):
            np.clip(place, low[:, None], high[:, None] - 1, out=place)
            np.minimum(out, self.values[place].min(axis=1), out=out)
        return out


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of suffixes sorted by their first `depth` symbols at least, by prefix doubling."""
    n = len(text)
    rank, length = text.astype(np.int64), 1
    order = np.argsort(rank)
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[: max(0, n - length)] = rank[length:] + 1
        key = rank * (max(n, int(rank.max())) + 2) + nxt
        order = np.argsort(key)
        ranked = key[order]
        dense = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = dense
        length *= 2
        if length >= depth or dense[-1] == n - 1:
            return order


class FMIndex:
    """Index of a text of word numbers, 0 being a separator, for patterns of up to `depth` words."""

    CHECKS = (4, 8, 16, 32)
    STRETCH = 32  # windows of a piece that are searched one after the other

    def __init__(self, text: np.ndarray, depth: int):
        self.text = text
        symbols = int(text.max()) + 1
        order = suffix_order(text, depth)
        self.tree = WaveletTree(text[order - 1], symbols)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.minimum = RangeMinimum(order)

    def extend(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that start with `word` followed by what the old ranges start with."""
        n = len(word)
        ranks = self.tree.rank(np.concatenate([word, word]), np.concatenate([low, high]))
        return self.starts[word] + ranks[:n], self.starts[word] + ranks[n:]

    def earlier_matches(self, begin: np.ndarray, end: np.ndarray, limit: np.ndarray, window: int) -> list[tuple[int, int, int]]:
        """(number of the piece, from, to) of the stretches of pieces of the text whose windows all occur before `limit`.

        Pieces are text[begin:end] and are themselves in the index. A window is searched backwards from its end. As soon
        as what is matched occurs nowhere before the limit, neither does any window that holds it, and the search goes
        on behind its first word. A window that does occur is followed to the right, word by word, at its first place.
        """
        found: list[tuple[int, int, int]] = []
        text, n = self.text, len(self.text)
        asks = np.zeros(window + 1, bool)
        asks[[*(c for c in self.CHECKS if c < window), window]] = True
        # Long pieces are searched in several stretches at a time.
        stretches = np.maximum(0, end - begin - window + self.STRETCH) // self.STRETCH
        piece = np.repeat(np.arange(len(begin)), stretches)
        at = begin[piece] + self.STRETCH * (np.arange(len(piece)) - np.repeat(np.cumsum(stretches) - stretches, stretches))
        last = np.minimum(at + self.STRETCH, end[piece] - window + 1)
        left = at + window
        low, high = np.zeros(len(piece), np.int64), np.full(len(piece), n)
        while len(piece):
            left = left - 1
            low, high = self.extend(text[left], low, high)
            length = at + window - left
            bad = high - low <= 1
            asked = np.flatnonzero(~bad & asks[length])
            place = self.minimum.least(low[asked], high[asked])
            good = place < limit[piece[asked]]
            bad[asked[~good]] = True
            at = np.where(bad, left + 1, at)
            whole = good & (length[asked] == window)
            hit, first = asked[whole], place[whole]
            if len(hit):
                reach = at[hit] + window
                other = first + window
                stop = end[piece[hit]]
                going = np.arange(len(hit))
                while len(going):
                    on = (reach[going] < stop[going]) & (other[going] < n)
                    going = going[on]
                    going = going[text[reach[going]] == text[other[going]]]
                    reach[going] += 1
                    other[going] += 1
                found += zip(piece[hit].tolist(), at[hit].tolist(), reach.tolist(), strict=True)
                at[hit] = reach - window + 1
                bad[hit] = True
            left = np.where(bad, at + window, left)
            low = np.where(bad, 0, low)
            high = np.where(bad, n, high)
            keep = at < last
            if not keep.all():
                piece, at, last, left, low, high = (x[keep] for x in (piece, at, last, left, low, high))
        return found
