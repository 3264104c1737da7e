"""A compressed full-text index of word sequences: suffix order, wavelet matrix, backward search.

Symbols are numbers from 1; 0 ends a sequence. Suffixes are sorted by their first ``DEPTH``
symbols, which is enough for patterns up to that length. All work is on whole arrays: many
patterns take their next step together.
"""

from __future__ import annotations

import numpy as np

DEPTH = 64


class WaveletMatrix:
    """Bits of the symbols by level, packed, with counts of ones before every 64th bit."""

    def __init__(self, symbols: np.ndarray, size: int) -> None:
        self.levels = max(int(size - 1).bit_length(), 1)
        self.words, self.ones, self.zeros = [], [], []
        now = symbols
        for level in reversed(range(self.levels)):
            bits = (now >> level & 1).astype(bool)
            packed = np.packbits(bits, bitorder="little")
            packed = np.append(packed, np.zeros(16 - len(packed) % 8, np.uint8)).view(np.uint64)
            self.words.append(packed)
            ones = np.zeros(len(packed) + 1, np.int64)
            np.cumsum(np.bitwise_count(packed), out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(int(len(now) - ones[-1]))
            now = np.concatenate([now[~bits], now[bits]])
        # Where the symbols' own rows begin on the last level.
        self.base = self._down(np.arange(size), np.zeros(size, np.int64))

    def _down(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for depth in range(self.levels):
            word, bit = places >> 6, (places & 63).astype(np.uint64)
            below = (np.uint64(1) << bit) - np.uint64(1)
            ones = self.ones[depth][word] + np.bitwise_count(self.words[depth][word] & below)
            is_one = (symbols >> (self.levels - 1 - depth) & 1).astype(bool)
            places = np.where(is_one, self.zeros[depth] + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        return self._down(symbols, places) - self.base[symbols]


def _suffixes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in suffix order by the first DEPTH symbols, and shared symbols with the one before."""
    n = len(text)
    rank = text.astype(np.int64)
    ranks, width = [rank], 1
    while width < DEPTH:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(np.diff(key[order]) != 0)
        rank, width = new, width * 2
        ranks.append(rank)
    # Ties keep the order of places, so that equal contexts are stable.
    order = np.argsort(rank, kind="stable")
    left, right = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(n - 1, np.int64)
    for step in reversed(range(len(ranks))):
        known = np.append(ranks[step], -1)
        a, b = known[np.minimum(left, n)], known[np.minimum(right, n)]
        same = (a == b) & (a >= 0)
        # Past the end nothing is equal.
        same &= np.maximum(left, right) + (1 << step) <= n
        shared += same * (1 << step)
        left, right = left + same * (1 << step), right + same * (1 << step)
    return order, np.minimum(shared, DEPTH)


class FMIndex:
    """Sequences of symbols, each followed by 0 in ``text``."""

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        self.n = len(text)
        order, shared = _suffixes(text)
        self.first = np.zeros(symbols + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=symbols), out=self.first[1:])
        self.bwt = WaveletMatrix(text[order - 1], symbols)
        self.shared = np.concatenate([[-1], shared, [-1]])
        self._enclose()

    def _enclose(self) -> None:
        """The nearest smaller values of ``shared`` to either side: where a wider range ends."""
        at = np.arange(self.n + 1)
        self.left, self.right = np.zeros(self.n + 1, np.int64), np.full(self.n + 1, self.n)
        for depth in np.unique(self.shared):
            if depth <= 0:
                continue
            here = np.flatnonzero(self.shared == depth)
            smaller = self.shared < depth
            self.left[here] = np.maximum.accumulate(np.where(smaller, at, 0))[here]
            back = np.where(smaller, at, self.n)[::-1]
            self.right[here] = np.minimum.accumulate(back)[::-1][here]

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray):
        """One step of backward search: the rows of the patterns with a symbol put before."""
        both = self.bwt.rank(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        start = self.first[symbols]
        return start + both[: len(low)], start + both[len(low) :]

    def shorten(self, low: np.ndarray, high: np.ndarray):
        """The next wider range of each, and how many symbols its pattern has."""
        depth = np.maximum(self.shared[low], self.shared[high])
        wider_low = np.where(self.shared[low] == depth, self.left[low], low)
        wider_high = np.where(self.shared[high] == depth, self.right[high], high)
        whole = depth <= 0
        return np.where(whole, 0, wider_low), np.where(whole, self.n, wider_high), np.maximum(depth, 0)

    def frequent(
        self, stream: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int, times: int = 2
    ) -> np.ndarray:
        """Which places of ``stream`` begin ``width`` symbols that the index has ``times`` or more.

        Each sequence ``starts`` to ``ends`` is read from its end: the longest match that ends
        at the current place is held as a range of rows, made longer to the left while it is
        frequent, else shorter from the right.
        """
        found = np.zeros(len(stream), bool)
        start, at, last = starts.copy(), ends - 1, ends - 1
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.n)
        while True:
            going = (at >= start) & (last - start + 1 >= width)
            if not going.all():
                start, at, last, low, high = (x[going] for x in (start, at, last, low, high))
            if not len(at):
                return found
            new_low, new_high = self.extend(stream[at], low, high)
            longer = new_high - new_low >= times
            found[at[longer & (last - at + 1 >= width)]] = True
            wide_low, wide_high, depth = self.shorten(low, high)
            nothing = ~longer & (last == at)
            last = np.where(longer, last, np.where(nothing, at - 1, at + depth))
            low = np.where(longer, new_low, np.where(nothing, 0, wide_low))
            high = np.where(longer, new_high, np.where(nothing, self.n, wide_high))
            at = at - (longer | nothing)
