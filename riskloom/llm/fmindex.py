"""A compressed FM-index over word numbers, searched for many texts at once."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Bits in 64-bit words with running counts."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words).astype(np.int64))]

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones in front of position i."""
        at, off = i >> 6, (i & 63).astype(np.uint64)
        mask = (np.uint64(1) << off) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & mask)


class WaveletTree:
    """Rank of a symbol in front of a position; a bit vector per level (matrix layout)."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels, self.zeros = [], []
        self.depth = max(1, int(sigma - 1).bit_length())
        x = symbols
        for shift in range(self.depth - 1, -1, -1):
            bits = (x >> shift & 1).astype(bool)
            self.levels.append(BitVector(bits))
            self.zeros.append(int((~bits).sum()))
            x = np.concatenate([x[~bits], x[bits]])
        every = np.arange(sigma, dtype=np.int64)
        self.start = self._descend(every, np.zeros(sigma, np.int64))

    def _descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = (symbol >> (self.depth - 1 - level) & 1).astype(bool)
            ones = bits.rank(i)
            i = np.where(one, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self._descend(symbol, i) - self.start[symbol]


class FMIndex:
    """Index of texts of word numbers from 1; 0 ends each text.

    Suffixes are sorted by their first ``depth`` words at least, which places the block of
    every pattern up to that length as a full sort would. ``edges`` marks where blocks of
    ``width`` equal words begin, and ``first`` is the earliest position of each block.
    """

    def __init__(self, texts: list[np.ndarray], width: int):
        ends = [np.zeros(1, np.int64)]
        x = np.concatenate([p for t in texts for p in (np.asarray(t, np.int64), ends[0])] or ends)
        n, sigma = len(x), int(x.max()) + 1
        rank, length = x.copy(), 1
        exact = None
        while length <= width:  # up to a depth above width: the search steps over width + 1 words
            exact = (rank, length)
            key = rank * (int(rank.max()) + 1) + np.r_[rank[length:], np.zeros(min(length, n), np.int64)][:n]
            order = np.argsort(key, kind="stable")
            new = np.r_[0, np.cumsum(np.diff(key[order]) != 0)]
            rank = np.empty(n, np.int64)
            rank[order] = new
            length *= 2
        self.text, self.suffix, self.width = x, order, width
        self.counts = np.r_[0, np.cumsum(np.bincount(x, minlength=sigma))]
        self.tree = WaveletTree(x[order - 1], sigma)
        # Equal first `width` words: equal in two overlapping runs of a length already ranked.
        half, size = exact
        late = order + (width - size)
        tail = np.where(late < n, half[np.minimum(late, n - 1)], -1)
        head = half[order]
        self.starts = np.flatnonzero(np.r_[True, (np.diff(head) != 0) | (np.diff(tail) != 0)])
        edges = np.zeros(n + 1, bool)
        edges[self.starts] = True
        edges[n] = True
        self.edges = BitVector(edges)
        self.bounds = np.r_[self.starts, n]
        self.first = np.minimum.reduceat(order, self.starts)

    def step(self, word: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: the suffixes that begin with ``word`` and go on inside [lo, hi)."""
        both = self.tree.rank(np.r_[word, word], np.r_[lo, hi])
        base = self.counts[word]
        return base + both[: len(word)], base + both[len(word) :]

    def widen(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block of ``width`` equal words around an interval."""
        at = self.edges.rank(lo + 1) - 1
        to = self.edges.rank(hi)
        return self.bounds[at], self.bounds[to]

    def earlier(self, texts: list[np.ndarray], places: np.ndarray) -> list[np.ndarray]:
        """For each text, which of its windows of ``width`` words occur before themselves.

        Texts are streamed from their ends, all side by side: the interval of the last
        words grows by a backward step per word, and once it holds ``width`` words it is
        widened again to them, so the matching statistic never passes ``width``.
        ``places`` are the positions of the texts in the index.
        """
        out = [np.zeros(max(0, len(t) - self.width + 1), bool) for t in texts]
        size = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-size, kind="stable")
        size = size[order]
        flat = np.concatenate([texts[i] for i in order]) if len(texts) else np.zeros(0, np.int64)
        begin = np.cumsum(size) - size
        hits = np.zeros(len(flat), bool)
        lo = np.zeros(len(size), np.int64)
        hi = np.full(len(size), len(self.suffix), np.int64)
        for k in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -k, side="left"))  # texts longer than k
            at = begin[:live] + size[:live] - 1 - k
            lo, hi = self.step(flat[at], lo[:live], hi[:live])
            if k + 1 > self.width:
                lo, hi = self.widen(lo, hi)
            if k + 1 >= self.width:
                block = self.edges.rank(lo + 1) - 1
                here = places[order[:live]] + size[:live] - 1 - k
                hits[at] = self.first[block] < here
        for i, b, s in zip(order, begin, size):
            out[i][:] = hits[b : b + len(out[i])]
        return out
