"""Suffix trees of word sequences, and the longest common extension of two of its places."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: The word behind the last one; smaller than any word in every order.
END = -1
#: Entries of a tour that are searched one by one.
SPAN = 32


class SuffixTree:
    """Ukkonen's tree of ``words`` (whole numbers from 0) and END, built in one pass.

    A node holds the words from ``start`` to ``stop`` on the edge to it; a leaf's edge runs to the
    end. Leaves appear in the order of their suffixes.
    """

    def __init__(self, words: Sequence[int]):
        text = self.text = [*words, END]
        size = self.size = len(text)
        self.start, self.stop = [0], [0]
        self.kids: list[dict[int, int] | None] = [{}]
        self.suffix = [-1]
        start, stop, kids, suffix = self.start, self.stop, self.kids, self.suffix
        link = [0]
        node = edge = length = waiting = leaves = 0
        for i, word in enumerate(text):
            waiting += 1
            split = 0  # the node made last, still without a suffix link
            while waiting:
                if not length:
                    edge = i
                below = kids[node]
                child = below.get(text[edge])
                if child is not None:
                    here = stop[child] - start[child]
                    if length >= here:  # the place lies below this child
                        node, edge, length = child, edge + here, length - here
                        continue
                    if text[start[child] + length] == word:  # the suffix is there already
                        length += 1
                        if split:
                            link[split] = node
                        break
                leaf = len(start)
                start.append(i)
                stop.append(size)
                kids.append(None)
                suffix.append(leaves)
                link.append(0)
                leaves += 1
                if child is None:
                    below[text[edge]] = leaf
                    inner = node
                else:  # cut the edge where the new suffix leaves it
                    inner = leaf + 1
                    start.append(start[child])
                    stop.append(start[child] + length)
                    start[child] += length
                    kids.append({word: leaf, text[start[child]]: child})
                    suffix.append(-1)
                    link.append(0)
                    below[text[edge]] = inner
                if split:
                    link[split] = inner
                split = inner
                waiting -= 1
                if node == 0 and length:
                    length -= 1
                    edge = i - waiting + 1
                else:
                    node = link[node]

    def ranks(self, descending: bool = False) -> list[int]:
        """The rank of each suffix, by the words or by their reverse order; END comes first in both."""
        kids, suffix = self.kids, self.suffix
        order, stack = [], [0]
        while stack:
            v = stack.pop()
            below = kids[v]
            if below is None:
                order.append(suffix[v])
            elif descending:
                stack.extend(below[w] for w in sorted(below) if w != END)
                if END in below:
                    stack.append(below[END])
            else:
                stack.extend(below[w] for w in sorted(below, reverse=True))
        rank = [0] * self.size
        for k, i in enumerate(order):
            rank[i] = k
        return rank

    def tour(self) -> tuple[np.ndarray, np.ndarray]:
        """The Euler tour as numbers of words from the root, and each leaf's place in it."""
        kids, suffix, start, stop = self.kids, self.suffix, self.start, self.stop
        depth = [0] * len(start)
        tour, first = [], [0] * self.size
        stack = [0]
        while stack:
            v = stack.pop()
            if v < 0:  # back from a child
                tour.append(depth[~v])
                continue
            below = kids[v]
            if below is None:
                first[suffix[v]] = len(tour)
            tour.append(depth[v])
            if below is not None:
                for child in below.values():
                    depth[child] = depth[v] + stop[child] - start[child]
                    stack.append(~v)
                    stack.append(child)
        return np.array(tour, np.int32), np.array(first, np.int64)


class RangeMinimum:
    """Smallest value between two places in constant time, in memory linear in the values.

    A table of doubling lengths over blocks of SPAN values, and the smallest value so far from
    either end of each block. Two places of one block are answered from the block.
    """

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        blocks = -(-self.n // SPAN)
        top = np.iinfo(values.dtype).max
        self.grid = np.full((blocks, SPAN), top, values.dtype)
        self.grid.reshape(-1)[: self.n] = values
        self.head = np.minimum.accumulate(self.grid, axis=1).reshape(-1)
        self.tail = np.minimum.accumulate(self.grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        self.levels = [self.grid.min(axis=1)]
        while 2 << (len(self.levels) - 1) <= blocks:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The smallest value from ``lo`` to ``hi``, both included."""
        a, b = lo // SPAN, hi // SPAN
        out = np.minimum(self.tail[lo], self.head[hi])
        one = np.flatnonzero(a == b)
        for k in range(0, len(one), 4096):
            some = one[k : k + 4096]
            place = np.arange(SPAN)
            inside = (place >= (lo[some] % SPAN)[:, None]) & (place <= (hi[some] % SPAN)[:, None])
            out[some] = np.where(inside, self.grid[a[some]], np.iinfo(self.grid.dtype).max).min(axis=1)
        count = b - a - 1
        for level in range(len(self.levels)):
            some = np.flatnonzero((count >= 1 << level) & (count < 2 << level))
            if len(some):
                row, last = self.levels[level], b[some] - (1 << level)
                out[some] = np.minimum(out[some], np.minimum(row[a[some] + 1], row[last]))
        return out


class Extension:
    """How many words two suffixes share: the depth of their leaves' lowest common ancestor."""

    def __init__(self, tree: SuffixTree):
        tour, self.first = tree.tour()
        self.minimum = RangeMinimum(tour)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        p, q = self.first[i], self.first[j]
        return self.minimum.least(np.minimum(p, q), np.maximum(p, q)).astype(np.int64)
