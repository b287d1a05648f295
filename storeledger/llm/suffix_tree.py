"""Suffix trees of integer strings, with longest common extensions in constant time."""

from __future__ import annotations

import numpy as np


class SuffixTree:
    """The suffix tree of ``symbols`` (positive integers), built by Ukkonen's algorithm, end marked by 0.

    ``lcp(i, j)`` is the length two suffixes have in common: the depth of the lowest common ancestor
    of their leaves, which is the least depth an Euler tour meets between them.
    """

    def __init__(self, symbols: list[int]):
        self.n = len(symbols)
        self._build([*symbols, 0])
        self._tour()

    def _build(self, s: list[int]) -> None:
        n, most = len(s), max(s) + 1
        start, end, depth, parent, link = [0], [0], [0], [0], [0]
        child: dict[int, int] = {}  # of a node and a first symbol
        node = edge = length = due = 0
        for i, c in enumerate(s):
            fresh = 0  # an inner node that waits for its suffix link
            due += 1
            while due:
                if not length:
                    edge = i
                key = node * most + s[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(start)
                    start.append(i), end.append(n), depth.append(n - 1 - i + due), parent.append(node), link.append(0)
                    if fresh:
                        link[fresh] = node
                        fresh = 0
                else:
                    first = start[below]
                    size = end[below] - first
                    if length >= size:
                        node, length, edge = below, length - size, edge + size
                        continue
                    if s[first + length] == c:
                        if fresh:
                            link[fresh] = node
                        length += 1
                        break
                    inner = len(start)
                    start.append(first), end.append(first + length), depth.append(due - 1), parent.append(node), link.append(0)
                    start.append(i), end.append(n), depth.append(n - 1 - i + due), parent.append(inner), link.append(0)
                    start[below], parent[below] = first + length, inner
                    child[key], child[inner * most + c], child[inner * most + s[first + length]] = inner, inner + 1, below
                    if fresh:
                        link[fresh] = inner
                    fresh = inner
                due -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - due + 1
        self.first = np.array(s)[start]
        self.depth, self.parent = np.array(depth), np.array(parent)
        self.leaf = np.array(end) == n
        self.leaf[0] = False
        if n == 1:  # the end mark alone
            self.leaf[1] = True

    def _tour(self) -> None:
        """Lays the nodes out as an Euler tour visits them, children by their first symbols."""
        up = np.lexsort((self.first, self.depth))[1:]  # every node after its parent, siblings by symbol
        up = up[np.lexsort((self.first[up], self.parent[up], self.depth[self.parent[up]]))]
        parent = self.parent.tolist()
        order = up.tolist()
        size = [1] * len(parent)  # visits below and at a node
        for v in np.argsort(-self.depth, kind="stable").tolist():
            if v:
                size[parent[v]] += size[v] + 1
        visit = [0] * len(parent)
        free = [1] * len(parent)
        for v in order:
            p = parent[v]
            visit[v] = at = visit[p] + free[p]
            free[p] += size[v] + 1
        depths = np.zeros(size[0], np.int64)
        visits, sizes = np.array(visit), np.array(size)
        depths[visits] = self.depth
        depths[visits[1:] + sizes[1:]] = self.depth[self.parent[1:]]  # back at the parent
        leaves = np.flatnonzero(self.leaf)
        leaves = leaves[np.argsort(visits[leaves])]
        self.suffixes = self.n + 1 - self.depth[leaves]  # in ascending order
        self.rank = np.empty(self.n + 1, np.int64)
        self.rank[self.suffixes] = np.arange(self.n + 1)
        between = np.minimum.reduceat(depths, visits[leaves])[:-1].astype(np.int32)
        self.table = [between]
        while 2 * (step := 1 << (len(self.table) - 1)) <= len(between):
            self.table.append(np.minimum(self.table[-1][:-step], self.table[-1][step:]))

    def reverse_rank(self) -> np.ndarray:
        """Ranks of the suffixes when larger symbols come first, the end still before all: the tour with children turned round."""
        turned = np.where(self.first > 0, -self.first, np.iinfo(np.int64).min)
        parent = self.parent.tolist()
        below = self.leaf.astype(np.int64).tolist()
        for v in np.argsort(-self.depth, kind="stable").tolist():
            if v:
                below[parent[v]] += below[v]
        free = [0] * len(parent)
        rank = np.empty(self.n + 1, np.int64)
        place = np.zeros(len(parent), np.int64).tolist()
        for v in np.lexsort((turned, self.parent, self.depth[self.parent])).tolist():
            if v:
                p = parent[v]
                place[v] = place[p] + free[p]
                free[p] += below[v]
        leaves = np.flatnonzero(self.leaf)
        rank[self.n + 1 - self.depth[leaves]] = np.array(place)[leaves]
        return rank

    def lcp(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For arrays of different positions, at most ``n``."""
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level).tolist():
            at = level == k
            table = self.table[k]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << k)])
        return out


def longest_lyndon(rank: np.ndarray) -> np.ndarray:
    """The length of the longest Lyndon word at each position, from the suffixes' ranks: up to the next smaller suffix."""
    ranks = rank.tolist()
    n = len(ranks) - 1  # the last is the empty suffix
    found = [0] * n
    open_ = [n]
    for i in range(n - 1, -1, -1):
        here = ranks[i]
        while ranks[open_[-1]] > here:
            open_.pop()
        found[i] = open_[-1] - i
        open_.append(i)
    return np.array(found, np.int64)


def runs(symbols: list[int], exponent: int, least: int) -> np.ndarray:
    """Maximal runs of at least ``exponent`` periods and ``least`` symbols: rows ``start, length, period``, sorted.

    Every run holds a Lyndon word of its period's length, the longest one at its position for the
    symbols' order or for the reverse order. So the longest Lyndon words of both orders are candidate
    periods, and each is extended to both sides by common extensions in the suffix trees of the
    string and of its reversal (Bannai et al., 2017).
    """
    n = len(symbols)
    if n < max(least, exponent):
        return np.empty((0, 3), np.int64)
    tree, back = SuffixTree(symbols), SuffixTree(symbols[::-1])
    found = []
    for rank in (tree.rank, tree.reverse_rank()):
        period = longest_lyndon(rank)
        i = np.flatnonzero(period * exponent <= n)
        period = period[i]
        right = tree.lcp(i, i + period)
        left = np.zeros(len(i), np.int64)
        left[i > 0] = back.lcp((n - i)[i > 0], (n - i - period)[i > 0])
        length = left + period + right
        good = (length >= exponent * period) & (length >= least)
        found.append(np.stack([i - left, length, period], axis=1)[good])
    every = np.unique(np.concatenate(found), axis=0)
    return every[np.lexsort((every[:, 2], every[:, 0]))]
