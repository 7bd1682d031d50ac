"""Suffix trees of integer sequences and longest common extensions of many pairs at once.

A tree is built word by word (Ukkonen), then laid out as arrays.  Its Euler
tour is ranked by pointer jumping; the least string depth between neighbouring
leaves of the tour goes into a table of powers of two, from which the depth of
the lowest common ancestor of any two leaves is read in constant time.
"""

from __future__ import annotations

from array import array

import numpy as np


class SuffixTree:
    """The tree of ``text``, whose last symbol occurs nowhere else.

    ``symbol`` is the first symbol of the edge that leads to a node; leaf number
    k (in order of creation) is the suffix that begins at k.  About 250 bytes a
    symbol are held while it is built, about 60 afterwards.
    """

    def __init__(self, text: list[int]):
        size, width = len(text), max(text, default=0) + 1
        start, end, link = array("q", [0]), array("q", [0]), array("q", [0])
        edges: dict[int, int] = {}
        node = length = waiting = 0  # the active point: a node, symbols below it, suffixes not yet inserted
        edge = 0
        for at, symbol in enumerate(text):
            waiting += 1
            last = 0
            while waiting:
                if not length:
                    edge = at
                key = node * width + text[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(at)
                    end.append(size)
                    link.append(0)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    begin = start[child]
                    span = end[child] - begin
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if text[begin + length] == symbol:
                        if last:
                            link[last] = node
                        length += 1
                        break
                    split = len(start)
                    edges[key] = split
                    edges[split * width + text[begin + length]] = child
                    edges[split * width + symbol] = split + 1
                    start.extend((begin, at))
                    end.extend((begin + length, size))
                    link.extend((0, 0))
                    start[child] = begin + length
                    if last:
                        link[last] = split
                    last = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = at - waiting + 1
        count = len(start)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        child = np.fromiter(edges.values(), np.int64, len(edges))
        del edges, link
        self.parent, self.symbol = np.zeros(count, np.int64), np.zeros(count, np.int64)
        self.parent[child], self.symbol[child] = keys // width, keys % width
        begin, stop = np.array(start, np.int64), np.array(end, np.int64)
        self.depth = self._depths(stop - begin)
        inner = np.zeros(count, bool)
        inner[self.parent[1:]] = True
        self.leaves = np.flatnonzero(~inner)
        # the suffix of a leaf follows from its depth, so the order of creation need not be trusted
        self.leaves = self.leaves[np.argsort(size - self.depth[self.leaves], kind="stable")]

    def _depths(self, length: np.ndarray) -> np.ndarray:
        depth, above = length.copy(), self.parent.copy()
        depth[0] = 0
        while above.any():
            depth += depth[above]
            above = above[above]
        return depth

    def tour(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Euler tour with children in order of ``keys[symbol]``: the nodes it meets and where it first meets each leaf."""
        count = len(self.parent)
        if count == 1:
            return np.zeros(1, np.int64), np.zeros(0, np.int64)
        nodes = np.arange(1, count)
        nodes = nodes[np.lexsort((keys[self.symbol[nodes]], self.parent[nodes]))]
        parents = self.parent[nodes]
        new = np.ones(len(nodes), bool)
        new[1:] = parents[1:] != parents[:-1]
        first = np.zeros(count, np.int64)
        first[parents[new]] = nodes[new]
        # step v goes down to v, step count + v back up from it; the way up to the root's place ends the tour
        follow = np.empty(2 * count, np.int64)
        down = np.arange(count)
        follow[down] = np.where(first > 0, first, down + count)
        final = np.ones(len(nodes), bool)
        final[:-1] = new[1:]
        beside = np.empty(len(nodes), np.int64)
        beside[:-1] = nodes[1:]
        follow[count + nodes] = np.where(final, count + parents, np.append(beside[:-1], 0))
        follow[count] = count
        left = np.ones(2 * count, np.int64)
        left[count] = 0
        jump = follow
        while (jump != count).any():
            left += left[jump]
            jump = jump[jump]
        place = left[0] - left
        visited = np.empty(int(left[0]), np.int64)
        visited[place[:count]] = down
        visited[place[count + nodes]] = parents
        return visited, place[self.leaves]

    def ranks(self, keys: np.ndarray) -> np.ndarray:
        """Rank of each suffix when symbols are ordered by ``keys``."""
        return np.argsort(np.argsort(self.tour(keys)[1]))


class Extensions:
    """Lengths of longest common prefixes of pairs of suffixes."""

    def __init__(self, tree: SuffixTree, keys: np.ndarray):
        visited, met = tree.tour(keys)
        order = np.argsort(met)
        self.rank = np.empty(len(met), np.int64)
        self.rank[order] = np.arange(len(met))
        self.lengths = tree.depth[tree.leaves]
        between = np.minimum.reduceat(tree.depth[visited], met[order])[:-1] if len(met) > 1 else np.zeros(1, np.int64)
        self.table = [between.astype(np.int32)]
        step = 1
        while 2 * step <= len(between):
            row = self.table[-1]
            self.table.append(np.minimum(row[:-step], row[step:]))
            step *= 2
        self.flat = np.concatenate(self.table)
        self.offsets = np.concatenate([[0], np.cumsum([len(row) for row in self.table])])[:-1]
        del self.table

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        low, high = np.minimum(self.rank[a], self.rank[b]), np.maximum(self.rank[a], self.rank[b])
        width = np.maximum(high - low, 1)
        level = np.frexp(width.astype(np.float64))[1] - 1
        base = self.offsets[level]
        low = np.minimum(low, high - 1).clip(0)
        shared = np.minimum(self.flat[base + low], self.flat[base + low + width - (np.int64(1) << level)])
        return np.where(a == b, self.lengths[a], shared)
