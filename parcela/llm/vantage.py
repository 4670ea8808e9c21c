"""Vantage-point partitions: a routing tree over shards and the trees inside a shard, for any metric.

Every inner node has a vantage point and a radius: points within the radius lie inside, the others outside. By the triangle
inequality no point inside is nearer to a query than distance - radius, none outside nearer than radius - distance (plus
``gap``, the least step of an integer metric). A search for everything within r prunes a side whose bound exceeds r;
``relax`` multiplies the bounds, so 1 prunes nothing that counts and larger factors prune more.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

Distance = Callable[[np.ndarray, np.ndarray], np.ndarray]
_SLACK = 1e-9          # of rounding in the distances


def hamming(points: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(points ^ x).astype(np.int64)


def euclid(points: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - x) ** 2).sum(1))


def vantage_point(points: np.ndarray, distance: Distance, rng: np.random.Generator, tries: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Of a few points, the one whose distances to the others are spread widest, and these distances."""
    best = None
    for i in rng.choice(len(points), min(tries, len(points)), replace=False):
        d = distance(points, points[i])
        if best is None or d.var() > best[1].var():
            best = (points[i], d)
    return best


class Router:
    """A vantage-point tree fitted on a sample; its leaves are the shards."""

    def __init__(self, sample: np.ndarray, leaves: int, distance: Distance, gap: float = 0, seed: int = 7):
        self.distance, self.gap = distance, gap
        self.nodes: list[tuple] = []               # (vantage, radius, inside, outside); a leaf is ~number
        self.leaves = 0
        self.root = self._grow(sample, leaves, np.random.default_rng(seed))

    def _grow(self, points: np.ndarray, leaves: int, rng: np.random.Generator) -> int:
        if leaves > 1 and len(points) > 1:
            vantage, d = vantage_point(points, self.distance, rng)
            # the cut between two distances that parts the points most evenly
            radius = np.partition(d, (len(d) - 1) // 2)[(len(d) - 1) // 2]
            if not (d > radius).any():
                radius = d[d < radius].max(initial=-1)
            inside = d <= radius
            if inside.any() and not inside.all():
                at = len(self.nodes)
                self.nodes.append(())
                left = self._grow(points[inside], leaves // 2, rng)
                self.nodes[at] = (vantage, radius, left, self._grow(points[~inside], leaves - leaves // 2, rng))
                return at
        self.leaves += 1
        return ~(self.leaves - 1)

    def home(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        out = np.zeros(len(points), np.int32)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            at, rows = todo.pop()
            if at < 0:
                out[rows] = ~at
            elif len(rows):
                vantage, radius, left, right = self.nodes[at]
                inside = self.distance(points[rows], vantage) <= radius
                todo += [(left, rows[inside]), (right, rows[~inside])]
        return out

    def visits(self, points: np.ndarray, r: np.ndarray, relax: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that may hold something within r of a point, its home included."""
        rows_out, leaves_out = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            at, rows = todo.pop()
            if not len(rows):
                continue
            if at < 0:
                rows_out.append(rows)
                leaves_out.append(np.full(len(rows), ~at, np.int32))
                continue
            vantage, radius, left, right = self.nodes[at]
            d = self.distance(points[rows], vantage)
            reach = r[rows] + _SLACK
            todo += [(left, rows[(d - radius) * relax <= reach]), (right, rows[(radius + self.gap - d) * relax <= reach])]
        return np.concatenate(rows_out), np.concatenate(leaves_out)


class UnionFind:
    """Components of 0..n-1 under batches of links."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            p = self.roots()
            a, b = p[a], p[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def hamming_forest(home: np.ndarray, guests: np.ndarray, r: int, leaf: int = 128, block: int = 1 << 20) -> UnionFind:
    """Components of home points and guests under links of at most r bits between a home point and any other point.

    The points are split by vantage points; a point follows every side that may hold a home point within r. Links are merged
    as they are found, so a dense group costs no memory by its pairs.
    """
    points = np.concatenate([home, guests])
    forest, rng = UnionFind(len(points)), np.random.default_rng(len(points))
    todo = [(np.arange(len(home)), np.arange(len(points)))]
    while todo:
        own, near = todo.pop()
        if len(own) > leaf:
            vantage, d = vantage_point(points[own], hamming, rng, 2)
            radius = int(np.median(d))
            inside = d <= radius
            if inside.any() and not inside.all():
                e = hamming(points[near], vantage)
                todo += [(own[inside], near[e <= radius + r]), (own[~inside], near[e >= radius + 1 - r])]
                continue
        step = max(1, block // max(1, len(own)))
        for s in range(0, len(near), step):
            rows = near[s:s + step]
            i, j = np.nonzero(np.bitwise_count(points[rows][:, None] ^ points[own][None, :]) <= r)
            forest.link(rows[i], own[j])
    return forest


class Tree:
    """The vantage-point tree of one shard of vectors, for the nearest neighbours of many queries at once."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = 64):
        self.points, self.ids, self.leaf = points, ids, leaf
        self.nodes: list[tuple] = []
        rng = np.random.default_rng(len(points))
        self.root = self._grow(np.arange(len(points)), rng)

    def _grow(self, rows: np.ndarray, rng: np.random.Generator) -> int:
        at = len(self.nodes)
        self.nodes.append((rows,))
        if len(rows) > self.leaf:
            vantage, d = vantage_point(self.points[rows], euclid, rng)
            radius = float(np.median(d))
            inside = d <= radius
            if inside.any() and not inside.all():
                left = self._grow(rows[inside], rng)
                self.nodes[at] = (vantage, radius, left, self._grow(rows[~inside], rng))
        return at

    def nearest(self, queries: np.ndarray, k: int, relax: float = 1.0, within: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Distances and rows (-1: none) of the k nearest of each query, ties to the smaller id; ``within`` bounds the search."""
        n = len(queries)
        self.d, self.i = np.full((n, k), np.inf), np.full((n, k), -1)
        self.cap = np.full(n, np.inf) if within is None else within.copy()
        self.queries, self.k, self.relax = queries, k, relax
        if len(self.points) and n:
            self._visit(self.root, np.arange(n))
        return self.d, self.i

    def _bound(self, q: np.ndarray) -> np.ndarray:
        return np.minimum(self.cap[q], self.d[q, -1]) + _SLACK

    def _visit(self, at: int, q: np.ndarray) -> None:
        if not len(q):
            return
        node = self.nodes[at]
        if len(node) == 1:
            rows = node[0]
            for s in range(0, len(q), step := max(1, (1 << 20) // max(1, len(rows) * self.points.shape[1]))):
                self._take(q[s:s + step], rows)
            return
        vantage, radius, left, right = node
        d = euclid(self.queries[q], vantage)
        inner = d <= radius
        a, da = q[inner], d[inner]
        self._visit(left, a)
        self._visit(right, a[(radius - da) * self.relax <= self._bound(a)])
        b, db = q[~inner], d[~inner]
        self._visit(right, b)
        self._visit(left, b[(db - radius) * self.relax <= self._bound(b)])

    def _take(self, q: np.ndarray, rows: np.ndarray) -> None:
        d = np.sqrt(((self.queries[q][:, None, :] - self.points[rows][None, :, :]) ** 2).sum(2))
        every = np.concatenate([self.d[q], d], 1)
        at = np.concatenate([self.i[q], np.broadcast_to(rows, d.shape)], 1)
        order = np.lexsort((np.where(at < 0, np.iinfo(np.int64).max, self.ids[at]), every), axis=1)[:, :self.k]
        self.d[q], self.i[q] = np.take_along_axis(every, order, 1), np.take_along_axis(at, order, 1)
