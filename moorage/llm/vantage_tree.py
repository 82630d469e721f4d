"""Approximate nearest neighbours by vantage-point trees, one per shard.

Largest inner products become smallest distances with one more component: candidates get sqrt(M^2 - |x|^2), M the
largest norm of the shard, and queries 0. A node holds a vantage point and the median distance of its points to it,
its radius. By the triangle inequality the side away from a query can be left out if the query is farther from the
radius than its k-th best distance so far. ``factor`` relaxes this: a side is left out once ``factor`` times that
distance passes the k-th best. Factor 1 restores exact search; with larger ones less is visited and some is missed.

How much is missed depends on the vectors, so each shard chooses its factor: ``SAMPLED`` of its vectors, drawn with a
fixed seed, are searched with each of ``FACTORS`` in turn and by comparison with all, until the share of true neighbours
found reaches ``RECALL``. The last of them is 1, with which none is missed.

Queries go down the tree together, those on one side of a node before the others. Vantage points are chosen on a
bounded sample of the points of a node, but every point is in the tree. Equal vectors are one point with the smallest
ids, ``k`` + 1 of them, which is all that a query can return. Zero vectors take no part; see ``vectors`` for the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from moorage.llm.vectors import Build, Search, nearest, widened

LEAF = 512
SAMPLE = 64  # points that the spread of a vantage point is judged on
TRIED = 8  # vantage points tried
FACTORS = (5.0, 3.0, 2.0, 1.5, 1.2, 1.0)
SAMPLED = 64
RECALL = 0.97
ROUNDING = 1e-9


@dataclass
class Node:
    points: np.ndarray | None = None
    vantage: int = 0
    radius: float = 0.0
    inside: Node | None = None
    outside: Node | None = None


class VantageTree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, factor: float | None = None) -> None:
        order = np.lexsort((ids, *vectors.T)) if vectors.shape[1] else np.argsort(ids)
        ids, vectors = ids[order], vectors[order]
        fresh = np.ones(len(ids), bool)
        fresh[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
        starts = np.flatnonzero(fresh)
        self.ids = [ids[a:b][: k + 1] for a, b in zip(starts, [*starts[1:], len(ids)], strict=True)]
        self.vectors = vectors[starts]
        norms = (self.vectors**2).sum(axis=1)
        self.largest = float(norms.max(initial=0))
        self.lifted = np.hstack([self.vectors, np.sqrt(np.maximum(self.largest - norms, 0))[:, None]])
        self.k, self.factor, self.visited = k, factor or 1.0, 0
        self.rng = np.random.default_rng(0)
        self.root = self._build(np.arange(len(starts)))
        if factor is None and self.root.points is None:
            self.factor = self._chosen_factor()

    def _chosen_factor(self) -> float:
        """The largest factor that finds enough of what the sampled vectors have as neighbours."""
        rows = self.vectors[np.sort(self.rng.choice(len(self.vectors), min(SAMPLED, len(self.vectors)), replace=False))]
        products = rows @ self.vectors.T
        k = min(self.k, products.shape[1])
        least = np.partition(products, products.shape[1] - k, axis=1)[:, products.shape[1] - k] - ROUNDING
        for self.factor in FACTORS:
            list(self.search(np.full(len(rows), -1), rows))
            met = np.take_along_axis(products, np.maximum(self.found, 0), 1) >= least[:, None]
            hits = np.minimum((met & (self.found >= 0)).sum(axis=1), k)
            if hits.sum() >= RECALL * k * len(rows):
                break
        self.visited = 0
        return self.factor

    def _distances(self, points: np.ndarray, vantage: int) -> np.ndarray:
        return np.sqrt(((self.lifted[points] - self.lifted[vantage]) ** 2).sum(axis=1))

    def _build(self, points: np.ndarray) -> Node:
        if len(points) <= LEAF:
            return Node(points=points)
        judged = self.rng.choice(points, min(SAMPLE, len(points)), replace=False)
        tried = self.rng.choice(points, TRIED, replace=False)
        vantage = int(max(tried, key=lambda v: self._distances(judged, v).std()))
        distances = self._distances(points, vantage)
        radius = float(np.median(distances))
        near = distances <= radius
        if near.all() or not near.any():
            return Node(points=points)
        return Node(None, vantage, radius, self._build(points[near]), self._build(points[~near]))

    def search(self, names: np.ndarray, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        width = self.vectors.shape[1]
        queries = widened(vectors, width)[:, :width]
        self.queries = np.hstack([queries, np.zeros((len(queries), 1))])
        self.norms = (queries**2).sum(axis=1)
        wanted = self.k + 1
        self.best = np.full((len(queries), wanted), np.inf)
        self.found = np.full((len(queries), wanted), -1)
        self._visit(self.root, np.arange(len(queries)))
        for row, name in enumerate(names):
            points = self.found[row][self.found[row] >= 0]
            scores = (self.vectors[points] * queries[row]).sum(axis=1)
            pairs = sorted((-s, int(i)) for s, p in zip(scores, points, strict=True) for i in self.ids[p] if i != name)[: self.k]
            yield np.full(len(pairs), name, np.int64), np.array([i for _, i in pairs], np.int64), np.array([-s for s, _ in pairs], np.float64)

    def _visit(self, node: Node, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if node.points is not None:
            self._scan(node.points, rows)
            return
        distances = np.sqrt(((self.queries[rows] - self.lifted[node.vantage]) ** 2).sum(axis=1))
        apart = distances - node.radius
        for side, first, second in ((apart <= 0, node.inside, node.outside), (apart > 0, node.outside, node.inside)):
            own, gap = rows[side], np.abs(apart[side])
            self._visit(first, own)
            left = gap * self.factor <= self.best[own, -1] + ROUNDING
            self._visit(second, own[left])

    def _scan(self, points: np.ndarray, rows: np.ndarray) -> None:
        self.visited += len(points) * len(rows)
        products = self.queries[rows] @ self.lifted[points].T
        # As products: what is nearer than the k-th best so far.
        least = (self.norms[rows] + self.largest - self.best[rows, -1] ** 2) / 2 - ROUNDING
        at, place = np.nonzero(products >= least[:, None])
        if not len(at):
            return
        touched, counts = np.unique(at, return_counts=True)
        column = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
        line = np.repeat(np.arange(len(touched)), counts)
        shape = (len(touched), int(counts.max()))
        distances, names = np.full(shape, np.inf), np.full(shape, -1)
        nearness = self.norms[rows[at]] + self.largest - 2 * products[at, place]
        distances[line, column] = np.sqrt(np.maximum(nearness, 0))
        names[line, column] = points[place]
        target = rows[touched]
        together = np.hstack([self.best[target], distances])
        order = np.argsort(together, axis=1, kind="stable")[:, : self.k + 1]
        self.best[target] = np.take_along_axis(together, order, 1)
        self.found[target] = np.take_along_axis(np.hstack([self.found[target], names]), order, 1)


def tree_search(k: int, factor: float | None) -> Build:
    def build(ids: np.ndarray, vectors: np.ndarray) -> Search:
        return VantageTree(ids, vectors, k, factor).search

    return build


def near_neighbours(rows: DataFrame, is_query: Column, k: int, factor: float | None = None) -> DataFrame:
    """query_id, rank, vec_id and score, the inner product, of the ``k`` nearest found of each query.

    Without a ``factor`` each shard chooses its own by the recall it measures.
    """
    not_zero = F.exists("vector", lambda x: x != 0)
    return nearest(rows, is_query, tree_search(k, factor), k, "double", not_zero)
