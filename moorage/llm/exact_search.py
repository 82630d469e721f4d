"""Exact top-k search by columnar branch and bound.

A shard keeps its vectors in vertical layout, one row per dimension. For a query, inner products are accumulated
block of dimensions by block. After each block what is missing of a product lies within the remaining mass: at most
the product of the norms of what remains of both vectors. Candidates whose upper bound is below the k-th best lower
bound are dropped, and the others compacted, so later blocks touch fewer and fewer.

Components are quantised to floor(256 x), and products are of integers, so results are exact: doubles hold them as
long as no product of a shard can pass 2**53; beyond, Python's integers are used, and scores that 64 bits can't hold
are cut to the nearest they can.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame

from moorage.llm.vectors import Build, Search, nearest, widened

DIMENSIONS = 8  # of a block
STEPS = 256


def quantised(vectors: np.ndarray) -> np.ndarray:
    return np.floor(vectors * STEPS)


class VerticalShard:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.k = ids[order], k
        self.columns = np.ascontiguousarray(quantised(vectors)[order].T)
        self.largest = float(np.abs(self.columns).max(initial=0))
        self.edges = list(range(0, max(1, len(self.columns)), DIMENSIONS))
        self.rest = np.array([self._norms(self.columns[e + DIMENSIONS :]) for e in self.edges])

    def _norms(self, columns: np.ndarray) -> np.ndarray:
        return np.sqrt((columns**2).sum(axis=0)) if np.isfinite(self.largest**2) else np.full(columns.shape[1], np.inf)

    def _is_exact_in_doubles(self, query: np.ndarray) -> bool:
        return self.largest * float(np.abs(query).max(initial=0)) * max(1, len(query)) < 2**53

    def _whole(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all candidates in Python's integers."""
        ask = [int(x) for x in query]
        scores = [sum(a * int(b) for a, b in zip(ask, column, strict=True)) for column in self.columns.T]
        return np.arange(len(self.ids)), np.array([max(-(2**63), min(2**63 - 1, s)) for s in scores], np.int64)

    def bounded(self, name: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of candidates that may be among the best, all of these included."""
        alive = np.flatnonzero(self.ids != name)
        sums = np.zeros(len(alive))
        whole = len(alive) == len(self.ids)
        for number, edge in enumerate(self.edges):
            block = self.columns[edge : edge + DIMENSIONS]
            sums = sums + query[edge : edge + DIMENSIONS] @ (block if whole else block[:, alive])
            if len(alive) <= self.k:
                continue
            mass = np.sqrt((query[edge + DIMENSIONS :] ** 2).sum()) * self.rest[number][alive]
            mass = mass * (1 + 1e-9) + 1e-3
            least = np.partition(sums - mass, len(alive) - self.k)[len(alive) - self.k]
            stays = sums + mass >= least
            if not stays.all():
                alive, sums, whole = alive[stays], sums[stays], False
        return alive, sums.astype(np.int64)

    def search(self, names: np.ndarray, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        width = max(len(self.columns), vectors.shape[1])
        for name, query in zip(names, widened(quantised(vectors), width), strict=True):
            query = query[: len(self.columns)]
            if self._is_exact_in_doubles(query):
                places, scores = self.bounded(name, query)
            else:
                places, scores = self._whole(query)
                places, scores = places[self.ids != name], scores[self.ids != name]
            best = np.lexsort((self.ids[places], -scores.astype(object) if len(scores) and scores.min() == -(2**63) else -scores))[: self.k]
            yield np.full(len(best), name, np.int64), self.ids[places[best]], scores[best]


def shard_search(k: int) -> Build:
    def build(ids: np.ndarray, vectors: np.ndarray) -> Search:
        return VerticalShard(ids, vectors, k).search

    return build


def top_products(rows: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id and score, the integer inner product, of each query's ``k`` best. See ``vectors``."""
    return nearest(rows, is_query, shard_search(k), k, "bigint")
