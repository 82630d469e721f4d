"""Vectors of a table dealt to shards, and queries streamed through each shard.

Candidates are spread evenly over shards of a bounded number of rows. Every query goes to every shard, after its
candidates, so a task holds one shard and a batch of queries at a time, and candidates are shuffled once. Each shard
returns its own best; the best of all are chosen by query.

Vectors that are null or hold null or non-finite components, and rows without id, take no part. Vectors shorter than
others count as filled up with zeros. Ids may repeat: each row is a candidate of its own, but none for queries of the
same id; equal query rows are asked once, and of query rows with one id and different vectors the best results stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

SHARD_ROWS = 65536
SMALL_SHARD_ROWS = 8192  # as long as there are at most SMALL_SHARDS of them
SMALL_SHARDS = 64
QUERY_BATCH = 256

Search = Callable[[np.ndarray, np.ndarray], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]
Build = Callable[[np.ndarray, np.ndarray], Search]


def usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def shard_count(rows: int) -> int:
    return max(1, min(SMALL_SHARDS, rows // SMALL_SHARD_ROWS), -(-rows // SHARD_ROWS))


def padded(column: pa.Array, width: int = 0) -> np.ndarray:
    """Lists as rows of a matrix, filled up with zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = max(width, int(lengths.max(initial=0)))
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width)
    matrix = np.zeros((len(lengths), width))
    matrix[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return matrix


def widened(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1]))) if matrix.shape[1] < width else matrix


def searched(batches: Iterable[pa.RecordBatch], build: Build) -> Iterator[pa.RecordBatch]:
    """Runs of (shard, is_query) in order: candidates of a shard are gathered, then queries searched batch by batch."""
    current, ids, vectors, search = None, [], [], None
    for batch in batches:
        keys = np.array(batch.column("shard")) * 2 + np.array(batch.column("is_query"))
        edges = [0, *(np.flatnonzero(np.diff(keys)) + 1), len(keys)]
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            if start == end:
                continue
            part = batch.slice(start, end - start)
            shard, is_query = divmod(int(keys[start]), 2)
            if shard != current:
                current, ids, vectors, search = shard, [], [], None
            if not is_query:
                ids.append(np.array(part.column("vec_id")))
                vectors.append(padded(part.column("vector")))
                continue
            if not ids:
                continue
            if search is None:
                width = max(v.shape[1] for v in vectors)
                search = build(np.concatenate(ids), np.concatenate([widened(v, width) for v in vectors]))
                ids, vectors = [None], []
            for at in range(0, len(part), QUERY_BATCH):
                asked = part.slice(at, QUERY_BATCH)
                names, found, scores = zip(*search(np.array(asked.column("vec_id")), padded(asked.column("vector"))), strict=True)
                columns = [np.concatenate(names), np.concatenate(found), np.concatenate(scores)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])


def nearest(rows: DataFrame, is_query: Column, build: Build, k: int, score_type: str, keep: Column | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best candidates of each query; of equal scores the smaller id first.

    ``rows`` has vec_id and vector. ``build`` makes the search of one shard from its ids and vectors.
    """
    valid = rows.where(F.col("vec_id").isNotNull() & usable("vector"))
    if keep is not None:
        valid = valid.where(keep)
    shards = shard_count(valid.count())
    # Numbers by place in the scan: the same when a task is run again, and even for rows that are all alike.
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    candidates = valid.select(place.alias("shard"), F.lit(0).alias("is_query"), "vec_id", "vector")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    queries = valid.where(is_query).select("vec_id", "vector").distinct()
    asked = queries.select(every, F.lit(1).alias("is_query"), "vec_id", "vector")
    dealt = candidates.unionByName(asked).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "is_query")
    best = dealt.mapInArrow(lambda batches: searched(batches, build), f"query_id bigint, vec_id bigint, score {score_type}")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
