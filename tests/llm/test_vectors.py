import numpy as np
import pytest
from pyspark.sql import functions as F

from moorage.llm import exact_search, vantage_tree, vectors
from moorage.llm.exact_search import VerticalShard, top_products
from moorage.llm.queries import op6_near_neighbours
from moorage.llm.vantage_tree import VantageTree, near_neighbours
from tests.llm.conftest import SMALL

SCHEMA = "vec_id bigint, vector array<float>, score string, shard int"


def brute(rows, step, k, integers):
    """Best of each query by scores of whole vectors, filled up with zeros."""
    width = max((len(v) for _, v in rows), default=0)
    held = []
    for i, v in rows:
        v = [float(np.float32(x)) for x in v] + [0.0] * (width - len(v))
        held.append((i, [int(np.floor(256 * x)) for x in v] if integers else v))
    found = []
    for q, a in held:
        if q % step == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in held if i != q)[:k]
            found += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores)]
    return sorted(found)


def random_rows(count, width, seed, copies=0):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=width).round(3).tolist()) for i in range(count)]
    return [(i, rows[5][1] if i >= count - copies else v) for i, v in rows]


@pytest.mark.parametrize("copies", [0, 40])
@pytest.mark.parametrize("width", [3, 8, 20])
def test_exact_search_of_a_shard(copies, width):
    rows = random_rows(150, width, 1, copies)
    ids, matrix = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float32).astype(float)
    shard = VerticalShard(ids, matrix, 5)
    asked = ids % 7 == 0
    found = [
        (int(q), r + 1, int(i), int(s))
        for names, places, scores in shard.search(ids[asked], matrix[asked])
        for r, (q, i, s) in enumerate(zip(names, places, scores))
    ]
    assert sorted(found) == brute(rows, 7, 5, True)


def test_exact_search_on_many_shards_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SMALL_SHARD_ROWS", 20)
    rows = random_rows(120, 9, 2, 50) + [(200, [0.5, 0.5]), (201, []), (202, [0.0] * 9)]
    odd = [(300, None), (301, [1.0, None]), (350, [float("nan")]), (400, [float("inf")] * 9), (None, [1.0] * 9)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + odd], SCHEMA)
    got = top_products(df, F.col("vec_id") % 10 == 0, 5).collect()
    assert sorted(map(tuple, got)) == brute(rows, 10, 5, True)


def test_products_beyond_doubles_and_longs(spark):
    rows = [(0, [3e9, 1.0, 5e-3]), (1, [3e9, 7.0, 5e-3]), (2, [3e9, -7.0, 5e-3]), (3, [3e38] * 3), (4, [1.0, 0.0, 0.0])]
    got = top_products(spark.createDataFrame([(i, v, "", 0) for i, v in rows], SCHEMA), F.col("vec_id") == 0, 9).collect()
    assert [(r.vec_id, r["rank"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1), (2, 2), (3, 3), (4, 4)]
    assert max(r.score for r in got) == 2**63 - 1


def test_rows_with_equal_ids(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [2.0]), (1, [2.0]), (2, [1.0])]
    df = spark.createDataFrame([(i, v, "", 0) for i, v in rows], SCHEMA)
    got = sorted(map(tuple, top_products(df, F.col("vec_id") == 0, 5).collect()))
    assert got == [(0, 1, 1, 2 * 65536), (0, 2, 1, 2 * 65536), (0, 3, 2, 65536)]


@pytest.mark.parametrize("copies", [0, 100])
def test_factor_one_is_exact(monkeypatch, copies):
    monkeypatch.setattr(vantage_tree, "LEAF", 8)
    rows = random_rows(300, 4, 3, copies)
    ids, matrix = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float32).astype(float)
    tree = VantageTree(ids, matrix, 5, factor=1.0)
    asked = ids % 9 == 0
    found = [
        (int(q), r + 1, int(i), pytest.approx(s))
        for names, places, scores in tree.search(ids[asked], matrix[asked])
        for r, (q, i, s) in enumerate(zip(names, places, scores))
    ]
    assert sorted(found, key=lambda r: r[:2]) == brute(rows, 9, 5, False)
    assert copies or tree.visited < 0.9 * len(ids) * asked.sum()


def test_neighbours_on_many_shards_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SMALL_SHARD_ROWS", 20)
    rows = random_rows(120, 6, 4, 50)
    odd = [(300, None), (301, [1.0, None]), (340, [0.0] * 6), (400, [float("-inf")]), (420, []), (None, [1.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + odd], SCHEMA)
    got = near_neighbours(df, F.col("vec_id") % 20 == 0, 7, factor=1.0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, pytest.approx(r.score)) for r in got) == brute(rows, 20, 7, False)


def test_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    best = {(q, i): s for q, _, i, s in brute(rows, 20, 20, False)}
    got = op6_near_neighbours(spark, SMALL).collect()
    assert len(got) == len(best) and [r.score for r in got if (r.query_id, r.vec_id) in best] == pytest.approx(
        [best[r.query_id, r.vec_id] for r in got if (r.query_id, r.vec_id) in best]
    )
    assert sum((r.query_id, r.vec_id) in best for r in got) >= 0.9 * len(best)


def made(kind, n=20_000, width=64):
    draw = np.random.default_rng(7)
    if kind.startswith("inner"):
        inner = int(kind.split()[1])
        rows = draw.standard_normal((n, inner)) @ draw.standard_normal((inner, width)) + 0.05 * draw.standard_normal((n, width))
    elif kind.startswith("clusters"):
        rows = draw.standard_normal((50, width))[draw.integers(50, size=n)] + 0.3 * draw.standard_normal((n, width))
    else:
        rows = draw.standard_normal((n, width))
    return rows / np.linalg.norm(rows, axis=1, keepdims=True) if kind.endswith("unit") else rows


@pytest.mark.parametrize("kind", ["isotropic unit", "isotropic", "inner 16 unit", "inner 8", "clusters", "clusters unit"])
def test_each_shard_keeps_its_recall(kind):
    rows = made(kind)
    tree = VantageTree(np.arange(len(rows)), rows, 20)
    assert tree.root.points is None and tree.factor in vantage_tree.FACTORS
    asked = np.arange(0, len(rows), 200)
    hits = 0
    products = rows[asked] @ rows.T
    products[np.arange(len(asked)), asked] = -np.inf
    for (_, found, _), row in zip(tree.search(asked, rows[asked]), products, strict=True):
        hits += len(set(found.tolist()) & set(np.argsort(-row)[:20].tolist()))
    assert hits >= 0.93 * 20 * len(asked)
