import json

import pytest
from pyspark.sql import functions as F, types as T

from moorage.functions.predicates import compile_filter
from tests.conftest import plan_of

DOCS = [
    {"_id": 0, "v": 5},
    {"_id": 1, "v": "5"},
    {"_id": 2, "v": 5.5},
    {"_id": 3, "v": None},
    {"_id": 4},
    {"_id": 5, "v": True},
    {"_id": 6, "v": [1, 5, "z"]},
    {"_id": 7, "v": {"w": 5}},
    {"_id": 8, "v": 9007199254740993},
    {"_id": 9, "v": ""},
]
NESTED = [
    {"_id": 0, "a": {"b": 1}},
    {"_id": 1, "a": [{"b": 1}, {"b": 2}]},
    {"_id": 2, "a": [{"b": [3, 4]}, {"c": 1}]},
    {"_id": 3, "a": []},
    {"_id": 4, "a": 1},
    {"_id": 5},
    {"_id": 6, "a": {"b": {"c": 7}}},
    {"_id": 7, "a": [{"b": [{"c": 7}, {"c": 8}]}]},
]


@pytest.mark.parametrize(
    "query, ids",
    [
        ({"a.b": 1}, [0, 1]),
        ({"a.b": {"$gte": 2}}, [1, 2]),
        ({"a.b": {"$ne": 1}}, [2, 3, 4, 5, 6, 7]),
        ({"a.b": {"$in": [2, 4]}}, [1, 2]),
        ({"a.b": {"$exists": True}}, [0, 1, 2, 6, 7]),
        ({"a.b": {"$exists": False}}, [3, 4, 5]),
        ({"a.b.c": 7}, [6, 7]),
        ({"a.b.c": {"$gt": 7}}, [7]),
        ({"a.0.b": 1}, [1]),
        ({"a.1.b": {"$exists": True}}, [1]),
        ({"a.b": None}, [2, 4, 5]),
    ],
)
def test_paths_go_through_arrays(spark, query, ids):
    docs = spark.createDataFrame([(json.dumps(d),) for d in NESTED], "x string").select(F.parse_json("x").alias("doc"))
    found = docs.where(compile_filter(query, F.col("doc"))).select(F.try_variant_get("doc", "$._id", "int"))
    assert sorted(r[0] for r in found.collect()) == ids


@pytest.mark.parametrize(
    "query, ids",
    [
        ({}, range(10)),
        (None, range(10)),
        ({"v": 5}, [0, 6]),
        ({"v": {"$eq": "5"}}, [1]),
        ({"v": {"$gte": 5}}, [0, 2, 6, 8]),
        ({"v": {"$gt": 5}}, [2, 8]),
        ({"v": {"$lt": 5.2}}, [0, 6]),
        ({"v": {"$lte": "5"}}, [1, 9]),
        ({"v": {"$gt": 9007199254740992}}, [8]),
        ({"v": {"$ne": 5}}, [1, 2, 3, 4, 5, 7, 8, 9]),
        ({"v": None}, [3, 4]),
        ({"v": {"$ne": None}}, [0, 1, 2, 5, 6, 7, 8, 9]),
        ({"v": True}, [5]),
        ({"v": {"$in": [5, "5"]}}, [0, 1, 6]),
        ({"v": {"$nin": [5, "5", None]}}, [2, 5, 7, 8, 9]),
        ({"v": {"$exists": True}}, [0, 1, 2, 3, 5, 6, 7, 8, 9]),
        ({"v": {"$exists": False}}, [4]),
        ({"v.w": 5}, [7]),
        ({"v.w": {"$exists": False}}, [0, 1, 2, 3, 4, 5, 6, 8, 9]),
        ({"$or": [{"v": 5}, {"v": "5"}]}, [0, 1, 6]),
        ({"$and": [{"v": {"$gte": 5}}, {"_id": {"$lt": 6}}]}, [0, 2]),
        ({"$nor": [{"v": {"$exists": True}}]}, [4]),
        ({"v": {"$not": {"$gte": 5}}}, [1, 3, 4, 5, 7, 9]),
        ({"v": {"$gte": 5, "$lt": 5.5}}, [0, 6]),
        ({"v": {"$in": []}}, []),
    ],
)
def test_filters(spark, query, ids):
    docs = spark.createDataFrame([(json.dumps(d),) for d in DOCS], "x string").select(F.parse_json("x").alias("doc"))
    found = docs.where(compile_filter(query, F.col("doc"))).select(F.try_variant_get("doc", "$._id", "int"))
    assert sorted(r[0] for r in found.collect()) == list(ids)


def test_unknown_operators_are_refused():
    for query in ({"v": {"$where": "1"}}, {"$where": "1"}):
        with pytest.raises(ValueError):
            compile_filter(query, F.col("doc"))
    with pytest.raises(TypeError):
        compile_filter({"v": {"$gt": object()}}, F.col("doc"))


def test_promoted_columns_reach_the_scan(spark, tmp_path):
    rows = spark.range(10).select(F.col("id").alias("value_date"), F.to_variant_object(F.struct("id")).alias("doc"))
    rows.write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    query = {"valueDate": {"$gte": 3}, "id": {"$lt": 8}}
    found = stored.where(compile_filter(query, F.col("doc"), {"valueDate": (F.col("value_date"), T.LongType())}))
    assert "GreaterThanOrEqual(value_date,3)" in plan_of(found)
    assert sorted(r.value_date for r in found.collect()) == [3, 4, 5, 6, 7]


@pytest.mark.parametrize(
    ("query", "ids"),
    [
        ({"s": 5}, []),
        ({"s": "5"}, [1]),
        ({"s": {"$ne": 5}}, [1, 2]),
        ({"n": "5"}, []),
        ({"n": {"$in": ["5", 5, True]}}, [1]),
        ({"b": 1}, []),
        ({"b": True}, [2]),
        ({"n": {"$gt": 4.5}}, [1]),
        ({"s": {"$not": {"$gt": 5}}}, [1, 2]),
    ],
)
def test_promoted_columns_compare_within_their_kind(spark, query, ids):
    rows = spark.createDataFrame([(1, "5", 5, False), (2, "x", 4, True)], "id int, s string, n int, b boolean")
    columns = {f.name: (F.col(f.name), f.dataType) for f in rows.schema}
    found = rows.where(compile_filter(query, F.parse_json(F.lit("{}")), columns))
    assert sorted(r.id for r in found.collect()) == ids


ARRAYS = [
    {"_id": 0, "v": ["a", "b"], "n": 7},
    {"_id": 1, "v": ["b"], "n": 7.0},
    {"_id": 2, "v": "Abc", "n": "7"},
    {"_id": 3, "v": [], "n": -7},
    {"_id": 4, "v": [{"x": 1, "y": "p"}, {"x": 5, "y": "q"}], "n": [7, 8]},
    {"_id": 5, "v": None, "n": None},
    {"_id": 6, "n": True},
    {"_id": 7, "v": {"x": 1}, "n": {"a": 1}},
    {"_id": 8, "v": [1, 5, 20], "n": 2.5},
]


@pytest.mark.parametrize(
    "query, ids",
    [
        ({"v": {"$regex": "^a"}}, [0]),
        ({"v": {"$regex": "^a", "$options": "i"}}, [0, 2]),
        ({"v": {"$not": {"$regex": "b"}}}, [3, 4, 5, 6, 7, 8]),
        ({"v": {"$size": 2}}, [0, 4]),
        ({"v": {"$size": 0}}, [3]),
        ({"v": {"$all": ["a", "b"]}}, [0]),
        ({"v": {"$all": ["Abc"]}}, [2]),
        ({"v": {"$all": []}}, []),
        ({"v": {"$elemMatch": {"$gt": 4, "$lt": 10}}}, [8]),
        ({"v": {"$elemMatch": {"x": 1, "y": "q"}}}, []),
        ({"v": {"$elemMatch": {"x": {"$gt": 2}, "y": "q"}}}, [4]),
        ({"v": {"$elemMatch": {"$or": [{"x": 1}, {"x": 9}]}}}, [4]),
        ({"n": {"$mod": [4, 3]}}, [0, 1, 4]),
        ({"n": {"$mod": [4, -3]}}, [3]),
        ({"n": {"$mod": [2, 0]}}, [4, 8]),
        ({"n": {"$type": "number"}}, [0, 1, 3, 4, 8]),
        ({"n": {"$type": ["string", "bool"]}}, [2, 6]),
        ({"v": {"$type": "array"}}, [0, 1, 3, 4, 8]),
        ({"n": {"$type": "null"}}, [5]),
        ({"v": {"$type": "object"}}, [4, 7]),
    ],
)
def test_operators_on_arrays_texts_and_types(spark, query, ids):
    rows = spark.createDataFrame([(json.dumps(d),) for d in ARRAYS], "raw string").select(F.parse_json("raw").alias("doc"))
    found = rows.where(compile_filter(query, F.col("doc"))).select(F.variant_get("doc", "$._id", "int").alias("i"))
    assert sorted(r.i for r in found.collect()) == ids


def test_unknown_types_are_refused():
    with pytest.raises(ValueError, match="unknown type"):
        compile_filter({"v": {"$type": "regex"}}, F.col("doc"))
