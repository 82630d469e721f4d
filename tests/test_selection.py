"""Filters on typed tables: the same documents as filters on documents, with what columns can tell given to the scan."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from moorage.functions.predicates import comparable_columns, compile_filter, split_filter
from moorage.operators.landing import good_rows
from moorage.operators.profile import layout_ranges, range_overlaps
from moorage.plans.document_load import load_documents, prepare
from moorage.sinks.tables import clustered
from moorage.sources.collections import as_documents, selected_documents
from moorage.spec import DocumentLoad
from tests.conftest import plan_of, rows_of

SCHEMA = "_id bigint, s string, n int, x double, b boolean, d date, m decimal(6,2), sub struct<k: int, t: string>, l array<int>, `odd.name` int"
DAY = datetime.date(2025, 1, 2)
ROWS = [
    (1, "a", 5, 1.5, True, DAY, Decimal("1.50"), (1, "p"), [1, 2], 1),
    (2, None, None, None, None, None, None, None, None, None),
    (3, "b", -1, float("nan"), False, DAY, Decimal("2.00"), (None, "q"), [], 2),
    (4, "", 5, float("inf"), None, None, None, (5, None), [5], None),
    (None, "a", 0, 0.0, True, DAY, None, (1, "p"), None, 0),
]
QUERIES = [
    {},
    {"n": 5},
    {"n": {"$gte": 0, "$lt": 5.5}},
    {"n": "5"},
    {"n": None},
    {"s": {"$ne": "a"}},
    {"s": {"$in": ["a", None, 3]}},
    {"s": {"$nin": ["a", "b"]}},
    {"b": True, "x": {"$gt": 1}},
    {"x": {"$lte": 1.5}},
    {"d": "2025-01-02"},
    {"d": {"$gt": "2025"}},
    {"m": {"$gt": "1"}},
    {"m": 2},
    {"sub.k": 1},
    {"sub.k": None},
    {"sub.t": {"$gte": "p"}, "l": 2},
    {"l": 5},
    {"l": {"$size": 0}},
    {"s": {"$exists": False}},
    {"s": {"$regex": "^a"}, "n": {"$gt": 0}},
    {"n": {"$not": {"$gt": 0}}},
    {"$or": [{"n": 5}, {"s": "b"}]},
    {"$or": [{"n": 5}, {"l": 1}], "b": True},
    {"$nor": [{"n": 5}, {"b": False}]},
    {"$and": [{"n": {"$gt": -5}}, {"$and": [{"s": "a"}, {"l": 1}]}]},
    {"missing": None},
    {"missing": 1},
]


@pytest.fixture
def typed(spark, tmp_path):
    path = str(tmp_path / "typed")
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("query", QUERIES, ids=str)
def test_the_same_documents_either_way(typed, query):
    docs = as_documents(typed)
    whole = docs.where(compile_filter(query, F.col("doc"))).select(F.to_json("doc"))
    chosen, rest = selected_documents(typed, query)
    split = chosen.where(compile_filter(rest, F.col("doc"))).select(F.to_json("doc"))
    assert rows_of(split) == rows_of(whole)


def test_what_columns_tell_reaches_the_scan_and_other_columns_are_not_read(typed):
    load = DocumentLoad(collection="c", table="", query={"n": {"$gte": 3}, "sub.k": {"$lt": 9}, "l": {"$size": 2}}, fields=("s", "sub.t"))
    rows = prepare(load, typed)
    plan = plan_of(rows)
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(n,3)" in pushed and "LessThan(sub.k,9)" in pushed
    read = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "x:double" not in read and "m:decimal" not in read and "b:boolean" not in read
    assert [r.document_id for r in good_rows(rows).collect()] == ["1"]


def test_split_filter_leaves_to_documents_what_columns_cannot_tell(spark, typed):
    columns = comparable_columns(typed.schema)
    assert set(columns) == {"_id", "s", "n", "x", "b", "sub.k", "sub.t"}
    condition, rest = split_filter({"n": 1, "l": 2, "s": {"$regex": "a"}, "$or": [{"n": 1}, {"d": "x"}]}, columns)
    assert rest == {"$and": [{"l": 2}, {"s": {"$regex": "a"}}, {"$or": [{"n": 1}, {"d": "x"}]}]}
    assert condition is not None and split_filter({"l": 1}, columns)[0] is None and split_filter(None, columns) == (None, {})


def test_a_typed_table_is_landed_as_it_is(spark, typed, table):
    load = DocumentLoad(collection="c", table=table, query={"b": True}, fields=("s", "n"), order_by="x", mode="upsert")
    result = load_documents(spark, load, typed)
    assert (result.read, result.failed, result.inserted) == (2, 1, 1)
    assert rows_of(spark.table(table).select("document_id", F.to_json("row_data"))) == [("1", '{"_id":"1","n":5,"s":"a"}')]


def test_ranges_of_files_that_are_not_laid_out_overlap(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 4).select((F.col("id") * 7 % 1000).alias("k"))
    for name, laid_out in (("plain", rows), ("ranged", clustered(rows, ["k"], 4))):
        laid_out.write.parquet(f"{tmp_path}/{name}")
    found = {n: range_overlaps(layout_ranges(spark.read.parquet(f"{tmp_path}/{n}"), "k")).first() for n in ("plain", "ranged")}
    assert found["plain"].overlapping == 3 and tuple(found["ranged"]) == (4, 1000, 0)
    assert "rand(" not in plan_of(clustered(rows, ["k"], 4))
