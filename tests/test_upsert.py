import json

import pytest
from pyspark.sql import functions as F

from moorage.operators.landing import failures
from moorage.operators.merge import (
    action_counts,
    in_collection,
    latest_documents,
    merged,
    updated_rows,
    upsert_actions,
)
from moorage.operators.profile import failure_counts, failure_examples, failure_report
from moorage.plans.document_load import NothingLanded, dry_run, load_documents, prepare
from moorage.sinks.tables import clustered, create_document_landing, merge_into, row_ids, table_location
from moorage.sources.collections import as_documents, documents_from, json_lines
from moorage.sources.tables import collection_counts, existing_ids, read_table, sample_rows
from moorage.spec import DocumentLoad, with_options
from tests.conftest import plan_of, rows_of


def texts(spark, *docs):
    rows = [(d if isinstance(d, str) else json.dumps(d), i) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "raw string, seq int")


def content(spark, table, collection="c"):
    rows = in_collection(spark.table(table), collection)
    return rows_of(rows.select("document_id", F.to_json("row_data")))


def counts(r):
    return {k: getattr(r, k) for k in ("read", "failed", "inserted", "updated", "unchanged", "duplicates")}


MIXED = [
    {"_id": "a", "x": 1}, {"_id": 12, "x": 2}, {"_id": {"$oid": "ff"}, "x": 3}, {"_id": None, "x": 4}, {"x": 5}, '{"a":1} x', "[1]",
    {"_id": "a", "x": 9}, {"_id": "", "x": 6},
]


def test_append_takes_documents_without_id_and_keeps_copies(spark, table):
    r = load_documents(spark, DocumentLoad(collection="c", table=table), texts(spark, *MIXED))
    assert counts(r) == {"read": 9, "failed": 2, "inserted": 7, "updated": 0, "unchanged": 0, "duplicates": 0}
    assert [i for i, _ in content(spark, table)].count("a") == 2
    assert sorted(e.error_type for e in r.failures.collect()) == ["invalid_json", "not_an_object"]
    load_documents(spark, DocumentLoad(collection="c", table=table), texts(spark, *MIXED))
    rows = spark.table(table)
    assert rows.count() == 14 and rows.select("row_id").distinct().count() == 14


def test_upsert_from_nothing_then_again_then_changed(spark, table):
    load = DocumentLoad(collection="c", table=table, mode="upsert", order_by="seq")
    r = load_documents(spark, load, texts(spark, *MIXED))
    assert counts(r) == {"read": 9, "failed": 5, "inserted": 3, "updated": 0, "unchanged": 0, "duplicates": 1}
    assert content(spark, table) == [("12", '{"_id":"12","x":2}'), ("a", '{"_id":"a","x":9}'), ("ff", '{"_id":"ff","x":3}')]
    failed = {(e.error_type, e.doc_id) for e in r.failures.collect()}
    assert failed == {("invalid_json", "unknown"), ("not_an_object", "unknown"), ("missing_id", "unknown")}

    before = rows_of(spark.table(table).select("row_id", "document_id", "load_timestamp"))
    again = load_documents(spark, load, texts(spark, *MIXED))
    assert (again.inserted, again.updated, again.unchanged) == (0, 0, 3)
    assert rows_of(spark.table(table).select("row_id", "document_id", "load_timestamp")) == before

    load_documents(spark, DocumentLoad(collection="other", table=table), texts(spark, {"_id": "a", "x": 1}))
    changed = load_documents(spark, load, texts(spark, {"x": 9, "_id": "a"}, {"_id": "ff", "x": 33}, {"_id": "new"}))
    assert (changed.inserted, changed.updated, changed.unchanged) == (1, 1, 1)
    assert content(spark, table) == [
        ("12", '{"_id":"12","x":2}'), ("a", '{"_id":"a","x":9}'), ("ff", '{"_id":"ff","x":33}'), ("new", '{"_id":"new"}'),
    ]
    assert content(spark, table, "other") == [("a", '{"_id":"a","x":1}')]
    rows = spark.table(table)
    assert rows.select("row_id").distinct().count() == rows.count() == 5
    old = {i: (n, t) for n, i, t in before}
    new = {r.document_id: (r.row_id, r.load_timestamp) for r in in_collection(rows, "c").collect()}
    assert new["a"] == old["a"] and new["12"] == old["12"]
    assert new["ff"][0] == old["ff"][0] and new["ff"][1] > old["ff"][1]
    # appending after the exchange goes to the same place
    load_documents(spark, DocumentLoad(collection="c", table=table), texts(spark, {"_id": "z"}))
    assert len(content(spark, table)) == 5


def test_clustered_append_counts_every_document_once(spark, table):
    load = DocumentLoad(collection="c", table=table, cluster=True)
    r = load_documents(spark, load, texts(spark, *MIXED))
    assert (r.read, r.failed, r.inserted) == (9, 2, 7) and spark.table(table).count() == 7


def test_append_new_skips_known_ids(spark, table):
    load_documents(spark, DocumentLoad(collection="c", table=table), texts(spark, {"_id": "a", "x": 1}))
    load = DocumentLoad(collection="c", table=table, mode="append_new")
    r = load_documents(spark, load, texts(spark, {"_id": "a", "x": 2}, {"_id": "b"}))
    assert (r.inserted, r.updated, r.unchanged) == (1, 0, 1)
    assert content(spark, table) == [("a", '{"_id":"a","x":1}'), ("b", '{"_id":"b"}')]


def test_filter_comes_before_projection_and_limit_after_filter(spark, table):
    docs = [{"_id": f"{i}", "valueDate": i, "o": {"k": i, "l": 1}, "drop": 1} for i in range(5)] + [{"_id": "9", "valueDate": "4"}]
    load = DocumentLoad(collection="c", table=table, query={"valueDate": {"$gte": 1}}, fields=("o.k",), limit=2)
    load_documents(spark, load, texts(spark, *docs))
    assert content(spark, table) == [("1", '{"_id":"1","o":{"k":1}}'), ("2", '{"_id":"2","o":{"k":2}}')]
    whole = prepare(DocumentLoad(collection="c", table="", limit=0), texts(spark, *docs))
    assert whole.count() == 6


def test_a_load_of_nothing_but_bad_documents_fails(spark, table):
    for mode in ("append", "upsert"):
        with pytest.raises(NothingLanded):
            load_documents(spark, DocumentLoad(collection="c", table=table, mode=mode), texts(spark, "{", "}"))
    nothing = load_documents(spark, DocumentLoad(collection="c", table=table), texts(spark, *MIXED).limit(0))
    assert nothing.read == 0
    with pytest.raises(ValueError):
        load_documents(spark, DocumentLoad(collection="c", table=table, mode="replace"), texts(spark, "{}"))


def test_the_text_is_parsed_once(spark):
    rows = prepare(DocumentLoad(collection="c", table="", fields=("x",), query={"x": 1}), texts(spark, *MIXED))
    plan = plan_of(rows.where("error_type is null").select("row_data", "document_id", "document_hash"))
    assert plan.count("parseJson") == 1
    assert "Python" not in plan


def test_typed_documents_and_json_lines(spark, table, tmp_path):
    (tmp_path / "d.json").write_text('{"_id":1}\n\n{"_id":2,"é":"\\u00e9"}\n')
    load_documents(spark, DocumentLoad(collection="c", table=table), json_lines(spark, str(tmp_path / "d.json")))
    assert content(spark, table) == [("1", '{"_id":"1"}'), ("2", '{"_id":"2","é":"é"}')]
    typed = as_documents(spark.sql("SELECT 7 AS _id, DATE'2025-01-02' AS day"))
    load_documents(spark, DocumentLoad(collection="t", table=table), typed)
    assert content(spark, table, "t") == [("7", '{"_id":"7","day":"2025-01-02"}')]


TARGET = "row_id long, row_data variant, document_id string, document_hash string, load_timestamp timestamp_ntz, collection_name string"


def target(spark):
    return spark.sql(
        """SELECT row_id, parse_json('{"old":1}') AS row_data, document_id, document_hash,
                  TIMESTAMP_NTZ'2024-01-01 00:00:00' AS load_timestamp, collection_name
           FROM VALUES (1L, 'same', 'h', 'c'), (2L, 'differs', 'x', 'c'), (3L, 'unhashed', NULL, 'c'), (4L, 'kept', 'h', 'c'),
                       (5L, 'twice', 'h', 'c'), (6L, 'twice', 'x', 'c'), (7L, NULL, 'h', 'c'), (8L, 'differs', 'x', 'other'),
                       (9L, '', 'h', 'c')
                AS t(row_id, document_id, document_hash, collection_name)"""
    )


def source(spark, *ids):
    rows = spark.createDataFrame([(i, "h", "c") for i in ids], "document_id string, document_hash string, collection_name string")
    return rows.withColumn("row_data", F.parse_json(F.lit('{"new":1}')))


def test_actions(spark):
    actions = upsert_actions(in_collection(target(spark), "c"), source(spark, "same", "differs", "unhashed", "twice", "new"))
    assert rows_of(actions) == [
        ("differs", "update"), ("kept", "keep"), ("new", "insert"), ("same", "unchanged"), ("twice", "update"), ("unhashed", "update"),
    ]
    assert rows_of(action_counts(actions)) == [("insert", 1), ("keep", 1), ("unchanged", 1), ("update", 3)]


def test_merged_table(spark):
    now = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    table = merged(target(spark), source(spark, "same", "differs", "unhashed", "twice", "new"), "c", now)
    assert table.columns == target(spark).columns
    shown = table.select("row_id", "document_id", F.to_json("row_data"), "document_hash", F.year("load_timestamp"), "collection_name")
    old, new = '{"old":1}', '{"new":1}'
    assert rows_of(shown) == sorted(
        [
            (1, "same", old, "h", 2024, "c"), (2, "differs", new, "h", 2025, "c"), (3, "unhashed", new, "h", 2025, "c"),
            (4, "kept", old, "h", 2024, "c"), (5, "twice", old, "h", 2024, "c"), (6, "twice", new, "h", 2025, "c"),
            (7, None, old, "h", 2024, "c"), (8, "differs", old, "x", 2024, "other"), (9, "", old, "h", 2024, "c"),
            (None, "new", new, "h", 2025, "c"),
        ], key=repr)


def test_merging_twice_is_merging_once(spark):
    now = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    arriving = source(spark, "same", "differs", "new")
    once = merged(target(spark), arriving, "c", now)
    twice = merged(once, arriving, "c", F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))
    as_text = lambda df: rows_of(df.withColumn("row_data", F.to_json("row_data")))
    assert as_text(once) == as_text(twice)


def test_latest_document_of_each_id(spark):
    rows = spark.createDataFrame(
        [("a", "h1", 1), ("a", "h2", 3), ("a", "h3", 2), ("b", "h1", None), ("b", "h2", 1), ("c", "h1", 1), ("c", "h2", 1)],
        "document_id string, document_hash string, seq int",
    )
    assert rows_of(latest_documents(rows, "seq")) == [("a", "h2", 3), ("b", "h2", 1), ("c", "h2", 1)]
    assert rows_of(latest_documents(rows).select("document_id", "document_hash")) == [("a", "h3"), ("b", "h2"), ("c", "h2")]
    assert plan_of(latest_documents(rows, "seq")).count("WindowGroupLimit") == 2


def test_rows_without_an_id_are_spread_over_tasks(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("row_id"), F.parse_json(F.lit("{}")).alias("row_data"), F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).alias("document_id"),
        F.lit("h").alias("document_hash"), F.localtimestamp().alias("load_timestamp"), F.lit("c").alias("collection_name"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = updated_rows(rows, source(spark, "0", "3", "999"))
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 4000 and max(sizes) < 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_small_source_does_not_shuffle_the_target(spark, tmp_path):
    target(spark).write.parquet(str(tmp_path / "t"))
    source(spark, "same", "new").write.parquet(str(tmp_path / "s"))
    stored, arriving = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s"))
    plan = plan_of(updated_rows(stored, arriving))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert "row_data" not in plan_of(upsert_actions(stored, arriving))


def test_failure_report(spark):
    failed = spark.createDataFrame(
        [(f"d{i}", "big", "m" * 500, "{}") for i in range(5)] + [("x", "small", "m", None)],
        "doc_id string, error_type string, error_message string, json_sample string",
    )
    assert [tuple(r) for r in failure_counts(failed).collect()] == [("big", 5, 2), ("small", 1, 0)]
    examples = failure_examples(failed)
    assert rows_of(examples.select("error_type", "nth", "doc_id", F.length("error_message"))) == [
        ("big", 1, "d0", 400), ("big", 2, "d1", 400), ("big", 3, "d2", 400), ("small", 1, "x", 1),
    ]
    assert failure_report(failed).count() == 4
    assert "WindowGroupLimit" in plan_of(examples)


def test_samples_of_bad_documents_are_cut(spark):
    rows = prepare(DocumentLoad(collection="c", table=""), texts(spark, '{"x":"' + "y" * 500))
    (failure,) = failures(rows).collect()
    assert (failure.doc_id, failure.error_type, len(failure.json_sample)) == ("unknown", "invalid_json", 200)


def test_dry_run(spark, table):
    load = DocumentLoad(collection="c", table=table, mode="upsert", batch_size=2)
    docs = texts(spark, {"_id": "a"}, {"_id": "b"}, {"_id": "c", "long": "x" * 600}, "bad")
    before = dry_run(spark, load, docs)
    assert before.upsert is None and not spark.catalog.tableExists(table)
    e = before.estimate.first()
    assert (e.matching, e.to_export, e.batches, e.sampled, e.sample_chars) == (3, 3, 2, 3, 11 + 11 + 621)
    assert [len(r.document) for r in before.samples.collect()] == [11, 11, 500]
    assert before.failures.count() == 1
    load_documents(spark, DocumentLoad(collection="c", table=table), docs.limit(1))
    load_documents(spark, DocumentLoad(collection="d", table=table), docs.limit(2))
    assert rows_of(dry_run(spark, load, docs).upsert) == [(3, 1, 1, 3, 1, 2)]


def test_reads_of_landing_tables(spark, table):
    assert read_table(spark, table) is None
    assert existing_ids(spark, None, "c").count() == 0
    load_documents(spark, DocumentLoad(collection="c", table=table), texts(spark, {"_id": "a"}, {"_id": "a"}, {"x": 1}, {"_id": ""}))
    load_documents(spark, DocumentLoad(collection="it's", table=table), texts(spark, {"_id": "b"}))
    load_documents(spark, DocumentLoad(collection="it's", table=table, mode="upsert"), texts(spark, {"_id": "b", "x": 1}))
    landing = read_table(spark, table)
    assert rows_of(existing_ids(spark, landing, "c")) == [("a",)]
    assert rows_of(existing_ids(spark, landing, "it's")) == [("b",)]
    assert dict(rows_of(collection_counts(landing))) == {"c": 4, "it's": 1}
    assert sample_rows(landing, 2, "c").count() == 2
    assert table_location(spark, table)


def test_clustered_rows_split_a_hot_key(spark):
    rows = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    laid_out = clustered(rows, ["k"], 6)
    sizes = [r["count"] for r in laid_out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1000 and laid_out.columns == ["k", "id"]


def test_merge_into_is_refused_only_by_the_table_format(spark, table):
    create_document_landing(spark, table)
    arriving = source(spark, "a").withColumn("load_timestamp", F.localtimestamp()).withColumn("row_id", F.lit(1).cast("long"))
    with pytest.raises(Exception, match="MERGE|row-level"):
        merge_into(arriving, table)


def test_typed_source_by_format(spark, tmp_path):
    spark.sql("SELECT 1 AS _id, DATE'2025-01-02' AS day").write.parquet(str(tmp_path / "p"))
    docs = documents_from(spark, "parquet", {"path": str(tmp_path / "p")})
    assert docs.select(F.to_json("doc")).first()[0] == '{"_id":1,"day":"2025-01-02"}'


def test_row_ids(spark):
    ids = [r[0] for r in spark.range(0, 1000, 1, 7).select(row_ids(100)).collect()]
    assert len(set(ids)) == 1000 and min(ids) == 100


def test_a_dry_run_by_option_writes_nothing(spark, table):
    load = with_options(DocumentLoad(collection="c", table=table, mode="upsert"), {"dry_run": "true"})
    result = load_documents(spark, load, texts(spark, '{"_id":1}', '{"_id":'))
    assert result.estimate.first().matching == 1 and result.failures.count() == 1
    assert not spark.catalog.tableExists(table)


def test_bad_documents_are_kept_whole(spark, table):
    long = '{"_id":1,"x":"' + "y" * 500
    result = load_documents(spark, DocumentLoad(collection="c", table=table), texts(spark, long, '{"_id":2}'))
    assert [r.bad_text for r in result.bad.collect()] == [long]
    assert [len(r.json_sample) for r in result.failures.collect()] == [200]
