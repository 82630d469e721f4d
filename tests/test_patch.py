import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from moorage.functions.values import fee_list
from moorage.operators.patch import (
    apply_patches,
    apply_patches_to_documents,
    build_patches,
    operations,
    patch_stats,
    repeated_keys,
)
from moorage.plans.document_load import load_documents
from moorage.plans.patch_load import dry_run, patch_documents, patch_table, run_patch, send_patches
from moorage.sources.tables import count_rows, source_rows
from moorage.session import new_location
from moorage.spec import DocumentLoad, PatchLoad, parse_field_mapping, preset, with_options
from tests.conftest import plan_of, rows_of


def stamp():
    return F.lit("2025-06-01 00:00:00").cast("timestamp")


def view(spark):
    return spark.sql(
        """SELECT * FROM VALUES
             ('k1', 1.50BD, '[{"feeAmount":"1.5"},{"feeAmount":"x"},7]', TIMESTAMP_NTZ'2025-01-01 10:00:00', 1),
             ('k2', NULL, '{"feeAmount":2}', NULL, 1), ('k3', NULL, ' ', NULL, 1), (NULL, 1BD, NULL, NULL, 1),
             (' \t', 1BD, NULL, NULL, 1), ('zz', 1BD, NULL, NULL, 1), ('k1', 2BD, NULL, NULL, 2), ('k4', NULL, 'bad', NULL, 1)
           AS t(TRANSACTION_ID, AMOUNT, FEES, TS, SEQ)"""
    )


def target(spark):
    return spark.sql(
        """SELECT * FROM VALUES ('k1', 1.0D, 'a'), ('k2', 2.0D, 'b'), ('k3', 3.0D, 'c'), ('k4', 4.0D, 'd'), (NULL, 5.0D, 'e')
           AS t(transactionId, Amount, other)"""
    )


MAPPING = {"AMOUNT": "Amount", "FEES": "fees", "TS": "ts", "NOPE": "nope"}


def fees(spark, text, schema="x string"):
    df = spark.createDataFrame([(text,)], schema)
    got = df.select(F.to_json(F.to_variant_object(fee_list(F.col("x"), df.schema["x"].dataType)))).first()[0]
    return None if got is None else json.loads(got)


@pytest.mark.parametrize(
    "text, expected",
    [
        ('[{"feeAmount":"1.5"},{"feeAmount":"x"},7]', [{"feeAmount": 1.5}, {"feeAmount": 0.0}, 7]),
        ('{"feeAmount":2,"n":"k"}', [{"feeAmount": 2.0, "n": "k"}]),
        ('[{"feeAmount":null},{"feeAmount":true},{"feeAmount":[1]},{"n":1}]', [{"feeAmount": 0.0}, {"feeAmount": 1.0}, {"feeAmount": 0.0}, {"n": 1}]),
        ('[{"feeAmount":" 1e2 "},{"feeAmount":"1_000"},{"feeAmount":"1.5d"},{"feeAmount":""}]', [{"feeAmount": 100.0}, {"feeAmount": 1000.0}, {"feeAmount": 0.0}, {"feeAmount": 0.0}]),
        ("bad", []), ("null", []), ("{}", []), ("0", []), ("0.0", []), ('""', []), ("false", []), ("[]", []),
        ("7", [7]), ("true", [True]), ('"x"', ["x"]), ('{"a":1} x', []),
        ("", None), ("  ", None), (None, None),
    ],
)
def test_fee_texts(spark, text, expected):
    assert fees(spark, text) == expected


def test_fee_values_that_are_not_text(spark):
    assert fees(spark, [{"feeAmount": "3"}, {"feeAmount": "x"}], "x array<map<string,string>>") == [{"feeAmount": 3.0}, {"feeAmount": 0.0}]
    assert fees(spark, {"feeAmount": 3}, "x struct<feeAmount: int>") == [{"feeAmount": 3.0}]
    assert fees(spark, 5, "x int") == [5]
    assert fees(spark, 0, "x int") == []
    assert fees(spark, None, "x int") is None


def test_patches_are_sparse(spark):
    patches = build_patches(view(spark), MAPPING, "TRANSACTION_ID")
    assert patches.schema["patch"].dataType.names == ["Amount", "fees", "ts"]
    assert rows_of(patches.groupBy("state").count()) == [("no_source_fields", 1), ("op", 5), ("skipped_empty", 1), ("skipped_null", 1)]
    first = patches.where("match_key = 'k1' and patch.ts is not null").select("patch.ts").first()
    assert first.ts.astimezone(timezone.utc) == datetime(2025, 1, 1, 10, tzinfo=timezone.utc)
    with pytest.raises(ValueError):
        build_patches(view(spark), {"NOPE": "x"}, "TRANSACTION_ID")


def test_times_without_zone_are_utc_in_any_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        times = spark.sql("SELECT 'k' AS id, TIMESTAMP_NTZ'2025-03-09 02:30:00.000001' AS t")  # an hour New York skips
        patch = build_patches(times, {"t": "t"}, "id")
        assert patch.select(F.unix_micros("patch.t")).first()[0] == 1741487400000001
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_patches_of_one_key_apply_in_order(spark):
    patches = build_patches(view(spark), MAPPING, "TRANSACTION_ID", "SEQ")
    ops = {r.match_key: r for r in operations(patches).select("match_key", "patch.Amount", F.size("patch.fees").alias("n")).collect()}
    assert set(ops) == {"k1", "k2", "zz", "k4"}
    assert (float(ops["k1"].Amount), ops["k1"].n) == (2.0, 3)  # amount of the second, fees of the first
    assert rows_of(repeated_keys(build_patches(view(spark), MAPPING, "TRANSACTION_ID"))) == [("k1", 2)]


def test_apply_updates_and_never_inserts(spark):
    patches = build_patches(view(spark), MAPPING, "TRANSACTION_ID", "SEQ")
    rows = apply_patches(target(spark), patches, "transactionId", stamp())
    assert rows.columns == ["transactionId", "Amount", "other", "fees", "ts", "recon_ops_updated_at", "recon_ops_version"]
    shown = rows.select("transactionId", "Amount", "other", F.to_json("fees"), F.col("recon_ops_updated_at") == stamp(), "recon_ops_version")
    assert rows_of(shown) == sorted(
        [
            ("k1", 2.0, "a", '[{"feeAmount":1.5},{"feeAmount":0.0},7]', True, True), ("k2", 2.0, "b", '[{"feeAmount":2.0}]', True, True),
            ("k3", 3.0, "c", None, None, None), ("k4", 4.0, "d", "[]", True, True), (None, 5.0, "e", None, None, None),
        ], key=repr)
    assert "Python" not in plan_of(rows) and "Cartesian" not in plan_of(rows) and "NestedLoop" not in plan_of(rows)


def test_applying_again_changes_nothing_but_the_audit_time(spark):
    patches = build_patches(view(spark), {"AMOUNT": "Amount"}, "TRANSACTION_ID", "SEQ")
    once = apply_patches(target(spark), patches, "transactionId", stamp())
    assert rows_of(apply_patches(once, patches, "transactionId", stamp())) == rows_of(once)
    assert patch_stats(once, patches, "transactionId").first().changed == 0


def test_stats(spark):
    patches = build_patches(view(spark), MAPPING, "TRANSACTION_ID", "SEQ")
    assert patch_stats(target(spark), patches, "transactionId").first().asDict() == {
        "records": 8, "matched": 3, "changed": 3, "errors": 0, "skipped_null": 1, "skipped_empty": 1, "no_source_fields": 1,
        "not_found": 1, "duplicates": 1,
    }


def test_only_the_first_of_several_matches_is_touched(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "x"), ("b", 1, "x"), (None, 1, "x")], "k string, at int, v string")
    source = spark.createDataFrame([("a", "new"), ("c", "new")], "k string, v string")
    patches = build_patches(source, {"v": "v"}, "k")
    got = apply_patches(rows, patches, "k", stamp(), first_by="at").select("k", "at", "v")
    assert rows_of(got) == sorted([("a", 1, "new"), ("a", 2, "x"), ("b", 1, "x"), (None, 1, "x")], key=repr)
    stats = patch_stats(rows, patches, "k", first_by="at").first()
    assert (stats.matched, stats.changed, stats.not_found) == (1, 1, 1)


def test_an_operation_with_several_target_rows_counts_once(spark):
    rows = spark.createDataFrame([("a", "old"), ("a", "new"), ("b", "x")], "k string, v string")
    patches = build_patches(spark.createDataFrame([("a", "new"), ("z", "new")], "k string, v string"), {"v": "v"}, "k")
    stats = patch_stats(rows, patches, "k").first()
    assert (stats.matched, stats.changed, stats.not_found) == (1, 1, 1)


def test_keys_and_values_of_another_kind_are_refused(spark):
    numbers = spark.createDataFrame([(1, "x")], "k long, v string")
    words = build_patches(spark.createDataFrame([("1", "y")], "k string, v string"), {"v": "v"}, "k")
    with pytest.raises(TypeError):
        apply_patches(numbers, words, "k")
    wrong = build_patches(spark.createDataFrame([(1, "y")], "k long, v string"), {"v": "n"}, "k")
    with pytest.raises(TypeError):
        apply_patches(spark.createDataFrame([(1, 2)], "k long, n int"), wrong, "k")


def test_documents_are_patched_in_place(spark):
    docs = [{"transactionId": "k1", "s": {"a": 1}}, {"transactionId": "k2"}, {"transactionId": 5}, {"x": 1}]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "t string").select(F.parse_json("t").alias("doc"))
    patches = build_patches(view(spark), {"AMOUNT": "s.amount", "FEES": "fees"}, "TRANSACTION_ID", "SEQ")
    got = [json.loads(r[0]) for r in apply_patches_to_documents(df, patches, "transactionId", updated_at=stamp()).select(F.to_json("doc")).collect()]
    audit = {"recon_ops_updated_at": "2025-06-01 00:00:00+00:00", "recon_ops_version": True}
    assert sorted(got, key=str) == sorted(
        [
            {"transactionId": "k1", "s": {"a": 1, "amount": 2}, "fees": [{"feeAmount": 1.5}, {"feeAmount": 0.0}, 7], **audit},
            {"transactionId": "k2", "fees": [{"feeAmount": 2.0}], **audit}, {"transactionId": 5}, {"x": 1},
        ], key=str)


def test_run(spark, tmp_path):
    load = PatchLoad("V", "c", "TRANSACTION_ID", "transactionId", MAPPING, where="SEQ = 1 OR AMOUNT > 1", order_by="SEQ")
    result = run_patch(load, view(spark), target(spark))
    assert result.stats.first().matched == 3 and result.rows.count() == 5
    unordered = PatchLoad("V", "c", "TRANSACTION_ID", "transactionId", MAPPING)
    with pytest.raises(ValueError):
        run_patch(unordered, view(spark), target(spark))
    single = PatchLoad("V", "c", "TRANSACTION_ID", "transactionId", MAPPING, where="SEQ = 1")
    assert run_patch(single, view(spark), target(spark)).stats.first().matched == 3
    send_patches(PatchLoad("V", "c", "TRANSACTION_ID", "transactionId", {"AMOUNT": "Amount"}, where="SEQ = 2"), view(spark), "parquet", {"path": str(tmp_path / "out")})
    sent = spark.read.parquet(str(tmp_path / "out"))
    assert sent.columns == ["transactionId", "Amount", "recon_ops_updated_at", "recon_ops_version"] and sent.count() == 1


def test_run_on_a_table(spark, table):
    view(spark).createOrReplaceTempView("V")
    target(spark).write.saveAsTable(table)
    load = PatchLoad("V", "c", "TRANSACTION_ID", "transactionId", {"AMOUNT": "Amount", "TS": "ts"}, order_by="SEQ")
    tried = patch_table(spark, with_options(load, {"dry_run": "true"}), table)
    assert tried.counters == {"records": 8, "batches": 1} and spark.table(table).columns == target(spark).columns
    run = patch_table(spark, load, table)
    assert (run.counters["matched"], run.counters["changed"], run.counters["not_found"]) == (1, 1, 1)
    assert run.finished >= run.started
    shown = spark.table(table).select("transactionId", "Amount", F.unix_seconds("ts"), "recon_ops_version")
    expected = [("k1", 2.0, 1735725600, True), ("k2", 2.0, None, None), ("k3", 3.0, None, None), ("k4", 4.0, None, None), (None, 5.0, None, None)]
    assert rows_of(shown) == sorted(expected, key=repr)
    again = patch_table(spark, load, table)
    assert (again.counters["matched"], again.counters["changed"]) == (1, 0)


def test_dry_run(spark):
    load = PatchLoad("V", "c", "TRANSACTION_ID", "transactionId", {"AMOUNT": "Amount"}, where="SEQ = 1", batch_size=3)
    result = dry_run(load, view(spark))
    assert rows_of(result.stats) == [(7, 3)] and result.rows is None
    assert result.sample.count() == 1


def test_source_scan_reads_only_what_it_needs(spark, tmp_path):
    view(spark).write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    rows = source_rows(stored, "TRANSACTION_ID", preset("transactions").field_mapping, "SEQ = 1")
    assert rows.columns == ["TRANSACTION_ID", "AMOUNT"]
    plan = plan_of(rows)
    assert "EqualTo(SEQ,1)" in plan and "FEES" not in plan.split("ReadSchema")[-1]
    assert count_rows(stored, "SEQ = 1").first()[0] == 7


def test_field_mapping_text():
    assert parse_field_mapping("VALUE_DATE:valueDate, amount , x : y:z") == {"VALUE_DATE": "valueDate", "AMOUNT": "amount", "X": "y:z"}


def test_patches_on_a_document_table(spark):
    name = "patched_documents"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    raw = ['{"k":"k1","a":{"Amount":1.0}}', '{"k":"k2","a":{"Amount":2}}', '{"k":7}', '{"k":null}', "{}", '{"k":"k1","a":9}']
    location = new_location(spark, name)
    load_documents(spark, DocumentLoad("one", name, cluster=False), spark.createDataFrame([(r,) for r in raw], "raw string").coalesce(1), location)
    load_documents(spark, DocumentLoad("two", name), spark.createDataFrame([(raw[0],)], "raw string"), location)
    before = {r.row_id: r for r in spark.table(name).withColumn("row_data", F.to_json("row_data")).collect()}
    view(spark).createOrReplaceTempView("patch_view")
    load = PatchLoad("patch_view", "one", "TRANSACTION_ID", "k", {"AMOUNT": "a.Amount"}, order_by="SEQ")
    assert patch_documents(spark, with_options(load, {"dry_run": True}), name).stats.first().records == 8
    run = patch_documents(spark, load, name)
    counted = {k: run.counters[k] for k in ("records", "matched", "changed", "not_found", "duplicates", "no_source_fields")}
    assert counted == {"records": 8, "matched": 1, "changed": 1, "not_found": 1, "duplicates": 1, "no_source_fields": 3}
    after = {r.row_id: r for r in spark.table(name).withColumn("row_data", F.to_json("row_data")).collect()}
    assert after.keys() == before.keys()
    [touched] = [i for i in after if after[i] != before[i]]
    doc = json.loads(after[touched].row_data)
    assert touched == min(i for i in before if before[i].collection_name == "one" and '"k1"' in before[i].row_data)
    assert doc["a"]["Amount"] == 2 and doc["recon_ops_version"] is True and "recon_ops_updated_at" in doc
    assert after[touched].document_hash != before[touched].document_hash
    assert after[touched].load_timestamp == before[touched].load_timestamp
    again = patch_documents(spark, load, name).counters
    assert (again["matched"], again["changed"]) == (1, 0)
    none = patch_documents(spark, with_options(load, {"where": "SEQ > 5"}), name).counters
    assert (none["records"], none["matched"]) == (0, 0)
