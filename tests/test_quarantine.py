from pyspark.sql import functions as F

from moorage.plans.quarantine import held_documents, load_with_quarantine, replay
from moorage.spec import DocumentLoad
from tests.conftest import rows_of

TEXTS = ['{"_id":"a","k":1}', '{"_id":"b","k":2} x', '{"_id":"b","k":2} x', '{"k":3}', '[1]', '{"_id":"c"', None]


def docs(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "raw string")


def held(spark, table):
    return rows_of(held_documents(spark, table, "c").select("bad_text", "error_type"))


def cut(text):
    return F.regexp_replace(text, " x$", "")


def test_bad_documents_are_held_once_and_landed_once(spark, table):
    load = DocumentLoad(collection="c", table=table, mode="upsert")
    assert held_documents(spark, table, "c").count() == 0
    for _ in range(2):
        load_with_quarantine(spark, load, docs(spark, TEXTS))
    kept = [("[1]", "not_an_object"), ('{"_id":"c"', "invalid_json"), ('{"k":3}', "missing_id")]
    assert held(spark, table) == [kept[0], ('{"_id":"b","k":2} x', "invalid_json"), *kept[1:]]
    assert replay(spark, load) is None
    assert replay(spark, load, cut).inserted == 1
    assert held(spark, table) == kept and replay(spark, load, cut) is None
    load_with_quarantine(spark, load, docs(spark, TEXTS))  # what was landed is not held anew
    assert held(spark, table) == kept
    assert rows_of(spark.table(table).select("document_id", F.to_json("row_data"))) == [
        ("a", '{"_id":"a","k":1}'), ("b", '{"_id":"b","k":2}')]


def test_another_rule_lets_documents_pass_and_collections_are_apart(spark, table):
    load_with_quarantine(spark, DocumentLoad(collection="c", table=table, mode="upsert"), docs(spark, TEXTS))
    load_with_quarantine(spark, DocumentLoad(collection="other", table=table, mode="upsert"), docs(spark, TEXTS[:4]))
    appended = replay(spark, DocumentLoad(collection="c", table=table))  # an append needs no id
    assert (appended.inserted, len(held(spark, table))) == (1, 3)
    assert held_documents(spark, table, "other").count() == 2
