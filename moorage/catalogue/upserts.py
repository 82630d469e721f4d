"""Upserts of events into a landing table that is behind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from moorage.catalogue.tables import scratch_table, table, text
from moorage.functions.documents import canonical_json, document_hash, strict_json
from moorage.operators.merge import action_counts, in_collection, latest_documents, merged, upsert_actions
from moorage.operators.profile import upsert_estimate
from moorage.plans.document_load import load_documents
from moorage.session import materialise
from moorage.spec import DocumentLoad

STORED_AT = "2024-01-01 00:00:00"
LOADED_AT = "2025-01-01 00:00:00"


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing table without the signups; the hash of an error is missing, that of a small value is old.

    A second collection holds the same ids, and must come through untouched. Views have no id at all.
    """
    events = table(spark, sf_dir, "events").withColumn("doc", strict_json(F.col("props")))
    digest = (
        F.when(F.col("event_type") == "error", F.lit(None))
        .when(F.col("value") < 50, F.md5(F.concat(F.lit("old"), text("event_id"))))
        .otherwise(document_hash(F.col("doc")))
    )
    stored = events.where(F.col("event_type") != "signup").select(
        F.col("event_id").alias("row_id"),
        F.to_variant_object(F.struct(F.lit(0).alias("k"))).alias("row_data"),
        F.when(F.col("event_type") != "view", text("event_id")).alias("document_id"),
        digest.alias("document_hash"),
        F.lit(STORED_AT).cast("timestamp_ntz").alias("load_timestamp"),
        F.lit("events").alias("collection_name"),
    )
    return stored.unionByName(stored.withColumn("collection_name", F.lit("archive")))


def arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events but the purchases, every event twice with the newer content last."""
    events = table(spark, sf_dir, "events").where(F.col("event_type") != "purchase")
    old = events.select("event_id", F.concat(F.lit('{"k":'), text("event_id"), F.lit("}")).alias("raw"), F.lit(1).alias("seq"))
    new = events.select("event_id", F.col("props").alias("raw"), F.lit(2).alias("seq"))
    docs = old.unionByName(new).select(
        text("event_id").alias("document_id"), "seq", strict_json(F.col("raw")).alias("row_data")
    )
    hashed = docs.withColumn("document_hash", document_hash(F.col("row_data"))).withColumn(
        "collection_name", F.lit("events")
    )
    return latest_documents(hashed, "seq").drop("seq")


def upsert_actions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert_actions(in_collection(landing(spark, sf_dir), "events"), arriving(spark, sf_dir))


def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return action_counts(upsert_actions_query(spark, sf_dir))


def upsert_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit(LOADED_AT).cast("timestamp_ntz")
    source = materialise(arriving(spark, sf_dir), "arriving")
    rows = merged(landing(spark, sf_dir), source, "events", now)
    return rows.select(
        "collection_name",
        F.coalesce(text("row_id"), F.lit("new")).alias("row_id"),
        "document_id",
        "document_hash",
        canonical_json(F.col("row_data")).alias("document"),
        (F.col("load_timestamp") == now).alias("reloaded"),
    )


def upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a table on disk: load, load again with changes, load again without."""
    name, location = scratch_table(spark)
    events = table(spark, sf_dir, "events")
    body = F.concat(F.lit('{"_id":'), text("event_id"), F.lit(","), F.substr("props", F.lit(2)))
    changed = F.when(F.col("value") < 50, F.concat(F.left(body, F.length(body) - 1), F.lit(',"seen":true}'))).otherwise(body)
    first = events.where(F.col("event_type") != "signup").select(body.alias("raw"))
    second = events.where(F.col("event_type") != "purchase").select(changed.alias("raw"))
    load_documents(spark, DocumentLoad(collection="archive", table=name), first, location)
    load_documents(spark, DocumentLoad(collection="events", table=name), first)
    for _ in range(2):
        load_documents(spark, DocumentLoad(collection="events", table=name, mode="upsert"), second)
    rows = spark.table(name)
    return rows.select("collection_name", "document_id", canonical_json(F.col("row_data")).alias("document"))


def dry_run_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events").agg(F.count("*").alias("to_export"))
    return upsert_estimate(landing(spark, sf_dir), "events", counts)


NEW = "replace(props, ' ', '')"
LANDING = f"""
    SELECT event_id AS row_id, CASE WHEN event_type <> 'view' THEN CAST(event_id AS VARCHAR) END AS document_id,
           CASE WHEN event_type = 'error' THEN NULL WHEN value < 50 THEN md5('old' || event_id)
                ELSE md5({NEW}) END AS document_hash, '{{"k":0}}' AS document
    FROM events WHERE event_type <> 'signup'"""
ARRIVING = f"""
    SELECT CAST(event_id AS VARCHAR) AS document_id, md5({NEW}) AS new_hash, {NEW} AS new_document
    FROM events WHERE event_type <> 'purchase'"""
ACTIONS = f"""
    SELECT coalesce(t.document_id, s.document_id) AS document_id,
           CASE WHEN t.document_id IS NULL THEN 'insert' WHEN s.document_id IS NULL THEN 'keep'
                WHEN t.document_hash IS NULL OR t.document_hash <> s.new_hash THEN 'update'
                ELSE 'unchanged' END AS action
    FROM (SELECT * FROM ({LANDING}) WHERE document_id IS NOT NULL) t
         FULL JOIN ({ARRIVING}) s ON t.document_id = s.document_id"""

QUERIES = {
    "upsert_actions": upsert_actions_query,
    "upsert_counts": upsert_counts,
    "upsert_result": upsert_result,
    "upsert_table": upsert_table,
    "dry_run_upsert": dry_run_upsert,
}

BODY = """'{"_id":"' || event_id || '",' || substr(replace(props, ' ', ''), 2)"""

SQL = {
    "upsert_actions": ACTIONS,
    "upsert_counts": f"SELECT action, count(*) AS n FROM ({ACTIONS}) GROUP BY action",
    "upsert_result": f"""
        WITH joined AS (
            SELECT t.*, s.new_hash, s.new_document,
                   s.new_hash IS NOT NULL AND (t.document_hash IS NULL OR t.document_hash <> s.new_hash) AS rewrite
            FROM ({LANDING}) t LEFT JOIN ({ARRIVING}) s ON t.document_id = s.document_id)
        SELECT 'events' AS collection_name, CAST(row_id AS VARCHAR) AS row_id, document_id,
               CASE WHEN rewrite THEN new_hash ELSE document_hash END AS document_hash,
               CASE WHEN rewrite THEN new_document ELSE document END AS document, rewrite AS reloaded
        FROM joined
        UNION ALL
        SELECT 'events', 'new', document_id, new_hash, new_document, true FROM ({ARRIVING}) s
        WHERE NOT EXISTS (SELECT 1 FROM ({LANDING}) t WHERE t.document_id = s.document_id)
        UNION ALL
        SELECT 'archive', CAST(row_id AS VARCHAR), document_id, document_hash, document, false FROM ({LANDING})""",
    "upsert_table": f"""
        SELECT 'archive' AS collection_name, CAST(event_id AS VARCHAR) AS document_id, {BODY} AS document
        FROM events WHERE event_type <> 'signup'
        UNION ALL
        SELECT 'events', CAST(event_id AS VARCHAR),
               CASE WHEN value < 50 AND event_type <> 'purchase'
                    THEN left({BODY}, length({BODY}) - 1) || ',"seen":true}}' ELSE {BODY} END
        FROM events""",
    "dry_run_upsert": f"""
        SELECT table_rows, collection_rows, known_ids, to_export, least(known_ids, to_export) AS updates_up_to,
               greatest(0, to_export - known_ids) AS inserts_at_least
        FROM (SELECT 2 * count(*) AS table_rows, count(*) AS collection_rows, count(DISTINCT document_id) AS known_ids
              FROM ({LANDING})), (SELECT count(*) AS to_export FROM events)""",
}
