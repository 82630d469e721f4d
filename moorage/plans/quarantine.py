"""Bad documents kept beside a landing table, and tried again once a rule has changed.

The table ``<landing table>_quarantine`` is a log. A document is held under the digest of its collection and text, however
often it arrives, and is left alone from the entry on that says it was landed. Replays in mode ``upsert`` or ``append_new``
can be run again after a failure; in mode ``append`` a run that dies between landing and log lands its documents twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from moorage.plans.document_load import DocumentResult, DryRun, load_documents, prepare
from moorage.session import materialise
from moorage.sinks.tables import location_clause
from moorage.sources.tables import read_table
from moorage.spec import DocumentLoad

HELD, LANDED = "held", "landed"


def quarantine_name(table: str) -> str:
    return f"{table}_quarantine"


def create_quarantine(spark: SparkSession, table: str, location: str | None = None) -> None:
    place = location_clause(None if location is None else f"{location}-quarantine")
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {quarantine_name(table)} (
            digest STRING, state STRING, bad_text STRING, error_type STRING, load_id STRING,
            recorded_at TIMESTAMP_NTZ, collection_name STRING) USING parquet{place}"""
    )


def _digest(text: Column, collection: str) -> Column:
    return F.sha2(F.concat(F.lit(f"{len(collection)}:{collection}:"), text), 256)


def held_documents(spark: SparkSession, table: str, collection: str) -> DataFrame:
    """Digest, text and reason of each document of a collection that is held, once."""
    log = read_table(spark, quarantine_name(table))
    if log is None:
        return spark.createDataFrame([], "digest string, bad_text string, error_type string")
    mine = log.where(F.col("collection_name") == F.lit(collection))
    # Text and reason come from the last entry; entries of one digest are added up before they are shuffled.
    last = F.max_by(F.struct("bad_text", "error_type"), "recorded_at").alias("last")
    known = mine.groupBy("digest").agg(F.bool_or(F.col("state") == LANDED).alias("done"), last).where(~F.col("done"))
    return known.select("digest", "last.bad_text", "last.error_type")


def _record(rows: DataFrame, state: str, table: str, collection: str, load_id: str) -> None:
    text = F.col("bad_text") if "bad_text" in rows.columns else F.lit(None).cast("string")
    reason = F.col("error_type") if "error_type" in rows.columns else F.lit(None).cast("string")
    rows.select(
        "digest",
        F.lit(state).alias("state"),
        text.alias("bad_text"),
        reason.alias("error_type"),
        F.lit(load_id).alias("load_id"),
        F.localtimestamp().alias("recorded_at"),
        F.lit(collection).alias("collection_name"),
    ).write.insertInto(quarantine_name(table))


def load_with_quarantine(
    spark: SparkSession, load: DocumentLoad, documents: DataFrame, location: str | None = None
) -> DocumentResult | DryRun:
    """``load_documents``, with the bad documents held, each text once."""
    result = load_documents(spark, load, documents, location)
    if isinstance(result, DryRun) or not result.failed:
        return result
    create_quarantine(spark, load.table, location)
    bad = result.bad.where(F.col("bad_text").isNotNull())
    bad = bad.select(_digest(F.col("bad_text"), load.collection).alias("digest"), "bad_text", "error_type").dropDuplicates(["digest"])
    known = spark.table(quarantine_name(load.table)).select("digest")
    _record(materialise(bad.join(known, "digest", "left_anti"), "held"), HELD, load.table, load.collection, uuid.uuid4().hex)
    return result


def replay(
    spark: SparkSession, load: DocumentLoad, repair: Callable[[Column], Column] | None = None
) -> DocumentResult | None:
    """Try the held documents again, under the rules of ``load`` and with their texts repaired; None if none can be landed.

    What can be landed is, and is noted; the others stay held.
    """
    held = held_documents(spark, load.table, load.collection)
    mended = repair(F.col("bad_text")) if repair else F.col("bad_text")
    tried = materialise(held.select("digest", mended.alias("raw")), "tried")
    outcome = prepare(DocumentLoad(**{**vars(load), "order_by": "digest", "limit": None}), tried)
    good = materialise(outcome.where(F.col("error_type").isNull()).select("digest"), "good")
    if good.isEmpty():
        return None
    result = load_documents(spark, load, tried.join(good, "digest", "left_semi").select("raw"))
    _record(good, LANDED, load.table, load.collection, uuid.uuid4().hex)
    return result
