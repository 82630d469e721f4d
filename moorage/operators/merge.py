"""Hash-gated upsert of documents as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from moorage.operators.joins import left_join_spread

INSERT, UPDATE, UNCHANGED, KEEP = "insert", "update", "unchanged", "keep"


def latest_by_key(rows: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """One row per key, the last in the given order.

    Spark keeps only the top row of each key before it shuffles, so a key with many rows does no harm.
    """
    last = Window.partitionBy(*keys).orderBy(*order_by)
    return rows.withColumn("nth", F.row_number().over(last)).where(F.col("nth") == 1).drop("nth")


def latest_documents(source: DataFrame, order_by: str | None = None) -> DataFrame:
    """Source documents with each id once: the last by ``order_by``, ties and no order by hash."""
    order = [F.col(order_by).desc_nulls_last()] if order_by else []
    return latest_by_key(source, ["document_id"], [*order, F.col("document_hash").desc()])


def _stale(stored: Column, new: Column) -> Column:
    """A row is rewritten if it has no hash or another one."""
    return stored.isNull() | (stored != new)


def in_collection(landing: DataFrame, collection: str) -> DataFrame:
    return landing.where(F.col("collection_name") == F.lit(collection))


def upsert_actions(target: DataFrame, source: DataFrame) -> DataFrame:
    """What an upsert does with each id: insert, update, unchanged, keep.

    ``target`` is one collection, ``source`` has each id once. Only ids and hashes are read. Of several
    target rows with one id, one stale row makes an update.
    """
    new = source.select("document_id", F.col("document_hash").alias("new_hash"))
    stored = (
        target.where(F.col("document_id") != "")
        .groupBy("document_id")
        .agg(
            F.min("document_hash").alias("low"),
            F.max("document_hash").alias("high"),
            F.bool_or(F.col("document_hash").isNull()).alias("unhashed"),
        )
    )
    stale = F.col("unhashed") | (F.col("low") != F.col("new_hash")) | (F.col("high") != F.col("new_hash"))
    action = (
        F.when(F.col("unhashed").isNull(), INSERT)
        .when(F.col("new_hash").isNull(), KEEP)
        .when(stale, UPDATE)
        .otherwise(UNCHANGED)
    )
    return stored.join(new, "document_id", "full").select("document_id", action.alias("action"))


def action_counts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action").agg(F.count("*").alias("n"))


def classified(target: DataFrame, source: DataFrame) -> DataFrame:
    """Source documents, each id once, with their action: insert, update or unchanged.

    Of the target, ids and hashes of documents the source has are looked at; with a small source Spark broadcasts its ids,
    and the target is not shuffled.
    """
    mine = target.where(F.col("document_id") != "").select("document_id", F.col("document_hash").alias("stored"))
    met = mine.join(source.select("document_id"), "document_id", "left_semi").groupBy("document_id")
    known = met.agg(
        F.min("stored").alias("low"), F.max("stored").alias("high"), F.bool_or(F.col("stored").isNull()).alias("unhashed")
    )
    new = F.col("document_hash")
    stale = F.col("unhashed") | (F.col("low") != new) | (F.col("high") != new)
    action = F.when(F.col("unhashed").isNull(), INSERT).when(stale, UPDATE).otherwise(UNCHANGED)
    return source.join(known, "document_id", "left").select(*source.columns, action.alias("action"))


def inserts(target: DataFrame, source: DataFrame) -> DataFrame:
    """Source documents whose id the target lacks."""
    known = target.where(F.col("document_id") != "").select("document_id").distinct()
    return source.join(known, "document_id", "left_anti")


def updated_rows(target: DataFrame, source: DataFrame, load_timestamp: Column | None = None) -> DataFrame:
    """The rows of one collection, rewritten where the source has other content.

    Row ids stay. A small source is broadcast by Spark and the target is not shuffled at all; otherwise
    both are, and target rows without an id are spread over tasks.
    """
    loaded = F.localtimestamp() if load_timestamp is None else load_timestamp
    new = source.select(
        F.col("document_id").alias("new_id"),
        F.col("row_data").alias("new_data"),
        F.col("document_hash").alias("new_hash"),
    )
    joined = left_join_spread(target, new, "document_id", "new_id")
    rewrite = F.col("new_hash").isNotNull() & _stale(F.col("document_hash"), F.col("new_hash"))
    replaced = {
        "row_data": F.when(rewrite, F.col("new_data")).otherwise(F.col("row_data")),
        "document_hash": F.when(rewrite, F.col("new_hash")).otherwise(F.col("document_hash")),
        "load_timestamp": F.when(rewrite, loaded).otherwise(F.col("load_timestamp")),
    }
    return joined.select(*[replaced[c].alias(c) if c in replaced else F.col(c) for c in target.columns])


def merged(
    landing: DataFrame, source: DataFrame, collection: str, load_timestamp: Column | None = None
) -> DataFrame:
    """The whole landing table after an upsert into one collection; new rows get no row id here."""
    loaded = F.localtimestamp() if load_timestamp is None else load_timestamp
    mine = in_collection(landing, collection)
    others = landing.where(~F.col("collection_name").eqNullSafe(F.lit(collection)))
    added = inserts(mine, source).withColumn("load_timestamp", loaded)
    return (
        others.unionByName(updated_rows(mine, source, loaded))
        .unionByName(added.select(*[c for c in landing.columns if c in added.columns]), allowMissingColumns=True)
        .select(*landing.columns)
    )
