"""Documents to landing rows, with the bad ones set apart."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, Observation, functions as F

from moorage.functions.documents import (
    canonical_json,
    document_id,
    is_object_text,
    project_paths,
    strict_json,
)
from moorage.functions.predicates import Columns, compile_filter

# Characters of a bad document and of a message that are kept.
SAMPLE_CHARS = 200
MESSAGE_CHARS = 400

MESSAGES = {
    "invalid_json": "not one complete JSON value with distinct keys",
    "not_an_object": "JSON value is not an object",
    "missing_id": "document has no usable _id",
}


def parse_documents(texts: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds ``doc`` (VARIANT, NULL if unusable) and ``error_type`` to rows with JSON text.

    The metric keeps later filters on either column above the parser; pushed below, they would parse every
    text a second time.
    """
    parsed = texts.withColumn("doc", strict_json(F.col(raw)))
    parsed = parsed.observe("parsed", F.count_if(F.col("doc").isNull()).alias("unusable"))
    error = F.when(F.col("doc").isNull(), "invalid_json").when(~is_object_text(F.col(raw)), "not_an_object")
    return parsed.withColumn("error_type", error)


def typed_documents(documents: DataFrame) -> DataFrame:
    """The same shape for documents that are VARIANT already."""
    return documents.select(
        "*", F.lit(None).cast("string").alias("error_type"), F.lit(None).cast("string").alias("raw")
    )


def matching(documents: DataFrame, query: Mapping[str, Any] | None, columns: Columns | None = None) -> DataFrame:
    """Documents the filter accepts. Unusable ones stay, as no filter can be applied to them."""
    if not query:
        return documents
    return documents.where(F.col("error_type").isNotNull() | compile_filter(query, F.col("doc"), columns))


def first_documents(documents: DataFrame, limit: int | None) -> DataFrame:
    """First ``limit`` documents in id order; none or 0 means all."""
    if not limit:
        return documents
    by_id = documents.withColumn("by_id", document_id(F.col("doc")))
    return by_id.orderBy(F.col("by_id").asc_nulls_last(), F.col("raw")).limit(limit).drop("by_id")


def landing_columns(
    documents: DataFrame,
    collection: str,
    fields: Iterable[str] | None = None,
    need_id: bool = False,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Landing columns of parsed documents, and ``error_type`` for those that must not be landed.

    The document is projected, its id made text, and then hashed. ``keep`` names columns to carry along.
    """
    rows = documents.withColumns(
        {"document_id": document_id(F.col("doc")), "row_data": project_paths(F.col("doc"), fields, id_as_text=True)}
    )
    error = F.col("error_type")
    if need_id:
        no_id = F.coalesce(F.col("document_id"), F.lit("")) == ""
        error = F.coalesce(error, F.when(no_id, "missing_id"))
    return rows.select(
        F.when(error.isNull(), F.col("row_data")).alias("row_data"),
        "document_id",
        F.when(error.isNull(), F.md5(canonical_json(F.col("row_data")))).alias("document_hash"),
        F.lit(collection).alias("collection_name"),
        error.alias("error_type"),
        F.when(error.isNotNull(), F.coalesce("raw", F.to_json("doc"))).alias("bad_text"),
        *keep,
    )


def counted(rows: DataFrame, observation: Observation) -> DataFrame:
    """Counts good and bad rows while they pass."""
    bad = F.col("error_type").isNotNull()
    return rows.observe(observation, F.count("*").alias("read"), F.count_if(bad).alias("failed"))


def good_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("error_type").isNull()).drop("error_type", "bad_text")


def bad_rows(rows: DataFrame) -> DataFrame:
    """The rows set apart, with the whole text of each document."""
    return rows.where(F.col("error_type").isNotNull()).select("document_id", "error_type", "bad_text")


def failures(rows: DataFrame) -> DataFrame:
    """Failure records of the rows set apart."""
    message = F.create_map(*[F.lit(x) for pair in MESSAGES.items() for x in pair])[F.col("error_type")]
    return rows.where(F.col("error_type").isNotNull()).select(
        F.coalesce(F.nullif("document_id", F.lit("")), F.lit("unknown")).alias("doc_id"),
        "error_type",
        message.alias("error_message"),
        F.left("bad_text", F.lit(SAMPLE_CHARS)).alias("json_sample"),
    )
