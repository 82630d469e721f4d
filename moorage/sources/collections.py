"""Document collections: JSON lines on disk, or any reader Spark knows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from moorage.functions.documents import document_of
from moorage.functions.predicates import comparable_columns, fields_of, split_filter


def json_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Documents as text, one per line, not yet parsed; blank lines are no documents."""
    return spark.read.text(path).where(F.trim("value") != "").select(F.col("value").alias("raw"))


def documents_from(spark: SparkSession, source: str, options: dict[str, str] | None = None) -> DataFrame:
    """Documents of a typed source (a document-store connector, parquet, ...) as a VARIANT column."""
    table = spark.read.format(source).options(**(options or {})).load()
    return as_documents(table)


def as_documents(table: DataFrame) -> DataFrame:
    """Rows of a typed table as documents; dates, decimals and binary values become text."""
    return table.select(document_of(table.schema).alias("doc"))


def selected_documents(
    table: DataFrame, query: Mapping[str, Any] | None, fields: Iterable[str] | None = None, keep: Iterable[str] = ()
) -> tuple[DataFrame, dict[str, Any]]:
    """Rows of a typed table as documents, made from no more than is needed, and the filter still to be applied.

    Comparisons with columns of the table become conditions on them, which Spark hands to the scan, and columns that
    neither ``fields`` nor the rest of the filter name are not read. ``keep`` names columns to carry along.
    """
    condition, rest = split_filter(query, comparable_columns(table.schema))
    rows = table if condition is None else table.where(condition)
    wanted = list(fields or [])
    top = {path.split(".")[0] for path in wanted} | {"_id"} | fields_of(rest)
    columns = [f for f in table.schema if not wanted or f.name in top or "." in f.name]
    carried = [F.col(f"`{c}`") for c in keep]
    return rows.select(document_of(type(table.schema)(columns)).alias("doc"), *carried), rest
