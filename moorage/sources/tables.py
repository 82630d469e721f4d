"""Reads of landing tables, ledgers and warehouse views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from moorage.functions.paths import relative_path

LEDGER_SCHEMA = "path string, content_hash string"
IDS_SCHEMA = "document_id string"


def read_table(spark: SparkSession, table: str) -> DataFrame | None:
    """The table, or None if there is none."""
    try:
        return spark.table(table) if spark.catalog.tableExists(table) else None
    except AnalysisException:
        return None


def loaded_files(spark: SparkSession, landing: DataFrame | None) -> DataFrame:
    """Ledger of a CSV landing table: each ``(path, content_hash)`` once; empty without a table."""
    if landing is None:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return landing.select(
        relative_path(F.col("filename")).alias("path"), F.col("file_hash").alias("content_hash")
    ).distinct()


def existing_ids(spark: SparkSession, landing: DataFrame | None, collection: str) -> DataFrame:
    """Ids a document landing table holds for one collection; empty without a table."""
    if landing is None:
        return spark.createDataFrame([], IDS_SCHEMA)
    mine = landing.where(F.col("collection_name") == F.lit(collection))
    return mine.where(F.col("document_id") != "").select("document_id").distinct()


def has_column(df: DataFrame, name: str) -> bool:
    return name.lower() in {c.lower() for c in df.columns}


def source_rows(source: DataFrame, key: str, mapping: dict[str, str], where: str | Column | None = None) -> DataFrame:
    """The key and the mapped columns of a view, under their own names; columns it lacks are left out."""
    rows = source if where is None else source.where(where)
    wanted = [key, *[c for c in mapping if c.lower() != key.lower()]]
    return rows.select(*[F.col(f"`{c}`").alias(c) for c in wanted if has_column(source, c)])


def count_rows(source: DataFrame, where: str | Column | None = None) -> DataFrame:
    rows = source if where is None else source.where(where)
    return rows.agg(F.count("*").alias("n_rows"))


def sample_rows(table: DataFrame, n: int = 10, collection: str | None = None, order_by: str = "row_id") -> DataFrame:
    """First ``n`` rows in ``order_by`` order, of one collection on request."""
    rows = table if collection is None else table.where(F.col("collection_name") == F.lit(collection))
    return rows.orderBy(order_by).limit(n)


def collection_counts(landing: DataFrame) -> DataFrame:
    """Documents per collection."""
    return landing.groupBy("collection_name").agg(F.count("*").alias("n_documents"))


def dataset_counts(datasets: dict[str, DataFrame]) -> DataFrame:
    """Rows per named dataset, in one job."""
    parts = [df.agg(F.count("*").alias("n_documents")).select(F.lit(name).alias("collection_name"), "n_documents")
             for name, df in datasets.items()]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts
