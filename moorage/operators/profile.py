"""Dry runs and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from moorage.functions.documents import canonical_json
from moorage.operators.joins import one_row
from moorage.operators.landing import MESSAGE_CHARS

# Sizes of the samples that reports are made of.
SIZE_SAMPLE = 100
EXAMPLES = 3
SAMPLE_DOCUMENTS = 3
SAMPLE_DOCUMENT_CHARS = 500
MEGABYTE = 1024 * 1024


def batches(n: Column, size: int) -> Column:
    return F.ceil(n / F.lit(size)).cast("bigint")


def limited(n: Column, limit: int | None) -> Column:
    """Documents exported under a limit; none or 0 means all."""
    return F.least(n, F.lit(limit).cast("bigint")) if limit else n


def export_estimate(rows: DataFrame, batch_size: int, limit: int | None = None) -> DataFrame:
    """One row for a dry run: documents, those within the limit, batches, and size.

    ``rows`` are landing columns. The size comes from the first documents in id order, in characters.
    """
    counts = rows.agg(F.count("*").alias("matching"))
    sample = rows.select("document_id", F.length(canonical_json(F.col("row_data"))).alias("chars"))
    sizes = sample.orderBy("document_id").limit(SIZE_SAMPLE).agg(
        F.count("*").alias("sampled"), F.sum("chars").alias("sample_chars")
    )
    total = limited(F.col("matching"), limit)
    mean = F.when(F.col("sampled") > 0, F.col("sample_chars") / F.col("sampled"))
    return one_row(counts, sizes).select(
        "matching",
        total.alias("to_export"),
        batches(total, batch_size).alias("batches"),
        "sampled",
        "sample_chars",
        mean.alias("mean_chars"),
        (mean * total / MEGABYTE).alias("estimated_mb"),
    )


def upsert_estimate(landing: DataFrame, collection: str, matching: DataFrame) -> DataFrame:
    """One row: rows of the table and the collection, known ids, and how far updates and inserts can go.

    ``matching`` is one row with the count ``to_export``. ``upsert_actions`` gives the exact split.
    """
    mine = F.col("collection_name") == F.lit(collection)
    stored = landing.agg(
        F.count("*").alias("table_rows"),
        F.count_if(mine).alias("collection_rows"),
        F.count_distinct(F.when(mine, F.col("document_id"))).alias("known_ids"),
    )
    return one_row(stored, matching.select("to_export")).select(
        "*",
        F.least("known_ids", "to_export").alias("updates_up_to"),
        F.greatest(F.lit(0).cast("bigint"), F.col("to_export") - F.col("known_ids")).alias("inserts_at_least"),
    )


def sample_documents(rows: DataFrame, n: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """First documents in id order, cut for display."""
    first = rows.orderBy("document_id").limit(n)
    return first.select(
        "document_id", F.left(canonical_json(F.col("row_data")), F.lit(SAMPLE_DOCUMENT_CHARS)).alias("document")
    )


def failure_counts(failures: DataFrame) -> DataFrame:
    """Failures per type, most frequent first, and how many go beyond the examples."""
    counts = failures.groupBy("error_type").agg(F.count("*").alias("n"))
    more = F.greatest(F.col("n") - EXAMPLES, F.lit(0)).cast("bigint").alias("more")
    return counts.select("error_type", "n", more).orderBy(F.desc("n"), "error_type")


def failure_examples(failures: DataFrame, n: int = EXAMPLES) -> DataFrame:
    """First failures of each type by id. Spark drops the rest before the shuffle."""
    first = Window.partitionBy("error_type").orderBy("doc_id", "json_sample")
    return (
        failures.withColumn("nth", F.row_number().over(first))
        .where(F.col("nth") <= n)
        .select(
            "error_type",
            "nth",
            "doc_id",
            F.left("error_message", F.lit(MESSAGE_CHARS)).alias("error_message"),
            "json_sample",
        )
    )


def failure_report(failures: DataFrame, n: int = EXAMPLES) -> DataFrame:
    """Examples of each type beside the count of the type."""
    counts = failure_counts(failures)
    return failure_examples(failures, n).join(F.broadcast(counts), "error_type")  # one row per error type


def layout_ranges(table: DataFrame, key: str) -> DataFrame:
    """What each data file of a table holds: rows, least and largest key."""
    return table.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n"), F.min(key).alias("least"), F.max(key).alias("most")
    )


def range_overlaps(ranges: DataFrame) -> DataFrame:
    """Files, and how many of them begin below the end of an earlier one; those that share a key at the edge don't count.

    The window holds a row per file.
    """
    earlier = Window.orderBy("least", "most", "file").rowsBetween(Window.unboundedPreceding, -1)
    over = F.col("least") < F.max("most").over(earlier)
    return ranges.withColumn("over", over).agg(
        F.count("*").alias("files"), F.sum("n").alias("n"), F.count_if("over").alias("overlapping")
    )
