"""The ledger of a CSV landing table: which files were seen, with what content, and which batch landed them.

A file whose path, length and time of change are in the ledger was read before and need not be opened again. One with
another length or time is, and its content hash tells whether it has changed. Entries of a batch are written twice, before
and after its rows: a run that died in between is mended by looking for the rows of that batch alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from moorage.sinks.tables import location_clause, next_row_id, table_location
from moorage.sources.tables import loaded_files, read_table

# What became of a file: about to be landed, landed, read and found unchanged, not loadable, given up.
BEGUN, LANDED, SAME, FAILED, LOST = "begun", "landed", "same", "failed", "lost"

COLUMNS = {
    "path": "string",
    "length": "bigint",
    "modified": "timestamp",
    "content_hash": "string",
    "state": "string",
    "rows_loaded": "bigint",
    "surplus_rows": "bigint",
    "problem": "string",
    "load_id": "string",
    "batch": "int",
    "first_row_id": "bigint",
    "last_row_id": "bigint",
    "listed_at": "timestamp",
}


def ledger_name(table: str) -> str:
    return f"{table}_files"


def read_ledger(spark: SparkSession, table: str) -> DataFrame:
    """Entries for a landing table; from its own rows if it has no ledger yet, and none if there is no table."""
    landing = read_table(spark, table)
    stored = read_table(spark, ledger_name(table)) if landing is not None else None
    return stored if stored is not None else entries(loaded_files(spark, landing), LANDED)


def entries(files: DataFrame, state: str | Column, **values: Column) -> DataFrame:
    """Files as rows of a ledger; columns that are neither given nor there are NULL."""
    values = {"state": F.lit(state) if isinstance(state, str) else state, **values}
    return files.select(
        *[
            values.get(c, F.col(c) if c in files.columns else F.lit(None)).cast(kind).alias(c)
            for c, kind in COLUMNS.items()
        ]
    )


def write_entries(rows: DataFrame, table: str) -> None:
    """A batch holds a bounded number of files, so its entries are one small file."""
    rows.coalesce(1).write.insertInto(ledger_name(table))


def open_ledger(spark: SparkSession, table: str, new: bool, location: str | None = None) -> None:
    """Make sure that there is a ledger, and that no batch in it is left open.

    With a ``new`` landing table it starts empty; for one that was filled without a ledger it is made from its rows, once.
    """
    name = ledger_name(table)
    if new:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    if read_table(spark, name) is not None:
        return _close_batches(spark, table)
    columns = ", ".join(f"{c} {kind}" for c, kind in COLUMNS.items())
    place = location_clause(None if location is None else f"{table_location(spark, table)}-files")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{place}")
    if not new:
        landing = spark.table(table)
        last = F.lit(next_row_id(landing) - 1)
        write_entries(entries(loaded_files(spark, landing), LANDED, last_row_id=last), table)


def _close_batches(spark: SparkSession, table: str) -> None:
    """Batches that were begun and never ended: landed if the table has rows of theirs, else lost."""
    ledger = spark.table(ledger_name(table))
    ended = ledger.where(F.col("state").isin(LANDED, LOST)).select("load_id", "batch").distinct()
    left = ledger.where(F.col("state") == BEGUN).join(ended, ["load_id", "batch"], "left_anti")
    for open_one in left.groupBy("load_id", "batch").agg(F.min("first_row_id").alias("first")).collect():
        files = left.where((F.col("load_id") == open_one.load_id) & (F.col("batch") == open_one.batch))
        rows = spark.table(table).where(F.col("row_id") >= open_one.first)
        found = landed_counts(rows).join(files.select("path", "content_hash"), ["path", "content_hash"], "left_semi")
        state = F.lit(LOST if found.isEmpty() else LANDED)
        counted = files.drop("rows_loaded", "last_row_id").join(found, ["path", "content_hash"], "left")
        # stored first, as a table can't be appended from its own scan
        closed = spark.createDataFrame(entries(counted, state).toArrow(), ledger.schema)
        write_entries(closed, table)


def landed_counts(rows: DataFrame) -> DataFrame:
    """Rows and last row id per landed file."""
    return rows.groupBy(F.col("filename").alias("path"), F.col("file_hash").alias("content_hash")).agg(
        F.count("*").alias("rows_loaded"), F.max("row_id").alias("last_row_id")
    )


def loaded_content(ledger: DataFrame) -> DataFrame:
    """Each path and content hash that has been loaded, once."""
    return ledger.where(F.col("state").isin(LANDED, SAME)).select("path", "content_hash").distinct()


def next_free_id(spark: SparkSession, table: str) -> int:
    """First row id that no load has used, from the ledger: the landing table is not read."""
    return (spark.table(ledger_name(table)).agg(F.max("last_row_id").alias("last")).first().last or 0) + 1


def not_seen(listing: DataFrame, ledger: DataFrame, settle_seconds: float = 2.0) -> DataFrame:
    """Listed files that have to be opened, as no entry has their path, length and time of change.

    An entry made within ``settle_seconds`` of the change proves nothing, since the file may have changed once more
    within the same tick of the clock.
    """
    settled = F.col("listed_at") - F.make_dt_interval(secs=F.lit(float(settle_seconds)))
    seen = ledger.where(F.col("state").isin(LANDED, SAME) & (F.col("modified") < settled))
    return listing.join(seen.select("path", "length", "modified").distinct(), ["path", "length", "modified"], "left_anti")
