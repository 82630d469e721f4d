"""Landing tables: creation, append, row ids, layout, exchange of a collection."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Partitions a load may have; row ids of one load interleave this many sequences.
ID_STRIDE = 1 << 22

DOCUMENT_COLUMNS = ["row_id", "row_data", "document_id", "document_hash", "load_timestamp", "collection_name"]


def location_clause(location: str | None) -> str:
    return f" LOCATION '{location}'" if location else ""


def create_csv_landing(spark: SparkSession, table: str, location: str | None = None) -> None:
    """CSV landing table, unless it is there."""
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {table} (
            row_id BIGINT, row_data VARIANT, filename STRING, file_hash STRING,
            load_timestamp TIMESTAMP_NTZ) USING parquet{location_clause(location)}"""
    )


def create_document_landing(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Document landing table, unless it is there.

    Partitioned by collection, so that loads of one collection neither read nor rewrite another.
    """
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {table} (
            row_id BIGINT, row_data VARIANT, document_id STRING, document_hash STRING,
            load_timestamp TIMESTAMP_NTZ, collection_name STRING) USING parquet
            PARTITIONED BY (collection_name){location_clause(location)}"""
    )


def row_ids(first: int) -> Column:
    """Ids from ``first`` on, unique within the job, without a global sort or window."""
    made = F.monotonically_increasing_id()
    partition, position = F.shiftright(made, 33), made.bitwiseAND(F.lit((1 << 33) - 1))
    made_id = F.lit(first).cast("bigint") + position * ID_STRIDE + partition
    return F.when(partition < ID_STRIDE, made_id).otherwise(F.raise_error(F.lit("too many partitions in one load")))


def next_row_id(landing: DataFrame) -> int:
    return (landing.agg(F.max("row_id").alias("last")).first().last or 0) + 1


def append_rows(rows: DataFrame, table: str, cluster: list[str] | None = None, first: int | None = None) -> None:
    """Append to a landing table, with row ids above all present ones and the time of the load.

    ``first`` is the first free row id, if the caller knows it; else the table is asked.
    ``cluster`` names columns to lay the rows out by; that takes a shuffle, so it is left to the caller.
    A scan leaves the rows of a file together as it is.
    """
    landing = rows.sparkSession.table(table)
    if cluster:
        rows = clustered(rows, cluster)
    stamped = rows.withColumn("row_id", row_ids(next_row_id(landing) if first is None else first))
    if "load_timestamp" not in rows.columns:
        stamped = stamped.withColumn("load_timestamp", F.localtimestamp())
    stamped.select(*landing.columns).write.insertInto(table)


def clustered(rows: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Rows laid out by ``keys`` for min/max skipping.

    A last key that is spread evenly lets a file or id that holds a large share of the rows be cut into
    several ranges, instead of filling one task. It follows from the place of a row in the stored or scanned
    input, so a task that is run again deals its rows as before.
    """
    order = [*keys, "spread"]
    spread = rows.withColumn("spread", F.xxhash64(F.monotonically_increasing_id()))
    ranged = spread.repartitionByRange(partitions, *order) if partitions else spread.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*keys).drop("spread")


def replace_collection(rows: DataFrame, table: str, collection: str) -> str:
    """Make ``rows`` the content of one collection, which may be an input of ``rows``.

    They are written beside the old ones, then the table's partition is pointed to them: readers see the
    old or the new content, and a failed write changes nothing. Returns the new location.
    """
    spark = rows.sparkSession
    location = new_version(spark, table)
    columns = [c for c in DOCUMENT_COLUMNS if c != "collection_name"]
    rows.select(*columns).write.parquet(location)
    name = collection.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (collection_name = '{name}')")
    spark.sql(f"ALTER TABLE {table} PARTITION (collection_name = '{name}') SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)
    return location


def replace_table(rows: DataFrame, table: str) -> str:
    """Make ``rows`` the content of an unpartitioned table, which may be an input of ``rows``.

    Written beside the old content like a collection; columns the table lacks are added to it.
    """
    spark = rows.sparkSession
    location = new_version(spark, table)
    present = {c.lower() for c in spark.table(table).columns}
    rows.write.parquet(location)
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name.lower() not in present]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)
    return location


def new_version(spark: SparkSession, table: str) -> str:
    """A fresh place for content of a table, below its root and hidden from scans of it.

    Earlier versions stay where they are; removing them is up to the owner of the table.
    """
    root = table_location(spark, table).split("/_versions/")[0]
    return f"{root}/_versions/{uuid.uuid4().hex}"


def table_location(spark: SparkSession, table: str) -> str:
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if row.col_name == "Location":
            return row.data_type.rstrip("/")
    raise ValueError(f"{table} has no location")


def merge_into(source: DataFrame, table: str) -> None:
    """Hash-gated upsert on a table format that has MERGE. ``source`` must have each key once."""
    target = table.split(".")[-1]
    same = " AND ".join(f"{target}.{c} = source.{c}" for c in ("document_id", "collection_name"))
    stale = f"{target}.document_hash IS NULL OR {target}.document_hash <> source.document_hash"
    (
        source.alias("source")
        .mergeInto(table, F.expr(same))
        .whenMatched(F.expr(stale))
        .update({c: F.col(f"source.{c}") for c in ("row_data", "document_hash", "load_timestamp")})
        .whenNotMatched()
        .insert({c: F.col(f"source.{c}") for c in source.columns})
        .merge()
    )


def write_to(df: DataFrame, sink: str, options: dict[str, str] | None = None, mode: str = "append") -> None:
    """Hand rows to a connector, such as a document store in update-only mode."""
    df.write.format(sink).options(**(options or {})).mode(mode).save()
