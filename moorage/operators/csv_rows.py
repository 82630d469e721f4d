"""CSV cells and per-file headers joined to rows that carry their own names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from moorage.functions.csv_text import has_surplus, row_object, width_class
from moorage.operators.joins import BROADCAST_BYTES, lookup_join
from moorage.sources.csv_files import RECORDS, UNCLOSED, WHOLE, scan_cells, scan_split_records, way_to_read
from moorage.sources.files import MAX_CONTENT_BYTES


def with_headers(files: DataFrame, headers: DataFrame) -> DataFrame:
    """Selected files with their column names, or the reason why they cannot be loaded."""
    return files.join(headers, "uri", "left").withColumn(
        "problem", F.when(F.col("names").isNull(), "could_not_read_header").otherwise(F.col("problem"))
    )


def with_columns(
    files: DataFrame,
    columns: list[str],
    max_content_bytes: int = MAX_CONTENT_BYTES,
    encoding: str = "UTF-8",
    records: DataFrame | None = None,
) -> DataFrame:
    """Selected files with column names given by the caller; headers are not parsed.

    ``records`` tells of files how to read them and whether they end within quotes.
    """
    names = F.array(*[F.lit(c) for c in columns]).cast("array<string>").alias("names")
    guess = way_to_read(files, max_content_bytes, encoding)
    empty = F.when(F.col("length") == 0, "could_not_read_header")
    if records is None:
        return files.select("*", names, guess.alias("reading"), empty.alias("problem"))
    told = files.withColumn("guess", guess).join(records.select("uri", F.col("reading").alias("told"), "open"), "uri", "left")
    return told.select(
        *files.columns,
        names,
        F.coalesce("told", "guess").alias("reading"),
        F.coalesce(empty, F.when(F.col("open"), UNCLOSED)).alias("problem"),
    )


def landing_rows(
    spark: SparkSession,
    files: DataFrame,
    sep: str = ",",
    encoding: str = "UTF-8",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame | None:
    """Landing rows of all files without a problem, read in one job; None if there are no such files.

    ``files`` must be a stored batch, since it is read several times and its names go through the driver,
    because that is how a scan is told what to read; names of columns and the rows do not. Files are
    parsed at about their own width, so one wide file doesn't widen the others. ``surplus`` tells of rows
    that hold more cells than their file has columns.
    """
    good = files.where(F.col("problem").isNull())
    names_size = F.aggregate("names", F.lit(0), lambda n, x: n + F.length(x) + 16)
    total = good.agg(
        F.count("*").alias("n"), F.sum(names_size + F.length("uri") + F.length("path") + 64).alias("bytes")
    ).first()
    if not total.n:
        return None
    paths: dict[tuple[str, int], list[str]] = {}
    for row in good.select("full_path", "reading", width_class(F.size("names")).alias("width")).toLocalIterator():
        paths.setdefault((row.reading, row.width), []).append(row.full_path)
    scans = []
    for (way, width), some in sorted(paths.items()):
        if way == RECORDS:
            scans.append(scan_split_records(spark, some, width, sep, encoding))
        else:
            scans.append(scan_cells(spark, some, width, skip_header=True, multi_line=way == WHOLE, sep=sep, encoding=encoding))
    cells = reduce(DataFrame.unionByName, scans)
    lookup = good.select("uri", "names", F.col("path").alias("filename"), F.col("content_hash").alias("file_hash"))
    joined = lookup_join(cells, lookup, "uri", total.bytes, broadcast_bytes)
    named = F.col("names"), F.col("cells")
    return joined.select(row_object(*named).alias("row_data"), "filename", "file_hash", has_surplus(*named).alias("surplus"))


def seen_surplus(rows: DataFrame, seen: Observation) -> DataFrame:
    """Notes while rows pass which files have rows with surplus cells."""
    return rows.observe(seen, F.collect_set(F.when(F.col("surplus"), F.col("filename"))).alias("files"))


def surplus_counts(rows: DataFrame) -> DataFrame:
    """Rows with surplus cells per file."""
    return rows.groupBy(F.col("filename").alias("path"), F.col("file_hash").alias("content_hash")).agg(
        F.count_if("surplus").alias("surplus_rows")
    )


def load_report(files: DataFrame, loaded: DataFrame | None) -> DataFrame:
    """One row per selected file: rows loaded, and the problem if it was not loaded.

    ``loaded`` has a row per landed row with ``filename`` and ``file_hash``.
    """
    if loaded is None:
        return files.select("path", F.lit(0).cast("bigint").alias("rows_loaded"), "problem")
    counts = loaded.groupBy("filename", "file_hash").agg(F.count("*").alias("n"))
    same = (F.col("path") == F.col("filename")) & F.col("content_hash").eqNullSafe(F.col("file_hash"))
    rows = F.when(F.col("problem").isNull(), F.coalesce("n", F.lit(0))).otherwise(F.lit(0)).cast("bigint")
    return files.join(counts, same, "left").select("path", rows.alias("rows_loaded"), "problem")


def load_summary(report: DataFrame) -> DataFrame:
    """One row of totals over a load report."""
    return report.agg(
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).cast("bigint").alias("rows_loaded"),
        F.count_if(F.col("problem").isNull()).alias("files_processed"),
        F.count_if(F.col("problem").isNotNull()).alias("files_failed"),
    )
