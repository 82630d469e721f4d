"""CSV landing of files that Spark writes from the customer table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from moorage.catalogue.tables import scratch_table, table
from moorage.operators.csv_rows import load_summary
from moorage.plans.csv_load import load_csv
from moorage.session import new_location
from moorage.sources.files import list_files
from moorage.spec import CsvLoad

COLUMNS = ["key", "name", "nation"]
WRITE = {"header": "true", "quote": '"', "escape": '"', "quoteAll": "false"}
BARE = {"header": "true", "quote": ""}  # cells written as they are, whatever they hold
NO_SEGMENT = "__HIVE_DEFAULT_PARTITION__"


def turn() -> Column:
    """How far the columns of a segment's file are turned."""
    return F.coalesce(F.length("c_mktsegment") % 3, F.lit(0))


def segment_of(folder: Column) -> Column:
    """Market segment of a folder ``segment=...``."""
    return F.nullif(F.replace(folder, F.lit("segment="), F.lit("")), F.lit(NO_SEGMENT))


def segment_folder(path: str = "filename") -> Column:
    return segment_of(F.split(path, "/")[1]).alias("segment")


def write_by_segment(rows: DataFrame, root: str, options: dict[str, str]) -> None:
    """One file per market segment, null among them."""
    dealt = rows.withColumnRenamed("c_mktsegment", "segment").repartition("segment")
    dealt.write.mode("append").options(**options).partitionBy("segment").csv(f"{root}/lake")


def write_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder per market segment, with columns in an order that depends on the segment.

    Names get a line break and quotes, so that a file cannot be read line by line.
    """
    root = new_location(spark, "csv")
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"),
        F.when(F.col("c_nationkey") == 5, F.concat("c_name", F.lit('\n"five", 5'))).otherwise(F.col("c_name")).alias("name"),
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey")).alias("nation"),
        "c_mktsegment",
    )
    for i in range(3):
        order = [COLUMNS[(i + j) % 3] for j in range(3)]
        write_by_segment(customer.where(turn() == i).select(*order, "c_mktsegment"), root, WRITE)
    return root


def write_odd_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Beside them, files with a header and no rows, and files whose column names repeat."""
    region = table(spark, sf_dir, "region")
    region.where(F.col("r_regionkey") < 0).coalesce(1).write.options(**WRITE).csv(f"{root}/lake/header_only")
    region.select(F.lit("a,a").alias("line")).write.text(f"{root}/lake/repeated")


def _load(spark: SparkSession, root: str, **options) -> tuple[DataFrame, DataFrame]:
    name, location = scratch_table(spark)
    result = load_csv(spark, CsvLoad(table=name, base=root, **options), root, location)
    return spark.table(name), result.report


def manifest_scan(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Bytes of data per folder, leaving out one header line per file."""
    root = write_files(spark, sf_dir)
    files = list_files(spark, root, pattern=r"lake/.*\.csv", base=root, **options)
    return files.groupBy(segment_of(F.col("merchant")).alias("merchant")).agg(
        F.sum(F.col("length") - len("key,name,nation\n")).alias("data_bytes"),
        F.bool_and(F.length("content_hash") == 32).alias("hashed"),
    )


def csv_per_file_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _load(spark, write_files(spark, sf_dir), pattern=r"lake/.*\.csv")
    cell = lambda name: F.try_variant_get("row_data", f"$.{name}", "string")
    return rows.select(
        cell("key").alias("key"),
        cell("name").alias("name"),
        cell("nation").alias("nation"),
        segment_folder(),
    )


def csv_land(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Files landed twice: the second load finds nothing new. Row ids are unique, hashes match the files."""
    root = write_files(spark, sf_dir)
    name, location = scratch_table(spark)
    load = CsvLoad(table=name, base=root, pattern=r"lake/.*\.csv", cluster=True, **options)
    load_csv(spark, load, root, location)
    load_csv(spark, load, root, location)
    rows = spark.table(name).join(
        list_files(spark, root, base=root, **options).select(F.col("path").alias("filename"), "content_hash"), "filename"
    )
    return rows.groupBy(segment_folder()).agg(
        F.count("*").alias("n"),
        F.count_distinct("row_id").alias("row_ids"),
        F.sum(F.try_variant_get("row_data", "$.key", "bigint")).alias("sum_key"),
        F.bool_and(F.col("file_hash") == F.col("content_hash")).alias("hash_matches"),
    )


def manifest_scan_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``manifest_scan`` with every file taken as a large one."""
    return manifest_scan(spark, sf_dir, max_content_bytes=1)


def csv_land_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``csv_land`` with every file taken as a large one."""
    return csv_land(spark, sf_dir, max_content_bytes=1)


def csv_explicit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names given by the caller instead of the header: the same name for each position."""
    root = write_files(spark, sf_dir)
    rows, _ = _load(spark, root, pattern=r"lake/.*\.csv", columns=("a", "b", "c"))
    return rows.select(
        segment_folder(),
        F.try_variant_get("row_data", "$.a", "string").alias("a"),
        F.try_variant_get("row_data", "$.b", "string").alias("b"),
        F.try_variant_get("row_data", "$.c", "string").alias("c"),
    )


def csv_load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = write_files(spark, sf_dir)
    write_odd_files(spark, sf_dir, root)
    _, report = _load(spark, root, pattern=r"lake/.*\.(csv|txt)")
    folder = segment_of(F.split("path", "/")[1]).alias("folder")
    return report.groupBy(folder, "problem").agg(F.sum("rows_loaded").alias("rows_loaded"))


def csv_load_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = write_files(spark, sf_dir)
    write_odd_files(spark, sf_dir, root)
    _, report = _load(spark, root, pattern=r"lake/.*\.(csv|txt)")
    return load_summary(report).select("rows_loaded", (F.col("files_failed") > 0).alias("some_failed"))


def csv_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = write_files(spark, sf_dir)
    write_odd_files(spark, sf_dir, root)
    name, _ = scratch_table(spark)
    load = CsvLoad(table=name, base=root, pattern=r"lake/.*\.(csv|txt)", dry_run=True)
    report = load_csv(spark, load, root).report
    folder = segment_of(F.split("path", "/")[1]).alias("folder")
    return report.select(folder, F.coalesce(F.col("n_columns").cast("bigint"), F.lit(0)).alias("n_columns"), "problem").distinct()


def ledger_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads: some files, no new ones, the others. The second opens nothing, the third only what is new."""
    root = new_location(spark, "csv")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", turn().alias("turn"))
    name, location = scratch_table(spark)
    load = CsvLoad(table=name, base=root, pattern=r"lake/.*\.csv", settle_seconds=0, batch_files=3)
    runs = []
    for nth, some in enumerate((F.col("turn") == 0, None, F.col("turn") > 0), 1):
        if some is not None:
            write_by_segment(customer.where(some).drop("turn"), root, WRITE)
        run = load_csv(spark, load, root, location)
        totals = run.report.agg(F.count("*").alias("landed"), F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows"))
        runs.append(totals.select(*[F.lit(n).cast("bigint").alias(c) for c, n in (("nth", nth), ("listed", run.listed), ("opened", run.opened))], "landed", "rows"))
    return reduce(DataFrame.unionByName, runs)


def csv_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``csv_land`` in batches of two files, with the number of batches."""
    root = write_files(spark, sf_dir)
    name, location = scratch_table(spark)
    result = load_csv(spark, CsvLoad(table=name, base=root, pattern=r"lake/.*\.csv", batch_files=2), root, location)
    batches = result.details.agg(F.count_distinct("batch").alias("batches"))
    rows = spark.table(name).groupBy(segment_folder()).agg(
        F.count("*").alias("n"), F.sum(F.try_variant_get("row_data", "$.key", "bigint")).alias("sum_key")
    )
    return rows.join(F.broadcast(batches))  # one row


def csv_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of 200 columns."""
    root = new_location(spark, "csv")
    wide = [(F.col("c_custkey") + i).alias(f"c{i}") for i in range(200)]
    write_by_segment(table(spark, sf_dir, "customer").select(*wide, "c_mktsegment"), root, WRITE)
    rows, _ = _load(spark, root, pattern=r"lake/.*\.csv")
    cell = lambda i: F.try_variant_get("row_data", f"$.c{i}", "string").alias(f"c{i}")
    return rows.select(segment_folder(), *[cell(i) for i in (0, 149, 150, 199)])


def _ragged(spark: SparkSession, sf_dir: str, name: Column) -> DataFrame:
    """Entries of the ledger after a load of files whose names are written bare."""
    root = new_location(spark, "csv")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), name.alias("name"), "c_mktsegment")
    write_by_segment(rows, root, BARE)
    table_name, location = scratch_table(spark)
    load = CsvLoad(table=table_name, base=root, pattern=r"lake/.*\.csv")
    return load_csv(spark, load, root, location).details.where("state <> 'begun'")


def csv_surplus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a cell too many, by file."""
    name = F.when(F.col("c_nationkey") == 5, F.concat("c_name", F.lit(",more"))).otherwise(F.col("c_name"))
    return _ragged(spark, sf_dir, name).select(segment_folder("path"), "rows_loaded", "surplus_rows")


def csv_unclosed_quote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quote that is opened and never closed, in the file with the first customer."""
    name = F.when(F.col("c_custkey") == 1, F.concat(F.lit('"'), "c_name")).otherwise(F.col("c_name"))
    return _ragged(spark, sf_dir, name).select(segment_folder("path"), "rows_loaded", "problem")


NAME = "c_name || CASE WHEN c_nationkey = 5 THEN chr(10) || '\"five\", 5' ELSE '' END"
# length of a cell in the file: one with quotes is quoted, and its quotes are doubled
LINE = """length(CAST(c_custkey AS VARCHAR)) + 1
    + length(c_name) + CASE WHEN c_nationkey = 5 THEN 1 + length('""five"", 5') + 2 ELSE 0 END + 1
    + CASE WHEN c_nationkey <> 3 THEN length(CAST(c_nationkey AS VARCHAR)) ELSE 0 END + 1"""

QUERIES = {
    "manifest_scan": manifest_scan,
    "csv_per_file_headers": csv_per_file_headers,
    "csv_land": csv_land,
    "manifest_scan_large": manifest_scan_large,
    "csv_land_large": csv_land_large,
    "csv_explicit_columns": csv_explicit_columns,
    "csv_load_summary": csv_load_summary,
    "csv_load_totals": csv_load_totals,
    "csv_dry_run": csv_dry_run,
    "ledger_load": ledger_load,
    "csv_batches": csv_batches,
    "csv_wide": csv_wide,
    "csv_surplus": csv_surplus,
    "csv_unclosed_quote": csv_unclosed_quote,
}

SQL = {
    "manifest_scan": f"""
        SELECT c_mktsegment AS merchant, CAST(sum({LINE}) AS BIGINT) AS data_bytes, true AS hashed
        FROM customer GROUP BY 1""",
    "csv_per_file_headers": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS key, {NAME} AS name,
               CASE WHEN c_nationkey <> 3 THEN CAST(c_nationkey AS VARCHAR) END AS nation, c_mktsegment AS segment
        FROM customer""",
    "csv_land": """
        SELECT c_mktsegment AS segment, count(*) AS n, count(*) AS row_ids, CAST(sum(c_custkey) AS BIGINT) AS sum_key,
               true AS hash_matches
        FROM customer GROUP BY 1""",
    "csv_explicit_columns": f"""
        SELECT segment, CASE turn WHEN 0 THEN key WHEN 1 THEN name ELSE nation END AS a,
               CASE turn WHEN 0 THEN name WHEN 1 THEN nation ELSE key END AS b,
               CASE turn WHEN 0 THEN nation WHEN 1 THEN key ELSE name END AS c
        FROM (SELECT CAST(c_custkey AS VARCHAR) AS key, {NAME} AS name, c_mktsegment AS segment,
                     CASE WHEN c_nationkey <> 3 THEN CAST(c_nationkey AS VARCHAR) END AS nation,
                     coalesce(length(c_mktsegment) % 3, 0) AS turn
              FROM customer)""",
    "csv_load_summary": """
        SELECT c_mktsegment AS folder, CAST(NULL AS VARCHAR) AS problem, count(*) AS rows_loaded FROM customer GROUP BY 1
        UNION ALL SELECT 'header_only', NULL, 0 UNION ALL SELECT 'repeated', 'duplicate_columns', 0""",
    "csv_load_totals": "SELECT count(*) AS rows_loaded, true AS some_failed FROM customer",
    "csv_dry_run": """
        SELECT DISTINCT c_mktsegment AS folder, CAST(3 AS BIGINT) AS n_columns, CAST(NULL AS VARCHAR) AS problem FROM customer
        UNION ALL SELECT 'header_only', 2, NULL UNION ALL SELECT 'repeated', 0, 'duplicate_columns'""",
}
SQL |= {
    "ledger_load": """
        WITH files AS (SELECT coalesce(length(c_mktsegment) % 3, 0) = 0 AS early, count(*) AS n
                       FROM customer GROUP BY c_mktsegment, 1)
        SELECT 1::BIGINT AS nth, count(*) AS listed, count(*) AS opened, count(*) AS landed, coalesce(sum(n), 0)::BIGINT AS rows
        FROM files WHERE early
        UNION ALL SELECT 2, count(*), 0, 0, 0 FROM files WHERE early
        UNION ALL SELECT 3, count(*), count(*) FILTER (NOT early), count(*) FILTER (NOT early),
                         coalesce(sum(n) FILTER (NOT early), 0)::BIGINT FROM files""",
    "csv_batches": """
        SELECT c_mktsegment AS segment, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS sum_key,
               (SELECT (count(DISTINCT coalesce(c_mktsegment, '')) + 1) // 2 FROM customer) AS batches
        FROM customer GROUP BY 1""",
    "csv_wide": """
        SELECT c_mktsegment AS segment, CAST(c_custkey AS VARCHAR) AS c0, CAST(c_custkey + 149 AS VARCHAR) AS c149,
               CAST(c_custkey + 150 AS VARCHAR) AS c150, CAST(c_custkey + 199 AS VARCHAR) AS c199
        FROM customer""",
    "csv_surplus": """
        SELECT c_mktsegment AS segment, count(*) AS rows_loaded, count(*) FILTER (c_nationkey = 5) AS surplus_rows
        FROM customer GROUP BY 1""",
    "csv_unclosed_quote": """
        SELECT c_mktsegment AS segment, CASE WHEN bool_or(c_custkey = 1) THEN 0 ELSE count(*) END AS rows_loaded,
               CASE WHEN bool_or(c_custkey = 1) THEN 'unclosed_quote' END AS problem
        FROM customer GROUP BY 1""",
}
SQL["manifest_scan_large"] = SQL["manifest_scan"]
SQL["csv_land_large"] = SQL["csv_land"]
