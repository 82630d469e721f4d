"""Choice of files, on a manifest made from the orders table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from moorage.catalogue.tables import table, text
from moorage.functions.paths import relative_path, whole_match
from moorage.operators.manifest import (
    after_start,
    first_files,
    latest_per_merchant,
    new_files,
    select_files,
    selection_counts,
)
from moorage.session import materialise
from moorage.sources.files import preview_files, with_attributes
from moorage.sources.tables import loaded_files

START = "1998-01-01"


def order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing: one path per customer group and day, some undated, misdated or without a folder."""
    orders = table(spark, sf_dir, "orders")
    group = F.col("o_custkey") % 50
    day = F.date_format("o_orderdate", "yyyy_MM_dd")
    name = (
        F.when((F.col("o_orderkey") % 11 == 0) | (group % 10 == 0), F.concat(F.lit("notes_"), text(F.col("o_orderkey") % 7), F.lit(".csv")))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("report_2025_02_30.CSV"))
        .otherwise(F.concat(F.lit("report_"), day, F.lit(".csv")))
    )
    path = F.when(group == 7, name).otherwise(F.concat(F.lit("lake/m"), text(group), F.lit("/"), name))
    listed = orders.select(
        F.concat(F.lit("s3://bucket/"), path).alias("full_path"), F.col("o_orderkey").alias("key")
    )
    files = listed.groupBy("full_path").agg(F.min("key").alias("key"), F.count("*").alias("length"))
    digest = F.when(F.col("key") % 13 != 0, F.md5(text("key")))
    return files.select(
        "full_path",
        F.col("full_path").alias("uri"),
        "length",
        digest.alias("content_hash"),
        F.lit(None).cast("string").alias("header"),
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_attributes(order_files(spark, sf_dir))


def loaded(files: DataFrame) -> DataFrame:
    """Landing rows of the files with an even number of orders; of four, the content was another."""
    files = files.where(F.col("length") % 2 == 0)
    digest = F.when(F.col("length") % 4 == 0, F.lit("stale")).otherwise(F.col("content_hash"))
    rows = files.select(F.col("full_path").alias("filename"), digest.alias("file_hash"))
    return rows.unionByName(rows)


def manifest_and_ledger(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both from one stored listing, as both are needed more than once."""
    files = materialise(order_files(spark, sf_dir), "listing")
    return with_attributes(files), loaded_files(spark, loaded(files))


def manifest_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(spark, sf_dir).select("path", "merchant", text("file_date").alias("file_date"))


def manifest_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(spark, sf_dir).where(whole_match(F.col("path"), r"lake/m[1-3]\d*/report_.*\.csv")).select("path")


def manifest_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview_files(manifest(spark, sf_dir)).select("path", "content_hash")


def ledger_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_files(spark, loaded(order_files(spark, sf_dir)))


def manifest_date_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(spark, sf_dir).where(after_start(START)).select("path")


def manifest_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, ledger = manifest_and_ledger(spark, sf_dir)
    return new_files(files, ledger).select("path", "content_hash")


def manifest_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, _ = manifest_and_ledger(spark, sf_dir)
    return latest_per_merchant(files).select("merchant", "path")


def manifest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_files(manifest(spark, sf_dir), 25).select("path")


def manifest_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, ledger = manifest_and_ledger(spark, sf_dir)
    return select_files(files, ledger, START, "daily", max_files=40).select("path", "content_hash")


def manifest_plan_latest_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, ledger = manifest_and_ledger(spark, sf_dir)
    return select_files(files, ledger, START, "daily", latest_of="all").select("path", "content_hash")


def manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, ledger = manifest_and_ledger(spark, sf_dir)
    return selection_counts(files, ledger, START)


def uri_relative_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", relative_path(F.col("url")).alias("path"))


FILES = """
    SELECT path, count(*) AS length,
           CASE WHEN min(o_orderkey) % 13 <> 0 THEN md5(CAST(min(o_orderkey) AS VARCHAR)) END AS content_hash
    FROM (SELECT o_orderkey,
                 CASE WHEN o_custkey % 50 = 7 THEN '' ELSE 'lake/m' || (o_custkey % 50) || '/' END ||
                 CASE WHEN o_orderkey % 11 = 0 OR o_custkey % 50 % 10 = 0 THEN 'notes_' || (o_orderkey % 7) || '.csv'
                      WHEN o_orderpriority = '5-LOW' THEN 'report_2025_02_30.CSV'
                      ELSE 'report_' || strftime(o_orderdate, '%Y_%m_%d') || '.csv' END AS path
          FROM orders)
    GROUP BY path"""
MANIFEST = f"""
    SELECT *, CASE WHEN contains(path, '/') THEN split_part(path, '/', 2) ELSE 'unknown' END AS merchant,
           CAST(try_strptime(nullif(regexp_extract(path, '(?i)(\\d{{4}}_\\d{{2}}_\\d{{2}})\\.csv$', 1), ''), '%Y_%m_%d') AS DATE) AS file_date
    FROM ({FILES})"""
LEDGER = f"""
    SELECT path, CASE WHEN length % 4 = 0 THEN 'stale' ELSE content_hash END AS content_hash
    FROM ({FILES}) WHERE length % 2 = 0"""


def _new(files: str) -> str:
    return f"""
    SELECT * FROM ({files}) m WHERE NOT EXISTS (
        SELECT 1 FROM ({LEDGER}) l WHERE l.path = m.path AND l.content_hash IS NOT DISTINCT FROM m.content_hash)"""


def _latest(files: str) -> str:
    return f"""
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY merchant ORDER BY file_date DESC NULLS LAST, path) AS nth,
               count(file_date) OVER (PARTITION BY merchant) AS dated FROM ({files}))
    WHERE dated = 0 OR (nth = 1 AND file_date IS NOT NULL)"""


IN_TIME = f"SELECT * FROM ({MANIFEST}) WHERE file_date IS NULL OR file_date >= DATE '{START}'"

QUERIES = {
    "manifest_attributes": manifest_attributes,
    "manifest_pattern": manifest_pattern,
    "manifest_preview": manifest_preview,
    "ledger_distinct": ledger_distinct,
    "manifest_date_cutoff": manifest_date_cutoff,
    "manifest_new_files": manifest_new_files,
    "manifest_latest": manifest_latest,
    "manifest_first": manifest_first,
    "manifest_plan": manifest_plan,
    "manifest_plan_latest_of_all": manifest_plan_latest_of_all,
    "manifest_counts": manifest_counts,
    "uri_relative_path": uri_relative_path,
}

SQL = {
    "manifest_attributes": f"SELECT path, merchant, CAST(file_date AS VARCHAR) AS file_date FROM ({MANIFEST})",
    "manifest_pattern": f"SELECT path FROM ({FILES}) WHERE regexp_full_match(path, 'lake/m[1-3]\\d*/report_.*\\.csv')",
    "manifest_preview": f"SELECT path, content_hash FROM ({FILES}) ORDER BY path LIMIT 10",
    "ledger_distinct": LEDGER,
    "manifest_date_cutoff": f"SELECT path FROM ({IN_TIME})",
    "manifest_new_files": f"SELECT path, content_hash FROM ({_new(MANIFEST)})",
    "manifest_latest": f"SELECT merchant, path FROM ({_latest(MANIFEST)})",
    "manifest_first": f"SELECT path FROM ({FILES}) ORDER BY path LIMIT 25",
    "manifest_plan": f"SELECT path, content_hash FROM ({_latest(_new(IN_TIME))}) ORDER BY path LIMIT 40",
    "manifest_plan_latest_of_all": f"SELECT path, content_hash FROM ({_new(_latest(IN_TIME))})",
    "manifest_counts": f"""
        SELECT count(*) AS found, count(*) FILTER (known) AS already_loaded,
               count(*) FILTER (NOT known AND NOT in_time) AS before_start,
               count(*) FILTER (NOT known AND in_time) AS to_load
        FROM (SELECT path NOT IN (SELECT path FROM ({_new(MANIFEST)})) AS known,
                     file_date IS NULL OR file_date >= DATE '{START}' AS in_time FROM ({MANIFEST}))""",
    "uri_relative_path": """
        SELECT page_id, regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/', '') AS path FROM pages""",
}
