"""Which files of a manifest to load."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: first date loaded if none is given.
DEFAULT_START = date(2025, 1, 1)

LOAD_MODES = ("historical", "daily")


def start_of(start_date: str | date | datetime | None) -> date:
    """Cut-off date from an option: ISO text, a date, or the default for anything else."""
    if isinstance(start_date, str):
        return datetime.strptime(start_date, "%Y-%m-%d").date()
    if isinstance(start_date, datetime):
        return start_date.date()
    return start_date if isinstance(start_date, date) else DEFAULT_START


def new_files(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose path and content are not in the ledger; a missing hash equals a missing hash."""
    loaded = ledger.select(F.col("path").alias("loaded_path"), F.col("content_hash").alias("loaded_hash"))
    same = (F.col("path") == F.col("loaded_path")) & F.col("content_hash").eqNullSafe(F.col("loaded_hash"))
    return manifest.join(loaded, same, "left_anti")


def after_start(start_date: str | date | datetime | None) -> Column:
    """Files from the cut-off on; files without a date pass."""
    return F.coalesce(F.col("file_date") >= F.lit(start_of(start_date)), F.lit(True))


def latest_per_merchant(manifest: DataFrame) -> DataFrame:
    """Newest dated file of each merchant; all files of a merchant that has no dated one.

    Of files with the same date the first path is taken. The newest file comes from an aggregation
    that starts before the shuffle, so no merchant's file list meets in one task.
    """
    newest_first = F.struct((-F.unix_date("file_date")).alias("age"), F.col("path").alias("newest_path"))
    newest = (
        manifest.where(F.col("file_date").isNotNull())
        .groupBy("merchant")
        .agg(F.min(newest_first).alias("newest"))
        .select("merchant", "newest.newest_path")
    )
    keep = F.col("newest_path").isNull() | (F.col("path") == F.col("newest_path"))
    return manifest.join(newest, "merchant", "left").where(keep).select(*manifest.columns)


def first_files(manifest: DataFrame, max_files: int | None) -> DataFrame:
    """First files in path order; None means all."""
    return manifest if max_files is None else manifest.orderBy("path").limit(max_files)


def select_files(
    manifest: DataFrame,
    ledger: DataFrame,
    start_date: str | date | datetime | None = None,
    load_mode: str = "historical",
    max_files: int | None = None,
    latest_of: str = "new",
) -> DataFrame:
    """Files a load has to read.

    ``daily`` takes the latest file per merchant, by default among files not loaded yet; with
    ``latest_of="all"`` an older file is not loaded just because the newest already is.
    """
    if load_mode not in LOAD_MODES:
        raise ValueError(f"unknown load mode {load_mode!r}")
    if latest_of not in ("new", "all"):
        raise ValueError(f"unknown latest_of {latest_of!r}")
    files = manifest.where(after_start(start_date))
    if load_mode == "daily" and latest_of == "all":
        files = new_files(latest_per_merchant(files), ledger)
    else:
        files = new_files(files, ledger)
        if load_mode == "daily":
            files = latest_per_merchant(files)
    return first_files(files, max_files)


def selection_counts(manifest: DataFrame, ledger: DataFrame, start_date: str | date | datetime | None = None) -> DataFrame:
    """One row: files found, loaded before, before the cut-off, and left to load."""
    loaded = ledger.select(
        F.col("path").alias("loaded_path"), F.col("content_hash").alias("loaded_hash"), F.lit(True).alias("loaded")
    )
    same = (F.col("path") == F.col("loaded_path")) & F.col("content_hash").eqNullSafe(F.col("loaded_hash"))
    known = F.coalesce("loaded", F.lit(False))
    return manifest.join(loaded, same, "left").agg(
        F.count("*").alias("found"),
        F.count_if(known).alias("already_loaded"),
        F.count_if(~known & ~after_start(start_date)).alias("before_start"),
        F.count_if(~known & after_start(start_date)).alias("to_load"),
    )
