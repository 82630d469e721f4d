"""CSV landing: choose files, read their headers, land their rows, batch by batch."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from moorage.operators.csv_rows import (
    landing_rows,
    load_report,
    seen_surplus,
    surplus_counts,
    with_columns,
    with_headers,
)
from moorage.operators.manifest import after_start, latest_per_merchant, new_files, select_files
from moorage.session import materialise
from moorage.sinks import ledger as book
from moorage.sinks.tables import append_rows, create_csv_landing
from moorage.sources.csv_files import header_records, read_headers
from moorage.sources.files import MAX_CONTENT_BYTES, in_batches, list_files, with_content
from moorage.sources.tables import read_table
from moorage.spec import CsvLoad


@dataclass(frozen=True)
class CsvResult:
    files: DataFrame  # selected files with names and problems
    report: DataFrame  # path, rows_loaded, problem
    details: DataFrame | None = None  # entries of the ledger for this load
    listed: int = 0
    opened: int = 0  # files whose content was read to tell it


@dataclass(frozen=True)
class Survey:
    """What a load found below its root."""

    chosen: DataFrame
    unchanged: DataFrame | None  # opened, and with the content that was loaded before
    listed: int
    opened: int


def survey(spark: SparkSession, load: CsvLoad, root: str | list[str]) -> Survey:
    """List the files, leave out those the ledger knows, open the others in batches, and choose.

    What path, date and listing exclude is never opened. With ``max_files`` opening stops when enough are new.
    """
    seen = Observation()
    listing = list_files(
        spark,
        root,
        pattern=load.pattern,
        glob=load.glob,
        base=load.base,
        fingerprint="listing",
        where=after_start(load.start_date),
    ).observe(seen, F.count("*").alias("n"))
    ledger = book.read_ledger(spark, load.table)
    loaded = book.loaded_content(ledger)
    options = (load.start_date, load.load_mode, load.max_files, load.latest_of)
    if load.fingerprint == "listing":
        files = materialise(select_files(materialise(listing, "manifest"), loaded, *options), "files")
        return Survey(files, None, seen.get["n"], 0)
    if load.fingerprint != "content":
        raise ValueError(f"unknown fingerprint {load.fingerprint!r}")
    wanted = listing
    if load.load_mode == "daily" and load.latest_of == "all":
        wanted = latest_per_merchant(materialise(listing, "manifest"))
    if not load.recheck:
        wanted = book.not_seen(wanted, ledger, load.settle_seconds)
    wanted = materialise(wanted, "unknown")
    found, opened, new = [], 0, 0
    enough = load.max_files if load.load_mode == "historical" else None
    limit = load.max_content_bytes or MAX_CONTENT_BYTES
    for batch in in_batches(wanted, load.batch_files) if enough != 0 else ():
        found.append(materialise(with_content(spark, batch, limit, load.encoding, load.sep), "opened"))
        opened += found[-1].count()
        if enough is not None:
            new += new_files(found[-1], loaded).count()
            if new >= enough:
                break
    if not opened:
        return Survey(wanted.limit(0), None, seen.get["n"], 0)
    candidates = reduce(DataFrame.unionByName, found)
    unchanged = candidates.join(new_files(candidates, loaded).select("uri"), "uri", "left_anti")
    return Survey(materialise(select_files(candidates, loaded, *options), "files"), unchanged, seen.get["n"], opened)


def choose_files(spark: SparkSession, load: CsvLoad, root: str | list[str]) -> DataFrame:
    """Files a load would read, stored."""
    return survey(spark, load, root).chosen


def name_columns(spark: SparkSession, load: CsvLoad, files: DataFrame) -> DataFrame:
    """The chosen files with their column names, stored."""
    limit = load.max_content_bytes or MAX_CONTENT_BYTES
    if load.columns:
        records, _ = header_records(spark, files, load.sep, load.encoding, limit, content=False)
        named = with_columns(files, list(load.columns), limit, load.encoding, records)
    else:
        named = with_headers(files, read_headers(spark, files, load.sep, load.encoding, load.max_columns, limit))
    return materialise(named, "named-files")


def load_csv(spark: SparkSession, load: CsvLoad, root: str | list[str], location: str | None = None) -> CsvResult:
    """Land all new files below ``root``, ``batch_files`` by one append. A dry run reads headers and writes no rows.

    The table is append-only: a changed file is landed again, beside its old rows. Each batch has its entries in the
    ledger, so a run that ended early is gone on with by loading again.
    """
    listed_at = F.lit(datetime.now(timezone.utc))
    if load.dry_run:
        files = choose_files(spark, load, root)
        files = with_columns(files, []) if files.isEmpty() else name_columns(spark, load, files)
        return CsvResult(files, dry_run_report(files))
    new_table = read_table(spark, load.table) is None
    if not new_table:
        book.open_ledger(spark, load.table, False, location)
    found = survey(spark, load, root)
    load_id = uuid.uuid4().hex
    stamp = {"load_id": F.lit(load_id), "listed_at": listed_at}
    named, first = [], None
    for number, batch in enumerate(in_batches(found.chosen, load.batch_files)):
        if new_table and not number:
            create_csv_landing(spark, load.table, location)
            book.open_ledger(spark, load.table, True, location)
        named.append(name_columns(spark, load, batch))
        first = book.next_free_id(spark, load.table)
        land_batch(spark, load, named[-1], {**stamp, "batch": F.lit(number)}, first)
    if new_table and not named:
        nothing = with_columns(found.chosen, [])
        return CsvResult(nothing, load_report(nothing, None), None, found.listed, found.opened)
    if found.unchanged is not None and not new_table and found.opened > found.chosen.count():
        book.write_entries(book.entries(found.unchanged, book.SAME, **stamp), load.table)
    details = spark.table(book.ledger_name(load.table)).where(F.col("load_id") == load_id)
    files = reduce(DataFrame.unionByName, named) if named else with_columns(found.chosen, [])
    ended = details.where(F.col("state").isin(book.LANDED, book.FAILED))
    return CsvResult(files, ended.select("path", "rows_loaded", "problem"), details, found.listed, found.opened)


def land_batch(spark: SparkSession, load: CsvLoad, named: DataFrame, stamp: dict, first: int) -> None:
    """Land the files of one batch: entries, one append, entries with what was landed."""
    good = named.where(F.col("problem").isNull())
    bad = named.where(F.col("problem").isNotNull())
    done = book.entries(bad, book.FAILED, rows_loaded=F.lit(0), **stamp)
    rows = landing_rows(spark, named, load.sep, load.encoding)
    if rows is not None:
        book.write_entries(book.entries(good, book.BEGUN, first_row_id=F.lit(first), **stamp), load.table)
        seen = Observation()
        append_rows(seen_surplus(rows, seen), load.table, ["filename", "file_hash"] if load.cluster else None, first)
        landed = book.landed_counts(spark.table(load.table).where(F.col("row_id") >= first))
        counts = good.join(landed, ["path", "content_hash"], "left")
        counts = counts.withColumn("rows_loaded", F.coalesce("rows_loaded", F.lit(0)))
        ragged = seen.get["files"]
        if ragged:  # read once more, to count by file
            again = landing_rows(spark, good.where(F.col("path").isin(list(ragged))), load.sep, load.encoding)
            counts = counts.join(F.broadcast(surplus_counts(again)), ["path", "content_hash"], "left")
        else:
            counts = counts.withColumn("surplus_rows", F.lit(None))
        counts = counts.withColumn("surplus_rows", F.coalesce(F.col("surplus_rows").cast("bigint"), F.lit(0)))
        done = done.unionByName(book.entries(counts, book.LANDED, first_row_id=F.lit(first), **stamp))
    book.write_entries(done, load.table)


def dry_run_report(files: DataFrame) -> DataFrame:
    """Columns found per file."""
    return files.select("path", F.when(F.col("problem").isNull(), F.size("names")).alias("n_columns"), "problem")
