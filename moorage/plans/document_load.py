"""Document landing: filter, project, hash, then append or upsert."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from moorage.operators.landing import (
    bad_rows,
    counted,
    failures,
    first_documents,
    good_rows,
    landing_columns,
    matching,
    parse_documents,
    typed_documents,
)
from moorage.operators.merge import (
    INSERT,
    UNCHANGED,
    UPDATE,
    action_counts,
    classified,
    in_collection,
    latest_documents,
    updated_rows,
)
from moorage.operators.profile import export_estimate, sample_documents, upsert_estimate
from moorage.session import materialise
from moorage.sinks.tables import append_rows, create_document_landing, next_row_id, replace_collection, row_ids
from moorage.sources.collections import selected_documents
from moorage.sources.tables import read_table
from moorage.spec import DocumentLoad

MODES = ("append", "append_new", "upsert")


class NothingLanded(RuntimeError):
    """Documents were read, and every one of them was bad."""


@dataclass(frozen=True)
class DocumentResult:
    read: int
    failed: int
    inserted: int
    updated: int
    unchanged: int
    duplicates: int
    failures: DataFrame
    bad: DataFrame  # whole texts of the documents that failed
    seconds: float

    @property
    def per_second(self) -> float:
        return (self.inserted + self.updated) / self.seconds if self.seconds else 0.0


@dataclass(frozen=True)
class DryRun:
    estimate: DataFrame
    upsert: DataFrame | None
    samples: DataFrame
    failures: DataFrame


def prepare(load: DocumentLoad, documents: DataFrame) -> DataFrame:
    """Landing columns of a collection: ``documents`` has JSON text in ``raw``, or VARIANT in ``doc``, or typed columns.

    A filter on typed columns goes to the scan as far as they can tell.
    """
    keep, query = [load.order_by] if load.order_by else [], load.query
    if "raw" in documents.columns:
        parsed = parse_documents(documents)
    else:
        if "doc" not in documents.columns:
            documents, query = selected_documents(documents, query, load.fields, keep)
        parsed = typed_documents(documents)
    chosen = first_documents(matching(parsed, query), load.limit)
    return landing_columns(chosen, load.collection, load.fields, need_id=load.mode != "append", keep=keep)


def dry_run(spark: SparkSession, load: DocumentLoad, documents: DataFrame) -> DryRun:
    """What a load would do. Nothing is written to the table."""
    rows = materialise(prepare(load, documents), "documents")
    good = good_rows(rows)
    estimate = export_estimate(good, load.batch_size)
    landing = read_table(spark, load.table)
    upsert = None
    if load.mode == "upsert" and landing is not None:
        upsert = upsert_estimate(landing, load.collection, estimate)
    return DryRun(estimate, upsert, sample_documents(good), failures(rows))


def load_documents(
    spark: SparkSession, load: DocumentLoad, documents: DataFrame, location: str | None = None
) -> DocumentResult | DryRun:
    """Land a collection, or with ``dry_run`` say what that would do and write nothing, not even an empty table.

    Raises if documents were read and none could be landed.
    """
    if load.mode not in MODES:
        raise ValueError(f"unknown mode {load.mode!r}")
    if load.dry_run:
        return dry_run(spark, load, documents)
    started = time.monotonic()
    create_document_landing(spark, load.table, location)
    cluster = ["document_id"] if load.cluster else None  # the time of the load is the same for all rows
    seen = Observation()
    # Good and bad documents are stored in one pass, parsed once. The counts are taken in the tasks that write,
    # before any shuffle, so that a lost executor does not make Spark count rows again.
    rows = materialise(counted(prepare(load, documents), seen), "documents")
    good = good_rows(rows)
    if load.mode == "append":
        append_rows(good, load.table, cluster)
        return _result(load, rows, seen, started, inserted=seen.get["read"] - seen.get["failed"])
    source, duplicates = _each_id_once(good, load.order_by)
    target = in_collection(spark.table(load.table), load.collection)
    acted = materialise(classified(target, source), "actions")
    counts = {r.action: r.n for r in action_counts(acted).collect()}
    new = acted.where(F.col("action") == INSERT).drop("action")
    n_insert, n_update, n_same = (counts.get(a, 0) for a in (INSERT, UPDATE, UNCHANGED))
    if load.mode == "append_new" or n_update == 0:
        if n_insert:
            append_rows(new, load.table, cluster)
        if load.mode == "append_new":
            n_same, n_update = n_same + n_update, 0
    else:
        added = new.withColumns(
            {"row_id": row_ids(next_row_id(spark.table(load.table))), "load_timestamp": F.localtimestamp()}
        )
        changed = acted.where(F.col("action") == UPDATE).drop("action")
        content = updated_rows(target, changed).unionByName(added.select(*target.columns))
        replace_collection(content, load.table, load.collection)
    return _result(load, rows, seen, started, n_insert, n_update, n_same, duplicates)


def _each_id_once(good: DataFrame, order_by: str | None) -> tuple[DataFrame, int]:
    """Source of an upsert, and how many documents gave way to a later one with the same id.

    Documents are only sorted and stored again if ids do repeat.
    """
    columns = ["row_data", "document_id", "document_hash", "collection_name"]
    n = good.agg(F.count("*").alias("rows"), F.count_distinct("document_id").alias("ids")).first()
    if n.rows == n.ids:
        return good.select(*columns), 0
    return materialise(latest_documents(good, order_by).select(*columns), "latest"), n.rows - n.ids


def _result(
    load: DocumentLoad,
    rows: DataFrame,
    seen: Observation,
    started: float,
    inserted: int = 0,
    updated: int = 0,
    unchanged: int = 0,
    duplicates: int = 0,
) -> DocumentResult:
    read, failed = seen.get["read"], seen.get["failed"]
    if read and read == failed:
        raise NothingLanded(f"all {read} documents of {load.collection} are bad")
    seconds = time.monotonic() - started
    return DocumentResult(read, failed, inserted, updated, unchanged, duplicates, failures(rows), bad_rows(rows), seconds)
