"""Update-only patch run: view to patches to target."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from moorage.operators.joins import left_join_spread
from moorage.operators.merge import in_collection
from moorage.operators.patch import (
    apply_patches,
    build_patches,
    document_hits,
    operations,
    patch_estimate,
    patch_sample,
    patch_stats,
    repeated_keys,
    run_counters,
    with_audit,
)
from moorage.session import materialise
from moorage.sinks.tables import replace_collection, replace_table, write_to
from moorage.spec import PatchLoad


@dataclass(frozen=True)
class PatchResult:
    rows: DataFrame | None  # the patched target; None in a dry run
    stats: DataFrame
    sample: DataFrame | None = None


@dataclass(frozen=True)
class PatchRun:
    counters: dict[str, int]
    started: datetime
    finished: datetime


def patches_of(load: PatchLoad, view: DataFrame) -> DataFrame:
    if not load.field_mapping:
        raise ValueError("field_mapping is required")
    source = view.where(load.where) if load.where else view
    return build_patches(source, load.field_mapping, load.match_field, load.order_by)


def dry_run(load: PatchLoad, view: DataFrame) -> PatchResult:
    """Rows, batches and one patch as it would be applied. The target is not touched."""
    source = view.where(load.where) if load.where else view
    return PatchResult(None, patch_estimate(source, load.batch_size), patch_sample(patches_of(load, view)))


def _stored_patches(load: PatchLoad, view: DataFrame) -> DataFrame:
    patches = materialise(patches_of(load, view), "patches")
    if not load.order_by and not repeated_keys(patches).isEmpty():
        raise ValueError(f"{load.match_field} repeats in {load.view}; name a column to order its rows by")
    return patches


def run_patch(load: PatchLoad, view: DataFrame, target: DataFrame, first_by: str | None = None) -> PatchResult:
    """The patched target and the counters of the run, from patches that are stored once.

    Without an order column the keys of the view must not repeat: which of two patches came last would
    be a matter of chance.
    """
    if load.dry_run:
        return dry_run(load, view)
    patches = _stored_patches(load, view)
    rows = apply_patches(target, patches, load.target_match_field, first_by=first_by)
    return PatchResult(rows, patch_stats(target, patches, load.target_match_field, first_by))


def patch_table(spark: SparkSession, load: PatchLoad, table: str, first_by: str | None = None) -> PatchRun:
    """Run the patches of a view on a table of documents with typed columns, and count."""
    started = datetime.now(timezone.utc)
    result = run_patch(load, spark.table(load.view), spark.table(table), first_by)
    counters = result.stats.first().asDict()  # before the table changes
    if result.rows is not None:
        replace_table(result.rows, table)
    return PatchRun(counters, started, datetime.now(timezone.utc))


def patch_documents(spark: SparkSession, load: PatchLoad, table: str, key_type: str = "string") -> PatchRun | PatchResult:
    """Run the patches of a view on ``load.collection`` of a document landing table, and count.

    ``load.target_match_field`` and the mapped targets are dotted paths. The touched documents are stored once; counters
    come from them, and the collection is rewritten only if there are any. Row ids and load times stay, hashes follow
    the content: an upsert from a source without the patch takes it for changed, and overwrites it.
    """
    view = spark.table(load.view)
    if load.dry_run:
        return dry_run(load, view)
    started = datetime.now(timezone.utc)
    patches = _stored_patches(load, view)
    target = in_collection(spark.table(table), load.collection)
    hits = materialise(document_hits(target, patches, load.target_match_field, key_type), "hits")
    counters = run_counters(patches, hits).first().asDict()
    if counters["matched"]:
        new = hits.select(F.col("row_id").alias("hit_id"), F.col("row_data").alias("new_data"), F.col("document_hash").alias("new_hash"))
        joined = left_join_spread(target, new, "row_id", "hit_id")
        hit = F.col("hit_id").isNotNull()
        values = {
            "row_data": F.when(hit, F.col("new_data")).otherwise(F.col("row_data")),
            "document_hash": F.when(hit, F.col("new_hash")).otherwise(F.col("document_hash")),
        }
        rows = joined.select(*[values[c].alias(c) if c in values else F.col(c) for c in target.columns])
        replace_collection(rows, table, load.collection)
    return PatchRun(counters, started, datetime.now(timezone.utc))


def send_patches(load: PatchLoad, view: DataFrame, sink: str, options: dict[str, str]) -> None:
    """Hand the patches to a document-store connector.

    ``options`` must tell it to update by the key without inserting, and to pass over NULL fields.
    """
    write_to(with_audit(operations(patches_of(load, view)), load.target_match_field), sink, options)
