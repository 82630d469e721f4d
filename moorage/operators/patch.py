"""Sparse patches from a view, applied to rows or documents that exist."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from moorage.functions.documents import as_variant, canonical_json, document_hash, field, set_fields
from moorage.functions.values import FEES_FIELD, fee_list, not_blank, utc_timestamp
from moorage.operators.joins import left_join_spread, one_row
from moorage.operators.merge import latest_by_key
from moorage.operators.profile import batches
from moorage.sources.tables import has_column, source_rows

# Audit fields every patched document gets.
UPDATED_AT = "recon_ops_updated_at"
VERSION = "recon_ops_version"

KEY_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType()}

OP, NO_KEY, BLANK_KEY, NO_FIELDS = "op", "skipped_null", "skipped_empty", "no_source_fields"


def patch_value(value: Column, kind: T.DataType, target: str) -> Column:
    """Value a field is set to, or NULL if it is to be left alone."""
    if target == FEES_FIELD:
        return fee_list(value, kind)
    return utc_timestamp(not_blank(value, kind), kind)


def build_patches(source: DataFrame, mapping: Mapping[str, str], key: str, order_by: str | None = None) -> DataFrame:
    """Patches of a view: ``match_key``, struct ``patch`` with a field per target, ``state``.

    Only the key, the mapped columns the view has, and ``order_by`` are read. ``state`` tells patches to
    apply from rows without a key, with a blank one, or with nothing to set. Of several columns for one
    target the last with a value counts.
    """
    kinds = {f.name.lower(): f.dataType for f in source.schema}
    targets: dict[str, list[str]] = {}
    for column, target in mapping.items():
        if has_column(source, column):
            targets.setdefault(target, []).append(column)
    if not targets:
        raise ValueError("the view has none of the mapped columns")
    wanted = {c: t for t, columns in targets.items() for c in columns}
    rows = source_rows(source, key, {**wanted, **({order_by: order_by} if order_by else {})})
    values = [
        F.coalesce(*[patch_value(F.col(f"`{c}`"), kinds[c.lower()], t) for c in reversed(columns)]).alias(t)
        for t, columns in targets.items()
    ]
    order = [F.col(f"`{order_by}`").alias("patch_order")] if order_by else []
    patches = rows.select(F.col(f"`{key}`").alias("match_key"), F.struct(*values).alias("patch"), *order)
    blank = F.lit(False)
    if isinstance(kinds[key.lower()], T.StringType):
        blank = not_blank(F.col("match_key"), T.StringType()).isNull()
    nothing = reduce(lambda a, b: a & b, [F.col("patch")[t].isNull() for t in targets])
    state = F.when(F.col("match_key").isNull(), NO_KEY).when(blank, BLANK_KEY).when(nothing, NO_FIELDS)
    return patches.withColumn("state", state.otherwise(OP))


def _orderable(value: Column, kind: T.DataType) -> Column:
    """Something to order values of a field by."""
    plain = isinstance(kind, T.AtomicType) and not isinstance(kind, T.VariantType)
    return value if plain else F.to_json(F.struct(value.alias("x")))


def operations(patches: DataFrame) -> DataFrame:
    """Patches to apply.

    With a ``patch_order`` the patches of one key are taken together, as if applied one after the other:
    each field gets its last value, equal positions the greater value. The aggregation starts before the
    shuffle. Without an order keys must not repeat.
    """
    ops = patches.where(F.col("state") == OP)
    if "patch_order" not in patches.columns:
        return ops.select("match_key", "patch")
    last = []
    for f in patches.schema["patch"].dataType.fields:
        value = F.col("patch")[f.name]
        place = F.when(value.isNotNull(), F.struct("patch_order", _orderable(value, f.dataType).alias("tie")))
        last.append(F.max_by(value, place).alias(f.name))
    names = [f.name for f in patches.schema["patch"].dataType.fields]
    merged = ops.groupBy("match_key").agg(*last)
    return merged.select("match_key", F.struct(*[F.col(f"`{n}`").alias(n) for n in names]).alias("patch"))


def repeated_keys(patches: DataFrame) -> DataFrame:
    """Keys that several patches want to set."""
    ops = patches.where(F.col("state") == OP)
    return ops.groupBy("match_key").agg(F.count("*").alias("n")).where(F.col("n") > 1)


def _family(kind: T.DataType) -> str:
    if isinstance(kind, T.StringType):
        return "text"
    return "number" if isinstance(kind, T.NumericType) else kind.typeName()


def check_key_types(target: T.DataType, source: T.DataType) -> None:
    """Keys of different kinds never match in the store; a join would cast one of them in silence."""
    if _family(target) != _family(source):
        raise TypeError(f"cannot match keys of type {source.simpleString()} with {target.simpleString()}")


def as_stored(value: Column, kind: T.DataType) -> Column:
    """Value as it goes into a document."""
    nested = isinstance(kind, (T.ArrayType, T.MapType, T.StructType))
    return F.to_variant_object(value) if nested else as_variant(value)


def fitted(value: Column, kind: T.DataType, column: T.DataType) -> Column:
    """Value in the type of the column it goes to; kinds that would need guessing are refused."""
    if isinstance(column, T.VariantType):
        return as_stored(value, kind)
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if _family(kind) == _family(column) or isinstance(column, T.StringType) or (
        isinstance(kind, times) and isinstance(column, times)
    ):
        return value.cast(column)
    raise TypeError(f"cannot set a {column.simpleString()} column to {kind.simpleString()}")


def first_matches(target: DataFrame, ops: DataFrame, key: Column, first_by: Column) -> DataFrame:
    """Operations with the position of the one target row each may touch."""
    positions = target.select(key.alias("match_key"), first_by.alias("at")).where(F.col("match_key").isNotNull())
    first = positions.groupBy("match_key").agg(F.min("at").alias("first_at"))
    return ops.join(first, "match_key")


def _matched(target: DataFrame, ops: DataFrame, key: Column, first_by: Column | None) -> DataFrame:
    """All target rows, with the patch of those that have one."""
    rows = target.withColumn("target_key", key)
    if first_by is None:
        return left_join_spread(rows, ops, "target_key", "match_key")
    rows = rows.withColumn("target_at", first_by)
    first = F.col("target_at") == F.col("first_at")
    return left_join_spread(rows, first_matches(target, ops, key, first_by), "target_key", "match_key", first)


def apply_patches(
    target: DataFrame,
    patches: DataFrame,
    key: str,
    updated_at: Column | None = None,
    first_by: str | None = None,
) -> DataFrame:
    """All rows of a typed target, patched where their key has a patch; nothing is inserted.

    A target whose keys repeat needs ``first_by``: only the first of such rows is touched. Fields the
    target lacks become columns.
    """
    kinds = {f.name: f.dataType for f in target.schema}
    check_key_types(kinds[key], patches.schema["match_key"].dataType)
    now = F.current_timestamp() if updated_at is None else updated_at
    ops = operations(patches)
    first = F.col(first_by) if first_by else None
    joined = _matched(target, ops, F.col(f"`{key}`"), first)
    hit = F.col("match_key").isNotNull()
    values: dict[str, Column] = {}
    for f in patches.schema["patch"].dataType.fields:
        value = F.col("patch")[f.name]
        if f.name in kinds:
            value = F.coalesce(fitted(value, f.dataType, kinds[f.name]), F.col(f"`{f.name}`"))
        values[f.name] = value
    old_at = F.col(UPDATED_AT) if UPDATED_AT in kinds else F.lit(None).cast("timestamp")
    old_version = F.col(VERSION) if VERSION in kinds else F.lit(None).cast("boolean")
    values[UPDATED_AT] = F.when(hit, now).otherwise(old_at)
    values[VERSION] = F.when(hit, F.lit(True)).otherwise(old_version)
    same = [F.col(f"`{c}`") for c in target.columns if c not in values]
    patched = [v.alias(c) for c, v in values.items()]
    order = {c: i for i, c in enumerate(target.columns)}
    result = joined.select(*same, *patched)
    return result.select(*[F.col(f"`{c}`") for c in sorted(result.columns, key=lambda c: order.get(c, len(order)))])


def with_audit(ops: DataFrame, key: str, updated_at: Column | None = None) -> DataFrame:
    """Operations as flat rows for a connector: key, fields to set, audit fields."""
    now = F.current_timestamp() if updated_at is None else updated_at
    return ops.select(
        F.col("match_key").alias(key), "patch.*", now.alias(UPDATED_AT), F.lit(True).alias(VERSION)
    )


def document_key(doc: Column, key: str, key_type: str) -> Column:
    """The value at a dotted path if it is of the kind of the key, else NULL: text and numbers never match."""
    raw = field(doc, *key.split("."))
    is_text = F.schema_of_variant(raw) == "STRING"
    return F.when(is_text if key_type == "string" else ~is_text, F.try_variant_get(raw, "$", key_type))


def document_hits(
    target: DataFrame, patches: DataFrame, key: str, key_type: str = "string", updated_at: Column | None = None
) -> DataFrame:
    """Rows of a landing table that a patch touches: row_id, match_key, the new row_data and document_hash, ``changed``.

    Of several documents with one key, that with the smallest row id is touched. ``changed`` tells whether a mapped
    field got another value; the audit fields always do. Documents no patch is for are dropped by the join, so what
    is shuffled and stored grows with the patches.
    """
    check_key_types(KEY_TYPES[key_type], patches.schema["match_key"].dataType)
    now = F.current_timestamp() if updated_at is None else updated_at
    keyed = target.select("row_id", "row_data", document_key(F.col("row_data"), key, key_type).alias("target_key"))
    met = keyed.where(F.col("target_key").isNotNull()).join(operations(patches), F.col("target_key") == F.col("match_key"))
    first = latest_by_key(met, ["match_key"], [F.col("row_id").asc()])
    fields = {f.name: as_stored(F.col("patch")[f.name], f.dataType) for f in patches.schema["patch"].dataType.fields}
    audit = {UPDATED_AT: as_variant(now), VERSION: as_variant(F.lit(True))}
    laid = first.withColumn("mapped", set_fields(F.col("row_data"), fields))
    changed = canonical_json(F.col("mapped")) != canonical_json(F.col("row_data"))
    patched = laid.select("row_id", "match_key", set_fields(F.col("mapped"), audit).alias("row_data"), changed.alias("changed"))
    return patched.withColumn("document_hash", document_hash(F.col("row_data")))


def apply_patches_to_documents(
    target: DataFrame,
    patches: DataFrame,
    key: str,
    key_type: str = "string",
    updated_at: Column | None = None,
    first_by: Column | None = None,
    doc: str = "doc",
) -> DataFrame:
    """The same for documents in a VARIANT column; ``key`` and mapped targets are dotted paths."""
    check_key_types(KEY_TYPES[key_type], patches.schema["match_key"].dataType)
    now = F.current_timestamp() if updated_at is None else updated_at
    joined = _matched(target, operations(patches), document_key(F.col(doc), key, key_type), first_by)
    hit = F.col("match_key").isNotNull()
    values = {
        f.name: as_stored(F.col("patch")[f.name], f.dataType) for f in patches.schema["patch"].dataType.fields
    }
    values[UPDATED_AT] = as_variant(F.when(hit, now))
    values[VERSION] = as_variant(F.when(hit, F.lit(True)))
    patched = F.when(hit, set_fields(F.col(doc), values)).otherwise(F.col(doc))
    return joined.select(*[patched.alias(doc) if c == doc else F.col(f"`{c}`") for c in target.columns])


def patch_stats(target: DataFrame, patches: DataFrame, key: str, first_by: str | None = None) -> DataFrame:
    """One row of counters over a patch run.

    ``matched`` counts operations with a target row, ``changed`` those that alter a mapped field,
    ``duplicates`` operations overruled by a later one of the same key. Only keys and mapped fields of the
    target are read. ``errors`` is 0: an operation that fails fails the job.
    """
    kinds = {f.name: f.dataType for f in target.schema}
    check_key_types(kinds[key], patches.schema["match_key"].dataType)
    fields = [f for f in patches.schema["patch"].dataType.fields if f.name in kinds]
    new = [f for f in patches.schema["patch"].dataType.fields if f.name not in kinds]
    first = [first_by] if first_by and first_by != key else []
    wanted = list(dict.fromkeys([key, *first, *[f.name for f in fields]]))
    stored = target.where(F.col(f"`{key}`").isNotNull()).select(*[F.col(f"`{c}`") for c in wanted])
    ops = operations(patches)
    if first_by:
        stored = latest_by_key(stored, [key], [F.col(first_by).asc()])
    differs = [F.col("patch")[f.name].isNotNull() for f in new]
    for f in fields:
        value, old = fitted(F.col("patch")[f.name], f.dataType, kinds[f.name]), F.col(f"stored.`{f.name}`")
        value, old = _orderable(value, kinds[f.name]), _orderable(old, kinds[f.name])
        differs.append(F.col("patch")[f.name].isNotNull() & ~value.eqNullSafe(old))
    hits = stored.alias("stored").join(ops, F.col(f"stored.`{key}`") == F.col("match_key"))
    hits = hits.groupBy("match_key").agg(F.bool_or(reduce(lambda a, b: a | b, differs)).alias("changed"))
    return run_counters(patches, hits)


def run_counters(patches: DataFrame, hits: DataFrame) -> DataFrame:
    """The counters of a run from its patches and, per operation that found a row, whether it ``changed`` one."""
    outcome = hits.agg(F.count("*").alias("matched"), F.count_if("changed").alias("changed"))
    states = patches.agg(
        F.count("*").alias("records"),
        *[F.count_if(F.col("state") == s).alias(s) for s in (NO_KEY, BLANK_KEY, NO_FIELDS)],
        F.count_if(F.col("state") == OP).alias("all_ops"),
    )
    return one_row(states, outcome, operations(patches).agg(F.count("*").alias("ops"))).select(
        "records",
        "matched",
        "changed",
        F.lit(0).cast("bigint").alias("errors"),
        NO_KEY,
        BLANK_KEY,
        NO_FIELDS,
        (F.col("ops") - F.col("matched")).alias("not_found"),
        (F.col("all_ops") - F.col("ops")).alias("duplicates"),
    )


def patch_estimate(source: DataFrame, batch_size: int) -> DataFrame:
    """One row for a dry run: rows the run would read, and batches."""
    return source.agg(F.count("*").alias("records")).select("records", batches(F.col("records"), batch_size).alias("batches"))


def patch_sample(patches: DataFrame, n: int = 1) -> DataFrame:
    """First patches in key order, as JSON without the fields that are left alone."""
    return patches.orderBy(F.col("match_key").asc_nulls_last()).limit(n).select("match_key", F.to_json("patch").alias("patch"))
