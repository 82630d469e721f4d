"""Joins against sides of unknown size, and against keys that may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 64


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, lookup_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Inner join of rows with a lookup that has each key once.

    The lookup is broadcast if ``lookup_bytes`` is within ``limit``. Beyond, rows are spread over salted
    keys, and the lookup repeated for each salt, so that no key ends up in one task.
    """
    if lookup_bytes <= limit:
        return rows.join(F.broadcast(lookup), key)
    others = [F.col(c) for c in rows.columns if c != key]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*others), F.lit(SALTS)))
    repeated = lookup.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    return salted.join(repeated, [key, "salt"]).drop("salt")


SCALARS = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def left_join_spread(rows: DataFrame, lookup: DataFrame, key: str, lookup_key: str, *more: Column) -> DataFrame:
    """Left join in which rows without a key, or with empty text for one, are spread over the tasks.

    They match nothing, yet would all be sent to one task. So the join is on the key and a salt: 0 wherever there
    is a key, else a number made from the scalar columns of the row. ``more`` are further conditions.
    """
    value = F.col(f"`{key}`")
    missing = value.isNull()
    if isinstance(rows.schema[key].dataType, T.StringType):
        missing = missing | (value == "")
    scalars = [F.col(f"`{f.name}`") for f in rows.schema if isinstance(f.dataType, SCALARS)]
    salt = F.when(missing, F.pmod(F.xxhash64(F.lit(0), *scalars), F.lit(1000)) + 1).otherwise(F.lit(0))
    salted = rows.withColumn("join_salt", salt.cast("int"))
    # Always 0, but no constant, which the optimiser would take out of the join key.
    found = lookup.withColumn("lookup_salt", F.pmod(F.xxhash64(lookup_key), F.lit(1)).cast("int"))
    on = (value == F.col(lookup_key)) & (F.col("join_salt") == F.col("lookup_salt"))
    for condition in more:
        on = on & condition
    return salted.join(found, on, "left").drop("join_salt", "lookup_salt")


def one_row(*parts: DataFrame) -> DataFrame:
    """Single-row tables side by side, put together as a union of rows and one aggregation."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])
