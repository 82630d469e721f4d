"""The given tables, and landing tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from moorage.functions.values import utc_timestamp
from moorage.session import new_location


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_table(spark: SparkSession) -> tuple[str, str]:
    """Name and place of a table of its own for one run of a query."""
    name = f"moorage_{uuid.uuid4().hex}"
    return name, new_location(spark, name)


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def epoch_millis(df: DataFrame, column: str) -> Column:
    return F.unix_millis(utc_timestamp(F.col(column), df.schema[column].dataType))
