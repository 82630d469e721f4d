from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from moorage.operators.manifest import (
    after_start,
    first_files,
    latest_per_merchant,
    new_files,
    select_files,
    selection_counts,
    start_of,
)
from moorage.sources.files import with_attributes
from moorage.sources.tables import loaded_files
from tests.conftest import plan_of, rows_of


def manifest(spark, *files):
    rows = [(f"s3://b/{p}", f"s3://b/{p}", 1, h, None) for p, h in files]
    return with_attributes(spark.createDataFrame(rows, "full_path string, uri string, length long, content_hash string, header string"))


def ledger(spark, *files):
    return loaded_files(spark, spark.createDataFrame(list(files) or [], "filename string, file_hash string"))


def paths(df):
    return sorted(r.path for r in df.collect())


def test_new_files_compare_path_and_hash_and_null_equals_null(spark):
    files = manifest(spark, ("l/a/1.csv", "h1"), ("l/a/2.csv", "h2"), ("l/a/3.csv", None), ("l/a/4.csv", None), ("l/a/5.csv", "h5"))
    loaded = ledger(spark, ("s3://b/l/a/1.csv", "h1"), ("l/a/2.csv", "old"), ("l/a/3.csv", None), ("l/a/4.csv", "h4"), ("l/a/1.csv", "h1"))
    assert loaded.count() == 4
    fresh = new_files(files, loaded)
    assert paths(fresh) == ["l/a/2.csv", "l/a/4.csv", "l/a/5.csv"]
    assert "NestedLoop" not in plan_of(fresh) and "Cartesian" not in plan_of(fresh)
    assert paths(new_files(files, loaded_files(spark, None))) == paths(files)


def test_start_date(spark):
    files = manifest(spark, ("l/a/r_2024_12_31.csv", "1"), ("l/a/r_2025_01_01.csv", "2"), ("l/a/n.csv", "3"), ("l/a/r_2025_02_30.csv", "4"))
    assert paths(files.where(after_start("2025-01-01"))) == ["l/a/n.csv", "l/a/r_2025_01_01.csv", "l/a/r_2025_02_30.csv"]
    assert start_of("2024-05-06") == date(2024, 5, 6)
    assert start_of(datetime(2024, 5, 6, 7)) == date(2024, 5, 6)
    assert start_of(None) == start_of(5) == date(2025, 1, 1)
    with pytest.raises(ValueError):
        start_of("06.05.2024")


def test_latest_per_merchant(spark):
    files = manifest(
        spark, ("l/a/x_2025_01_01.csv", "1"), ("l/a/x_2025_03_01.csv", "2"), ("l/a/w_2025_03_01.csv", "3"), ("l/a/n.csv", "4"),
        ("l/b/n1.csv", "5"), ("l/b/n2.csv", "6"), ("solo.csv", "7"),
    )
    latest = latest_per_merchant(files)
    assert paths(latest) == ["l/a/w_2025_03_01.csv", "l/b/n1.csv", "l/b/n2.csv", "solo.csv"]
    assert latest.columns == files.columns
    assert "Window" not in plan_of(latest)


def test_first_files(spark):
    files = manifest(spark, ("c", "1"), ("a", "2"), ("b", "3"))
    assert paths(first_files(files, 2)) == ["a", "b"]
    assert paths(first_files(files, None)) == ["a", "b", "c"]
    assert paths(first_files(files, 0)) == []


def test_select_files_refuses_unknown_modes(spark):
    files = manifest(spark, ("a", "1"))
    with pytest.raises(ValueError):
        select_files(files, ledger(spark), load_mode="weekly")
    with pytest.raises(ValueError):
        select_files(files, ledger(spark), latest_of="some")


def test_selection_counts(spark):
    files = manifest(spark, ("l/a/r_2024_12_31.csv", "1"), ("l/a/r_2025_01_01.csv", "2"), ("l/a/n.csv", None), ("l/a/m.csv", "3"))
    loaded = ledger(spark, ("l/a/n.csv", None), ("l/a/gone.csv", "9"))
    assert rows_of(selection_counts(files, loaded, "2025-01-01")) == [(4, 1, 1, 2)]


def test_a_merchant_with_most_files_is_aggregated_before_the_shuffle(spark):
    files = spark.range(20000).select(F.concat(F.lit("s3://b/l/hot/n"), "id", F.lit(".csv")).alias("full_path"))
    rows = with_attributes(files.select("full_path", F.col("full_path").alias("uri"), F.lit(1).cast("long").alias("length"), F.lit("h").alias("content_hash"), F.lit(None).cast("string").alias("header")))
    assert latest_per_merchant(rows).count() == 20000
    assert "partial_min" in plan_of(latest_per_merchant(rows))
