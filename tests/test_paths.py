from datetime import date

import pytest
from pyspark.sql import functions as F

from moorage.functions import paths


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column).first()[0]


@pytest.mark.parametrize(
    "path, expected",
    [
        ("lake/acme/report_2025_01_15.csv", date(2025, 1, 15)),
        ("lake/acme/report_2025_01_15.CSV", date(2025, 1, 15)),
        ("2025_01_15.csv", date(2025, 1, 15)),
        ("report_2025_02_30.csv", None),
        ("report_0000_01_01.csv", None),
        ("report_2025_13_01.csv", None),
        ("report_2025_01_15.csv.gz", None),
        ("report_2025_01_15_v2.csv", None),
        ("report_2025_1_5.csv", None),
        ("notes.csv", None),
        ("12025_01_15.csv", date(2025, 1, 15)),
        ("2024_02_29.csv", date(2024, 2, 29)),
        ("2023_02_29.csv", None),
    ],
)
def test_file_date(spark, path, expected):
    assert one(spark, paths.file_date(F.col("x")), path) == expected


@pytest.mark.parametrize(
    "path, expected",
    [("lake/acme/x.csv", "acme"), ("lake/x.csv", "x.csv"), ("x.csv", "unknown"), ("a//b", ""), ("", "unknown")],
)
def test_merchant(spark, path, expected):
    assert one(spark, paths.merchant(F.col("x")), path) == expected


@pytest.mark.parametrize(
    "path, base, expected",
    [
        ("s3://bucket/lake/a.csv", None, "lake/a.csv"),
        ("s3a://bucket/lake/a.csv", "s3a://bucket/lake", "a.csv"),
        ("s3://bucket", None, "s3://bucket"),
        ("lake/a.csv", None, "lake/a.csv"),
        ("file:/tmp/x/lake/a.csv", "/tmp/x", "lake/a.csv"),
        ("file:/tmp/x/lake/a.csv", "file:///tmp/x/", "lake/a.csv"),
        ("file:/tmp/xy/a.csv", "/tmp/x", "tmp/xy/a.csv"),
    ],
)
def test_relative_path(spark, path, base, expected):
    assert one(spark, paths.relative_path(F.col("x"), base), path) == expected


def test_decoded_uri(spark):
    assert one(spark, paths.decoded_uri(F.col("x")), "file:///tmp/a%20b+c/%5B1%5D.csv") == "file:/tmp/a b+c/[1].csv"


def test_whole_match(spark):
    match = paths.whole_match(F.col("x"), r".*/data_source_file_01.*\.csv|other")
    assert one(spark, match, "lake/m/data_source_file_01_2025.csv") is True
    assert one(spark, match, "lake/m/data_source_file_01.csv.bak") is False
    assert one(spark, match, "data_source_file_01.csv") is False
    assert one(spark, match, "other") is True
    assert one(spark, match, "another") is False
