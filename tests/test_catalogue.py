"""Every query against its SQL, on the smallest of the given data sets."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from moorage.catalogue import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    cursor = duck.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})")
    assert got == sorted(cursor.fetchall(), key=repr)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
