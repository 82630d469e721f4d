"""Every query that has SQL against its SQL, on the smallest of the given data sets and on empty tables."""

import pytest

import __spark_entry__ as entry_point
from moorage.llm.queries import QUERIES, SQL
from tests.llm.conftest import SMALL

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "pages": "page_id bigint, url string, html string",
}


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    cursor = duck.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})")
    assert got == sorted(cursor.fetchall(), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables_give_empty_results(spark, stored, name):
    folder = stored(**{table: ([], schema) for table, schema in SCHEMAS.items()})
    assert QUERIES[name](spark, folder).count() == 0


def test_all_are_registered():
    assert set(QUERIES) < set(entry_point.queries())
    assert set(SQL) < set(entry_point.oracle_sql())
