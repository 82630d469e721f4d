import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from moorage.functions.csv_text import leaves_quote_open
from moorage.operators.csv_rows import landing_rows
from moorage.plans import csv_load
from moorage.sources.csv_files import split_records
from moorage.spec import CsvLoad
from tests.conftest import plan_of, rows_of


@pytest.mark.parametrize(
    "line, outside, inside",
    [
        ("a,b", False, True), ("", False, True), ('a,"b', True, False), ('"a","b"', False, False), ('b",c', False, False),
        ('"', True, False), ('""', False, True), ('"""', True, False), ('a,"b""c', True, False), ('"a""', True, False),
        ('5" pipe,x', False, False), ('a,5" pipe', False, False), ('x","y', True, True), ('x",y,"z', True, True),
        ('"a"b,"c', True, True), (',,"', True, False), ('"",""', False, True), ('a b"', False, False), (' "a', False, False),
        ('"a\r', True, False), ('"a""",b', False, False), ('"""a"', False, False), ('"a,"b', False, True),
    ],
)
def test_states(spark, line, outside, inside):
    df = spark.createDataFrame([(line,)], "x string")
    got = df.select(leaves_quote_open(F.col("x")), leaves_quote_open(F.concat(F.lit('"'), "x"))).first()
    assert tuple(got) == (outside, inside)


def split_lines(spark, text, cuts):
    """Lines as a scan in splits gives them, with a split beginning at each of the given lines."""
    rows, block = [], 0
    for i, line in enumerate(text.split("\n")):
        block = i if i in cuts else block
        rows.append(("f", block, i, line))
    return spark.createDataFrame(rows, "uri string, block long, place long, value string")


def test_records_that_reach_over_several_splits(spark):
    text = 'h,k\n1,"a\nb\n\nc"\n2,x\n"3\n","\ny"\n4,5" z\n5,w'
    whole = ["h,k", '1,"a\nb\n\nc"', "2,x", '"3\n","\ny"', '4,5" z', "5,w"]
    for cuts in ({}, {1}, {2}, {3, 4}, {2, 3, 4, 5}, set(range(11)), {7, 9}):
        records = split_records(split_lines(spark, text, cuts))
        assert [r.record for r in records.orderBy("block", "nth").collect()] == whole, cuts


def test_any_table_comes_back(spark):
    pick = random.Random(3)
    lines, tables = [], {}
    for i in range(80):
        cells = ["".join(pick.choices('ab",\n\r é', k=pick.randint(0, 4))) for _ in range(2 * pick.randint(1, 12))]
        tables[f"f{i}"] = [list(row) for row in zip(cells[::2], cells[1::2])]
        out = io.StringIO()
        quoting = csv.QUOTE_ALL if i % 2 else csv.QUOTE_MINIMAL
        csv.writer(out, lineterminator="\n", quoting=quoting).writerows(tables[f"f{i}"])
        block = 0
        for place, line in enumerate(out.getvalue().removesuffix("\n").split("\n")):
            block = place if place and pick.random() < 0.3 else block
            lines.append((f"f{i}", block, place, line))
    frame = spark.createDataFrame(lines, "uri string, block long, place long, value string")
    got = {}
    for r in split_records(frame).orderBy("uri", "block", "nth").collect():
        got.setdefault(r.uri, []).append(next(csv.reader(io.StringIO(r.record, newline=""))))
    assert got == tables


def loaded(spark, root, **options):
    load = CsvLoad(table="none_such", base=root, **options)
    files = csv_load.name_columns(spark, load, csv_load.choose_files(spark, load, root))
    rows = landing_rows(spark, files)
    return files, rows, rows_of(rows.select("filename", F.to_json("row_data")))


def test_large_files_give_the_rows_of_small_ones(spark, lake):
    quoted = "".join(f'{i},"name {i}\n""x"", {i}"\r\n' for i in range(400))
    stray = "".join(f'{i},{i}" pipe\n' for i in range(400))
    lake.write("lake/a/quoted.csv", '\ufeffid,"na\nme"\r\n' + quoted)
    lake.write("lake/a/stray.csv", "id,size\n" + stray)
    lake.write("lake/b/mixed.csv", "id,size\n" + stray + quoted + "\n" + stray)
    lake.write("lake/b/long.csv", 'id,text\n1,"' + "line\n" * 5000 + '"\n2,x\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        _, _, small = loaded(spark, lake.root)
        files, rows, large = loaded(spark, lake.root, fingerprint="listing", max_content_bytes=100)
        assert large == small and len(small) == 400 + 400 + 1200 + 2
        assert dict(rows_of(files.select("path", "reading"))) == {
            "lake/a/quoted.csv": "records", "lake/a/stray.csv": "lines", "lake/b/mixed.csv": "records", "lake/b/long.csv": "records",
        }
        assert "multiLine" not in plan_of(rows)
        _, _, named = loaded(spark, lake.root, columns=("p", "q"))
        assert loaded(spark, lake.root, columns=("p", "q"), max_content_bytes=100)[2] == named
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
