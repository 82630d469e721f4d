import bz2
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from moorage.plans import csv_load
from moorage.plans.csv_load import load_csv
from moorage.sinks import ledger as book
from moorage.sinks.tables import create_csv_landing
from moorage.spec import CsvLoad
from tests.conftest import rows_of

LONG_AGO = 1_700_000_000


def write(lake, path, content, at=LONG_AGO):
    lake.write(path, content)
    if at:
        os.utime(Path(lake.root) / path, (at, at))


def cells(spark, table):
    return rows_of(spark.table(table).select("filename", F.to_json("row_data").alias("j")))


def several(lake, n=5):
    for i in range(n):
        write(lake, f"lake/m{i}/f_2025_01_0{i + 1}.csv", "x,y\n" + "".join(f"{i},{j}\n" for j in range(i + 1)))


def test_a_second_run_opens_no_file(spark, lake, table):
    several(lake)
    load = CsvLoad(table=table, base=lake.root)
    first = load_csv(spark, load, lake.root)
    assert (first.listed, first.opened, first.report.count()) == (5, 5, 5)
    again = load_csv(spark, load, lake.root)
    assert (again.listed, again.opened, again.report.count()) == (5, 0, 0)
    before = cells(spark, table)
    write(lake, "lake/m0/f_2025_01_01.csv", "x,y\n9,9\n")  # as long and as old: nobody can know without opening it
    assert load_csv(spark, load, lake.root).opened == 0
    opened = load_csv(spark, CsvLoad(table=table, base=lake.root, recheck=True), lake.root)
    assert (opened.opened, rows_of(opened.report)) == (5, [("lake/m0/f_2025_01_01.csv", 1, None)])
    assert len(cells(spark, table)) == len(before) + 1


def test_only_unknown_files_are_opened_and_touched_ones_are_not_landed(spark, lake, table):
    several(lake)
    load = CsvLoad(table=table, base=lake.root)
    load_csv(spark, load, lake.root)
    write(lake, "lake/m9/new.csv", "x\n1\n")
    os.utime(Path(lake.root) / "lake/m1/f_2025_01_02.csv", (LONG_AGO + 60, LONG_AGO + 60))
    result = load_csv(spark, load, lake.root)
    assert (result.opened, rows_of(result.report)) == (2, [("lake/m9/new.csv", 1, None)])
    assert rows_of(result.details.select("path", "state").distinct()) == [
        ("lake/m1/f_2025_01_02.csv", "same"), ("lake/m9/new.csv", "begun"), ("lake/m9/new.csv", "landed")]
    assert load_csv(spark, load, lake.root).opened == 0


def test_a_file_changed_a_moment_ago_is_opened_again(spark, lake, table):
    write(lake, "lake/a/f.csv", "x\n1\n", at=time.time())
    load = CsvLoad(table=table, base=lake.root, settle_seconds=3600)
    load_csv(spark, load, lake.root)
    lake.write("lake/a/f.csv", "x\n2\n")
    result = load_csv(spark, load, lake.root)
    assert (result.opened, rows_of(result.report)) == (1, [("lake/a/f.csv", 1, None)])


@pytest.mark.parametrize("options", [{}, {"fingerprint": "listing"}, {"load_mode": "daily"}, {"max_files": 3}])
def test_small_batches_give_the_rows_and_the_report_of_one(spark, lake, table, options):
    several(lake)
    write(lake, "lake/m1/g_2025_01_09.csv", "a,a\n1,2\n")
    write(lake, "lake/m2/g_2025_01_09.csv", "h\n")
    write(lake, "lake/m3/none.csv", "")
    whole = load_csv(spark, CsvLoad(table=table, base=lake.root, **options), lake.root)
    other = f"{table}_b"
    cut = load_csv(spark, CsvLoad(table=other, base=lake.root, batch_files=2, **options), lake.root)
    assert rows_of(whole.report) == rows_of(cut.report)
    assert rows_of(whole.files.select("path", "names", "problem")) == rows_of(cut.files.select("path", "names", "problem"))
    assert cells(spark, table) == cells(spark, other)
    ids = [r.row_id for r in spark.table(other).select("row_id").collect()]
    assert len(ids) == len(set(ids))
    n = whole.report.count()
    assert cut.details.agg(F.count_distinct("batch")).first()[0] == -(-n // 2)


def test_opening_stops_when_enough_files_are_new(spark, lake, table):
    several(lake)
    result = load_csv(spark, CsvLoad(table=table, base=lake.root, batch_files=1, max_files=2), lake.root)
    assert (result.opened, result.report.count()) == (2, 2)
    assert load_csv(spark, CsvLoad(table=table, base=lake.root, max_files=0), lake.root).opened == 0


class Died(RuntimeError):
    pass


@pytest.mark.parametrize("where", ["before the rows", "after the rows"])
def test_a_run_that_died_is_gone_on_with(spark, lake, table, monkeypatch, where):
    several(lake)
    load = CsvLoad(table=table, base=lake.root, batch_files=2)
    real, calls = csv_load.append_rows, []

    def dying(*args):
        calls.append(1)
        if len(calls) == 2 and where == "before the rows":
            raise Died
        real(*args)
        if len(calls) == 2:
            raise Died

    monkeypatch.setattr(csv_load, "append_rows", dying)
    with pytest.raises(Died):
        load_csv(spark, load, lake.root)
    monkeypatch.undo()
    result = load_csv(spark, load, lake.root)
    assert result.opened == (3 if where == "before the rows" else 1)
    assert spark.table(table).count() == sum(range(1, 6)) == spark.table(table).select("row_id").distinct().count()
    states = dict(rows_of(spark.table(book.ledger_name(table)).groupBy("state").count()))
    assert states == {"begun": 7 if where == "before the rows" else 5, "landed": 5} | ({"lost": 2} if where == "before the rows" else {})
    assert load_csv(spark, load, lake.root).opened == 0


def test_a_table_filled_without_a_ledger_gets_one(spark, lake, table):
    several(lake, 2)
    load = CsvLoad(table=table, base=lake.root)
    load_csv(spark, load, lake.root)
    last = spark.table(table).agg(F.max("row_id")).first()[0]
    spark.sql(f"DROP TABLE {book.ledger_name(table)}")
    write(lake, "lake/m7/new.csv", "x\n1\n")
    result = load_csv(spark, load, lake.root)
    assert (result.opened, rows_of(result.report)) == (3, [("lake/m7/new.csv", 1, None)])
    assert spark.table(table).where(F.col("row_id") > last).count() == 1
    assert load_csv(spark, load, lake.root).opened == 0


def test_a_new_table_starts_with_an_empty_ledger(spark, lake, table):
    several(lake, 1)
    load = CsvLoad(table=table, base=lake.root)
    load_csv(spark, load, lake.root)
    spark.sql(f"DROP TABLE {table}")
    assert load_csv(spark, load, lake.root).report.count() == 1


def test_the_landing_table_is_not_read_for_what_is_loaded(spark, lake, table, monkeypatch):
    several(lake, 2)
    load_csv(spark, CsvLoad(table=table, base=lake.root), lake.root)
    monkeypatch.setattr(book, "loaded_files", lambda *_: pytest.fail("read"))
    monkeypatch.setattr(book, "next_row_id", lambda *_: pytest.fail("read"))
    assert load_csv(spark, CsvLoad(table=table, base=lake.root), lake.root).opened == 0


@pytest.mark.parametrize("options", [{}, {"max_content_bytes": 1}, {"fingerprint": "listing"}])
def test_files_of_any_width(spark, lake, table, options):
    for width in (1, 15, 16, 151, 1000):
        write(lake, f"lake/a/w{width}.csv", ",".join(f"c{i}" for i in range(width)) + "\n" + ",".join(str(i) for i in range(width)) + "\n")
    report = load_csv(spark, CsvLoad(table=table, base=lake.root, **options), lake.root).report
    assert {r.problem for r in report.collect()} == {None}
    got = {name: j.count(":") for name, j in cells(spark, table)}
    assert got == {f"lake/a/w{n}.csv": n for n in (1, 15, 16, 151, 1000)}


@pytest.mark.parametrize("options", [{}, {"max_content_bytes": 1}])
def test_surplus_cells_are_counted_by_file(spark, lake, table, options):
    write(lake, "lake/a/f.csv", "a,b\n1,2,3\n1,2\n1,2,,\n1,2,,,5\n")
    write(lake, "lake/a/g.csv", "a,b\n1,2\n")
    write(lake, "lake/a/h.csv", ",".join(f"c{i}" for i in range(31)) + "\n" + ",".join("x" * 40) + "\n")
    result = load_csv(spark, CsvLoad(table=table, base=lake.root, **options), lake.root)
    landed = result.details.where("state = 'landed'").select("path", "rows_loaded", "surplus_rows")
    assert rows_of(landed) == [("lake/a/f.csv", 4, 2), ("lake/a/g.csv", 1, 0), ("lake/a/h.csv", 1, 1)]
    assert ("lake/a/f.csv", '{"a":"1","b":"2"}') in cells(spark, table)


@pytest.mark.parametrize("options", [{}, {"max_content_bytes": 1}, {"max_content_bytes": 1, "columns": ("p", "q")}, {"fingerprint": "listing"}])
def test_a_quote_that_is_never_closed_is_reported(spark, lake, table, options):
    body = "".join(f'{i},"n\n{i}"\n' for i in range(500))
    write(lake, "lake/a/good.csv", "id,name\n" + body)
    write(lake, "lake/a/inches.csv", 'id,name\n1,5" pipe\n2,x"y"z\n')
    write(lake, "lake/a/open.csv", "id,name\n" + body + '7,"stray\n' + "8,x\n" * 500)
    write(lake, "lake/a/open_header.csv", 'id,"name\n1,2\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        report = {r.path: (r.rows_loaded, r.problem) for r in load_csv(spark, CsvLoad(table=table, base=lake.root, **options), lake.root).report.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert report["lake/a/good.csv"] == (500, None) and report["lake/a/inches.csv"] == (2, None)
    assert report["lake/a/open.csv"] == (0, "unclosed_quote") and report["lake/a/open_header.csv"][1] == "unclosed_quote"


def test_bz2_is_read_in_splits(spark, lake, table):
    lines = [f'{i},"n\n{i}"' if i % 3 == 0 else f"{i},n{i}" for i in range(3000)]
    write(lake, "lake/a/f.csv.bz2", bz2.compress(("id,name\n" + "\n".join(lines) + "\n").encode(), 1))
    load = CsvLoad(table=table, base=lake.root, max_content_bytes=1)
    files = csv_load.name_columns(spark, load, csv_load.choose_files(spark, load, lake.root))
    assert rows_of(files.select("names", "reading")) == [(["id", "name"], "records")]
    assert rows_of(load_csv(spark, load, lake.root).report) == [("lake/a/f.csv.bz2", 3000, None)]
    create_csv_landing(spark, table)
