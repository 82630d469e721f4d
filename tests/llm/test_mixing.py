import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from moorage.llm import mixing
from moorage.llm.mixing import mixed_documents, mixture_report, plan_mixture
from moorage.llm.queries import op10_mixing
from tests.llm.conftest import SMALL

SCHEMA = "doc_id bigint, text string, source string, size int, bin string"


def brute_targets(sizes, repeats=3):
    """Shares by weight, the excess of sources that are full reshared until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weights = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        open_ones = [s for s in names if s not in full]
        left = total - sum(full.values())
        share = {s: left * weights[s] / sum(weights[x] for x in open_ones) for s in open_ones}
        over = [s for s in open_ones if share[s] > repeats * sizes[s]]
        if not over:
            return {s: full.get(s, share.get(s)) for s in names}
        full.update({s: float(repeats * sizes[s]) for s in over})


def test_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op10_mixing(spark, SMALL).collect()
    assert len(rows) == len(docs)
    sizes = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text or "")) for r in rows}
    by_source, taken = Counter(), Counter()
    for r in rows:
        by_source[docs[r.doc_id].source] += sizes[r.doc_id]
        taken[docs[r.doc_id].source] += r.taken
        assert r.size == sizes[r.doc_id] and r.taken <= 3 * r.size
    goals = brute_targets(by_source)
    for r in rows:
        source = docs[r.doc_id].source
        assert r.source_size == by_source[source] and r.target == pytest.approx(goals[source])
    for source, goal in goals.items():
        largest_half = sorted(s for i, s in sizes.items() if docs[i].source == source)[len(docs) // 40 :]
        assert taken[source] == pytest.approx(goal, rel=0.03, abs=largest_half[0] / 2)
    assert sorted(rows) == sorted(op10_mixing(spark, SMALL).collect())


def test_nulls_repeats_and_a_hot_source(spark):
    rows = [(i, "w " * (i % 7), "hot" if i % 3 else f"s{i % 6}", 1, "x") for i in range(300)]
    rows += [(None, "a b", None, None, None)] * 3 + [(7, None, "nothing", 1, None), (8, "x " * 5000, "s0", 1, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    report = mixture_report(docs).collect()
    assert len(report) == len(rows)
    sizes = Counter()
    for _, text, source, *_ in rows:
        sizes[source] += len((text or "").split())
    goals = brute_targets(sizes)
    assert {round(r.target, 6) for r in report} == {round(g, 6) for g in goals.values()}
    assert all(0 <= r.taken <= 3 * r.size for r in report)
    assert mixed_documents(docs).columns == docs.columns


def test_the_mixture_holds_what_the_report_says(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    report = {r.doc_id: r.taken // r.size for r in mixture_report(docs).collect() if r.taken}
    assert Counter(r.doc_id for r in mixed_documents(docs).select("doc_id").collect()) == report


def test_shards_draw_disjoint_blocks_and_all_of_them(spark):
    docs = spark.createDataFrame([(i, "w " * 20, f"s{i % 5}", 0, "") for i in range(2000)], SCHEMA)
    _, _, shards, _, count = plan_mixture(docs, words_per_shard=5000)
    rows = shards.collect()
    assert count == 16 and len({(r.bin, r.block, r["pass"]) for r in rows}) == len(rows)
    held = Counter(r.shard for r in rows)
    assert set(held) == set(range(16)) and max(held.values()) - min(held.values()) <= 4


def test_many_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "POOL", 64)
    docs = spark.createDataFrame([(i, "a b c", f"s{i % 40:02}", 0, "") for i in range(400)], SCHEMA)
    assert sum(r.taken for r in mixture_report(docs).collect()) == pytest.approx(1200, rel=0.1)


@pytest.mark.parametrize("sources, hot", [(2000, 0), (5000, 2)])
def test_a_hot_source_among_thousands_comes_near_its_target(spark, sources, hot):
    """A third of all rows; the weight of the source is its place among the names, 1 to 3."""
    number = F.when(F.col("id") % 3 == 0, hot).otherwise(F.col("id") % sources)
    docs = spark.range(sources * 15).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("w "), (F.xxhash64("id") % 5 + 9).cast("int")).alias("text"),
        F.format_string("s%05d", number).alias("source"),
    )
    report = mixture_report(docs).join(docs, "doc_id").where(F.col("source") == f"s{hot:05}")
    (row,) = report.agg(F.first("target").alias("target"), F.sum("taken").alias("taken")).collect()
    assert row.taken == pytest.approx(row.target, rel=0.03, abs=3)


def test_targets_are_met_where_most_blocks_are_tiny(spark, monkeypatch):
    """The candidates, so many blocks by number, hold far fewer words than the target."""
    monkeypatch.setattr(mixing, "BLOCKS", 64)
    rows = [(i, "w " * 3000, "a", 0, "") for i in range(20)] + [(100 + i, "w", "a", 0, "") for i in range(3000)]
    rows += [(10_000 + i, "w " * 1000, f"b{i:02}", 0, "") for i in range(59)]
    report = mixture_report(spark.createDataFrame(rows, SCHEMA)).where("doc_id < 10000").collect()
    assert report[0].target < 1100
    assert sum(r.taken for r in report) == pytest.approx(report[0].target, rel=0.05)


def test_shards_of_several_depths(spark):
    docs = spark.createDataFrame([(i, "w " * 20, f"s{i % 5}", 0, "") for i in range(400)], SCHEMA)
    for words_per_shard, shards in ((10_000, 1), (4000, 4), (500, 32)):
        _, _, drawn, _, count = plan_mixture(docs, words_per_shard=words_per_shard)
        held = Counter(r.shard for r in drawn.collect())
        assert count == shards and max(held.values()) - min(held.get(i, 0) for i in range(count)) <= count.bit_length()
