"""From documents to token ids: language, near copies, mixture, pieces.

Each stage takes the documents its predecessor kept and returns documents of the same columns, all but the last,
which returns what was encoded. ``run`` writes the result of each stage to the shared folder and reads it again.

Nulls, empty texts, repeated rows and empty tables are handled as the operators say; what a stage makes of them:

* language: a document without a letter, or whose language can't be told from the others, goes.
* near copies: of each group the document with the smallest id stays. Documents without words or without id are
  nobody's copies and stay. Rows that repeat id and text are one; those of one id and different texts go only if
  all of them are copies of others.
* mixture: documents are taken as whole rows, none of them or up to three times.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from moorage.llm.common import join_stored
from moorage.llm.language import UNDETERMINED, identify_by_fold
from moorage.llm.mixing import mixed_documents
from moorage.llm.ngram_join import ngram_components
from moorage.llm.queries import piece_digests
from moorage.session import materialise

LEAST_SCORE = 0.5
ORACLE_SQL = None  # naive Bayes, a draw and an encoding can't be said in SQL


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier can tell."""
    rows = docs.select("doc_id", "text", "lang", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    judged = identify_by_fold(rows, keep=("row",))
    return judged.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    found = materialise(ngram_components(docs), "found")
    several = materialise(found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "several")
    heads = found.where("doc_id = component_id").select("doc_id")
    copies = found.where("doc_id <> component_id").select("doc_id").distinct()
    # An id that several rows bear can be a copy in one and the first of a group in another.
    gone = materialise(copies.join(join_stored(heads, several, ["doc_id"], "left_semi", 16), "doc_id", "left_anti"), "gone")
    kept = join_stored(docs, gone, ["doc_id"], "left_anti", 16).select(*docs.columns)
    if several.isEmpty():
        return kept
    once = join_stored(kept, several, ["doc_id"], "left_anti", 16).select(*docs.columns)
    again = join_stored(kept, several, ["doc_id"], "left_semi", 16).select(*docs.columns)
    return once.unionByName(again.dropDuplicates(["doc_id", "text"]))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources come near to their target weights, shuffled."""
    return mixed_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document of the mixture."""
    return piece_digests(docs)


STAGES = [("language", language), ("near_copies", near_copies), ("mixture", mixture), ("pieces", pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
