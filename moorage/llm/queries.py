"""The operators as queries on the given tables, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from moorage.llm.common import table
from moorage.llm.conversations import conversation_report
from moorage.llm.exact_search import top_products
from moorage.llm.fill_middle import fill_in_middle, restored
from moorage.llm.language import held_out, identify_by_fold
from moorage.llm.licences import scan_licences
from moorage.llm.mixing import mixture_report
from moorage.llm.ngram_join import ngram_components
from moorage.llm.pieces import encode_documents
from moorage.llm.quality import score_by_fold
from moorage.llm.token_files import token_report, with_starts, write_tokens
from moorage.llm.url_rules import judge_urls
from moorage.llm.vantage_tree import near_neighbours
from moorage.llm.warc import capture_index, write_archives
from moorage.session import materialise

URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents")).drop("spans")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages have no time of capture: the one given follows from the id."""
    captured = F.timestamp_seconds(1_700_000_000 + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(100_000_000)))
    pages = table(spark, sf_dir, "pages")
    rows = pages.select(F.col("page_id").alias("record_id"), "url", captured.alias("captured"), F.col("html").alias("payload"))
    index = capture_index(spark, write_archives(rows))
    return index.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_by_fold(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return with_starts(materialise(token_report(spark, files), "token-report"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))


def op5_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(vectors(spark, sf_dir), F.col("vec_id") % 50 == 0, 5)


def op6_near_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_neighbours(vectors(spark, sf_dir), F.col("vec_id") % 20 == 0, 20)


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    return judge_urls(table(spark, sf_dir, "pages"), rules, "url", ("page_id",))


def piece_digests(docs: DataFrame) -> DataFrame:
    encoded = encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture_report(table(spark, sf_dir, "documents"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return score_by_fold(documents, table(spark, sf_dir, "labels"), held_out(F.col("doc_id")))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_report(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_licences": op1_licences,
    "op2_warc": op2_warc,
    "op3_language": op3_language,
    "op4_token_files": op4_token_files,
    "op5_exact_search": op5_exact_search,
    "op6_near_neighbours": op6_near_neighbours,
    "op7_url_filters": op7_url_filters,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_ngram_join": op9_ngram_join,
    "op10_mixing": op10_mixing,
    "op11_quality": op11_quality,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL = {
    "op2_warc": """
        WITH held AS (
                 SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
             firsts AS (
                 SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload) ELSE page_id END AS first
                 FROM held)
        SELECT page_id, payload_bytes, sha256(payload) AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM firsts""",
    "op5_exact_search": """
        WITH whole AS (
                 SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
                 FROM embeddings
                 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                       AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
             scored AS (
                 SELECT q.vec_id AS query_id, c.vec_id,
                        list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
                 FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
             ranked AS (
                 SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op7_url_filters": """
        WITH rules(host, path, verdict) AS (VALUES
                 ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                 ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
             rests AS (
                 SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
                 FROM pages),
             parts AS (
                 SELECT page_id, regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path,
                        translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
                 FROM rests)
        SELECT p.page_id, p.host, p.path,
               max_by(r.host || r.path, length(r.host || r.path)) AS rule,
               coalesce(max_by(r.verdict, length(r.host || r.path)), 'allow') AS verdict
        FROM parts p LEFT JOIN rules r
             ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
        GROUP BY p.page_id, p.host, p.path""",
    "op12_fill_in_middle": """
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n,
                              sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
             draws AS (
                 SELECT *, CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (n + 1) AS one,
                        CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (n + 1) AS two,
                        CAST('0x' || substr(digest, 17, 8) AS BIGINT) % 100 AS three,
                        CAST('0x' || substr(digest, 25, 8) AS BIGINT) % 100 AS four FROM texts),
             parts AS (
                 SELECT *, substr(text, 1, least(one, two)) AS prefix, substr(text, greatest(one, two) + 1) AS suffix,
                        substr(text, least(one, two) + 1, greatest(one, two) - least(one, two)) AS middle,
                        CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR three >= 90
                             THEN 'plain' WHEN four < 20 THEN 'spm' ELSE 'psm' END AS form FROM draws)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(one, two) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN greatest(one, two) - least(one, two) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts""",
}
