"""Document landing on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from moorage.catalogue.tables import epoch_millis, scratch_table, table, text
from moorage.functions.documents import canonical_json, strict_json
from moorage.operators.landing import failures, good_rows, landing_columns, matching, parse_documents
from moorage.operators.profile import export_estimate, failure_report, layout_ranges, range_overlaps, sample_documents
from moorage.plans.document_load import load_documents, prepare
from moorage.plans.quarantine import held_documents, load_with_quarantine, replay
from moorage.session import new_location
from moorage.sinks.tables import clustered
from moorage.sources.collections import as_documents, json_lines
from moorage.sources.tables import collection_counts, dataset_counts, existing_ids, sample_rows
from moorage.spec import DocumentLoad, with_options


def variant_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", strict_json(F.col("props")).alias("doc"))
    k = F.try_variant_get("doc", "$.k", "bigint")
    return events.groupBy("event_type").agg(
        F.count(k).alias("n"), F.sum(k).alias("sum_k"), F.max(k).alias("max_k")
    )


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table as a collection of JSON texts."""
    docs = table(spark, sf_dir, "documents")
    fields = F.struct("source", "text", F.col("doc_id").alias("_id"), "n_chars", "lang")
    return docs.select(F.to_json(fields).alias("raw"))


def doc_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    load = DocumentLoad(collection="documents", table="")
    rows = good_rows(prepare(load, document_texts(spark, sf_dir)))
    return rows.select(
        "document_id",
        "collection_name",
        "document_hash",
        F.length(canonical_json(F.col("row_data"))).cast("bigint").alias("json_chars"),
    )


def doc_clean_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed table as documents: dates and decimals become text."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("_id"),
        F.to_date("o_orderdate").alias("day"),
        F.col("o_custkey").cast("decimal(12,2)").alias("customer"),
        F.array(F.struct(F.to_date("o_orderdate").alias("on"))).alias("stops"),
    )
    documents = as_documents(orders).select("doc", F.lit(None).cast("string").alias("raw"))
    documents = documents.withColumn("error_type", F.lit(None).cast("string"))
    rows = good_rows(landing_columns(documents, "orders"))
    return rows.select("document_id", canonical_json(F.col("row_data")).alias("document"))


def doc_project_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey)
    name = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name"))
    status = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderstatus"))
    doc = F.struct(
        F.col("o_orderkey").alias("_id"),
        status.alias("status"),
        F.struct(name.alias("name"), F.col("o_custkey").alias("key")).alias("cust"),
        F.array(F.struct(F.col("c_name").alias("name"))).alias("people"),
    )
    texts = rows.select(F.to_json(doc, {"ignoreNullFields": "false"}).alias("raw"))
    load = DocumentLoad(
        collection="orders", table="", fields=("status", "cust.name", "cust.none", "people.name", "absent")
    )
    landed = good_rows(prepare(load, texts))
    return landed.select("document_id", canonical_json(F.col("row_data")).alias("document"))


# Fixed value: the filter of the query below, on 2024-01-10 and later.
EVENT_FILTER = {
    "valueDate": {"$gte": 1704844800000},
    "event_type": {"$ne": "error"},
    "$or": [{"event_type": {"$in": ["purchase", "signup"]}}, {"props.k": {"$lt": 10}}],
}


def doc_query_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    millis = text(epoch_millis(events, "ts"))
    # a date stored as text is not a number, so it must not match
    date = F.when(F.col("event_type") == "view", F.concat(F.lit('"'), millis, F.lit('"'))).otherwise(millis)
    raw = F.concat(
        F.lit('{"_id":'), text("event_id"),
        F.lit(',"valueDate":'), date,
        F.lit(',"event_type":"'), F.col("event_type"),
        F.lit('","props":'), F.col("props"), F.lit("}"),
    )
    found = matching(parse_documents(events.select("event_type", raw.alias("raw"))), EVENT_FILTER)
    return good_rows(landing_columns(found, "events", keep=["event_type"])).select("document_id", "event_type")


def damaged_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as JSON text, most of them good, the others bad in one of several ways."""
    kind = F.col("event_id") % 10
    good = F.concat(
        F.lit('{"_id":"e'), text("event_id"), F.lit('",'), F.substr("props", F.lit(2))
    )
    raw = (
        F.when(kind == 1, F.left(good, F.length(good) - 1))
        .when(kind == 2, F.concat(good, F.lit(" x")))
        .when(kind == 3, F.concat(good, F.lit("}")))
        .when(kind == 4, F.concat(F.lit("["), good, F.lit("]")))
        .when(kind == 5, F.col("props"))
        .when(kind == 6, F.concat(F.lit('{"_id":"e'), text("event_id"), F.lit('","k":1,"k":2}')))
        .otherwise(good)
    )
    return table(spark, sf_dir, "events").select(raw.alias("raw"))


def _prepared_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(DocumentLoad(collection="events", table="", mode="upsert"), damaged_texts(spark, sf_dir))


def doc_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _prepared_damaged(spark, sf_dir)
    outcome = F.coalesce("error_type", F.lit("landed"))
    return rows.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def failure_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = failure_report(failures(_prepared_damaged(spark, sf_dir)))
    return report.select("error_type", "n", "more", F.col("nth").cast("bigint").alias("nth"), "doc_id", "json_sample")


def _event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = F.concat(F.lit('{"_id":'), text("event_id"), F.lit(","), F.substr("props", F.lit(2)))
    return table(spark, sf_dir, "events").select("event_type", "value", good.alias("raw"))


def doc_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends to a landing table: nothing is skipped, row ids stay unique."""
    name, location = scratch_table(spark)
    load = DocumentLoad(collection="events", table=name)
    for _ in range(2):
        load_documents(spark, load, _event_texts(spark, sf_dir).select("raw"), location)
    landed = spark.table(name)
    return landed.groupBy("document_id", "document_hash").agg(
        F.count("*").alias("copies"), F.count_distinct("row_id").alias("row_ids")
    )


def doc_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that is told by option to write nothing."""
    name, location = scratch_table(spark)
    load = with_options(DocumentLoad(collection="events", table=name), {"dry_run": "true"})
    result = load_documents(spark, load, damaged_texts(spark, sf_dir), location)
    failed = result.failures.agg(F.count("*").alias("failed"))
    there = F.lit(spark.catalog.tableExists(name)).alias("table_exists")
    return result.estimate.select("to_export").join(F.broadcast(failed)).select("to_export", "failed", there)  # one row each


def doc_append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events appended after a first load without the views: only the views are added."""
    name, location = scratch_table(spark)
    texts = _event_texts(spark, sf_dir)
    first = texts.where(F.col("event_type") != "view").select("raw")
    load_documents(spark, DocumentLoad(collection="events", table=name), first, location)
    load_documents(spark, DocumentLoad(collection="events", table=name, mode="append_new"), texts.select("raw"))
    return spark.table(name).groupBy("document_id").agg(F.count("*").alias("copies"))


def _conversation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = table(spark, sf_dir, "conversations")
    id_text = F.when(F.col("turn") != 1, text("conv_id")).when(F.col("conv_id") % 2 == 0, F.lit(""))
    return talk.select(id_text.alias("document_id"), F.col("role").alias("collection_name"))


def existing_ids_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return existing_ids(spark, _conversation_rows(spark, sf_dir), "user")


def collection_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collection_counts(_conversation_rows(spark, sf_dir))


def dataset_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_counts({n: table(spark, sf_dir, n) for n in TABLES})


PRIORITY = {"o_orderpriority": {"$in": ["1-URGENT", "2-HIGH"]}, "o_custkey": {"$gte": 100}}


def doc_typed_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed table landed with a filter: numbers and texts are compared in the scan, the date, which becomes text, after it."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "_id")
    query = {**PRIORITY, "$or": [{"o_orderdate": {"$gte": "1996"}}, {"o_orderstatus": {"$ne": "F"}}]}
    load = DocumentLoad(collection="orders", table="", query=query, fields=("o_custkey", "o_orderpriority"))
    rows = good_rows(prepare(load, orders))
    return rows.select("document_id", canonical_json(F.col("row_data")).alias("document"))


def doc_filter_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters on arrays, texts, types and remainders."""
    tagged = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("_id"),
        F.col("event_type").alias("type"),
        F.array(F.col("event_type"), (F.col("user_id") % 5).cast("string")).alias("tags"),
        F.array(
            F.struct((F.col("user_id") % 7).alias("k"), (F.col("event_id") % 3).alias("v")),
            F.struct((F.col("user_id") % 3).alias("k"), (F.col("event_id") % 5).alias("v")),
        ).alias("items"),
        F.when(F.col("event_id") % 2 == 0, text("event_id")).alias("note"),
    )
    query = {
        "type": {"$regex": "^(P|S)", "$options": "i"},
        "_id": {"$mod": [3, 1]},
        "tags": {"$size": 2, "$all": ["purchase"]},
        "items": {"$elemMatch": {"k": {"$gt": 0}, "v": 1}},
        "note": {"$type": ["string", "null"]},
    }
    rows = good_rows(prepare(DocumentLoad(collection="events", table="", query=query, fields=("type", "note")), tagged))
    return rows.select("document_id", canonical_json(F.col("row_data")).alias("document"))


def doc_load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of loads from files of JSON lines: an upsert of damaged texts, and the first hundred of all in id order."""
    place = new_location(spark, "json")
    damaged_texts(spark, sf_dir).write.text(f"{place}/damaged")
    _event_texts(spark, sf_dir).select("raw").write.text(f"{place}/good")
    twice = json_lines(spark, [f"{place}/damaged", f"{place}/damaged"])
    parts = []
    for name, docs, options in (
        ("upsert", twice, {"mode": "upsert"}),
        ("limit", json_lines(spark, f"{place}/good"), {"limit": 100}),
    ):
        target, location = scratch_table(spark)
        r = load_documents(spark, DocumentLoad(collection="events", table=target, **options), docs, location)
        last = spark.table(target).agg(F.max("document_id").alias("last_id"))
        figures = {"n_read": r.read, "failed": r.failed, "inserted": r.inserted, "updated": r.updated, "unchanged": r.unchanged, "duplicates": r.duplicates}
        parts.append(last.select(F.lit(name).alias("name"), *[F.lit(v).cast("bigint").alias(c) for c, v in figures.items()], "last_id"))
    return parts[0].unionByName(parts[1])


def _event_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    load = DocumentLoad(collection="events", table="")
    return good_rows(prepare(load, _event_texts(spark, sf_dir).select("raw")))


def dry_run_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_estimate(_event_landing(spark, sf_dir), batch_size=1000, limit=5000)


def sample_documents_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_documents(_event_landing(spark, sf_dir))


def table_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    landing = docs.select(
        F.col("doc_id").alias("row_id"), F.md5("text").alias("document_hash"), F.col("source").alias("collection_name")
    )
    return sample_rows(landing, 10, "src3")


EVENT_JSON = """'{"_id":"' || event_id || '",' || substr(replace(props, ' ', ''), 2)"""

DAMAGED = """
    SELECT event_id % 10 AS kind, event_id, props,
           '{"_id":"e' || event_id || '",' || substr(props, 2) AS good
    FROM events"""

FAILED = f"""
    SELECT CASE WHEN kind IN (1, 2, 3, 6) THEN 'invalid_json' WHEN kind = 4 THEN 'not_an_object'
                WHEN kind = 5 THEN 'missing_id' END AS error_type,
           'unknown' AS doc_id,
           CASE kind WHEN 1 THEN left(good, length(good) - 1) WHEN 2 THEN good || ' x' WHEN 3 THEN good || '}}'
                WHEN 4 THEN '[' || good || ']' WHEN 5 THEN props
                WHEN 6 THEN '{{"_id":"e' || event_id || '","k":1,"k":2}}' ELSE good END AS json_sample
    FROM ({DAMAGED})"""

CONVERSATION_ROWS = """
    SELECT CASE WHEN turn <> 1 THEN CAST(conv_id AS VARCHAR) WHEN conv_id % 2 = 0 THEN '' END AS document_id,
           role AS collection_name
    FROM conversations"""

def quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged documents held, then tried again twice with a repair of one kind of damage: what is landed, and what stays."""
    name, location = scratch_table(spark)
    load = DocumentLoad(collection="events", table=name, mode="upsert")
    load_with_quarantine(spark, load, damaged_texts(spark, sf_dir), location)
    runs = [replay(spark, load, lambda t: F.regexp_replace(t, " x$", "")) for _ in range(2)]
    again = [F.lit(r.inserted if r else 0).cast("bigint").alias(f"replay_{i}") for i, r in enumerate(runs, 1)]
    left = held_documents(spark, name, "events").agg(F.count("*").alias("held"))
    landed = spark.table(name).agg(F.count("*").alias("landed"), F.count_distinct("document_id").alias("ids"))
    return landed.join(F.broadcast(left)).select("landed", "ids", "held", *again)  # one row each


def clustered_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents laid out by type and id: the ranges of the files, read back from them, don't overlap but for a hot key."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id")
    parts = []
    for key in ("event_type", "event_id"):
        place = new_location(spark, "laid-out")
        clustered(events, [key], 8).write.parquet(place)
        found = range_overlaps(layout_ranges(spark.read.parquet(place), key))
        parts.append(found.select(F.lit(key).alias("key"), "n", "overlapping", (F.col("files") > 1).alias("several")))
    return parts[0].unionByName(parts[1])


TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

QUERIES = {
    "doc_typed_source": doc_typed_source,
    "doc_filter_operators": doc_filter_operators,
    "doc_load_summary": doc_load_summary,
    "clustered_ranges": clustered_ranges,
    "quarantine_replay": quarantine_replay,
    "doc_dry_run": doc_dry_run,
    "variant_extract": variant_extract,
    "doc_land": doc_land,
    "doc_clean_types": doc_clean_types,
    "doc_project_paths": doc_project_paths,
    "doc_query_filter": doc_query_filter,
    "doc_quarantine": doc_quarantine,
    "failure_report": failure_report_query,
    "doc_append": doc_append,
    "doc_append_new": doc_append_new,
    "existing_ids": existing_ids_query,
    "collection_counts": collection_counts_query,
    "dataset_counts": dataset_counts_query,
    "dry_run_export": dry_run_export,
    "sample_documents": sample_documents_query,
    "table_sample": table_sample,
}

SQL = {
    "quarantine_replay": """
        WITH told AS (SELECT event_id % 10 AS kind, props, CASE WHEN event_id % 10 = 5 THEN props ELSE CAST(event_id AS VARCHAR) END AS text
                      FROM events)
        SELECT count(*) FILTER (kind IN (0, 2, 7, 8, 9)) AS landed, count(*) FILTER (kind IN (0, 2, 7, 8, 9)) AS ids,
               (SELECT count(*) FROM (SELECT DISTINCT kind, text FROM told WHERE kind IN (1, 3, 4, 5, 6))) AS held,
               count(*) FILTER (kind = 2) AS replay_1, 0::BIGINT AS replay_2
        FROM told""",
    "clustered_ranges": """
        SELECT unnest(['event_type', 'event_id']) AS key, count(*) AS n, 0::BIGINT AS overlapping, true AS several FROM events""",
    "doc_typed_source": """
        SELECT CAST(o_orderkey AS VARCHAR) AS document_id,
               '{"_id":"' || o_orderkey || '","o_custkey":' || o_custkey || ',"o_orderpriority":"' || o_orderpriority || '"}' AS document
        FROM orders
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_custkey >= 100
              AND (o_orderdate >= TIMESTAMP '1996-01-01' OR o_orderstatus IS DISTINCT FROM 'F')""",
    "doc_filter_operators": """
        SELECT CAST(event_id AS VARCHAR) AS document_id,
               '{"_id":"' || event_id || '","note":' || CASE WHEN event_id % 2 = 0 THEN '"' || event_id || '"' ELSE 'null' END
               || ',"type":"' || event_type || '"}' AS document
        FROM events
        WHERE regexp_matches(event_type, '^(p|s)') AND event_id % 3 = 1 AND event_type = 'purchase'
              AND ((user_id % 7 > 0 AND event_id % 3 = 1) OR (user_id % 3 > 0 AND event_id % 5 = 1))""",
    "doc_load_summary": f"""
        WITH told AS (SELECT event_id, event_id % 10 AS kind FROM events), sums AS (
             SELECT count(*) AS n, count(*) FILTER (kind BETWEEN 1 AND 6) AS bad, count(*) FILTER (kind NOT BETWEEN 1 AND 6) AS good,
                    max('e' || event_id) FILTER (kind NOT BETWEEN 1 AND 6) AS last FROM told)
        SELECT 'upsert' AS name, 2 * n AS n_read, 2 * bad AS failed, good AS inserted, 0::BIGINT AS updated, 0::BIGINT AS unchanged,
               good AS duplicates, last AS last_id FROM sums
        UNION ALL
        SELECT 'limit', count(*), 0, count(*), 0, 0, 0, max(id)
        FROM (SELECT CAST(event_id AS VARCHAR) AS id FROM events ORDER BY id LIMIT 100)""",
    "doc_dry_run": """
        SELECT count_if(event_id % 10 NOT IN (1, 2, 3, 4, 6)) AS to_export,
               count_if(event_id % 10 IN (1, 2, 3, 4, 6)) AS failed, false AS table_exists
        FROM events""",
    "variant_extract": """
        SELECT event_type, count(k) AS n, CAST(sum(k) AS BIGINT) AS sum_k, max(k) AS max_k
        FROM (SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
        GROUP BY event_type""",
    "doc_land": """
        SELECT CAST(doc_id AS VARCHAR) AS document_id, 'documents' AS collection_name, md5(j) AS document_hash,
               CAST(length(j) AS BIGINT) AS json_chars
        FROM (SELECT doc_id, '{"_id":"' || doc_id || '","lang":' || CAST(to_json(lang) AS VARCHAR)
                     || ',"n_chars":' || n_chars || ',"source":' || CAST(to_json(source) AS VARCHAR)
                     || ',"text":' || CAST(to_json(text) AS VARCHAR) || '}' AS j
              FROM documents)""",
    "doc_clean_types": """
        SELECT CAST(o_orderkey AS VARCHAR) AS document_id,
               '{"_id":"' || o_orderkey || '","customer":"' || o_custkey || '.00","day":"' || d
               || '","stops":[{"on":"' || d || '"}]}' AS document
        FROM (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)""",
    "doc_project_paths": """
        SELECT CAST(o_orderkey AS VARCHAR) AS document_id,
               '{"_id":"' || o_orderkey || '"'
               || CASE WHEN c_mktsegment <> 'BUILDING' THEN ',"cust":{"name":"' || c_name || '"}' ELSE '' END
               || ',"status":' || CASE WHEN o_orderpriority <> '5-LOW' THEN '"' || o_orderstatus || '"' ELSE 'null' END
               || '}' AS document
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "doc_query_filter": """
        SELECT CAST(event_id AS VARCHAR) AS document_id, event_type
        FROM events
        WHERE epoch_ms(ts) >= 1704844800000 AND event_type NOT IN ('error', 'view')
          AND (event_type IN ('purchase', 'signup') OR CAST(json_extract_string(props, '$.k') AS BIGINT) < 10)""",
    "doc_quarantine": f"""
        SELECT coalesce(error_type, 'landed') AS outcome, count(*) AS n FROM ({FAILED}) GROUP BY 1""",
    "failure_report": f"""
        SELECT error_type, n, greatest(n - 3, 0) AS more, nth, doc_id, json_sample
        FROM (SELECT *, count(*) OVER (PARTITION BY error_type) AS n,
                     row_number() OVER (PARTITION BY error_type ORDER BY doc_id, json_sample) AS nth
              FROM (SELECT CASE WHEN error_type = 'not_an_object' THEN 'unknown' ELSE doc_id END AS doc_id,
                           error_type, json_sample FROM ({FAILED}) WHERE error_type IS NOT NULL))
        WHERE nth <= 3""",
    "doc_append": f"""
        SELECT CAST(event_id AS VARCHAR) AS document_id, md5(j) AS document_hash, count(*) AS copies, count(*) AS row_ids
        FROM (SELECT event_id, {EVENT_JSON} AS j FROM events
              UNION ALL SELECT event_id, {EVENT_JSON} AS j FROM events)
        GROUP BY 1, 2""",
    "doc_append_new": """
        SELECT CAST(event_id AS VARCHAR) AS document_id, count(*) AS copies FROM events GROUP BY 1""",
    "existing_ids": f"""
        SELECT DISTINCT document_id FROM ({CONVERSATION_ROWS})
        WHERE collection_name = 'user' AND document_id <> ''""",
    "collection_counts": f"""
        SELECT collection_name, count(*) AS n_documents FROM ({CONVERSATION_ROWS}) GROUP BY 1""",
    "dataset_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS collection_name, count(*) AS n_documents FROM {n}"
        for n in TABLES
    ),
    "dry_run_export": f"""
        SELECT matching, to_export, CAST(ceil(to_export / 1000.0) AS BIGINT) AS batches, sampled, sample_chars,
               sample_chars / sampled AS mean_chars, sample_chars / sampled * to_export / 1048576 AS estimated_mb
        FROM (SELECT count(*) AS matching, least(count(*), 5000) AS to_export FROM events),
             (SELECT count(*) AS sampled, CAST(sum(length(j)) AS BIGINT) AS sample_chars
              FROM (SELECT {EVENT_JSON} AS j FROM events ORDER BY CAST(event_id AS VARCHAR) LIMIT 100))""",
    "sample_documents": f"""
        SELECT CAST(event_id AS VARCHAR) AS document_id, left({EVENT_JSON}, 500) AS document
        FROM events ORDER BY 1 LIMIT 3""",
    "table_sample": """
        SELECT doc_id AS row_id, md5(text) AS document_hash, source AS collection_name
        FROM documents WHERE source = 'src3' ORDER BY doc_id LIMIT 10""",
}
