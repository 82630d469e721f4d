"""Patch runs from lineitem and customer to orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from moorage.catalogue.tables import scratch_table, table, text
from moorage.functions.documents import canonical_json, project_paths
from moorage.functions.values import fee_list
from moorage.operators.patch import (
    apply_patches,
    apply_patches_to_documents,
    build_patches,
    operations,
    patch_sample,
    patch_stats,
)
from moorage.plans.document_load import load_documents
from moorage.plans.patch_load import dry_run, patch_documents as patch_collection, patch_table
from moorage.sources.tables import count_rows, source_rows
from moorage.spec import DocumentLoad, PatchLoad, parse_field_mapping

VIEW_FILTER = "o_totalprice > 100000 AND o_orderstatus = 'F'"


def patch_source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = {"o_orderpriority": "priority", "no_such_column": "x"}
    return source_rows(table(spark, sf_dir, "orders"), "o_orderkey", mapping, VIEW_FILTER)


def patch_source_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(table(spark, sf_dir, "orders"), VIEW_FILTER)


def patch_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renamed, sparse fields; blanks are left out, times without a zone are UTC."""
    status = F.when(F.col("o_orderstatus") == "O", F.lit(" \t")).when(F.col("o_orderstatus") == "F", F.col("o_orderstatus"))
    view = table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("ORDER_ID"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("PRIORITY"),
        status.alias("STATUS"),
        F.when(F.col("o_custkey") % 3 == 0, F.col("o_orderdate")).alias("ORDERED"),
    )
    mapping = parse_field_mapping("priority, STATUS : orderStatus,ordered:orderedAt,MISSING:missing")
    patches = build_patches(view, mapping, "ORDER_ID")
    return patches.select(
        "match_key",
        "state",
        F.col("patch.priority").alias("priority"),
        F.col("patch.orderStatus").alias("order_status"),
        text(F.unix_millis("patch.orderedAt")).alias("ordered_ms"),
    )


def fees_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fee texts of every kind, with the number each event carries."""
    events = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r"(\d+)", 1)
    kind = F.col("event_id") % 8
    fees = (
        F.when(kind == 0, F.concat(F.lit('[{"feeAmount":"'), k, F.lit('.5"},{"feeAmount":"x"},7]')))
        .when(kind == 1, F.concat(F.lit('{"feeAmount":'), k, F.lit("}")))
        .when(kind == 2, F.concat(F.lit("bad"), k))
        .when(kind == 3, F.lit("null"))
        .when(kind == 4, F.lit("{}"))
        .when(kind == 5, F.lit("0"))
        .when(kind == 6, F.lit("  "))
        .otherwise(F.concat(F.lit('[{"note":"n'), k, F.lit('"},{"feeAmount":null}]')))
    )
    rows = events.select("event_id", fees.alias("fees"))
    listed = rows.withColumn("list", fee_list(F.col("fees"), rows.schema["fees"].dataType))
    amounts = F.aggregate(
        "list", F.lit(0.0), lambda n, x: n + F.coalesce(F.try_variant_get(x, "$.feeAmount", "double"), F.lit(0.0))
    )
    return listed.select(
        "event_id",
        F.coalesce(F.size("list"), F.lit(-1)).cast("bigint").alias("n_fees"),
        F.coalesce(amounts, F.lit(-1.0)).alias("total"),
        F.to_json(F.to_variant_object("list")).alias("fees"),
    )


def line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view with a row per order: its quantity, and a status for the large ones."""
    lines = table(spark, sf_dir, "lineitem")
    quantity = F.sum(F.col("l_quantity").cast("bigint"))
    return lines.groupBy("l_orderkey").agg(
        F.when(F.count("*") % 5 != 0, quantity).alias("QTY"),
        F.when(quantity > 150, F.lit("X")).otherwise(F.lit(" ")).alias("STATUS"),
    ).select(F.col("l_orderkey").alias("ORDER_KEY"), "QTY", "STATUS")


LINE_MAPPING = {"QTY": "qty", "STATUS": "o_orderstatus"}


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")


def patch_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    patches = build_patches(line_totals(spark, sf_dir), LINE_MAPPING, "ORDER_KEY")
    rows = apply_patches(_orders(spark, sf_dir), patches, "o_orderkey")
    stamped = F.col("recon_ops_updated_at").isNotNull().alias("stamped")
    return rows.select(
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        text("qty").alias("qty"),
        F.coalesce("recon_ops_version", F.lit(False)).alias("version"),
        stamped,
    )


def patch_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a patch of its order, applied by line number."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ORDER_KEY"),
        F.when(F.col("l_returnflag") != "A", F.col("l_partkey")).alias("PART"),
        F.when(F.col("l_linestatus") == "O", F.col("l_returnflag")).alias("FLAG"),
        F.col("l_linenumber").alias("LINE"),
    )
    ops = operations(build_patches(lines, {"PART": "part", "FLAG": "flag"}, "ORDER_KEY", "LINE"))
    return ops.select("match_key", text("patch.part").alias("part"), "patch.flag")


def patch_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items patched by order: only the first line item of an order is touched."""
    lines = table(spark, sf_dir, "lineitem")
    place = (F.col("l_linenumber") * 100000 + F.col("l_partkey")) * 100000 + F.col("l_suppkey")
    target = lines.groupBy("l_orderkey", place.cast("bigint").alias("place")).agg(F.count("*").alias("copies"))
    view = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    patches = build_patches(view, {"o_orderpriority": "priority"}, "o_orderkey")
    rows = apply_patches(target, patches, "l_orderkey", first_by="place")
    return rows.select("l_orderkey", "place", "priority")


def patch_fees_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on a table: the first adds the list of fees, the second changes some of them."""
    name, location = scratch_table(spark)
    orders = table(spark, sf_dir, "orders")
    orders.select("o_orderkey", "o_orderstatus").write.option("path", location).saveAsTable(name)
    for run, rows in enumerate([orders, orders.where(F.col("o_orderkey") % 3 == 0)]):
        amount = F.concat(F.lit('[{"feeAmount":"'), text(F.col("o_custkey") + run), F.lit('.5"}]'))
        view = f"{name}_view_{run}"
        rows.select(F.col("o_orderkey").alias("ORDER_KEY"), amount.alias("FEES")).createOrReplaceTempView(view)
        patch_table(spark, PatchLoad(view, "orders", "ORDER_KEY", "o_orderkey", {"FEES": "fees"}), name)
    fee = F.try_variant_get(F.get("fees", F.lit(0)), "$.feeAmount", "double")
    return spark.table(name).select("o_orderkey", "o_orderstatus", fee.alias("fee"))


def patch_date_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key of type DATE that many rows lack."""
    orders = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    view = orders.where(F.dayofmonth("day") > 3).groupBy(F.col("day").alias("DAY")).agg(F.count("*").alias("N"))
    target = orders.select("o_orderkey", F.when(F.dayofmonth("day") > 2, F.col("day")).alias("day"))
    rows = apply_patches(target, build_patches(view, {"N": "n"}, "DAY"), "day")
    return rows.select("o_orderkey", text("day").alias("day"), "n")


def patch_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patches set into documents, at a nested path."""
    orders = _orders(spark, sf_dir)
    doc = F.to_variant_object(
        F.struct(
            F.col("o_orderkey").alias("orderKey"),
            F.struct(F.col("o_orderstatus").alias("status")).alias("state"),
        )
    )
    view = line_totals(spark, sf_dir)
    patches = build_patches(view, {"QTY": "state.qty", "STATUS": "state.status"}, "ORDER_KEY")
    patched = apply_patches_to_documents(orders.select(doc.alias("doc")), patches, "orderKey", "bigint")
    shown = project_paths(F.col("doc"), ["orderKey", "state", "recon_ops_version"])
    return patched.select(canonical_json(shown).alias("document"))


def patch_document_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items landed as documents, patched by order: of the documents of an order, one is touched."""
    name, location = scratch_table(spark)
    lines = table(spark, sf_dir, "lineitem").select(F.struct(F.col("l_orderkey").alias("key")).alias("order"))
    load_documents(spark, DocumentLoad("lines", name), lines, location)
    view = f"{name}_view"
    table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    mapping = {"o_orderpriority": "order.priority"}
    run = patch_collection(spark, PatchLoad(view, "lines", "o_orderkey", "order.key", mapping, VIEW_FILTER), name, "bigint")
    doc = F.col("row_data")
    priority = F.try_variant_get(doc, "$.order.priority", "string")
    stamped = F.try_variant_get(doc, "$.recon_ops_version", "boolean")
    per_order = spark.table(name).groupBy(F.try_variant_get(doc, "$.order.key", "bigint").alias("order_key"))
    return per_order.agg(
        F.count("*").alias("documents"),
        F.count_if(stamped).alias("patched"),
        F.max(priority).alias("priority"),
    ).withColumns({c: F.lit(run.counters[c]) for c in ("records", "matched", "changed", "not_found")})


def _keyed_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals under text keys, some missing, blank, unknown or repeated."""
    view = line_totals(spark, sf_dir)
    kind = F.col("ORDER_KEY") % 17
    key = (
        F.when(kind == 1, F.lit(None))
        .when(kind == 2, F.lit("  "))
        .when(kind == 3, F.concat(F.lit("no-"), text("ORDER_KEY")))
        .when(kind == 4, text(F.col("ORDER_KEY") - 4))
        .otherwise(text("ORDER_KEY"))
    )
    return view.select(key.alias("KEY"), "QTY", "STATUS", F.col("ORDER_KEY").alias("SEQ"))


def patch_stats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "orders").select(text("o_orderkey").alias("key"), "o_orderstatus")
    patches = build_patches(_keyed_view(spark, sf_dir), {"QTY": "qty", "STATUS": "o_orderstatus"}, "KEY", "SEQ")
    return patch_stats(target, patches, "key")


def dry_run_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    load = PatchLoad("orders", "orders", "o_orderkey", "orderKey", {"o_orderpriority": "priority"}, VIEW_FILTER)
    return dry_run(load, table(spark, sf_dir, "orders")).stats


def patch_sample_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = table(spark, sf_dir, "orders").where(VIEW_FILTER)
    return patch_sample(build_patches(view, {"o_orderpriority": "priority"}, "o_orderkey"))


TOTALS = """
    SELECT l_orderkey AS k, CASE WHEN count(*) % 5 <> 0 THEN CAST(sum(l_quantity) AS BIGINT) END AS qty,
           CASE WHEN sum(l_quantity) > 150 THEN 'X' END AS status
    FROM lineitem GROUP BY l_orderkey"""
OPS = f"SELECT * FROM ({TOTALS}) WHERE qty IS NOT NULL OR status IS NOT NULL"
KEYED = f"""
    SELECT CASE k % 17 WHEN 1 THEN NULL WHEN 2 THEN '  ' WHEN 3 THEN 'no-' || k WHEN 4 THEN CAST(k - 4 AS VARCHAR)
           ELSE CAST(k AS VARCHAR) END AS key, qty, status, k AS seq FROM ({TOTALS})"""

QUERIES = {
    "patch_fees_twice": patch_fees_twice,
    "patch_date_key": patch_date_key,
    "patch_source_scan": patch_source_scan,
    "patch_source_count": patch_source_count,
    "patch_fields": patch_fields,
    "fees_normalise": fees_normalise,
    "patch_apply": patch_apply,
    "patch_repeated_keys": patch_repeated_keys,
    "patch_first_match": patch_first_match,
    "patch_documents": patch_documents,
    "patch_document_table": patch_document_table,
    "patch_stats": patch_stats_query,
    "dry_run_patch": dry_run_patch,
    "patch_sample": patch_sample_query,
}

SQL = {
    "patch_fees_twice": """
        SELECT o_orderkey, o_orderstatus, o_custkey + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END + 0.5::DOUBLE AS fee
        FROM orders""",
    "patch_date_key": """
        WITH days AS (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders),
             counts AS (SELECT d, count(*) AS n FROM days WHERE day(d) > 3 GROUP BY d)
        SELECT o_orderkey, CASE WHEN day(days.d) > 2 THEN CAST(days.d AS VARCHAR) END AS day, n
        FROM days LEFT JOIN counts ON days.d = counts.d""",
    "patch_source_scan": f"SELECT o_orderkey, o_orderpriority FROM orders WHERE {VIEW_FILTER}",
    "patch_source_count": f"SELECT count(*) AS n_rows FROM orders WHERE {VIEW_FILTER}",
    "patch_fields": """
        SELECT match_key, CASE WHEN priority IS NULL AND order_status IS NULL AND ordered_ms IS NULL
                               THEN 'no_source_fields' ELSE 'op' END AS state, priority, order_status, ordered_ms
        FROM (SELECT CAST(o_orderkey AS VARCHAR) AS match_key, nullif(o_orderpriority, '5-LOW') AS priority,
                     CASE WHEN o_orderstatus = 'F' THEN 'F' END AS order_status,
                     CASE WHEN o_custkey % 3 = 0 THEN CAST(epoch_ms(o_orderdate) AS VARCHAR) END AS ordered_ms FROM orders)""",
    "fees_normalise": """
        SELECT event_id,
               CAST(CASE event_id % 8 WHEN 0 THEN 3 WHEN 1 THEN 1 WHEN 6 THEN -1 WHEN 7 THEN 2 ELSE 0 END AS BIGINT) AS n_fees,
               CAST(CASE event_id % 8 WHEN 0 THEN k + 0.5 WHEN 1 THEN k WHEN 6 THEN -1 ELSE 0 END AS DOUBLE) AS total,
               CASE event_id % 8 WHEN 0 THEN '[{"feeAmount":' || k || '.5},{"feeAmount":0.0},7]'
                    WHEN 1 THEN '[{"feeAmount":' || k || '.0}]' WHEN 6 THEN NULL
                    WHEN 7 THEN '[{"note":"n' || k || '"},{"feeAmount":0.0}]' ELSE '[]' END AS fees
        FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "patch_apply": f"""
        SELECT o_orderkey, coalesce(status, o_orderstatus) AS o_orderstatus, o_orderpriority,
               CAST(qty AS VARCHAR) AS qty, k IS NOT NULL AS version, k IS NOT NULL AS stamped
        FROM orders LEFT JOIN ({OPS}) ON k = o_orderkey""",
    "patch_repeated_keys": """
        SELECT match_key, CAST(part_key AS VARCHAR) AS part, flag FROM (
        SELECT l_orderkey AS match_key,
               arg_max(part, struct_pack(n := l_linenumber, v := part)) FILTER (part IS NOT NULL) AS part_key,
               arg_max(flag, struct_pack(n := l_linenumber, v := flag)) FILTER (flag IS NOT NULL) AS flag
        FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'A' THEN l_partkey END AS part,
                     CASE WHEN l_linestatus = 'O' THEN l_returnflag END AS flag FROM lineitem)
        WHERE part IS NOT NULL OR flag IS NOT NULL GROUP BY l_orderkey)""",
    "patch_first_match": """
        WITH target AS (SELECT DISTINCT l_orderkey, CAST((l_linenumber * 100000 + l_partkey) * 100000 + l_suppkey AS BIGINT) AS place
                        FROM lineitem)
        SELECT l_orderkey, place,
               CASE WHEN place = min(place) OVER (PARTITION BY l_orderkey) THEN o_orderpriority END AS priority
        FROM target LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "patch_documents": f"""
        SELECT '{{"orderKey":' || o_orderkey || CASE WHEN k IS NOT NULL THEN ',"recon_ops_version":true' ELSE '' END
               || ',"state":{{' || CASE WHEN qty IS NOT NULL THEN '"qty":' || qty || ',' ELSE '' END
               || '"status":"' || coalesce(status, o_orderstatus) || '"}}}}' AS document
        FROM orders LEFT JOIN ({OPS}) ON k = o_orderkey""",
    "patch_document_table": f"""
        WITH lines AS (SELECT l_orderkey AS order_key, count(*) AS documents FROM lineitem GROUP BY l_orderkey),
             ops AS (SELECT o_orderkey, o_orderpriority FROM orders WHERE {VIEW_FILTER}),
             met AS (SELECT count(*) AS n FROM ops JOIN lines ON o_orderkey = order_key),
             asked AS (SELECT count(*) AS n FROM ops)
        SELECT order_key, documents, CAST(o_orderkey IS NOT NULL AS BIGINT) AS patched, o_orderpriority AS priority,
               asked.n AS records, met.n AS matched, met.n AS changed, asked.n - met.n AS not_found
        FROM lines LEFT JOIN ops ON o_orderkey = order_key, met, asked""",
    "patch_stats": f"""
        WITH keyed AS ({KEYED}),
             usable AS (SELECT * FROM keyed WHERE trim(key) <> '' AND (qty IS NOT NULL OR status IS NOT NULL)),
             ops AS (SELECT key, arg_max(qty, seq) FILTER (qty IS NOT NULL) AS qty,
                            arg_max(status, seq) FILTER (status IS NOT NULL) AS status FROM usable GROUP BY key),
             hits AS (SELECT ops.*, o_orderstatus FROM ops JOIN orders ON key = CAST(o_orderkey AS VARCHAR)),
             c AS (SELECT (SELECT count(*) FROM hits) AS matched, (SELECT count(*) FROM ops) AS n_ops)
        SELECT (SELECT count(*) FROM keyed) AS records, matched,
               (SELECT count(*) FROM hits WHERE qty IS NOT NULL OR status <> o_orderstatus) AS changed,
               CAST(0 AS BIGINT) AS errors,
               (SELECT count(*) FROM keyed WHERE key IS NULL) AS skipped_null,
               (SELECT count(*) FROM keyed WHERE trim(key) = '') AS skipped_empty,
               (SELECT count(*) FROM keyed WHERE trim(key) <> '' AND qty IS NULL AND status IS NULL) AS no_source_fields,
               n_ops - matched AS not_found, (SELECT count(*) FROM usable) - n_ops AS duplicates
        FROM c""",
    "dry_run_patch": f"""
        SELECT count(*) AS records, CAST(ceil(count(*) / 5000.0) AS BIGINT) AS batches FROM orders WHERE {VIEW_FILTER}""",
    "patch_sample": f"""
        SELECT o_orderkey AS match_key, '{{"priority":"' || o_orderpriority || '"}}' AS patch
        FROM orders WHERE {VIEW_FILTER} ORDER BY o_orderkey LIMIT 1""",
}
