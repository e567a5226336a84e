"""Queries of the registry operators: envelopes, receipts, duplicates, closure, order, controls, versions of references."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..claims.cross_rules import overlapping_versions, several_current, uncovered_plans
from ..operators import registry as R
from .registry import query


@query("""SELECT 'customers' AS source_identity, 'crm' AS source_system, c_custkey::VARCHAR AS source_record_id, sha256('{"balance":"' || (CAST(c_acctbal * 100 AS BIGINT))::VARCHAR || '","name":"' || c_name || '"}') AS payload_sha256, c_name AS name FROM customer WHERE c_acctbal IS NOT NULL""")
def envelope_records(t):
    """Customers in envelopes with the checksum of their payload, opened again and held against it."""
    payload = F.create_map(F.lit("name"), F.col("c_name"), F.lit("balance"), F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string"))
    lineage = F.create_map(F.lit("batch_id"), F.lit("B"), F.lit("source_identity"), F.lit("customers"), F.lit("source_system"), F.lit("crm"))
    key = F.col("c_custkey").cast("string")
    sent = t.customer.filter("c_acctbal IS NOT NULL").select(key.alias("source_record_id"), F.concat(F.lit("c"), key).alias("natural_key"), R.payload_checksum(payload).alias("payload_sha256"), F.lit("accepted").alias("disposition"), F.lit(True).alias("synthetic_only"), payload.alias("raw_payload"), payload.alias("normalized_payload"), F.array().cast("array<string>").alias("issues"), lineage.alias("lineage"))
    return R.records_of(sent, "customers", "B").select("source_identity", "source_system", "source_record_id", "payload_sha256", F.col("normalized_payload")["name"].alias("name"))


@query("SELECT o_orderkey AS receipt, o_orderstatus AS status, md5(o_orderpriority) AS sha FROM orders WHERE o_orderstatus <> 'F'")
def receipt_register(t):
    """Receipts of all orders where those of finished ones are registered already: only the others are to be added."""
    receipts = t.orders.select(F.col("o_orderkey").alias("receipt"), F.col("o_orderstatus").alias("status"), F.md5("o_orderpriority").alias("sha"))
    return R.register_receipt(receipts.filter("status = 'F'"), receipts, "receipt")


@query("""WITH r AS (SELECT event_type AS source_system, (event_id % 9973)::VARCHAR AS source_record_id, user_id || '/' || CAST(floor(value) AS BIGINT) AS natural_key FROM events),
k AS (SELECT *, count(*) OVER (PARTITION BY natural_key) > 1 AS by_key, count(*) OVER (PARTITION BY source_system, source_record_id) > 1 AS by_id FROM r)
SELECT source_system, source_record_id, natural_key, CASE WHEN bool_or(by_key) AND bool_or(by_id) THEN 'natural_key,record_id' WHEN bool_or(by_key) THEN 'natural_key' ELSE 'record_id' END AS kinds FROM k WHERE by_key OR by_id GROUP BY 1, 2, 3""")
def duplicate_record_kinds(t):
    rows = t.events.select(F.lit("claims").alias("source_identity"), F.col("event_type").alias("source_system"), (F.col("event_id") % 9973).cast("string").alias("source_record_id"), F.concat_ws("/", F.col("user_id").cast("string"), F.floor("value").cast("string")).alias("natural_key"), F.create_map(F.lit("x"), F.lit("y")).alias("normalized_payload"))
    return R.duplicate_records(rows).select("source_system", "source_record_id", "natural_key", F.array_join("duplicate_kinds", ",").alias("kinds"))


@query("""WITH r AS (SELECT DISTINCT o_orderpriority AS relation, o_custkey::VARCHAR AS key FROM orders), i AS (SELECT DISTINCT o_orderpriority AS relation, o_custkey::VARCHAR AS key FROM orders WHERE o_orderstatus <> 'P')
SELECT relation, key, 'not in inventory' AS gap FROM r ANTI JOIN i USING (relation, key)
UNION ALL SELECT relation, NULL, 'count differs' FROM (SELECT relation, count(*) AS n FROM r GROUP BY 1) JOIN (SELECT relation, count(*) AS m FROM i GROUP BY 1) USING (relation) WHERE n <> m""")
def closure_of_inventories(t):
    shape = lambda df: df.select(F.col("o_orderpriority").alias("relation"), F.col("o_custkey").cast("string").alias("key"))
    inventory = shape(t.orders.filter("o_orderstatus <> 'P'")).distinct()
    return R.closure_gaps(shape(t.orders), inventory, inventory.groupBy("relation").agg(F.count("*").alias("row_count")))


@query("""WITH i AS (SELECT event_type AS relation, lpad(user_id::VARCHAR, 9, '0') AS key, event_id FROM events), w AS (SELECT *, lag(key) OVER (PARTITION BY relation ORDER BY event_id) AS before FROM i),
s AS (SELECT relation, min(event_id) AS f, max(event_id) AS e, min_by(key, event_id) AS key FROM i GROUP BY 1), x AS (SELECT *, lag(e) OVER (ORDER BY relation) AS before FROM s)
SELECT relation, key, event_id FROM w WHERE before >= key UNION ALL SELECT relation, key, f FROM x WHERE before >= f""")
def inventory_order(t):
    """Events as an inventory of their types, which they are not in the order of."""
    return R.out_of_order(t.events.select(F.col("event_type").alias("relation"), F.lpad(F.col("user_id").cast("string"), 9, "0").alias("key"), "event_id"), "event_id")


@query("""SELECT 'lineitem' AS relation, count(*) AS row_count, '{"l_extendedprice":"' || CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS DECIMAL(38,2))::VARCHAR || '","l_quantity":"' || CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))), 0) AS DECIMAL(38,2))::VARCHAR || '"}' AS amounts FROM lineitem""")
def control_vector_of_lines(t):
    return R.control_vector(t.lineitem, "lineitem", ["l_extendedprice", "l_quantity"])


_SPANS = "(SELECT o_orderkey AS row_id, o_custkey, CAST(o_orderdate AS DATE) AS f, CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER) - 20 END AS e, o_orderstatus FROM orders)"


def _spans(t):
    """Orders as versions of their customer; some end before they begin, a quarter never."""
    day, k = F.to_date("o_orderdate"), F.col("o_orderkey")
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return t.orders.select(k.alias("row_id"), "o_custkey", text(day).alias("valid_from"), text(F.when(k % 4 > 0, F.date_add(day, (k % 90 - 20).cast("int")))).alias("valid_to"), F.when(F.col("o_orderstatus") == "F", "true").otherwise("false").alias("active_flag"), F.lit("accepted").alias("disposition"))


@query(f"SELECT row_id FROM {_SPANS} a WHERE EXISTS (SELECT 1 FROM {_SPANS} b WHERE a.o_custkey = b.o_custkey AND a.row_id <> b.row_id AND a.f < coalesce(b.e, DATE '9999-12-31') AND b.f < coalesce(a.e, DATE '9999-12-31'))")
def reference_version_overlap(t):
    return overlapping_versions(_spans(t), ["o_custkey"])


@query(f"SELECT row_id FROM (SELECT row_id, count(*) OVER (PARTITION BY o_custkey) AS n FROM {_SPANS} WHERE e IS NULL AND o_orderstatus = 'F') WHERE n > 1")
def several_current_versions(t):
    return several_current(_spans(t), ["o_custkey"])


@query(f"""SELECT p.row_id FROM {_SPANS} p LEFT JOIN (SELECT c_custkey, DATE '1994-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS f, CASE WHEN c_custkey % 3 > 0 THEN DATE '1994-01-01' + CAST(c_custkey % 1000 + 1500 AS INTEGER) END AS e FROM customer) y ON p.o_custkey = c_custkey AND y.f <= p.f AND (y.e IS NULL OR p.e <= y.e) GROUP BY 1 HAVING count(c_custkey) <> 1""")
def validity_within_parent(t):
    """Orders as plans of a customer's validity: a plan lies in it as a whole or not."""
    start = F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int"))
    payers = t.customer.select(F.col("c_custkey").cast("string").alias("payer_id"), start.cast("string").alias("valid_from"), F.coalesce(F.when(F.col("c_custkey") % 3 > 0, F.date_add(start, 1500)).cast("string"), F.lit("")).alias("valid_to"), F.lit("accepted").alias("disposition"))
    return uncovered_plans(_spans(t).withColumn("payer_id", F.col("o_custkey").cast("string")), payers)
