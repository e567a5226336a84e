from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import sets as U
from ..operators import windows as W
from .join_queries import VERSIONS_SQL, versions
from .registry import query

_CENTS = "CAST({} AS DECIMAL(18,2))"


@query("""SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS n_events, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds, bool_and(value < 100) AS all_small FROM events GROUP BY 1""")
def entity_rollup(t):
    return t.events.groupBy("user_id").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count("*").alias("n_events"), F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("kinds"), F.bool_and(F.col("value") < 100).alias("all_small"))


@query("SELECT c_nationkey, sha256(string_agg(sha256(c_name), chr(10) ORDER BY sha256(c_name))) AS record_set FROM customer GROUP BY 1")
def record_set_digest(t):
    return t.customer.groupBy("c_nationkey").agg(A.digest(F.sha2("c_name", 256)).alias("record_set"))


@query("SELECT c_mktsegment, sha256(string_agg(printf('%08x', strlen(c_name)) || ':' || c_name || ':' || md5(c_name), '' ORDER BY c_name)) AS inventory FROM customer GROUP BY 1")
def inventory_digest(t):
    return t.customer.groupBy("c_mktsegment").agg(A.inventory_digest(F.col("c_name"), F.md5("c_name")).alias("inventory"))


@query(f"""SELECT o_orderkey, coalesce(s.total, 0) AS lines_total, s.l_orderkey IS NULL OR s.total <> CAST(o_totalprice AS DECIMAL(18,2)) AS failed FROM orders LEFT JOIN (SELECT l_orderkey, CAST(sum({_CENTS.format('l_extendedprice')}) AS DECIMAL(38,2)) AS total FROM lineitem GROUP BY 1) s ON o_orderkey = s.l_orderkey""")
def rollup_control(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(A.total(F.col("l_extendedprice")).alias("total"))
    joined = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("o_orderkey", F.coalesce("total", F.lit(0)).cast("decimal(38,2)").alias("lines_total"), (F.col("l_orderkey").isNull() | (F.col("total") != A.money(F.col("o_totalprice")))).alias("failed"))


@query("""SELECT user_id, count(*) FILTER (event_type IN ('purchase', 'error')) AS n_ledger, CAST(coalesce(sum(CASE event_type WHEN 'purchase' THEN CAST(value AS DECIMAL(18,2)) WHEN 'error' THEN -CAST(value AS DECIMAL(18,2)) END), 0) AS DECIMAL(38,2)) AS balance FROM events GROUP BY 1""")
def signed_control_total(t):
    ledger = F.col("event_type").isin("purchase", "error")
    signed = F.when(ledger, S.signed_amount(F.col("event_type"), A.money(F.col("value")), "purchase"))
    return t.events.groupBy("user_id").agg(F.count_if(ledger).alias("n_ledger"), A.total(signed).alias("balance"))


@query("""WITH c AS (SELECT o_orderkey, o_orderkey - o_orderkey % 10 AS parent, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders)
SELECT p.o_orderkey AS parent, CAST(sum(c.amount) AS DECIMAL(38,2)) AS reversed, sum(c.amount) > any_value(p.amount) AS exceeded FROM c JOIN c p ON c.parent = p.o_orderkey AND c.o_orderkey <> p.o_orderkey GROUP BY 1""")
def cumulative_reversal(t):
    rows = t.orders.select("o_orderkey", A.money(F.col("o_totalprice")).alias("amount"))
    children = rows.select((F.col("o_orderkey") - F.col("o_orderkey") % 10).alias("parent"), "o_orderkey", "amount").filter("parent <> o_orderkey").groupBy("parent").agg(F.sum("amount").cast("decimal(38,2)").alias("reversed"))
    return children.join(rows, F.col("parent") == F.col("o_orderkey")).select("parent", "reversed", (F.col("reversed") > F.col("amount")).alias("exceeded"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) <> 1")
def duplicate_keys_having(t):
    return A.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("SELECT l_returnflag, count(DISTINCT (l_suppkey, l_linestatus)) AS pairs, count(DISTINCT CASE WHEN l_discount > 0.05 THEN l_suppkey END) AS discounting FROM lineitem GROUP BY 1")
def distinct_struct_count(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_suppkey", "l_linestatus").alias("pairs"), F.countDistinct(F.when(F.col("l_discount") > 0.05, F.col("l_suppkey"))).alias("discounting"))


@query("SELECT CAST(min(d) AS DATE) AS first_day, CAST(max(d) AS DATE) AS last_day FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem UNION ALL SELECT ts FROM events)")
def global_date_bounds(t):
    return _dates(t).agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def _dates(t):
    return U.union_all([df.select(F.to_date(c).alias("day")) for df, c in ((t.orders, "o_orderdate"), (t.lineitem, "l_shipdate"), (t.events, "ts"))])


@query("SELECT user_id, event_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_version(t):
    return W.latest(t.events.select("user_id", "event_id", "event_type", "ts"), ["user_id"], F.desc("ts"), F.desc("event_id"))


@query("SELECT user_id, event_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_version_preaggregated(t):
    return W.latest_by_aggregate(t.events.select("user_id", "event_id", "event_type", "ts"), ["user_id"], "ts", "event_id")


@query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1 AND event_type <> 'error'")
def tombstone_membership(t):
    return W.latest(t.events, ["user_id"], F.desc("ts"), F.desc("event_id")).filter("event_type <> 'error'").select("user_id", "event_id")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) > 1 AS duplicate FROM lineitem")
def first_duplicate_kept(t):
    at = W.occurrence(["l_orderkey", "l_linenumber"], F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", (at > 1).alias("duplicate"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS duplicate FROM lineitem")
def all_duplicates_flagged(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", (W.copies(["l_orderkey", "l_linenumber"]) > 1).alias("duplicate"))


@query("SELECT o_orderkey, o_orderstatus = 'O' AND count(*) FILTER (o_orderstatus = 'O') OVER (PARTITION BY o_custkey) > 1 AS flagged FROM orders")
def multiple_current(t):
    open_ = F.col("o_orderstatus") == "O"
    return t.orders.select("o_orderkey", (open_ & (F.count_if(open_).over(Window.partitionBy("o_custkey")) > 1)).alias("flagged"))


@query("SELECT o_orderkey, CAST(ceil(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) / 5.0) AS BIGINT) AS batch, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) % 2 = 1 AS odd FROM orders")
def position_group(t):
    at = W.occurrence(["o_custkey"], F.col("o_orderkey"))
    return t.orders.select("o_orderkey", F.ceil(at / 5).cast("bigint").alias("batch"), (at % 2 == 1).alias("odd"))


@query("SELECT to_timestamp(floor(epoch(ts) / 3600) * 3600)::TIMESTAMP AS window_start, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount FROM events GROUP BY 1")
def tumbling_window(t):
    return t.events.groupBy(W.tumbling_start(F.col("ts"), 3600).alias("window_start")).agg(F.count("*").alias("n"), A.total(F.col("value")).alias("amount"))


@query("""SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC, o_orderdate DESC, o_orderkey DESC) AS r FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01' AND o_orderkey % 7 <> 0) WHERE r = 1 AND o_orderstatus <> 'P'""")
def current_identity(t):
    known = t.orders.filter((F.col("o_orderdate") <= "2000-01-01") & (F.col("o_orderkey") % 7 != 0))
    now = W.latest(known, ["o_custkey"], F.desc("o_orderpriority"), F.desc("o_orderdate"), F.desc("o_orderkey"))
    return now.filter("o_orderstatus <> 'P'").select("o_custkey", "o_orderkey", "o_orderstatus")


@query("SELECT CAST(d AS DATE) AS day, count(*) AS n FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem UNION ALL SELECT ts FROM events) GROUP BY 1")
def union_all_dates(t):
    return _dates(t).groupBy("day").agg(F.count("*").alias("n"))


@query("SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t):
    return t.customer.select(F.col("c_nationkey").alias("nation")).union(t.supplier.select("s_nationkey")).distinct()


@query("""SELECT *, 'missing' AS side FROM (SELECT l_partkey AS k FROM lineitem WHERE l_returnflag = 'A' AND l_quantity < 3 EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 47)
UNION ALL SELECT *, 'unexpected' FROM (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 47 EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_quantity < 3)""")
def symmetric_difference(t):
    k = t.lineitem.withColumnRenamed("l_partkey", "k")
    return U.symmetric_difference(k.filter("l_returnflag = 'A' AND l_quantity < 3").select("k"), k.filter("l_returnflag = 'R' AND l_quantity > 47").select("k"))


@query("""WITH b AS (SELECT c_custkey AS k, md5(c_name) AS h FROM customer WHERE c_custkey % 9 <> 0), a AS (SELECT c_custkey AS k, md5(CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment ELSE c_name END) AS h FROM customer WHERE c_custkey % 8 <> 0)
SELECT coalesce(b.k, a.k) AS k, CASE WHEN b.k IS NULL THEN 'added' WHEN a.k IS NULL THEN 'removed' ELSE 'changed' END AS change FROM b FULL JOIN a ON b.k = a.k WHERE b.h IS DISTINCT FROM a.h""")
def changed_keys_delta(t):
    k = F.col("c_custkey")
    before = t.customer.filter(k % 9 != 0).select(k.alias("k"), F.md5("c_name").alias("h"))
    after = t.customer.filter(k % 8 != 0).select(k.alias("k"), F.md5(F.when(k % 5 == 0, F.col("c_mktsegment")).otherwise(F.col("c_name"))).alias("h"))
    return U.changed_keys(before, after, "k", "h")


@query("SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS full_date FROM orders")
def date_spine(t):
    return U.date_spine(t.orders.select(F.to_date("o_orderdate").alias("day")), "day")


@query(f"""SELECT sha256('{{"key_namespace":"customer_version","customer":' || o_custkey || ',"valid_from":"' || strftime(valid_from, '%Y-%m-%d') || '"}}') AS version_key, o_custkey, c_name, valid_from, valid_to, valid_to IS NULL AS is_current FROM {VERSIONS_SQL} JOIN customer ON o_custkey = c_custkey""")
def scd_dimension(t):
    return _dimension(t)


def _dimension(t):
    v = versions(t).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    key = S.deterministic_key("customer_version", customer=F.col("o_custkey"), valid_from=F.col("valid_from"))
    return v.select(key.alias("version_key"), "o_custkey", "c_name", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))


@query(f"""SELECT sha256('{{"key_namespace":"order","order":' || o_orderkey || '}}') AS order_key, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS order_date_key,
sha256('{{"key_namespace":"customer_version","customer":' || v.o_custkey || ',"valid_from":"' || strftime(valid_from, '%Y-%m-%d') || '"}}') AS version_key, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
FROM orders o LEFT JOIN (SELECT v.* FROM {VERSIONS_SQL} v JOIN customer ON v.o_custkey = c_custkey) v ON o.o_custkey = v.o_custkey AND CAST(o_orderdate AS DATE) >= valid_from AND (valid_to IS NULL OR CAST(o_orderdate AS DATE) < valid_to)""")
def fact_build(t):
    from ..operators.joins import asof_join

    facts = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    joined = asof_join(facts, _dimension(t), [("o_custkey", "o_custkey")], "day")
    return joined.select(S.deterministic_key("order", order=F.col("f.o_orderkey")).alias("order_key"), S.date_key(F.col("f.day")).alias("order_date_key"), F.col("v.version_key").alias("version_key"), A.money(F.col("f.o_totalprice")).alias("amount"))
