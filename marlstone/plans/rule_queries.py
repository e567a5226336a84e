from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.fixpoint import settle
from .registry import query

_LINES = "SELECT l_orderkey, l_linenumber, l_partkey, {} FROM lineitem"


def _flag(issue):
    return issue.isNotNull().alias("broken")


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END, '') = '' AS broken FROM orders")
def required_field_rule(t):
    k = F.col("o_orderkey")
    holes = F.when(k % 11 == 0, "").when(k % 13 == 0, None).otherwise(F.col("o_orderpriority"))
    return t.orders.withColumn("x", holes).select("o_orderkey", _flag(Q.required("R-001", "x")))


@query("SELECT event_id, NOT regexp_full_match(json_extract_string(props, '$.k'), '[0-4]?[0-9]') AS broken FROM events")
def type_cast_rule(t):
    return t.events.withColumn("k", F.get_json_object("props", "$.k")).select("event_id", _flag(Q.pattern("R-013", "k", "^[0-4]?[0-9]$")))


@query("SELECT o_orderkey, o_orderstatus NOT IN ('F', 'O') AS broken FROM orders")
def allowed_value_rule(t):
    return t.orders.select("o_orderkey", _flag(Q.allowed("R-014", "o_orderstatus", ["F", "O"])))


@query("SELECT p_partkey, NOT regexp_full_match(p_brand, 'Brand#[0-9]') AS broken FROM part")
def pattern_rule(t):
    return t.part.select("p_partkey", _flag(Q.pattern("R-014", "p_brand", "^Brand#[0-9]$")))


@query(_LINES.format("l_quantity <= 2 OR l_quantity > 45 AS broken"))
def numeric_bound_rule(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", _flag(Q.bounds("R-004", "l_quantity", 2, 45, exclusive=True)))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate < o_orderdate AS broken FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def date_order_rule(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", _flag(Q.in_order("R-003", "o_orderdate", "l_shipdate")))


@query("SELECT s_suppkey, (s_suppkey % 3 = 0) <> (s_suppkey % 5 = 0) AS broken FROM supplier")
def pair_pointer_rule(t):
    k = F.col("s_suppkey")
    rows = t.supplier.withColumn("a", F.when(k % 3 == 0, "x")).withColumn("b", F.when(k % 5 == 0, "y"))
    return rows.select("s_suppkey", _flag(Q.whole_pointer("R-012", ["a", "b"])))


@query(_LINES.format("CAST(l_extendedprice AS DECIMAL(18,2)) <> CAST(l_extendedprice / 2 AS DECIMAL(18,2)) * 2 AS broken"))
def financial_equation_rule(t):
    half = (F.col("l_extendedprice") / 2).cast("decimal(18,2)")
    rows = t.lineitem.withColumn("whole", F.col("l_extendedprice").cast("decimal(18,2)")).withColumn("a", half).withColumn("b", half)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", _flag(Q.balances("R-006", "whole", ["a", "b"])))


@query("SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') BETWEEN 0 AND 7 AND o_orderstatus = 'O' AS broken FROM orders")
def deadline_window_rule(t):
    left = F.date_diff(F.lit("2001-08-01").cast("date"), F.to_date("o_orderdate"))
    near = Q.issue("R-009", "accepted_with_warning", "o_orderdate", "deadline near", (left >= 0) & (left <= 7) & (F.col("o_orderstatus") == "O"))
    return t.orders.select("o_orderkey", _flag(near))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN 'rejected' WHEN o_orderstatus = 'P' THEN 'quarantined' WHEN o_totalprice > 400000 THEN 'accepted_with_warning' ELSE 'accepted' END AS disposition,
CAST((o_orderkey % 17 = 0)::INT + (o_orderstatus = 'P')::INT + (o_totalprice > 400000)::INT AS BIGINT) AS n_issues FROM orders""")
def disposition_fold(t):
    return _judged(t).select("o_orderkey", "disposition", F.size("issues").cast("bigint").alias("n_issues"))


def _judged(t):
    key = F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderkey").cast("string"))
    rules = [Q.required("R-001", "key"), Q.allowed("R-014", "o_orderstatus", ["F", "O"]), Q.bounds("R-004", "o_totalprice", high=400000, disposition="accepted_with_warning")]
    return Q.classified(t.orders.withColumn("key", key), rules)


_JUDGED = "SELECT o_orderkey, o_orderpriority, o_orderkey % 17 = 0 AS r, o_orderstatus = 'P' AS q, o_totalprice > 400000 AS w FROM orders"


@query(f"""SELECT o_orderpriority, count(*) FILTER (NOT r AND NOT q AND NOT w) AS accepted, count(*) FILTER (NOT r AND NOT q AND w) AS accepted_with_warning, count(*) FILTER (NOT r AND q) AS quarantined, count(*) FILTER (r) AS rejected, count(*) AS raw FROM ({_JUDGED}) GROUP BY 1""")
def disposition_counts(t):
    return Q.disposition_counts(_judged(t), "o_orderpriority")


@query(f"SELECT rule_id, count(*) AS failures FROM (SELECT unnest([CASE WHEN r THEN 'R-001' END, CASE WHEN q THEN 'R-014' END, CASE WHEN w THEN 'R-004' END]) AS rule_id FROM ({_JUDGED})) WHERE rule_id IS NOT NULL GROUP BY 1")
def issue_distribution(t):
    return Q.issue_distribution(_judged(t))


@query("""SELECT event_type, greatest(CAST(date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-02-01 00:00:00') AS BIGINT), 0) AS age_seconds, date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-02-01 00:00:00') > 1000 AS late FROM events GROUP BY 1""")
def freshness_age(t):
    return Q.freshness(t.events, "event_type", "ts", F.lit("2024-02-01 00:00:00").cast("timestamp"), 1000)


_EDGE = Q.Relationship("nation_of_customer", "customer", "nation", (("c_nationkey", "n_nationkey"),), "R-004")


@query("SELECT c_custkey AS row_id FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey % 6 <> 0)")
def exactly_one_relationship(t):
    rows = t.customer.withColumn("row_id", F.col("c_custkey")).withColumn("disposition", F.lit("accepted"))
    nations = t.nation.withColumn("disposition", F.when(F.col("n_nationkey") % 6 == 0, "quarantined").otherwise("accepted"))
    return Q.relationship_failures(rows, nations, _EDGE)


@query("""WITH RECURSIVE r AS (SELECT o_orderkey AS id, o_orderkey - 1 AS parent, o_orderkey % 10 <> 0 AS has, o_orderkey % 37 = 5 AS bad FROM orders),
down AS (SELECT id FROM r WHERE bad UNION SELECT r.id FROM r JOIN down d ON r.parent = d.id AND r.has) SELECT id AS row_id, 'quarantined' AS disposition FROM down""")
def relationship_fixpoint(t):
    """Orders point at the order before them, but every tenth; a bad order takes those that hang on it along."""
    k = F.col("o_orderkey")
    bad = Q.issue("R-014", "quarantined", "o_orderkey", "bad", k % 37 == 5)
    rows = Q.classified(t.orders.select(k.alias("row_id"), k, F.when(k % 10 != 0, k - 1).alias("parent")), [bad])
    edge = Q.Relationship("previous_order", "orders", "orders", (("parent", "o_orderkey"),), "R-010", optional=True)
    keep = _kept(t.spark)
    settled = settle({"orders": keep(rows)}, [edge], keep)["orders"]
    return settled.filter("disposition = 'quarantined'").select("row_id", "disposition")


def _kept(spark):
    from ..sources.files import shared_checkpoint

    return lambda df: shared_checkpoint(df)
