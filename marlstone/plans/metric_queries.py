from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from ..operators import publication as P
from . import metrics as M
from ..operators.compaction import compact, resolve
from ..sources.files import shared_checkpoint, shared_folder
from .registry import query


def _date(text: str):
    return F.lit(text).cast("timestamp")


_RATIO = "CAST(n AS DECIMAL(38,2)) AS numerator, CAST(d AS DECIMAL(38,2)) AS denominator, CASE WHEN d <> 0 THEN CAST(round(CAST(n AS DECIMAL(38,10)) / d, 6) AS DECIMAL(18,6)) END AS unrounded, CASE WHEN d <> 0 THEN CAST(round(CAST(n AS DECIMAL(38,10)) * 100 / d, 2) AS DECIMAL(18,2)) END AS display, CASE WHEN d <> 0 THEN 'ok' ELSE 'not_applicable' END AS status"


@query(f"""SELECT {_RATIO} FROM (SELECT count(*) AS d, count(*) FILTER (EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' AND o_orderstatus <> 'P')""")
def metric_ratio_half_open(t):
    """Share of the orders of a year that have a returned line."""
    population = M.in_period(t.orders.filter("o_orderstatus <> 'P'"), "o_orderdate", _date("1998-01-01"), _date("1999-01-01"))
    returned = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return M.share_with(population, ["o_orderkey"], returned)


@query(f"SELECT {_RATIO} FROM (SELECT 0 AS n, 0 AS d)")
def metric_ratio_empty(t):
    none = M.in_period(t.orders, "o_orderdate", _date("1900-01-01"), _date("1900-01-01"))
    return M.share_with(none, ["o_orderkey"], t.orders)


_CURRENT = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders WHERE o_orderdate <= TIMESTAMP '1999-06-30') WHERE r = 1 AND o_orderstatus <> 'P')"""


def _current(t):
    known = M.known_at(t.orders, "o_orderdate", _date("1999-06-30"))
    return M.current_rows(known, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], F.col("o_orderstatus") == "P")


@query(f"SELECT CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DECIMAL(38,2)) AS amount FROM {_CURRENT}")
def metric_as_of_balance(t):
    return M.sum_or_zero(_current(t), F.col("o_totalprice"))


@query(f"""WITH b AS (SELECT CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DECIMAL(38,2)) AS b FROM {_CURRENT}), s AS (SELECT CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DECIMAL(38,2)) AS s FROM orders WHERE o_orderdate > TIMESTAMP '1999-04-01' AND o_orderdate <= TIMESTAMP '1999-06-30')
SELECT b AS balance, s AS billed, CASE WHEN s > 0 THEN CAST(round(CAST(b AS DECIMAL(30,12)) * 90 / s, 6) AS DECIMAL(18,6)) END AS days FROM b, s""")
def metric_days_in_ar(t):
    billed = t.orders.filter((F.col("o_orderdate") > "1999-04-01") & (F.col("o_orderdate") <= "1999-06-30"))
    return M.days_outstanding(M.sum_or_zero(_current(t), F.col("o_totalprice")), M.sum_or_zero(billed, F.col("o_totalprice")))


@query(f"""SELECT user_id, {_RATIO} FROM (SELECT user_id, coalesce(sum(CASE event_type WHEN 'purchase' THEN a WHEN 'error' THEN -a END), 0) AS n, coalesce(sum(CASE WHEN event_type IN ('purchase', 'signup') THEN a END), 0) AS d FROM (SELECT *, CAST(value AS DECIMAL(18,2)) AS a FROM events) GROUP BY 1) WHERE d > 0""")
def metric_net_collection(t):
    amount, kind = F.col("value").cast("decimal(18,2)"), F.col("event_type")
    sums = t.events.groupBy("user_id").agg(F.coalesce(F.sum(F.when(kind == "purchase", amount).when(kind == "error", -amount)), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(kind.isin("purchase", "signup"), amount)), F.lit(0)).alias("d"))
    return sums.filter("d > 0").select("user_id", *M.ratio(F.col("n"), F.col("d")))


@query("SELECT CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))), 0) AS DECIMAL(38,2)) AS amount FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2030-01-01'")
def metric_sum_or_zero(t):
    return M.sum_or_zero(t.events.filter((F.col("event_type") == "purchase") & (F.col("ts") >= "2030-01-01")), F.col("value"))


#: Every four days of events are a publication; each event is a change of its user, an error a removal.
_DELTAS_SQL = "(SELECT 'p' || CAST((day(ts) - 1) // 4 AS VARCHAR) AS publication_id, 'user' AS relation, CAST(user_id AS VARCHAR) AS key, event_id AS sequence, CASE WHEN event_type <> 'error' THEN md5(CAST(event_id AS VARCHAR)) END AS content, CAST((day(ts) - 1) // 4 AS BIGINT) AS chain_position FROM events)"


def _deltas(t):
    place = F.floor((F.day("ts") - 1) / 4).cast("string")
    return t.events.select(F.concat(F.lit("p"), place).alias("publication_id"), F.lit("user").alias("relation"), F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("sequence"), F.when(F.col("event_type") != "error", F.md5(F.col("event_id").cast("string"))).alias("content"))


@query(f"SELECT publication_id, relation, key, content FROM (SELECT *, row_number() OVER (PARTITION BY relation, key ORDER BY chain_position DESC, sequence DESC) AS r FROM {_DELTAS_SQL}) WHERE r = 1 AND content IS NOT NULL")
def active_membership(t):
    deltas = _deltas(t)
    chain = deltas.select("publication_id").distinct().withColumn("chain_position", F.substring("publication_id", 2, 9).cast("bigint"))
    return P.active_membership(deltas, chain).select("publication_id", "relation", "key", "content")


@query(f"SELECT relation, count(*) AS row_count, sha256(string_agg(printf('%08x', strlen(key)) || ':' || key || ':' || content, '' ORDER BY key)) AS inventory_sha256 FROM (SELECT *, row_number() OVER (PARTITION BY relation, key ORDER BY chain_position DESC, sequence DESC) AS r FROM {_DELTAS_SQL}) WHERE r = 1 AND content IS NOT NULL GROUP BY 1")
def inventory_commitment(t):
    return P.inventory_commitment(active_membership(t))


@query(f"SELECT publication_id, relation, key, content FROM (SELECT *, row_number() OVER (PARTITION BY relation, key ORDER BY chain_position DESC, sequence DESC) AS r FROM {_DELTAS_SQL}) WHERE r = 1 AND content IS NOT NULL")
def membership_after_compaction(t):
    """All publications but the last two are folded into a base, in two compactions; the rest is merged when it is read."""
    placed = shared_checkpoint(_deltas(t).withColumn("chain_position", F.substring("publication_id", 2, 9).cast("bigint")))
    folder = f"{shared_folder(t.spark)}/membership-{uuid4().hex}"
    for at in (F.col("chain_position") < 3, F.col("chain_position").between(3, 5)):
        compact(t.spark, folder, placed.filter(at))
    return resolve(t.spark, folder, placed.filter("chain_position > 5"))


@query("""SELECT publication_id, defect FROM (SELECT 'p' || n_nationkey AS publication_id, unnest([CASE WHEN n_nationkey % 10 = 0 AND n_nationkey > 0 THEN 'base not first' END, CASE WHEN n_nationkey % 10 <> 0 AND n_nationkey % 7 = 0 THEN 'delta without parent' END, CASE WHEN n_nationkey > 8 THEN 'chain too long' END]) AS defect FROM nation) WHERE defect IS NOT NULL""")
def publication_chain_integrity(t):
    k = F.col("n_nationkey")
    name = lambda c: F.concat(F.lit("p"), c.cast("string"))
    base = k % 10 == 0
    manifests = t.nation.select(name(k).alias("publication_id"), F.when(~base, F.when(k % 7 == 0, "absent").otherwise(name(k - 1))).alias("parent_id"), F.when(base, "base").otherwise("delta").alias("mode"), k.cast("bigint").alias("chain_position"))
    return P.chain_defects(manifests)


@query("""SELECT relation, key, 'missing' AS defect FROM (SELECT 'customer' AS relation, c_custkey::VARCHAR AS key FROM customer WHERE c_custkey % 5 = 0 AND c_custkey % 3 = 0 AND c_name <> c_mktsegment)
UNION ALL SELECT 'customer', c_custkey::VARCHAR, 'superfluous' FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 4 = 0 AND c_custkey % 3 <> 0""")
def delta_verification(t):
    k = F.col("c_custkey")
    shape = lambda df, content: df.select(F.lit("customer").alias("relation"), k.cast("string").alias("key"), content.alias("content"))
    new = F.when(k % 5 == 0, F.md5("c_mktsegment")).otherwise(F.md5("c_name"))
    delta = t.customer.filter((k % 3 != 0) & ((k % 5 == 0) | (k % 4 == 0)))
    return P.delta_defects(shape(t.customer, F.md5("c_name")), shape(t.customer, new), shape(delta, new))


@query("""SELECT v.n AS validation_id, r.c AS n_records FROM (SELECT n_nationkey AS n, count(*) AS c, sha256(string_agg(sha256(c_name), chr(10) ORDER BY sha256(c_name))) AS h FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1) v JOIN (SELECT c_nationkey AS n, count(*) AS c, sha256(string_agg(sha256(CASE WHEN c_custkey % 400 = 7 THEN 'changed' ELSE c_name END), chr(10) ORDER BY sha256(CASE WHEN c_custkey % 400 = 7 THEN 'changed' ELSE c_name END))) AS h FROM customer GROUP BY 1) r ON v.n = r.n AND v.c = r.c AND v.h = r.h""")
def validated_boundary(t):
    """Record sets show up only where their count and digest equal what validation has signed."""
    from ..operators.aggregates import digest

    signed = t.customer.groupBy(F.col("c_nationkey").alias("validation_id")).agg(F.count("*").alias("c"), digest(F.sha2("c_name", 256)).alias("h"))
    name = F.when(F.col("c_custkey") % 400 == 7, "changed").otherwise(F.col("c_name"))
    stored = t.customer.groupBy(F.col("c_nationkey").alias("validation_id")).agg(F.count("*").alias("n_records"), digest(F.sha2(name, 256)).alias("stored"))
    signed = signed.join(t.nation, F.col("validation_id") == F.col("n_nationkey"), "left_semi")
    return signed.join(stored, "validation_id").filter("c = n_records AND h = stored").select("validation_id", "n_records")
