from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from .registry import query


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(value AS DECIMAL(18,2)) AS amount, CAST(ts AS DATE) AS day, event_type = 'error' AS is_error FROM events")
def typed_projection(t):
    text = F.get_json_object("props", "$.k")
    return t.events.select("event_id", S.typed(text, "INTEGER").alias("k"), F.col("value").cast("decimal(18,2)").alias("amount"), F.to_date("ts").alias("day"), (F.col("event_type") == "error").alias("is_error"))


@query("""SELECT p_partkey, CAST(len(m) AS BIGINT) AS n_members, m[1] AS first_member, array_to_string(m, ',') AS joined FROM (
SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN [] ELSE string_split(replace(p_name, ' ', '|'), '|') END AS m FROM part)""")
def list_split(t):
    packed = F.when(F.col("p_size") % 7 == 0, "").otherwise(F.translate("p_name", " ", "|"))
    members = S.list_members(packed)
    return t.part.select("p_partkey", F.size(members).cast("bigint").alias("n_members"), F.get(members, F.lit(0)).alias("first_member"), F.array_join(members, ",").alias("joined"))


@query("SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key FROM orders")
def date_key(t):
    return t.orders.select("o_orderkey", S.date_key(F.col("o_orderdate")).alias("date_key"))


@query("""SELECT d AS full_date, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, year(d) AS calendar_year, quarter(d) AS calendar_quarter, month(d) AS calendar_month, day(d) AS day_of_month, dayofweek(d) + 1 AS day_of_week,
isoyear(d) AS iso_year, weekofyear(d) AS iso_week, monthname(d) AS month_name, dayname(d) AS day_name, CAST(date_trunc('week', d) AS DATE) AS week_start, CAST(date_trunc('month', d) AS DATE) AS month_start,
CAST(date_trunc('quarter', d) AS DATE) AS quarter_start, CAST(date_trunc('year', d) AS DATE) AS year_start, dayofweek(d) IN (0, 6) AS is_weekend FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""")
def calendar_attributes(t):
    days = t.orders.select(F.to_date("o_orderdate").alias("full_date")).distinct()
    return days.select("full_date", *(c.alias(n) for n, c in S.calendar(F.col("full_date")).items()))


@query("SELECT event_id, CASE WHEN CASE event_type WHEN 'purchase' THEN 'credit' WHEN 'error' THEN 'debit' END = 'credit' THEN CAST(value AS DECIMAL(18,2)) ELSE -CAST(value AS DECIMAL(18,2)) END AS signed_amount FROM events")
def signed_amount(t):
    direction = F.when(F.col("event_type") == "purchase", "credit").when(F.col("event_type") == "error", "debit")
    return t.events.select("event_id", S.signed_amount(direction, F.col("value").cast("decimal(18,2)")).cast("decimal(18,2)").alias("signed_amount"))


@query("""SELECT c_custkey, sha256('{"key_namespace":"customer","nation":' || c_nationkey || ',"name":"' || c_name || '"}') AS customer_key,
CASE WHEN c_acctbal > 0 THEN sha256('{"key_namespace":"balance","customer":' || c_custkey || '}') END AS balance_key FROM customer""")
def deterministic_key(t):
    positive = F.when(F.col("c_acctbal") > 0, F.col("c_custkey"))
    return t.customer.select("c_custkey", S.deterministic_key("customer", nation=F.col("c_nationkey"), name=F.col("c_name")).alias("customer_key"), S.optional_key(S.deterministic_key("balance", customer=F.col("c_custkey")), positive).alias("balance_key"))


@query("""SELECT c_custkey, sha256('name=' || strlen(c_name) || ':' || c_name || '|segment=' || coalesce(strlen(s) || ':' || s, '-1:')) AS evidence FROM (SELECT *, nullif(c_mktsegment, 'MACHINERY') AS s FROM customer)""")
def evidence_hash(t):
    return t.customer.select("c_custkey", S.evidence(name=F.col("c_name"), segment=F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY"))).alias("evidence"))


@query("""SELECT s_suppkey, a IS NOT DISTINCT FROM b AS same, a IS DISTINCT FROM b AS differs FROM (SELECT s_suppkey, nullif(s_nationkey % 3, 0) AS a, nullif(s_suppkey % 3, 0) AS b FROM supplier)""")
def null_safe_compare(t):
    a, b = F.nullif(F.col("s_nationkey") % 3, F.lit(0)), F.nullif(F.col("s_suppkey") % 3, F.lit(0))
    return t.supplier.select("s_suppkey", a.eqNullSafe(b).alias("same"), (~a.eqNullSafe(b)).alias("differs"))


@query("""SELECT event_type, count(*) AS n, count(json_extract_string(props, '$.k')) AS n_k, count(json_extract_string(props, '$.missing')) AS n_missing, CAST(sum(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k FROM events GROUP BY 1""")
def json_field_extract(t):
    k = F.get_json_object("props", "$.k")
    return t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.count(k).alias("n_k"), F.count(F.get_json_object("props", "$.missing")).alias("n_missing"), F.sum(k.try_cast("bigint")).alias("sum_k"))


@query("SELECT o_orderkey, CAST(('0x' || substr(sha256('42:orders:' || o_orderkey), 15, 2))::INTEGER % 64 AS BIGINT) AS bucket FROM orders")
def stable_hash_bucket(t):
    return t.orders.select("o_orderkey", S.stable_integer(0, 63, F.lit(42), F.lit("orders"), F.col("o_orderkey")).alias("bucket"))


@query("""SELECT p_partkey, CASE WHEN regexp_full_match(x, '-?[0-9]+(\\.[0-9]{1,2})?') THEN CAST(x AS DECIMAL(18,2)) END AS amount, CASE WHEN regexp_full_match(x, '-?[0-9]+') THEN CAST(x AS BIGINT) END AS whole FROM (
SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN '12.345' WHEN 1 THEN '+7' WHEN 2 THEN '-' || p_size || '.5' WHEN 3 THEN '' ELSE CAST(p_size AS VARCHAR) END AS x FROM part)""")
def strict_numbers(t):
    k = F.col("p_size") % 5
    text = F.when(k == 0, "12.345").when(k == 1, "+7").when(k == 2, F.concat(F.lit("-"), F.col("p_size").cast("string"), F.lit(".5"))).when(k == 3, "").otherwise(F.col("p_size").cast("string"))
    return t.part.select("p_partkey", S.typed(text, "NUMERIC(18,2)").alias("amount"), S.typed(text, "INTEGER").alias("whole"))


@query("SELECT p_partkey, CAST(round(CAST(p_retailprice AS DECIMAL(18,2)) / 8, 2) AS DECIMAL(18,2)) AS eighth FROM (SELECT p_partkey, CAST(round(p_retailprice * 8) / 8 AS DECIMAL(18,2)) AS p_retailprice FROM part)")
def half_up_rounding(t):
    price = F.round(F.round(F.col("p_retailprice") * 8) / 8, 2).cast("decimal(18,2)")
    return t.part.select("p_partkey", S.half_up(price / 8, 2).cast("decimal(18,2)").alias("eighth"))
