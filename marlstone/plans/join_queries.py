from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators.aggregates import money, ordered_values
from ..operators.windows import with_validity
from .registry import query

VERSIONS_SQL = """(SELECT o_custkey, valid_from, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS valid_to FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS valid_from FROM orders))"""


def versions(t):
    """Effective-dated rows of each customer: a version from each order date to the next."""
    return with_validity(t.orders.select("o_custkey", F.to_date("o_orderdate").alias("day")), ["o_custkey"], "day")


@query(f"""SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(v.valid_from) AS BIGINT) AS n_versioned, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue
FROM lineitem JOIN orders o ON l_orderkey = o_orderkey LEFT JOIN {VERSIONS_SQL} v ON o.o_custkey = v.o_custkey AND CAST(l_shipdate AS DATE) >= v.valid_from AND (v.valid_to IS NULL OR CAST(l_shipdate AS DATE) < v.valid_to) GROUP BY 1""")
def asof_dimension_join(t):
    facts = t.lineitem.join(t.orders.select("o_orderkey", F.col("o_custkey").alias("custkey")), F.col("l_orderkey") == F.col("o_orderkey")).select("custkey", F.to_date("l_shipdate").alias("ship_day"), money(F.col("l_extendedprice")).alias("price"))
    joined = J.asof_join(facts, versions(t), [("custkey", "o_custkey")], "ship_day")
    return joined.groupBy(F.trunc("ship_day", "month").alias("month")).agg(F.count("*").alias("n_lines"), F.count("v.valid_from").alias("n_versioned"), F.sum("price").cast("decimal(38,2)").alias("revenue"))


@query(f"""SELECT o.o_orderkey, v.valid_from AS version_from FROM orders o ASOF LEFT JOIN (SELECT o_custkey, valid_from FROM {VERSIONS_SQL}) v ON o.o_custkey = v.o_custkey AND CAST(o.o_orderdate AS DATE) - 30 >= v.valid_from""")
def asof_latest_before(t):
    facts = t.orders.select("o_orderkey", "o_custkey", F.date_sub(F.to_date("o_orderdate"), 30).alias("day"))
    known = versions(t).select("o_custkey", "valid_from", F.col("valid_from").alias("version_from"))
    return J.asof_lookup(facts, known, ("o_custkey", "o_custkey"), "day", "valid_from", "version_from").select("o_orderkey", "version_from")


@query(f"""WITH v AS (SELECT * FROM {VERSIONS_SQL}), y AS (SELECT DISTINCT o_custkey, CAST(date_trunc('year', valid_from) AS DATE) AS y0, CAST(date_trunc('year', valid_from) + INTERVAL 1 YEAR AS DATE) AS y1 FROM v)
SELECT v.o_custkey, v.valid_from, v.valid_to, y.y0 AS year_from FROM v LEFT JOIN y ON v.o_custkey = y.o_custkey AND v.valid_from >= y.y0 AND coalesce(v.valid_to, DATE '9999-12-31') <= y.y1""")
def interval_containment_join(t):
    v = versions(t)
    start = F.trunc("valid_from", "year")
    years = v.select("o_custkey", start.alias("y0"), F.add_months(start, 12).alias("y1")).distinct()
    joined = J.within(v, years, F.col("i.o_custkey") == F.col("o.o_custkey"), ("valid_from", "valid_to"), ("y0", "y1"))
    return joined.select("i.o_custkey", "i.valid_from", "i.valid_to", F.col("o.y0").alias("year_from"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, o_orderstatus AS parent_status, o_custkey AS parent_customer FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus <> 'P'")
def parent_fact_join(t):
    parents = t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey", F.col("o_orderstatus").alias("parent_status"), F.col("o_custkey").alias("parent_customer"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(parents, F.col("l_orderkey") == F.col("o_orderkey"), "left").drop("o_orderkey")


@query("""WITH u AS (SELECT l_orderkey, l_linenumber, any_value(l_partkey) AS part FROM lineitem GROUP BY 1, 2 HAVING count(*) = 1)
SELECT o_orderkey, u.part AS first_line_part FROM orders LEFT JOIN u ON o_orderkey = u.l_orderkey AND u.l_linenumber = 1""")
def unique_parent_lookup(t):
    once = J.unique_parents(t.lineitem, ["l_orderkey", "l_linenumber"], "l_partkey").filter("l_linenumber = 1").select("l_orderkey", F.col("l_partkey").alias("first_line_part"))
    return t.orders.select("o_orderkey").join(once, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "first_line_part")


@query("""WITH v AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS f, CAST(o_orderdate AS DATE) + 20 AS e FROM orders)
SELECT a.o_custkey, a.o_orderkey AS left_id, b.o_orderkey AS right_id FROM v a JOIN v b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.f < b.e AND b.f < a.e""")
def self_overlap_join(t):
    day = F.to_date("o_orderdate")
    spans = t.orders.select("o_custkey", "o_orderkey", day.alias("valid_from"), F.date_add(day, 20).alias("valid_to"))
    return J.overlapping(spans, ["o_custkey"], "o_orderkey")


@query("SELECT c.o_orderkey, p.o_orderkey AS parent_key, p.o_custkey IS DISTINCT FROM c.o_custkey AS other_customer FROM orders c LEFT JOIN orders p ON c.o_orderkey - c.o_orderkey % 10 = p.o_orderkey AND p.o_orderkey <> c.o_orderkey")
def self_parent_join(t):
    child = t.orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") - F.col("o_orderkey") % 10).alias("points_at"))
    parent = t.orders.select(F.col("o_orderkey").alias("parent_key"), F.col("o_custkey").alias("parent_customer"))
    joined = child.join(parent, (F.col("points_at") == F.col("parent_key")) & (F.col("parent_key") != F.col("o_orderkey")), "left")
    return joined.select("o_orderkey", "parent_key", (~F.col("parent_customer").eqNullSafe(F.col("o_custkey"))).alias("other_customer"))


@query("""WITH e AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_orderkey % 50 <> 3 GROUP BY 1), a AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' OR l_orderkey % 4 > 0 GROUP BY 1)
SELECT coalesce(e.k, a.k) AS k, e.n AS expected_n, a.n AS actual_n, CASE WHEN e.k IS NULL THEN 'unexpected' WHEN a.k IS NULL THEN 'missing' ELSE 'different' END AS state FROM e FULL JOIN a ON e.k = a.k WHERE e.n IS DISTINCT FROM a.n""")
def full_outer_reconciliation(t):
    lines = t.lineitem.withColumn("k", F.col("l_orderkey"))
    count = lambda df: df.groupBy("k").agg(F.count("*").alias("n"))
    return J.reconcile(count(lines.filter("k % 50 <> 3")), count(lines.filter("l_returnflag <> 'R' OR k % 4 > 0")), ["k"], ["n"])


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def anti_join_orphans(t):
    return J.orphans(t.orders.select("o_orderkey"), t.lineitem, [("o_orderkey", "l_orderkey")])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_orderkey = o_orderkey AND p_brand = 'Brand#2')")
def semi_join_slice(t):
    sliced = t.lineitem.join(t.part.filter("p_brand = 'Brand#2'"), F.col("l_partkey") == F.col("p_partkey"))
    return t.orders.join(sliced, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey", "o_custkey")


@query("SELECT p_partkey, i AS position, string_split(p_name, ' ')[i + 1] AS member FROM (SELECT p_partkey, p_name, CAST(unnest(range(len(string_split(p_name, ' ')))) AS INTEGER) AS i FROM part)")
def lateral_unnest_offset(t):
    return t.part.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("position", "member"))


@query("""SELECT p_partkey, m AS member FROM (SELECT p_partkey, unnest(CASE WHEN p_size % 4 = 0 THEN [NULL] ELSE string_split(p_name, ' ') END) AS m FROM part)""")
def left_unnest(t):
    members = F.when(F.col("p_size") % 4 == 0, F.array().cast("array<string>")).otherwise(F.split("p_name", " "))
    return t.part.select("p_partkey", F.posexplode_outer(members).alias("position", "member")).drop("position")


@query("""SELECT n.n_nationkey, s.seg AS segment FROM nation n CROSS JOIN (SELECT unnest(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY', 'SPACE']) AS seg) s WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n.n_nationkey AND c_mktsegment = s.seg)""")
def cross_required_set(t):
    """Nations that lack a required segment; the constant set is exploded on each row, so nothing is cross-joined."""
    wanted = t.nation.select("n_nationkey", F.explode(F.array(*map(F.lit, ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "SPACE"]))).alias("segment"))
    return J.orphans(wanted, t.customer, [("n_nationkey", "c_nationkey"), ("segment", "c_mktsegment")])


@query("SELECT s_suppkey, s_name, n_name, r_name FROM supplier LEFT JOIN (SELECT n_nationkey AS s_nationkey, n_name, n_regionkey FROM nation) USING (s_nationkey) LEFT JOIN region ON n_regionkey = r_regionkey")
def using_join(t):
    nations = t.nation.withColumnRenamed("n_nationkey", "s_nationkey")
    return t.supplier.join(nations, "s_nationkey", "left").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("s_suppkey", "s_name", "n_name", "r_name")


@query("""SELECT l_orderkey, array_to_string(list(coalesce(p_brand, '__unresolved__') ORDER BY l_linenumber, coalesce(p_brand, '__unresolved__')), ',') AS brands FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON l_partkey = p_partkey GROUP BY 1""")
def ordered_array_agg(t):
    joined = t.lineitem.join(t.part.filter("p_size > 10"), F.col("l_partkey") == F.col("p_partkey"), "left")
    return joined.groupBy("l_orderkey").agg(F.array_join(ordered_values(F.col("l_linenumber"), F.col("p_brand"), "__unresolved__"), ",").alias("brands"))
