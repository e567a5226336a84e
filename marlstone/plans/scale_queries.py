"""Queries of the operators that split hot keys, settle long chains and compile rule catalogues."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.asof import asof_scan
from ..operators.catalogue import compile_catalogue, read_catalogue
from ..operators.fixpoint import settle
from ..operators.sweep import overlap_totals
from ..operators.trees import fingerprints, replay_difference, tree_commitment
from ..operators.windows import with_validity
from ..sources.files import shared_checkpoint, shared_folder
from ..sources.transactions import commit, committed
from .registry import query

#: Rows above which a key of these queries may be cut.
LEAST = 5_000

_FLAG_VERSIONS = """(SELECT flag, valid_from, lead(valid_from) OVER (PARTITION BY flag ORDER BY valid_from) AS valid_to FROM
(SELECT DISTINCT l_returnflag AS flag, CAST(min(l_shipdate) OVER (PARTITION BY l_returnflag, date_trunc('month', l_shipdate), l_quantity) AS DATE) AS valid_from FROM lineitem))"""


@query(f"""SELECT l_returnflag, valid_from, count(*) AS n_lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue FROM lineitem
LEFT JOIN {_FLAG_VERSIONS} v ON l_returnflag = flag AND CAST(l_shipdate AS DATE) >= valid_from AND (valid_to IS NULL OR CAST(l_shipdate AS DATE) < valid_to) GROUP BY 1, 2""")
def asof_hot_entities(t):
    """Three entities hold all lines, and a version of them begins with the first line of a quantity in a month."""
    starts = t.lineitem.groupBy(F.col("l_returnflag").alias("flag"), F.trunc("l_shipdate", "month"), "l_quantity").agg(F.to_date(F.min("l_shipdate")).alias("day"))
    facts = t.lineitem.select("l_returnflag", F.to_date("l_shipdate").alias("day"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    found = asof_scan(facts, with_validity(starts, ["flag"], "day"), [("l_returnflag", "flag")], "day", least=LEAST)
    return found.groupBy("l_returnflag", F.col("version.valid_from").alias("valid_from")).agg(F.count("*").alias("n_lines"), F.sum("price").cast("decimal(38,2)").alias("revenue"))


@query("""WITH v AS (SELECT o_orderpriority, o_orderkey AS id, CAST(o_orderdate AS DATE) AS f, CAST(o_orderdate AS DATE) + CAST(o_custkey % 3 AS INTEGER) AS e FROM orders)
SELECT a.o_orderpriority, a.id AS left_id, count(*) AS n, CAST(sum(b.id) AS BIGINT) AS rights FROM v a JOIN v b ON a.o_orderpriority = b.o_orderpriority AND a.id < b.id AND a.f < b.e AND b.f < a.e GROUP BY 1, 2""")
def overlap_hot_entities(t):
    """Five entities hold all orders, each a stretch of up to two days; stretches of no day meet what runs through them."""
    day = F.to_date("o_orderdate")
    spans = t.orders.select("o_orderpriority", "o_orderkey", day.alias("valid_from"), F.date_add(day, (F.col("o_custkey") % 3).cast("int")).alias("valid_to"))
    return overlap_totals(spans, ["o_orderpriority"], "o_orderkey")


@query("""WITH RECURSIVE r AS (SELECT o_orderkey AS id, o_orderkey - 1 AS parent, o_orderkey % 1000 <> 0 AS has, o_orderkey % 1009 = 5 AS bad FROM orders),
down AS (SELECT id FROM r WHERE bad UNION SELECT r.id FROM r JOIN down d ON r.parent = d.id AND r.has) SELECT id AS row_id, 'quarantined' AS disposition, count(*) OVER () AS n FROM down""")
def relationship_long_chains(t):
    """Orders point at the order before them, in chains of a thousand; what hangs on a bad order goes with it."""
    k = F.col("o_orderkey")
    bad = Q.issue("R-014", "quarantined", "o_orderkey", "bad", k % 1009 == 5)
    rows = Q.classified(t.orders.select(k.alias("row_id"), k, F.when(k % 1000 != 0, k - 1).alias("parent")), [bad])
    edge = Q.Relationship("previous_order", "orders", "orders", (("parent", "o_orderkey"),), "R-010", optional=True)
    settled = settle({"orders": shared_checkpoint(rows)}, [edge], shared_checkpoint)["orders"].filter("disposition = 'quarantined'")
    return settled.select("row_id", "disposition").join(settled.agg(F.count("*").alias("n")), F.lit(True))


_TWO_LEVELS = """WITH n AS (SELECT n_nationkey FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_regionkey <> 1)), c AS (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM n) AND c_acctbal >= 0)
SELECT 'orders' AS identity, o_orderkey AS row_id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM c)
UNION ALL SELECT 'customer', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM c)
UNION ALL SELECT 'nation', n_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT n_nationkey FROM n)
UNION ALL SELECT 'region', r_regionkey FROM region WHERE r_regionkey = 1"""


@query(_TWO_LEVELS)
def relationship_frontier(t):
    """All is settled while everything is sound; then a region and the customers in debt fail, and only what hangs on them is
    judged again, through nations, customers and orders."""
    made = {"region": (t.region, "r_regionkey"), "nation": (t.nation, "n_nationkey"), "customer": (t.customer, "c_custkey"), "orders": (t.orders, "o_orderkey")}
    frames = {n: shared_checkpoint(Q.classified(df.withColumn("row_id", F.col(k).cast("bigint")), [Q.required("R-001", k)])) for n, (df, k) in made.items()}
    edge = lambda source, target, a, b: Q.Relationship(f"{source}_{target}", source, target, ((a, b),), "R-004")
    edges = [edge("orders", "customer", "o_custkey", "c_custkey"), edge("customer", "nation", "c_nationkey", "n_nationkey"), edge("nation", "region", "n_regionkey", "r_regionkey")]
    settled = settle(frames, edges, shared_checkpoint)
    lost = {"region": settled["region"].filter("r_regionkey = 1").select("row_id"), "customer": settled["customer"].filter("c_acctbal < 0").select("row_id")}
    for n, failed in lost.items():
        settled[n] = shared_checkpoint(Q.with_issue(settled[n], failed, "R-014", "row_id", "withdrawn"))
    done = settle(settled, edges, shared_checkpoint, lost)
    out = None
    for n, df in done.items():
        some = df.filter("disposition = 'quarantined'").select(F.lit(n).alias("identity"), "row_id")
        out = some if out is None else out.unionByName(some)
    return out


#: Rules over the tables of the folder, a line each.
RULES = """
region   REG-001 rejected    required      r_name
region   REG-002 rejected    unique        r_regionkey
region   REG-003 block_batch present       r_regionkey
region   REG-004 block_batch absent        r_secret
nation   NAT-001 rejected    required      n_name
nation   NAT-002 quarantined refers        n_regionkey region.r_regionkey
nation   NAT-003 accepted    not_applicable n_name
customer CUS-001 rejected    required      c_name
customer CUS-002 rejected    unique        c_custkey
customer CUS-003 quarantined refers        c_nationkey nation.n_nationkey
customer CUS-004 quarantined allowed       c_mktsegment AUTOMOBILE BUILDING FURNITURE
customer CUS-005 accepted_with_warning from c_acctbal 0
orders   ORD-001 rejected    required      o_orderpriority
orders   ORD-002 rejected    unique        o_orderkey
orders   ORD-003 quarantined refers        o_custkey customer.c_custkey
orders   ORD-004 quarantined allowed       o_orderstatus F O
orders   ORD-005 accepted_with_warning to  o_totalprice 400000
orders   ORD-006 quarantined like          o_orderpriority [1-4]-.*
lineitem LIN-001 rejected    required      l_returnflag
lineitem LIN-002 rejected    unique        l_orderkey l_linenumber
lineitem LIN-003 quarantined refers        l_orderkey orders.o_orderkey
lineitem LIN-004 quarantined may_refer     l_partkey part.p_partkey
lineitem LIN-005 quarantined above         l_quantity 2
lineitem LIN-006 quarantined to            l_quantity 45
part     PAR-001 quarantined like          p_brand Brand#[0-9]
part     PAR-002 rejected    unique        p_brand
"""
_POLICY = {("nation", "region"): "NAT-002", ("customer", "nation"): "CUS-003", ("orders", "customer"): "ORD-003", ("lineitem", "orders"): "LIN-003", ("lineitem", "part"): "LIN-004"}

_COUNTS = [
    ("region", "REG-001", "row", "count(*) FILTER (coalesce(r_name, '') = '') FROM region"),
    ("region", "REG-002", "key", "count(*) - count(DISTINCT r_regionkey) FROM region"),
    ("region", "REG-003", "batch", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM region"),
    ("region", "REG-004", "boundary", "0"),
    ("nation", "NAT-001", "row", "count(*) FILTER (coalesce(n_name, '') = '') FROM nation"),
    ("nation", "NAT-002", "relationship", "count(*) FILTER (n_regionkey NOT IN (SELECT r_regionkey FROM region)) FROM nation"),
    ("nation", "NAT-003", "not_applicable", "0"),
    ("customer", "CUS-001", "row", "count(*) FILTER (coalesce(c_name, '') = '') FROM customer"),
    ("customer", "CUS-002", "key", "count(*) - count(DISTINCT c_custkey) FROM customer"),
    ("customer", "CUS-003", "relationship", "count(*) FILTER (c_nationkey NOT IN (SELECT n_nationkey FROM nation)) FROM customer"),
    ("customer", "CUS-004", "row", "count(*) FILTER (c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')) FROM customer"),
    ("customer", "CUS-005", "row", "count(*) FILTER (c_acctbal < 0) FROM customer"),
    ("orders", "ORD-001", "row", "count(*) FILTER (coalesce(o_orderpriority, '') = '') FROM orders"),
    ("orders", "ORD-002", "key", "count(*) - count(DISTINCT o_orderkey) FROM orders"),
    ("orders", "ORD-003", "relationship", "count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer)) FROM orders"),
    ("orders", "ORD-004", "row", "count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders"),
    ("orders", "ORD-005", "row", "count(*) FILTER (o_totalprice > 400000) FROM orders"),
    ("orders", "ORD-006", "row", "count(*) FILTER (NOT regexp_full_match(o_orderpriority, '[1-4]-.*')) FROM orders"),
    ("lineitem", "LIN-001", "row", "count(*) FILTER (coalesce(l_returnflag, '') = '') FROM lineitem"),
    ("lineitem", "LIN-002", "key", "count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem"),
    ("lineitem", "LIN-003", "relationship", "count(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders)) FROM lineitem"),
    ("lineitem", "LIN-004", "relationship", "count(*) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part)) FROM lineitem"),
    ("lineitem", "LIN-005", "row", "count(*) FILTER (l_quantity <= 2) FROM lineitem"),
    ("lineitem", "LIN-006", "row", "count(*) FILTER (l_quantity > 45) FROM lineitem"),
    ("part", "PAR-001", "row", "count(*) FILTER (NOT regexp_full_match(p_brand, 'Brand#[0-9]')) FROM part"),
    ("part", "PAR-002", "key", "count(*) - count(DISTINCT p_brand) FROM part"),
]


def _compiled(t):
    tables = {n: getattr(t, n) for n in ("region", "nation", "customer", "orders", "lineitem", "part")}
    return tables, compile_catalogue(read_catalogue(RULES), {n: df.columns for n, df in tables.items()}, _POLICY)


@query("\nUNION ALL ".join(f"SELECT '{s}' AS source, '{r}' AS rule_id, '{c}' AS class, CAST((SELECT {sql}) AS BIGINT) AS failures" for s, r, c, sql in _COUNTS))
def rule_catalogue(t):
    """Every rule of the catalogue with its class and what breaks it: one scan of a source for all its row rules."""
    tables, compiled = _compiled(t)
    return compiled.failures(tables)


@query("""SELECT o_orderkey, CASE WHEN coalesce(o_orderpriority, '') = '' THEN 'rejected' WHEN o_orderstatus NOT IN ('F', 'O') OR NOT regexp_full_match(o_orderpriority, '[1-4]-.*') THEN 'quarantined' WHEN o_totalprice > 400000 THEN 'accepted_with_warning' ELSE 'accepted' END AS disposition,
array_to_string(list_filter([CASE WHEN coalesce(o_orderpriority, '') = '' THEN 'ORD-001' END, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'ORD-004' END, CASE WHEN o_totalprice > 400000 THEN 'ORD-005' END, CASE WHEN NOT regexp_full_match(o_orderpriority, '[1-4]-.*') THEN 'ORD-006' END], lambda x: x IS NOT NULL), ',') AS broken FROM orders""")
def catalogue_dispositions(t):
    """The row rules that the catalogue has for orders, fused to one projection."""
    tables, compiled = _compiled(t)
    return compiled.judged("orders", tables["orders"]).select("o_orderkey", "disposition", F.array_join(F.transform("issues", lambda x: x["rule_id"]), ",").alias("broken"))


def _level(name: str, of: str, length: int) -> str:
    """Nodes whose prefix has ``length`` hex digits fold into those above them; others stay."""
    return f"""{name} AS (SELECT relation, depth, prefix, members, hash FROM {of} WHERE length(prefix) <> {length}
UNION ALL SELECT relation, depth, prefix[1:{length - 2}], CAST(sum(members) AS BIGINT), sha256(string_agg(prefix[-2:] || hash, '' ORDER BY prefix)) FROM {of} WHERE length(prefix) = {length} GROUP BY 1, 2, 3)"""


@query(f"""WITH m AS (SELECT 'orders' AS relation, o_orderkey::VARCHAR AS k, md5(o_orderstatus || o_orderpriority) AS c FROM orders UNION ALL SELECT 'lineitem', l_orderkey || '/' || l_linenumber || '/' || l_partkey || '/' || l_suppkey, md5(l_returnflag || l_linestatus) FROM lineitem UNION ALL SELECT 'nation', n_nationkey::VARCHAR, md5(n_name) FROM nation),
s AS (SELECT relation, count(*) AS n, ((count(*) > 1024)::INT + (count(*) > 262144)::INT + (count(*) > 67108864)::INT + (count(*) > 17179869184)::INT) AS depth FROM m GROUP BY 1),
l0 AS (SELECT relation, depth, sha256(k)[1:2 * depth] AS prefix, count(*) AS members, sha256(string_agg(printf('%08x', strlen(k)) || ':' || k || ':' || c, chr(10) ORDER BY printf('%08x', strlen(k)) || ':' || k || ':' || c)) AS hash FROM m JOIN s USING (relation) GROUP BY 1, 2, 3),
{_level("l1", "l0", 8)}, {_level("l2", "l1", 6)}, {_level("l3", "l2", 4)}, {_level("l4", "l3", 2)}
SELECT relation, CAST(members AS BIGINT) AS row_count, CAST(depth AS INTEGER) AS depth, sha256('tree-v1:' || members || ':' || depth || ':' || hash) AS tree_sha256 FROM l4""")
def tree_inventory_commitment(t):
    """Hash trees over whole relations of any size."""
    text = lambda *cols: F.concat_ws("/", *(F.col(c).cast("string") for c in cols))
    shape = lambda df, relation, key, content: df.select(F.lit(relation).alias("relation"), key.alias("key"), F.md5(F.concat(*content)).alias("content"))
    members = shape(t.orders, "orders", text("o_orderkey"), ["o_orderstatus", "o_orderpriority"]).unionByName(shape(t.lineitem, "lineitem", text("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_returnflag", "l_linestatus"])).unionByName(shape(t.nation, "nation", text("n_nationkey"), ["n_name"]))
    return tree_commitment(members)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 977 = 1 THEN 'missing' ELSE 'different' END AS state FROM orders WHERE o_orderkey % 977 = 1 OR o_orderkey % 977 = 2 AND o_orderstatus = 'F'")
def replay_by_fingerprints(t):
    """A replay loses some orders and alters the status of others; fingerprints find the buckets, and only those are compared."""
    k = F.col("o_orderkey")
    again = t.orders.filter(k % 977 != 1).withColumn("o_orderstatus", F.when((k % 977 == 2) & (F.col("o_orderstatus") == "F"), "O").otherwise(F.col("o_orderstatus")))
    return replay_difference(t.orders, again, fingerprints(t.orders, "orders", ["o_orderkey"]), "orders", ["o_orderkey"])


@query("""SELECT 'batches' AS name, 'all' AS delivery, count(DISTINCT o_orderpriority) AS n, CAST(count(*) AS BIGINT) AS total FROM orders
UNION ALL SELECT 'rows', o_orderpriority, count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders GROUP BY 2""")
def transactional_deliveries(t):
    """Orders come as a delivery for each priority, rows and batch record committed together; each comes twice and counts once."""
    folder = f"{shared_folder(t.spark)}/deliveries-{uuid4().hex}"
    for k in [r[0] for r in t.orders.select("o_orderpriority").distinct().orderBy("o_orderpriority").collect()] * 2:  # a row a delivery
        rows = t.orders.filter(F.col("o_orderpriority") == k)
        commit(t.spark, folder, k, "v1", {"batches": rows.agg(F.count("*").alias("n")), "rows": rows.select("o_orderkey")})
    batches = committed(t.spark, folder, "batches").agg(F.count("*").alias("n"), F.sum("n").alias("total")).select(F.lit("batches").alias("name"), F.lit("all").alias("delivery"), "n", "total")
    return batches.unionByName(committed(t.spark, folder, "rows").groupBy("delivery").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("total")).select(F.lit("rows").alias("name"), "delivery", "n", "total"))
