"""Hot keys, long chains and compiled catalogues against brute force."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from marlstone.operators import catalogue as C
from marlstone.operators import fixpoint
from marlstone.operators import quality as Q
from marlstone.operators.asof import asof_scan
from marlstone.operators.splits import hot_splits
from marlstone.operators.sweep import overlap_pairs, overlap_totals
from marlstone.sources.files import shared_checkpoint

DAY = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)


@pytest.mark.parametrize("least", [10, 10_000])
def test_asof_scan_by_brute_force(spark, least):
    rng = random.Random(least)
    versions, facts = [], []
    for k in ("hot", "cold", "other", None):
        starts = sorted(rng.sample(range(0, 120), 25 if k == "hot" else 5))
        for a, b in itertools.pairwise([*starts, None]):
            end = None if b is None else rng.choice([b, b, max(a + 1, b - 2)])
            versions.append((k, DAY(a), None if end is None else DAY(end), f"{k}{a}"))
    versions.append(("cold", None, DAY(3), "never"))
    for i in range(400):
        k = "hot" if i % 2 else rng.choice(["cold", "other", "nobody", None])
        facts.append((i, k, None if rng.random() < 0.05 else DAY(60 if i % 5 == 1 else rng.randint(-5, 130))))
    facts += facts[:3]  # repeated rows stay
    f, v = spark.createDataFrame(facts, "id int, key string, day date"), spark.createDataFrame(versions, "entity string, valid_from date, valid_to date, name string")
    got = [(r.id, r.key, r.day, r.version.name if r.version else None) for r in asof_scan(f, v, [("key", "entity")], "day", least=least).collect()]

    def covering(k, day):
        return next((n for e, a, b, n in versions if k and day and e == k and a and a <= day and (b is None or day < b)), None)

    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted([(i, k, d, covering(k, d)) for i, k, d in facts], key=key)
    assert asof_scan(f.filter("false"), v, [("key", "entity")], "day", least=least).count() == 0
    assert asof_scan(f, v.filter("false"), [("key", "entity")], "day", least=least).filter("version IS NOT NULL").count() == 0


def test_a_hot_key_is_cut_into_even_parts(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"), (F.col("id") % 5000).alias("t"))
    splits = hot_splits(rows, ["k"], "t", least=100)
    (hot,) = splits.collect()
    assert hot.k == "hot" and len(hot.cuts) >= 1 and hot.cuts == sorted(hot.cuts)
    edges = [-1, *hot.cuts, 5000]
    sizes = [sum(4 for x in range(0, 5000, 2) if a < x <= b) // 2 for a, b in itertools.pairwise(edges)]
    assert max(sizes) <= 2 * min(sizes)
    assert hot_splits(rows, ["k"], "t", least=50_000) is None and hot_splits(rows.filter("k <> 'hot'"), ["k"], "t", least=100) is None
    # the plan of the scan deals by entity and part
    facts = rows.select("k", F.date_add(F.lit("2024-01-01").cast("date"), F.col("t").cast("int")).alias("day"))
    versions = spark.createDataFrame([("hot", DAY(3), None)], "k string, valid_from date, valid_to date")
    scanned = asof_scan(facts, versions, [("k", "k")], "day", least=100)
    assert "_part" in scanned._jdf.queryExecution().executedPlan().toString() and scanned.filter("version IS NOT NULL").count() == 10_000 - 8


@pytest.mark.parametrize("least", [8, 10_000])
def test_overlap_pairs_by_brute_force(spark, least):
    rng = random.Random(least)
    rows = [(rng.choice(["a", "a", "a", "b", None]), k if rng.random() < 0.95 else None, *(None if rng.random() < 0.08 else DAY(rng.randint(0, 60)) for _ in range(2))) for k in range(120)]
    rows += [("a", 500 + k, DAY(k), DAY(k + 1)) for k in range(30)] + [("a", 600, DAY(-5), None), ("a", 600, DAY(-5), None), ("a", 601, DAY(30), DAY(20))]
    df = spark.createDataFrame(rows, "entity string, id int, valid_from date, valid_to date")
    end = lambda x: x or datetime.date(9999, 12, 31)
    want = [(a[0], min(a[1], b[1]), max(a[1], b[1])) for a, b in itertools.combinations(rows, 2) if a[0] == b[0] and a[0] and a[1] is not None and b[1] is not None and a[1] != b[1] and a[2] and b[2] and a[2] < end(b[3]) and b[2] < end(a[3])]
    assert sorted(tuple(r) for r in overlap_pairs(df, ["entity"], "id", least=least).collect()) == sorted(want)
    assert overlap_pairs(df.filter("false"), ["entity"], "id").count() == 0


def test_touching_intervals_are_swept_in_line(spark):
    n = 100_000
    chain = spark.range(n).select(F.lit("one").alias("e"), "id", F.timestamp_seconds("id").alias("valid_from"), F.timestamp_seconds(F.col("id") + 1).alias("valid_to"))
    assert overlap_pairs(chain, ["e"], "id", least=5000).count() == 0
    met = overlap_pairs(chain.withColumn("valid_to", F.timestamp_seconds(F.col("id") + 2)), ["e"], "id", least=5000)
    assert met.agg(F.count("*"), F.count_if(F.col("right_id") - F.col("left_id") == 1)).first()[:] == (n - 1, n - 1)


def test_overlap_totals_by_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "a", "b", None]), rng.randint(0, 90) if rng.random() < 0.95 else None, None if rng.random() < 0.05 else (f := rng.randint(-9, 9)), None if rng.random() < 0.05 else f + rng.choice([0, 0, 1, 2, 5])) for _ in range(150)]
    df = spark.createDataFrame(rows + [("a", 95, 4, 2)], "entity string, id bigint, valid_from int, valid_to int")
    want = {}
    for a, b in itertools.permutations(rows, 2):
        if None not in (*a, *b) and a[0] == b[0] and a[1] < b[1] and a[2] < b[3] and b[2] < a[3]:
            n, rights = want.get(a[:2], (0, 0))
            want[a[:2]] = n + 1, rights + b[1]
    assert {tuple(r[:2]): tuple(r[2:]) for r in overlap_totals(df, ["entity"], "id").collect()} == want
    assert overlap_totals(df.filter("false"), ["entity"], "id").count() == 0


def test_hot_overlaps_are_counted_without_their_pairs(spark, tmp_path):
    """All orders of one day: each meets every other, 200 million pairs, of which the query makes none."""
    from __spark_entry__ import queries

    n = 20_000
    spark.range(n).selectExpr("id AS o_orderkey", "1L AS o_custkey", "'1-URGENT' AS o_orderpriority", "timestamp'1995-01-01' AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    found = queries()["overlap_hot_entities"](spark, str(tmp_path))
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.agg(F.count("*"), F.sum("n"), F.sum(F.col("rights") - (F.lit(n * (n - 1) // 2) - F.expr("left_id * (left_id + 1) div 2")))).first()[:] == (n - 1, n * (n - 1) // 2, 0)


def settled(spark, rows, edges, failed=None):
    df = Q.classified(spark.createDataFrame(rows, "row_id string, k string, parent string, ok boolean"), [Q.issue("BAD", "quarantined", "k", "bad", ~F.col("ok"))])
    frames = {"x": shared_checkpoint(df)}
    return frames, fixpoint.settle(frames, edges, shared_checkpoint, failed)


SELF = Q.Relationship("parent", "x", "x", (("parent", "k"),), "R", optional=True)


def test_long_chains_and_circles_settle(spark, monkeypatch):
    rounds, plain = [], fixpoint.shared_table
    monkeypatch.setattr(fixpoint, "shared_table", lambda df: rounds.append(1) or plain(df))
    rows = [(f"c{i}", f"c{i}", f"c{i - 1}" if i else "", i != 1) for i in range(1000)]  # a chain whose second row is bad
    rows += [(f"o{i}", f"o{i}", f"o{(i + 1) % 7}", True) for i in range(7)]  # a sound circle
    rows += [(f"p{i}", f"p{i}", f"p{(i + 1) % 5}", True) for i in range(5)] + [("q", "q", "q", True), ("r", "r", "nobody", True), ("s", "s", "r", True)]
    rows += [("t1", "t", "", True), ("t2", "t", "", True), ("u", "u", "t", True), ("v", "v", "u", True)]  # two targets are none
    _, out = settled(spark, rows, [SELF])
    gone = {r.row_id for r in out["x"].filter("disposition = 'quarantined'").collect()}
    assert gone == {f"c{i}" for i in range(1, 1000)} | {"r", "s", "u", "v"} and len(rounds) <= 13
    assert all([i.rule_id for i in r.issues] == ["R"] for r in out["x"].filter("row_id IN ('c500', 'r', 's', 'u', 'v')").collect())


def test_frontier_equals_settling_anew(spark):
    rng = random.Random(4)
    make = lambda n, up, m: [(f"{n}{i}", f"{n}{i}", f"{up}{rng.randint(0, m)}" if up else "", rng.random() < 0.97) for i in range(40)]
    schema = "row_id string, k string, parent string, ok boolean"
    sound = {n: Q.classified(spark.createDataFrame(rows, schema), [Q.issue("BAD", "rejected", "k", "bad", ~F.col("ok"))]) for n, rows in (("a", make("a", "", 0)), ("b", make("b", "a", 41)), ("c", make("c", "b", 39)))}
    edges = [Q.Relationship("c_b", "c", "b", (("parent", "k"),), "C"), Q.Relationship("b_a", "b", "a", (("parent", "k"),), "B")]
    first = fixpoint.settle({n: shared_checkpoint(df) for n, df in sound.items()}, edges, shared_checkpoint)
    lost = {"a": Q.active(first["a"]).select("row_id").filter("row_id LIKE '%3'")}
    marked = {**first, "a": shared_checkpoint(Q.with_issue(first["a"], lost["a"], "X", "k", "withdrawn"))}
    states = [{n: {(r.row_id, r.disposition) for r in df.select("row_id", "disposition").collect()} for n, df in fixpoint.settle(marked, edges, shared_checkpoint, how).items()} for how in (lost, None)]
    assert states[0] == states[1] and states[0] != {n: {(r.row_id, r.disposition) for r in df.select("row_id", "disposition").collect()} for n, df in first.items()}
    assert fixpoint.settling_order(edges) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        fixpoint.settling_order([*edges, Q.Relationship("a_c", "a", "c", (("parent", "k"),), "A")])


RULES = """
# customers and what they bought
customer C-1 rejected required name
customer C-2 rejected unique id
order O-1 quarantined refers customer customer.id
order O-2 quarantined balances total part tax
order O-3 quarantined not_before shipped ordered
order O-4 quarantined whole_pointer a b
order O-5 quarantined may_refer agent customer.id
order O-6 block_batch absent secret
order O-7 block_batch present id
order O-8 accepted not_applicable id
"""
FIELDS = {"customer": ["id", "name"], "order": ["id", "customer", "agent", "total", "part", "tax", "shipped", "ordered", "a", "b"]}
POLICY = {("order", "customer"): "O-1"}


def test_catalogue_counts(spark):
    entries = [e for e in C.read_catalogue(RULES) if e.rule_id != "O-5"]
    tables = {"customer": spark.createDataFrame([(1, "x"), (2, ""), (2, None), (2, "y")], "id int, name string"), "order": spark.createDataFrame([(1, 1, None, 3, 1, 2, DAY(1), DAY(0), "x", "y"), (2, 2, 1, 3, 1, 1, DAY(0), DAY(1), "x", None), (3, None, 9, None, 1, 1, None, DAY(1), None, None)], "id int, customer int, agent int, total int, part int, tax int, shipped date, ordered date, a string, b string")}
    compiled = C.compile_catalogue(entries, FIELDS, POLICY)
    got = {r.rule_id: (r["class"], r.failures) for r in compiled.failures(tables).collect()}
    assert got == {"C-1": ("row", 2), "C-2": ("key", 2), "O-1": ("relationship", 2), "O-2": ("row", 1), "O-3": ("row", 1), "O-4": ("row", 1), "O-6": ("boundary", 0), "O-7": ("batch", 0), "O-8": ("not_applicable", 0)}
    assert {c: len(p) for c, p in compiled.inventory().items()} == {"row": 4, "key": 1, "relationship": 1, "batch": 1, "boundary": 1, "not_applicable": 1}
    assert {r.id: [i.rule_id for i in r.issues] for r in compiled.judged("order", tables["order"]).collect()} == {1: [], 2: ["O-2", "O-3", "O-4"], 3: []}
    gone = {r.rule_id: r.failures for r in C.compile_catalogue(entries, FIELDS, POLICY).failures({"customer": tables["customer"], "order": tables["order"].filter("false")}).collect()}
    assert gone["O-7"] == 1 and gone["O-1"] == 0
    optional = C.compile_catalogue(C.read_catalogue(RULES), FIELDS)
    assert {r.rule_id: r.failures for r in optional.failures(tables).collect()}["O-5"] == 1
    assert compiled._scan("order", tables["order"])._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


@pytest.mark.parametrize("change", [("required name", "needed name"), ("required name", "required names"), ("customer.id", "client.id"), ("customer.id", "customer.key"), ("absent secret", "absent a"), ("order O-2", "orders O-2"), ("O-3 quarantined", "O-2 quarantined"), ("O-4 quarantined", "O-4 ignored"), ("balances total part tax", "balances total"), ("refers customer customer.id", "required customer"), ("order O-1", "order O-11"), ("C-1 rejected required name", "C-1 rejected")])
def test_what_cannot_be_bound_is_fatal(change):
    text = "\n".join(x for x in RULES.splitlines() if "O-5" not in x)
    assert change[0] in text
    with pytest.raises(C.CatalogueError):
        C.compile_catalogue(C.read_catalogue(text.replace(*change)), FIELDS, POLICY)


def test_a_source_without_rules_and_an_unused_policy_are_fatal():
    entries = [e for e in C.read_catalogue(RULES) if e.rule_id != "O-5"]
    with pytest.raises(C.CatalogueError, match="no rule"):
        C.compile_catalogue(entries, FIELDS | {"stray": ["id"]}, POLICY)
    with pytest.raises(C.CatalogueError, match="used by no rule"):
        C.compile_catalogue(entries, FIELDS, POLICY | {("customer", "order"): "C-9"})


def test_deliveries_become_visible_together(spark, tmp_path):
    from pyspark.sql.functions import raise_error

    from marlstone.sources.files import DeliveryError
    from marlstone.sources.transactions import commit, committed

    at = str(tmp_path / "deliveries")
    rows = spark.range(10).repartition(3)
    assert committed(spark, at, "rows") is None
    broken = rows.withColumn("x", F.when(F.col("id") == 7, raise_error(F.lit("a task dies"))).otherwise("x"))
    with pytest.raises(Exception, match="a task dies"):
        commit(spark, at, "d1", "h", {"batch": rows.limit(1), "rows": broken})
    assert committed(spark, at, "batch") is None
    assert commit(spark, at, "d1", "h", {"batch": rows.limit(1), "rows": rows.withColumn("x", F.lit("x"))}) == "committed"
    assert commit(spark, at, "d1", "h", {"batch": rows, "rows": broken}) == "duplicate_no_op"
    with pytest.raises(DeliveryError):
        commit(spark, at, "d1", "other", {"batch": rows})
    assert commit(spark, at, "d2", "h", {"rows": rows.withColumn("x", F.lit("y"))}) == "committed"
    assert committed(spark, at, "batch").count() == 1
    assert {(r.delivery, r.x, r.n) for r in committed(spark, at, "rows").groupBy("delivery", "x").agg(F.count("*").alias("n")).collect()} == {("d1", "x", 10), ("d2", "y", 10)}
    # of two commits of one key at once the first counts
    spark.read.parquet(f"{at}/commits").filter("key = 'd2'").withColumns({"number": F.lit(2**62), "id": F.lit("later")}).write.mode("append").parquet(f"{at}/commits")
    assert committed(spark, at, "rows").count() == 20


def test_row_numbers_of_split_files(spark, tmp_path):
    from marlstone.sources.files import DeliveryError, read_numbered_csv

    rows = {f"{n}.csv": [[f"{n}-{i}", "x" * (i * 7 % 50), "a,b" if i % 5 == 0 else ""] for i in range(n)] for n in (1, 200, 431, 0)}
    quoted = lambda x: f'"{x}"' if "," in x else x
    for name, content in rows.items():
        (tmp_path / name).write_text("\n".join(["id,text,more", *(",".join(map(quoted, r)) for r in content)]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = read_numbered_csv(spark, str(tmp_path), ["id", "text", "more"])
        assert got.rdd.getNumPartitions() > 1
        assert {(r.file.rsplit("/", 1)[1], r.row_number, r.id, r.text, r.more) for r in got.collect()} == {(name, i, *r) for name, content in rows.items() for i, r in enumerate(content, 1)}
        with pytest.raises(DeliveryError):
            read_numbered_csv(spark, str(tmp_path), ["id", "more", "text"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_hash_trees(spark):
    from marlstone.operators import trees

    rows = spark.range(3000).select(F.when(F.col("id") < 2900, "big").otherwise("small").alias("relation"), F.col("id").cast("string").alias("key"), F.md5(F.col("id").cast("string")).alias("content"))
    commit = lambda df: {r.relation: (r.row_count, r.depth, r.tree_sha256) for r in trees.tree_commitment(df, leaf=20).collect()}
    first = commit(rows)
    assert first == commit(rows.repartition(7).orderBy(F.desc("key"))) and first["big"][:2] == (2900, 1) and first["small"][:2] == (100, 1)
    for changed in (rows.filter("key <> '17'"), rows.withColumn("content", F.when(F.col("key") == "17", "x").otherwise(F.col("content"))), rows.unionByName(rows.filter("key = '17'")), rows.withColumn("key", F.when(F.col("key") == "17", "17 ").otherwise(F.col("key")))):
        again = commit(changed)
        assert again["big"][2] != first["big"][2] and again["small"] == first["small"]
    levels = trees.tree_nodes(rows, leaf=20)
    assert levels[0].agg(F.max("members")).first()[0] < 60 and levels[-1].filter("prefix = ''").count() == 2


def test_hash_trees_read_their_members_once(spark):
    from hashlib import sha256

    from marlstone.operators import trees

    rows = spark.range(900).select(F.when(F.col("id") < 870, "deep").when(F.col("id") < 890, "low").otherwise("leaf").alias("relation"), F.concat(F.lit("é"), "id").alias("key"), F.when(F.col("id") % 9 > 0, F.col("id").cast("string")).alias("content"))
    rows = rows.unionByName(spark.createDataFrame([("leaf", None, "no key")], "relation string, key string, content string"))
    tree = trees.tree_commitment(rows, leaf=3)
    assert tree._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 2  # the count and the leaves
    digest = lambda x: sha256(x.encode()).hexdigest()

    def node(members, prefix, depth):
        if len(prefix) == 2 * depth:
            return digest("\n".join(sorted(f"{len(k.encode()):08x}:{k}:{c or ''}" for k, c in members)))
        below = {}
        for k, c in members:
            below.setdefault(digest(k)[: len(prefix) + 2], []).append((k, c))
        return digest("".join(p[-2:] + node(m, p, depth) for p, m in sorted(below.items())))

    for r in tree.collect():
        members = [(x.key, x.content) for x in rows.filter((F.col("relation") == r.relation) & F.col("key").isNotNull()).collect()]
        assert r.depth == {"deep": 2, "low": 1, "leaf": 1}[r.relation] and r.tree_sha256 == digest(f"tree-v1:{len(members)}:{r.depth}:{node(members, '', r.depth)}")


def test_replay_is_located_by_fingerprints(spark):
    from marlstone.operators import trees

    rows = spark.range(500).select("id", F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("a"), F.lit(None).cast("string").alias("b"))
    known = trees.fingerprints(rows, "r", ["id"], 16)
    assert known.agg(F.sum("n")).first()[0] == 500 and trees.differing(known, trees.fingerprints(rows.repartition(5), "r", ["id"], 16)).count() == 0
    after = rows.filter("id <> 3").withColumn("b", F.when(F.col("id") == 8, "new").otherwise(F.col("b"))).unionByName(rows.filter("id = 20")).unionByName(spark.createDataFrame([(900, "x", None)], rows.schema))
    got = {tuple(r) for r in trees.replay_difference(rows, after, known, "r", ["id"], 16).collect()}
    assert got == {(3, "missing"), (8, "different"), (20, "unexpected"), (900, "unexpected")}
    swapped = rows.withColumn("b", F.col("a")).withColumn("a", F.lit(None).cast("string"))
    assert trees.differing(known, trees.fingerprints(swapped, "r", ["id"], 16)).count() == 16


def test_compaction_touches_only_its_buckets(spark, tmp_path):
    from marlstone.operators import compaction

    at = str(tmp_path / "membership")
    schema = "publication_id string, chain_position bigint, relation string, key string, sequence bigint, content string"
    one = lambda rows: spark.createDataFrame(rows, schema)
    base = one([("p0", 0, "r", str(i), 0, f"c{i}") for i in range(40)])
    delta = one([("p1", 1, "r", "3", 0, None), ("p1", 1, "r", "3", 1, "again"), ("p1", 1, "r", "4", 0, None), ("p1", 1, "r", "new", 0, "n")])
    late = one([("p0", 0, "r", "4", 9, "too late"), ("p2", 2, "r", "5", 0, "five")])
    whole = {tuple(r) for r in compaction.resolve(spark, str(tmp_path / "none"), base.unionByName(delta).unionByName(late)).collect()}
    assert compaction.compact(spark, at, base, buckets=8) == 8 and compaction.compact(spark, at, base.filter("false"), buckets=8) == 0
    assert {tuple(r) for r in compaction.resolve(spark, at, delta.unionByName(late)).collect()} == whole
    assert 1 <= compaction.compact(spark, at, delta, buckets=8) <= 3
    assert {tuple(r) for r in compaction.resolve(spark, at, late).collect()} == whole
    assert compaction.compact(spark, at, late, buckets=8) <= 2
    assert {tuple(r) for r in compaction.resolve(spark, at).collect()} == whole and ("p0", "r", "4", "too late") not in whole
