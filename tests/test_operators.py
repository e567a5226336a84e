import hashlib

import pytest
from pyspark.sql import functions as F

from marlstone.functions import scalars as S
from marlstone.operators import aggregates as A
from marlstone.operators import joins as J
from marlstone.operators import publication as P
from marlstone.operators import quality as Q
from marlstone.operators import sets as U
from marlstone.sources import files


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_stable_integer_is_the_hash_formula(spark):
    drawn = spark.range(300).select("id", S.stable_integer(10, 99, F.lit(7), F.lit("claims"), F.col("id")).alias("x")).collect()
    for r in drawn:
        assert r.x == 10 + int.from_bytes(hashlib.sha256(f"7:claims:{r.id}".encode()).digest()[:8], "big") % 90


@pytest.mark.parametrize(
    ("text", "kind", "want"),
    [("12.5", "NUMERIC(18,2)", "12.50"), ("1.239", "NUMERIC(18,2)", None), ("+1", "INTEGER", None), ("", "STRING", None), ("TRUE", "BOOLEAN", True), ("2", "BOOLEAN", None), ("2026-07-01", "DATE", "2026-07-01"), ("20260701", "DATE", None), ("2026-07-01T00:00:00", "TIMESTAMP", None), ("2026-07-01T02:00:00+02:00", "TIMESTAMP", "2026-07-01 00:00:00")],
)
def test_typed(spark, text, kind, want):
    got = one(spark, S.typed(F.lit(text), kind))
    assert (got if got is None or isinstance(got, bool) else str(got)) == want


def test_list_members(spark):
    assert one(spark, S.list_members(F.lit("a||b"))) == ["a", "", "b"]
    assert one(spark, S.list_members(F.lit(""))) == []


def test_asof_boundaries(spark):
    versions = spark.sql("SELECT 1 AS k, DATE'2026-01-01' AS valid_from, DATE'2026-02-01' AS valid_to, 'a' AS v UNION ALL SELECT 1, DATE'2026-02-01', NULL, 'b'")
    facts = spark.sql("SELECT 1 AS k, DATE'2026-01-31' AS day UNION ALL SELECT 1, DATE'2026-02-01' UNION ALL SELECT 1, DATE'2025-12-31' UNION ALL SELECT 2, DATE'2026-02-01'")
    joined = J.asof_join(facts, versions, [("k", "k")], "day").select("f.k", F.col("f.day").cast("string"), "v.v").collect()
    assert {tuple(r) for r in joined} == {(1, "2026-01-31", "a"), (1, "2026-02-01", "b"), (1, "2025-12-31", None), (2, "2026-02-01", None)}
    looked = J.asof_lookup(facts, versions, ("k", "k"), "day", "valid_from", "v").select("k", F.col("day").cast("string"), "v").collect()
    assert {tuple(r) for r in looked} == {tuple(r) for r in joined}


def test_digests(spark):
    df = spark.createDataFrame([("k1", "x"), ("k22", "y")], "k string, c string")
    assert df.agg(A.digest(F.col("c")).alias("d")).first().d == hashlib.sha256(b"x\ny").hexdigest()
    assert df.agg(A.inventory_digest(F.col("k"), F.col("c")).alias("d")).first().d == hashlib.sha256(b"00000002:k1:x00000003:k22:y").hexdigest()
    assert df.filter("false").agg(A.digest(F.col("c")).alias("d")).first().d == hashlib.sha256(b"").hexdigest()
    assert A.bucketed_digest(df, "k", "c", 8).first().digest == A.bucketed_digest(df.orderBy(F.desc("k")).repartition(3), "k", "c", 8).first().digest


def test_date_spine_of_nothing(spark):
    assert U.date_spine(spark.sql("SELECT DATE'2026-01-01' AS d WHERE false"), "d").count() == 0


def test_classification_keeps_distinct_issues(spark):
    df = spark.createDataFrame([(1, "", 5), (2, "x", -1), (3, "x", 1)], "row_id int, a string, b int")
    low = Q.bounds("R2", "b", low=0)
    got = {r.row_id: (r.disposition, len(r.issues)) for r in Q.classified(df, [Q.required("R1", "a"), low, low]).collect()}
    assert got == {1: ("rejected", 1), 2: ("quarantined", 1), 3: ("accepted", 0)}


def test_relationships_take_two_matches_as_failure(spark):
    s = spark.createDataFrame([(1, "a", "accepted"), (2, "b", "accepted"), (3, "", "accepted"), (4, "c", "rejected")], "row_id int, k string, disposition string")
    t = spark.createDataFrame([("a", "accepted"), ("b", "accepted"), ("b", "accepted_with_warning"), ("c", "accepted")], "id string, disposition string")
    spec = Q.Relationship("x", "s", "t", (("k", "id"),), "R")
    assert rows(Q.relationship_failures(s, t, spec)) == [(2,), (3,)]
    assert rows(Q.relationship_failures(s, t, Q.Relationship("x", "s", "t", (("k", "id"),), "R", optional=True))) == [(2,)]
    lists = spark.createDataFrame([(1, "a|b", "accepted"), (2, "a|", "accepted")], "row_id int, k string, disposition string")
    assert rows(Q.relationship_failures(lists, t, Q.Relationship("x", "s", "t", (("k", "id"),), "R", members="k"))) == [(1,)]


def test_gate(spark):
    df = spark.createDataFrame([(1, "a", 1)], "row_id int, source string, b int")
    counts = Q.disposition_counts(Q.classified(df, [Q.bounds("R", "b", low=0)]), "source")
    assert Q.gate(counts, spark.createDataFrame([], "rule string"))["publication_allowed"]
    assert not Q.gate(counts, spark.createDataFrame([("B",)], "rule string"))["publication_allowed"]


def test_pointer_swap_and_rollback(tmp_path):
    p = P.Pointer(str(tmp_path))
    passed = dict.fromkeys(P.REQUIRED_GATES, True)
    assert p.append_candidate("pub_one", "f1", passed) == "appended"
    assert p.append_candidate("pub_one", "f1", passed) == "no_op"
    with pytest.raises(P.Conflict):
        p.append_candidate("pub_one", "f2", passed)
    assert p.activate("pub_one", (None, 0)) == "active"
    p.append_candidate("pub_two", "f3", passed)
    with pytest.raises(P.Conflict):
        p.activate("pub_two", (None, 0))
    assert p.activate("pub_two", ("pub_one", 1)) == "active"
    p.append_candidate("pub_three", "f4", {**passed, "facts": False})
    assert p.activate("pub_three", ("pub_two", 2)) == "blocked"
    with pytest.raises(P.Conflict):
        p.rollback("pub_three", ("pub_two", 2))
    p.rollback("pub_one", ("pub_two", 2))
    assert p.read()["publication"] == "pub_one" and p.read()["revision"] == 3


def test_fingerprints():
    assert P.selection_fingerprint(["b", "a", "b"]) == hashlib.md5(b"validated-staging-v1\na\nb").hexdigest()
    with pytest.raises(ValueError):
        P.selection_fingerprint([])
    with pytest.raises(ValueError):
        P.build_fingerprint("Bad Id", "s", "c")


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", "a,b"), ("2", "")], "id string, name string")
    path = str(tmp_path / "x.csv")
    assert files.write_contract_csv(df, path, ["id", "name"]) == 2
    assert rows(files.read_contract_csv(spark, path, ["id", "name"])) == [("1", "a,b"), ("2", "")]
    with pytest.raises(files.DeliveryError):
        files.read_contract_csv(spark, path, ["id", "other"])
    data = (tmp_path / "x.csv").read_bytes()
    manifest = {"files": [{"path": "x.csv", "sha256": hashlib.sha256(data).hexdigest(), "rows": 2}]}
    files.verify_manifest(spark, str(tmp_path), manifest)
    manifest["files"][0]["rows"] = 3
    with pytest.raises(files.DeliveryError):
        files.verify_manifest(spark, str(tmp_path), manifest)


def test_split_and_replay(spark, tmp_path):
    df = spark.createDataFrame([(1, "", 5), (2, "x", -1), (3, "x", 1)], "row_id int, a string, b int")
    judged = Q.classified(df, [Q.required("R1", "a"), Q.bounds("R2", "b", low=0)])
    target = str(tmp_path / "out")
    files.split_by_disposition(judged, target)
    assert [spark.read.parquet(f"{target}/{n}").count() for n in ("validated", "quarantined", "rejected", "issues")] == [1, 1, 1, 2]
    with pytest.raises(FileExistsError):
        files.split_by_disposition(judged, target)
    loads = str(tmp_path / "loads")
    assert files.append_once(df, loads, "l1") == 3 and files.append_once(df, loads, "l1") == 0


def test_version_register(spark):
    known = spark.createDataFrame([("a", 1, "h1")], "k string, v int, h string")
    offered = spark.createDataFrame([("a", 1, "h1"), ("b", 1, "h2")], "k string, v int, h string")
    assert rows(files.register_versions(known, offered, ["k", "v"], "h")) == [("b", 1, "h2")]
    with pytest.raises(files.VersionCollision):
        files.register_versions(known, spark.createDataFrame([("a", 1, "other")], "k string, v int, h string"), ["k", "v"], "h")
