"""Envelopes, receipts, look-ups, closure, duplicates, coverage and replay on small tables; the sweep by brute force."""

import datetime
import hashlib
import itertools
import json
import random

import pytest

from marlstone.operators import joins
from marlstone.operators import registry as R

ENVELOPE = "source_record_id string, natural_key string, payload_sha256 string, disposition string, synthetic_only boolean, raw_payload map<string,string>, normalized_payload map<string,string>, issues array<string>, lineage map<string,string>"


def envelope(i, **over):
    raw = {"b": "2", "a": f"{i} é😀 \"\\uABCD\x7f\x1f\n/"}
    row = [f"r{i}", f"n{i}", hashlib.sha256(json.dumps(raw, sort_keys=True, separators=(",", ":")).encode()).hexdigest(), "accepted", True, raw, raw, [], {"batch_id": "B", "source_identity": "claims", "source_system": "S"}]
    names = [x.split()[0] for x in ENVELOPE.split(", ")]
    return tuple(over.get(n, v) for n, v in zip(names, row))


def test_envelopes(spark):
    rows = R.records_of(spark.createDataFrame([envelope(i) for i in range(3)], ENVELOPE), "claims", "B")
    assert [(r.source_record_id, r.source_system) for r in rows.orderBy("source_record_id").collect()] == [(f"r{i}", "S") for i in range(3)]
    for bad in ({"payload_sha256": "0" * 64}, {"disposition": "maybe"}, {"synthetic_only": False}, {"lineage": {"batch_id": "C"}}, {"issues": None}):
        with pytest.raises(Exception, match="contradicts its evidence"):
            R.records_of(spark.createDataFrame([envelope(1, **bad)], ENVELOPE), "claims", "B").collect()


def test_receipts_look_ups_and_replay(spark):
    known = spark.createDataFrame([("v1", "x", None), ("v2", "y", 2)], "validation_id string, sha string, n int")
    assert R.register_receipt(known, known.filter("validation_id = 'v1'"), "validation_id").count() == 0
    assert R.register_receipt(known, spark.createDataFrame([("v3", "x", 1)], known.schema), "validation_id").count() == 1
    with pytest.raises(R.RegistryError):
        R.register_receipt(known, spark.createDataFrame([("v1", "x", 1)], known.schema), "validation_id")
    assert R.look_up(known, validation_id="v2", n=2).sha == "y" and R.look_up(known, validation_id="v9") is None
    with pytest.raises(R.RegistryError):
        R.look_up(known.union(known), validation_id="v2")
    assert R.replay(None, {}) == "new" and R.replay(R.look_up(known, validation_id="v2"), {"sha": "y"}) == "duplicate_no_op"
    with pytest.raises(R.RegistryError):
        R.replay(R.look_up(known, validation_id="v2"), {"sha": "z"})
    sent = spark.createDataFrame([(2, "claims", "S", "h"), (1, "claims", "S", "h"), (0, "claims", "T", "h")], "seq int, source_identity string, source_system string, sha256 string")
    assert R.first_delivery(sent, "claims", "S", "h", "seq").seq == 1 and R.first_delivery(sent, "claims", "S", "q", "seq") is None


def test_runs_candidates_controls_and_events(spark, tmp_path):
    runs = spark.createDataFrame([("a", True, True, True, "approved", 3, 2), ("b", True, True, None, "approved", 1, 1), ("c", True, True, True, "held", 1, 1)], "validation_id string, synthetic_only boolean, publication_allowed boolean, reconciled boolean, decision string, accepted int, warned int")
    assert [(r.validation_id, r.expected_validated_record_count) for r in R.approved_runs(runs).collect()] == [("a", 5)] and R.approved_runs(runs, ["c"]).count() == 0
    assert R.as_candidate(runs, "p", "f").columns[-2:] == ["publication_id", "publication_selection_fingerprint"]
    assert R.candidate_name("fact", "p", "s", "b") == "fact__p__s__b" and R.candidate_name("fact", "p", "s", "b", scoped=False) == "fact"
    money = spark.createDataFrame([(0.1, None), (0.2, None)], "x double, y double")
    assert R.control_vector(money, "m", ["x", "y"]).collect()[0][1:] == (2, '{"x":"0.30","y":"0.00"}')
    assert R.control_vector(money.filter("false"), "m", ["x"]).collect()[0][1:] == (0, '{"x":"0.00"}')
    events = spark.createDataFrame([("e", datetime.datetime(2024, 1, 2, 3))], "id string, occurred_at timestamp")
    R.append_event(events, f"{tmp_path}/audit")
    R.append_event(events, f"{tmp_path}/audit")
    assert spark.read.parquet(f"{tmp_path}/audit").filter("event_date = '2024-01-02'").count() == 2
    R.materialise(money, "named_money", "view")
    assert spark.table("named_money").count() == 2


def test_closure_order_and_duplicates(spark):
    keys = lambda rows: spark.createDataFrame(rows, "relation string, key string")
    counts = spark.createDataFrame([("f", 2), ("g", 5)], "relation string, row_count long")
    gaps = {tuple(r) for r in R.closure_gaps(keys([("f", "1"), ("f", "2"), ("g", "1")]), keys([("f", "1"), ("f", "3"), ("g", "1")]), counts).collect()}
    assert gaps == {("f", "2", "not in inventory"), ("f", "3", "not resolved"), ("g", None, "count differs")}
    listed = spark.createDataFrame([(0, "f", "a"), (1, "f", "c"), (2, "f", "b"), (3, "e", "z")], "n int, relation string, key string")
    assert {r.n for r in R.out_of_order(listed, "n").collect()} == {2, 0} and R.out_of_order(listed.filter("n < 2"), "n").count() == 0
    rows = [("claims", "S", "1", "k", {}), ("claims", "S", "2", "k", {}), ("claim-lines", "S", "3", "l", {"claim_line_id": "x"}), ("claim-lines", "S", "4", "m", {"claim_line_id": "x"}), ("claim-lines", "T", "4", "o", {"claim_line_id": "x"})]
    rows += [("remittances", "S", str(5 + i), f"r{i}", {"source_control_number": "c", "payment_trace_number": t, "remittance_status": s}) for i, (t, s) in enumerate([("", "paid"), ("", "paid"), ("t", "reversed")])]
    records = spark.createDataFrame(rows, "source_identity string, source_system string, source_record_id string, natural_key string, normalized_payload map<string,string>")
    got = {(r.source_system, r.source_record_id): r.duplicate_kinds for r in R.duplicate_records(records).collect()}
    assert got == {("S", "1"): ["natural_key"], ("S", "2"): ["natural_key"], ("S", "3"): ["claim_line_id"], ("S", "4"): ["claim_line_id"], ("S", "5"): ["control_number"], ("S", "6"): ["control_number"]}


def test_coverage_and_configuration():
    assert R.rule_coverage({("a", "1"), ("a", "2")}, {"row": {("a", "1")}, "batch": {("a", "1"), ("a", "2")}}) == {"row": [("a", "1")], "batch": [("a", "2")]}
    for classes in ({"row": {("a", "1")}}, {"row": {("a", "1"), ("a", "2"), ("b", "1")}}):
        with pytest.raises(R.RegistryError):
            R.rule_coverage({("a", "1"), ("a", "2")}, classes)
    assert R.configuration_sha256({"p": b"1", "c": b"2"}) == R.configuration_sha256({"c": b"2", "p": b"1"}) != R.configuration_sha256({"p": b"2", "c": b"1"})


def test_overlaps_by_brute_force(spark):
    rng = random.Random(6)
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)
    rows = [(rng.randint(0, 3), k, *(None if rng.random() < 0.1 else day(rng.randint(0, 40)) for _ in range(2))) for k in range(80)]
    df = spark.createDataFrame(rows, "entity int, id int, valid_from date, valid_to date")
    end = lambda x: x or datetime.date(9999, 12, 31)
    want = {(a[0], a[1], b[1]) for a, b in itertools.combinations(rows, 2) if a[0] == b[0] and a[2] and b[2] and a[2] < end(b[3]) and b[2] < end(a[3])}
    assert {tuple(r) for r in joins.overlapping(df, ["entity"], "id").collect()} == want and want
