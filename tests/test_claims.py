from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marlstone.claims import generator, rules, warehouse
from marlstone.claims.contracts import contracts
from marlstone.sources.files import shared_checkpoint

evaluated = lambda: F.lit("2026-08-16 00:30:00").cast("timestamp")


@pytest.fixture(scope="module")
def month(spark):
    return {n: shared_checkpoint(df) for n, df in generator.generate(spark, 42, 64, date(2026, 7, 1)).items()}


@pytest.fixture(scope="module")
def batch(month):
    return rules.evaluate(dict(month), evaluated(), shared_checkpoint)


@pytest.fixture(scope="module")
def model(batch):
    staged = warehouse.stage(batch["rows"])
    dims = {n: shared_checkpoint(df) for n, df in warehouse.dimensions(staged).items()}
    return staged, dims, {n: shared_checkpoint(df) for n, df in warehouse.facts(staged, dims).items()}


def test_contracts_are_whole():
    found = contracts()
    assert len(found) == 14 and sum(len(c.fields) for c in found.values()) == 202
    assert all(set(c.key) <= {"source_system", *c.columns} for c in found.values())


def test_generated_month_is_valid_and_repeats(spark, month, batch):
    bad = {n: df.filter("disposition <> 'accepted'").select("disposition", "issues").take(2) for n, df in batch["rows"].items()}
    assert {n: b for n, b in bad.items() if b} == {}
    assert batch["publication_allowed"] and batch["findings"].count() == 0
    again = generator.generate(spark, 42, 64, date(2026, 7, 1))
    assert all(again[n].exceptAll(df).count() == 0 for n, df in month.items())
    other = generator.generate(spark, 43, 64, date(2026, 7, 1))["claims"]
    assert other.join(month["claims"], "claim_id").count() == 0
    with pytest.raises(ValueError):
        generator.generate(spark, 1, 0, date(2026, 7, 1))


def change(df, key, value, **new):
    return df.withColumns({c: F.when(F.col(key) == value, F.lit(x)).otherwise(F.col(c)) for c, x in new.items()})


def test_rules_catch_mutations(month):
    ids = [r.claim_id for r in month["claims"].orderBy("claim_id").take(5)]
    frames = dict(month)
    claims = change(change(change(frames["claims"], "claim_id", ids[0], billed_amount="1.00"), "claim_id", ids[1], service_to_date="2026-06-01"), "claim_id", ids[2], payer_id="SYN-PAY-99")
    claims = change(claims, "claim_id", ids[3], submission_sequence="x").unionByName(claims.filter(F.col("claim_id") == ids[4]))
    frames["claims"] = claims
    result = rules.evaluate(frames, evaluated(), shared_checkpoint)
    got = {(r.claim_id, r.disposition): {i.rule_id for i in r.issues} for r in result["rows"]["claims"].collect()}
    assert "CLM-006" in got[ids[0], "quarantined"] and "CLM-003" in got[ids[1], "quarantined"] and "CLM-004" in got[ids[2], "quarantined"]
    assert "CMN-013" in got[ids[3], "rejected"] and "CLM-002" in got[ids[4], "rejected"] and (ids[4], "accepted") in got
    lines = {r.claim_id: r.disposition for r in result["rows"]["claim-lines"].collect()}
    assert all(lines[i] == "quarantined" for i in ids[:4]) and lines[ids[4]] == "accepted"  # orphans follow their claim
    assert not result["publication_allowed"] and result["reconciled"]
    assert {r.rule_id for r in result["findings"].collect()} >= {"CMN-016"}


def test_normalisation(spark):
    c = contracts()["reference-data.payers"]
    row = {n: "" for n in c.columns} | {"payer_id": " P ", "payer_type": "MediCare", "active_flag": "1"}
    got = c.normalised(spark.createDataFrame([tuple(row[n] for n in c.columns)], ", ".join(f"{n} string" for n in c.columns))).first()
    assert (got.payer_id, got.payer_type, got.active_flag) == ("P", "medicare", "true")


def test_missing_source_blocks(month):
    frames = {n: df for n, df in month.items() if n != "appeals"}
    result = rules.evaluate(frames, evaluated(), shared_checkpoint)
    assert ("REF-008", "appeals") in {tuple(r) for r in result["findings"].collect()}


def test_warehouse_passes_its_gates(batch, model):
    staged, dims, built = model
    assert [tuple(r) for r in warehouse.gates(staged, dims, built).collect()] == []
    for source, fact in (("claims", "fact_claim"), ("claim-lines", "fact_claim_line"), ("payments", "fact_payment"), ("denials", "fact_denial"), ("appeals", "fact_appeal")):
        assert built[fact].count() == staged[source].count()
    assert built["fact_claim"].filter("original_claim_key IS NOT NULL").count() == 0
    bounds = dims["dim_date"].agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()
    assert (bounds[1] - bounds[0]).days + 1 == bounds[2]


def test_gates_report_a_lost_line(model):
    staged, dims, built = model
    key = built["fact_claim_line"].first().claim_line_key
    broken = {**built, "fact_claim_line": built["fact_claim_line"].filter(F.col("claim_line_key") != key)}
    assert {r.gate for r in warehouse.gates(staged, dims, broken).collect()} == {"fact_claim_line rows", "line rollup"}


def test_metrics_are_the_plain_sums(model):
    _, _, built = model
    start, end = F.lit("2026-07-01").cast("timestamp"), F.lit("2026-09-01").cast("timestamp")
    got = {n: df.first().asDict() for n, df in warehouse.metrics(built, start, end, F.lit("2026-08-31").cast("date")).items()}
    claims, appeals, payments = built["fact_claim"].collect(), built["fact_appeal"].collect(), built["fact_payment"].collect()
    denied = sum(c.claim_status == "denied" for c in claims)
    assert (got["denial_rate"]["numerator"], got["denial_rate"]["denominator"]) == (denied, len(claims))
    assert got["denial_rate"]["display"] == round(Decimal(100 * denied) / len(claims), 2)
    assert got["clean_claim_rate"]["numerator"] == len(claims) - denied and got["first_pass_acceptance_rate"]["display"] == 100
    owed = sum(c.outstanding_balance for c in claims)
    assert got["outstanding_balance"]["amount"] == owed == got["days_in_ar"]["balance"]
    assert got["days_in_ar"]["days"] == round(owed * 90 / sum(c.billed_amount for c in claims), 6)
    cash = sum(p.amount for p in payments if p.transaction_type != "contractual_adjustment")
    assert got["net_collection_rate"]["numerator"] == cash
    won = [a for a in appeals if a.outcome == "overturned"]
    assert (got["appeal_success_rate"]["numerator"], got["appeal_success_rate"]["denominator"]) == (len(won), len(appeals))
    assert got["recovered_revenue"]["amount"] == sum(a.recovered_amount for a in won)
    empty = warehouse.metrics(built, end, end, F.lit("2020-01-01").cast("date"))
    assert empty["denial_rate"].first().status == "not_applicable" and empty["recovered_revenue"].first().amount == 0


def test_rules_across_rows(month):
    frames = dict(month)
    some = lambda n, key, k=3, where="true": [r[0] for r in frames[n].filter(where).orderBy(key).select(key).distinct().orderBy(key).take(k)]
    lines, denials, claims = some("claim-lines", "claim_line_id"), some("denials", "denial_id", 2), some("claims", "eligibility_id", 3)
    frames["claim-lines"] = change(change(frames["claim-lines"], "claim_line_id", lines[0], currency_code="EUR"), "claim_line_id", lines[1], service_from_date="2020-01-01")
    frames["denials"] = change(frames["denials"], "denial_id", denials[0], denied_amount="99999999.00")
    frames["eligibility"] = change(change(frames["eligibility"], "eligibility_id", claims[0], response_status="unknown"), "eligibility_id", claims[1], coverage_end_date="2020-06-01", coverage_start_date="2020-01-01")
    result = rules.evaluate(frames, evaluated(), shared_checkpoint)
    got = {n: {(r[key], i.rule_id) for r in result["rows"][n].collect() for i in r.issues} for n, key in (("claim-lines", "claim_line_id"), ("denials", "denial_id"), ("claims", "eligibility_id"), ("eligibility", "eligibility_id"))}
    assert (lines[0], "CLN-006") in got["claim-lines"] and (lines[0], "CLN-007") not in got["claim-lines"] and (denials[0], "DEN-006") in got["denials"]
    assert any(r == "CLM-011" for _, r in got["claims"])
    assert (claims[0], "ELG-008") in got["eligibility"]
    fresh = {r.identity: (r.age_seconds, r.late) for r in result["freshness"].collect()}
    assert set(fresh) == {"claims", "claim-lines", "eligibility", "remittances", "payments", "denials", "appeals"} and all(age >= 0 for age, _ in fresh.values())


def test_rules_of_reference_versions(month):
    payers = month["reference-data.payers"]
    first, second = (r[0] for r in payers.select("payer_id").distinct().orderBy("payer_id").take(2))
    again = payers.filter(F.col("payer_id") == first).limit(1).withColumn("valid_from", F.lit("2026-07-15"))
    result = rules.evaluate({"reference-data.payers": change(payers, "payer_id", second, historical_resolution_rate="1.5").unionByName(again)}, evaluated(), shared_checkpoint)
    got = {(r.payer_id, i.rule_id) for r in result["rows"]["reference-data.payers"].collect() for i in r.issues}
    assert got == {(first, "REF-004"), (first, "REF-005"), (second, "REF-007")} and result["freshness"] is None


def test_overlapping_versions_by_one_sort(spark):
    from marlstone.claims.cross_rules import overlapping_versions

    spans = [("a", 1, "2020-01-01", "2020-12-31"), ("a", 2, "2020-12-31", ""), ("b", 3, "2020-01-01", ""), ("b", 4, "2020-03-01", "2020-04-01"), ("b", 5, "2021-01-01", "2021-02-01"), ("c", 6, "2020-01-01", "2020-02-01"), ("c", 7, "2020-01-01", "2020-02-01"), ("d", 8, "", "")]
    df = spark.createDataFrame(spans, "e string, row_id int, valid_from string, valid_to string")
    assert {r[0] for r in overlapping_versions(df, ["e"]).collect()} == {3, 4, 5, 6, 7}


def test_every_governed_rule_is_executed_somewhere(spark, monkeypatch):
    from marlstone.claims import catalogue

    found = catalogue.execution_inventory()
    sizes = {c: len(p) for c, p in found.items()}
    assert sum(sizes.values()) == 131 == len({p for pairs in found.values() for p in pairs}) and all(sizes.values())
    assert (sizes["not_applicable"], sizes["boundary"], sizes["batch"], sizes["reverified"]) == (11, 1, 7, 49)
    assert ("claims", "CLM-004") in found["relationship"] and ("appeals", "APL-011") in found["semantic"] and ("appeals", "APL-010") in found["boundary"]
    for lost in ("claim_payer", "plan_payer", "remittance_reversed"):
        with pytest.raises(catalogue.CatalogueError):
            catalogue.execution_inventory([r for r in rules.RELATIONSHIPS if r.name != lost] if lost != "claim_payer" else [r for r in rules.RELATIONSHIPS if r.target != "reference-data.payers" or r.source != "claims"])
    for rule in ("DEN-005", "REF-006", "APL-011", "PAY-009"):
        kept = tuple(r for r in (*catalogue.ACROSS, *catalogue.SUMS) if r != rule)
        with monkeypatch.context() as m:
            m.setattr(catalogue, "ACROSS", kept), m.setattr(catalogue, "SUMS", ())
            built = rule in ("DEN-005", "REF-006")  # half of them are judged by the row or the relationship alone
            if not built:
                with pytest.raises(catalogue.CatalogueError):
                    catalogue.execution_inventory()
    with monkeypatch.context() as m:
        m.setattr(catalogue, "POLICY", catalogue.POLICY.replace("appeals claims APL-003\n", ""))
        with pytest.raises(catalogue.CatalogueError):
            catalogue.execution_inventory()


def issues_of(rows, key):
    return {(r[key], i.rule_id) for r in rows.select(key, "issues").collect() for i in r.issues}


def test_halves_of_row_rules(month):
    """Each rule half by a mutation of one row, under its own id."""
    first = lambda n, key: [r[0] for r in month[n].select(key).distinct().orderBy(key).take(2)]
    (denial, _), (remit, *_), (line, other) = first("denials", "denial_id"), first("remittances", "remittance_id"), first("claim-lines", "claim_line_id")
    judged = lambda n, df, key: issues_of(rules.classify(n, df, evaluated()), key)
    assert (denial, "DEN-007") in judged("denials", change(month["denials"], "denial_id", denial, appeal_deadline_date=""), "denial_id")
    assert judged("remittances", change(month["remittances"], "remittance_id", remit, remittance_date="2026-01-01"), "remittance_id") == {(remit, "REM-005")}
    lines = change(change(month["claim-lines"], "claim_line_id", line, place_of_service_code="x1"), "claim_line_id", other, revenue_code="12")
    assert judged("claim-lines", lines, "claim_line_id") == {(line, "CLN-005"), (other, "CLN-005")}


def test_halves_of_rules_across_rows(month):
    frames = dict(month)
    appeals = {r.appeal_id: r.denial_id for r in month["appeals"].orderBy("appeal_id").collect()}
    (late, _), (large, _) = list(appeals.items())[:2]
    early = next(r.denial_id for r in month["denials"].orderBy("denial_id").collect() if r.denial_id not in (appeals[late], appeals[large]))
    frames["denials"] = change(month["denials"], "denial_id", early, denial_date="2026-06-01")
    frames["appeals"] = change(change(month["appeals"], "appeal_id", late, appeal_deadline_date="2026-12-31"), "appeal_id", large, requested_amount="9999999.00")
    rows = rules.evaluate(frames, evaluated(), shared_checkpoint)["rows"]
    assert (early, "DEN-005") in issues_of(rows["denials"], "denial_id")
    got = issues_of(rows["appeals"], "appeal_id")
    assert (late, "APL-011") in got and (late, "APL-003") not in got and (large, "APL-007") in got
    assert {a for a, rule in got if rule == "APL-003"} == {a for a, d in appeals.items() if d == early}  # it goes with its denial


def test_plans_lie_within_one_version_of_their_payer(month):
    names = ("reference-data.payers", "reference-data.plans")
    payer = month[names[0]].orderBy("payer_id").first().payer_id
    frames = {names[0]: change(month[names[0]], "payer_id", payer, valid_to="2026-12-31"), names[1]: month[names[1]]}
    assert issues_of(rules.evaluate(frames, evaluated(), shared_checkpoint)["rows"][names[1]], "payer_id") == {(payer, "REF-006")}


def test_unknown_source_blocks(month):
    result = rules.evaluate({**month, "strays": month["appeals"]}, evaluated(), shared_checkpoint)
    assert ("REF-008", "strays") in {tuple(r) for r in result["findings"].collect()} and not result["publication_allowed"]
