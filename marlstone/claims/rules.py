"""Rules of the claims pack: row rules beyond the contracts, declared relationships, and the evaluation of a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import typed
from ..operators import quality as Q
from ..operators import windows as W
from ..operators.fixpoint import settle
from ..operators.sets import union_all
from .catalogue import execution_inventory
from .contracts import FRESHNESS, KEYS, contracts
from .cross_rules import batch_freshness, parent_rules, reference_rules, unasked_eligibility
from .ledger import applied_failures, reversal_failures

R = Q.Relationship


def row_rules(identity: str, evaluated: Column) -> list[Q.Rule]:
    kinds = {f.name: f.kind for f in contracts()[identity].fields}
    v = lambda name: typed(F.col(name), kinds[name])
    day = lambda name: F.to_date(v(name))
    has = lambda name: F.coalesce(F.col(name), F.lit("")) != ""
    bad = lambda rule, field, broken, how="quarantined": Q.Rule(rule, how, field, rule, broken)
    whole = lambda rule, fields: bad(rule, fields[0], Q.half_pointer(fields))
    near = lambda name: F.date_diff(v(name), F.to_date(evaluated)).between(0, 7)
    if identity == "claims":
        pointer = ["original_claim_source_system", "original_claim_id", "original_submission_sequence"]
        original = F.col("submission_type") == "original"
        return [
            bad("CLM-003", "service_to_date", (v("service_to_date") < v("service_from_date")) | (v("service_to_date") > day("submitted_at")) | (v("service_from_date") > day("submitted_at"))),
            bad("CLM-006", "billed_amount", v("billed_amount") != v("payer_paid_amount") + v("patient_paid_amount") + v("adjustment_amount") + v("outstanding_balance")),
            bad("CLM-007", "allowed_amount", v("payer_paid_amount") + v("patient_responsibility_amount") > v("allowed_amount")),
            bad("CLM-009", "filing_deadline_date", F.col("claim_status").isin("submitted", "accepted", "rejected", "denied") & ~has("filing_deadline_date")),
            whole("CLM-010", pointer),
            bad("CLM-010", "submission_type", original == has("original_claim_id")),
            bad("CLM-010", "original_submission_sequence", has("original_claim_id") & ((F.col("original_claim_source_system") != F.col("source_system")) | (F.col("original_claim_id") != F.col("claim_id")) | (v("original_submission_sequence") >= v("submission_sequence")))),
            bad("CLM-012", "patient_paid_amount", v("patient_paid_amount") > v("patient_responsibility_amount")),
            bad("CLM-013", "first_response_at", (has("first_response_at") != has("first_response_disposition")) | ((F.col("claim_status") != "submitted") & ~has("first_response_at"))),
            bad("CLM-014", "first_pass_accepted_flag", (v("first_pass_accepted_flag") != F.coalesce(F.col("first_response_disposition") == "accepted", F.lit(False))) | (v("first_response_at") < v("submitted_at")) | (v("first_response_at") > v("adjudicated_at"))),
        ]
    if identity == "claim-lines":
        return [
            bad("CLN-004", "service_to_date", v("service_to_date") < v("service_from_date")),
            bad("CLN-007", "billed_amount", v("billed_amount") != v("payer_paid_amount") + v("patient_paid_amount") + v("adjustment_amount") + v("outstanding_balance")),
            bad("CLN-008", "denial_reason_code", (F.col("line_status") == "denied") & ~has("denial_reason_code")),
            bad("CLN-009", "allowed_amount", v("payer_paid_amount") + v("patient_responsibility_amount") > v("allowed_amount")),
            bad("CLN-010", "patient_paid_amount", v("patient_paid_amount") > v("patient_responsibility_amount")),
        ]
    if identity == "eligibility":
        active = F.col("coverage_status") == "active"
        return [
            bad("ELG-005", "coverage_end_date", v("coverage_end_date") <= v("coverage_start_date")),
            bad("ELG-006", "coverage_status", active & (~has("coverage_start_date") | ~has("verification_at") | (day("verification_at") < v("coverage_start_date")) | F.coalesce(day("verification_at") >= v("coverage_end_date"), F.lit(False)))),
        ]
    if identity == "remittances":
        reversed_ = F.col("remittance_status") == "reversed"
        return [
            bad("REM-005", "remittance_date", (v("remittance_date") > day("received_at")) | (F.unix_timestamp(v("received_at")) - F.unix_timestamp(v("remittance_date").cast("timestamp")) > FRESHNESS["remittances"][1] + 86400)),
            bad("REM-007", "direction", F.col("direction") != F.when(reversed_, "debit").otherwise("credit")),
            bad("REM-008", "reverses_remittance_id", reversed_ != has("reverses_remittance_id")),
            whole("REM-009", ["reverses_remittance_source_system", "reverses_remittance_id"]),
        ]
    if identity == "payments":
        kind = F.col("transaction_type")
        undoing = kind.isin("refund", "reversal")
        return [
            bad("PAY-005", "payment_date", v("payment_date") > day("posted_at")),
            bad("PAY-006", "remittance_id", (kind == "payer_payment") & ~(has("remittance_source_system") & has("remittance_id") & has("payer_id"))),
            bad("PAY-007", "adjustment_reason_code", kind.isin("contractual_adjustment", "write_off") & ~has("adjustment_reason_code")),
            bad("PAY-008", "reverses_payment_id", undoing != has("reverses_payment_id")),
            bad("PAY-010", "posted_at", (F.col("source_system") == "synthetic_billing_spreadsheet") & (F.unix_timestamp(evaluated) - F.unix_timestamp(v("posted_at")) > 7200), "accepted_with_warning"),
            bad("PAY-011", "direction", F.col("direction") != F.when(undoing, "debit").otherwise("credit")),
            *(whole("PAY-012", list(pair)) for pair in (("remittance_source_system", "remittance_id"), ("claim_line_number", "claim_line_id"), ("reverses_payment_source_system", "reverses_payment_id"))),
        ]
    if identity == "denials":
        return [
            bad("DEN-005", "denial_date", v("denial_date") > day("received_at")),
            bad("DEN-007", "appeal_deadline_date", v("denial_date").isNotNull() & (v("filing_deadline_date").isNull() | v("appeal_deadline_date").isNull() | (v("filing_deadline_date") < v("denial_date")) | (v("appeal_deadline_date") < v("denial_date")))),
            bad("DEN-008", "documentation_ready_flag", v("documentation_ready_flag") & has("missing_document_codes")),
            bad("DEN-009", "appeal_deadline_date", (F.col("denial_status") == "open") & near("appeal_deadline_date"), "accepted_with_warning"),
            whole("DEN-010", ["claim_line_number", "claim_line_id"]),
        ]
    if identity == "appeals":
        decided, status = F.col("appeal_status").isin("overturned", "partially_overturned", "upheld"), F.col("appeal_status")
        return [
            bad("APL-004", "appeal_deadline_date", (status != "expired") & ((day("created_at") > v("appeal_deadline_date")) | F.coalesce(day("filed_at") > v("appeal_deadline_date"), F.lit(False)))),
            bad("APL-005", "filed_at", (decided | status.isin("filed", "pending")) & ~has("filed_at")),
            bad("APL-006", "decision_date", decided != (has("decision_date") & has("outcome"))),
            bad("APL-007", "recovered_amount", v("recovered_amount") > v("requested_amount")),
            bad("APL-008", "documentation_ready_flag", status.isin("ready_for_human_review", "filed") & ~v("documentation_ready_flag")),
            bad("APL-009", "appeal_deadline_date", ~has("filed_at") & (status != "expired") & near("appeal_deadline_date"), "accepted_with_warning"),
            bad("APL-012", "filed_at", (v("filed_at") < v("created_at")) | (v("decision_date") < day("created_at")) | (v("decision_date") < day("filed_at"))),
        ]
    return [bad("REF-003", "valid_to", v("valid_to") <= v("valid_from"))]


#: The declared relationships, targets before the sources that point at them.
RELATIONSHIPS = [
    R("plan_payer", "reference-data.plans", "reference-data.payers", (("payer_id", "payer_id"),), "REF-006", as_of="valid_from"),
    *(R(f"eligibility_{n}", "eligibility", f"reference-data.{n}s", ((f"{n}_id", f"{n}_id"),), "ELG-003", as_of="verification_at") for n in ("payer", "plan")),
    *(R(f"claim_{n}", "claims", f"reference-data.{t}", ((f"{n}_id", f"{n}_id"),), "CLM-004", as_of="service_from_date") for n, t in (("provider", "providers"), ("facility", "facilities"), ("payer", "payers"), ("plan", "plans"))),
    R("claim_diagnosis", "claims", "reference-data.diagnoses", (("primary_diagnosis_code", "diagnosis_code"), ("primary_diagnosis_code_system", "code_system")), "CLM-008", as_of="service_from_date"),
    R("claim_eligibility", "claims", "eligibility", (("eligibility_source_system", "source_system"), ("eligibility_id", "eligibility_id"), ("patient_id", "patient_id"), ("payer_id", "payer_id"), ("plan_id", "plan_id")), "CLM-011"),
    R("claim_original", "claims", "claims", (("original_claim_source_system", "source_system"), ("original_claim_id", "claim_id"), ("original_submission_sequence", "submission_sequence")), "CLM-010", optional=True),
    R("line_claim", "claim-lines", "claims", (("source_system", "source_system"), ("claim_id", "claim_id"), ("submission_sequence", "submission_sequence")), "CLN-003"),
    R("line_procedure", "claim-lines", "reference-data.procedures", (("procedure_code", "procedure_code"), ("procedure_code_system", "code_system")), "CLN-005", as_of="service_from_date"),
    R("line_diagnoses", "claim-lines", "reference-data.diagnoses", (("diagnosis_codes", "diagnosis_code"), ("diagnosis_code_system", "code_system")), "CLN-005", as_of="service_from_date", members="diagnosis_codes"),
    R("line_reason", "claim-lines", "reference-data.denial-reasons", (("denial_reason_code", "denial_reason_code"),), "CLN-005", optional=True, as_of="service_from_date"),
    R("remittance_payer", "remittances", "reference-data.payers", (("payer_id", "payer_id"),), "REM-003", as_of="remittance_date"),
    R("remittance_reversed", "remittances", "remittances", (("reverses_remittance_source_system", "source_system"), ("reverses_remittance_id", "remittance_id")), "REM-008", optional=True),
    *(R(f"{s}_claim", f"{s}s", "claims", (("claim_source_system", "source_system"), ("claim_id", "claim_id"), ("claim_submission_sequence", "submission_sequence")), rule) for s, rule in (("payment", "PAY-003"), ("denial", "DEN-003"))),
    *(R(f"{s}_line", f"{s}s", "claim-lines", (("claim_source_system", "source_system"), ("claim_id", "claim_id"), ("claim_submission_sequence", "submission_sequence"), ("claim_line_number", "line_number"), ("claim_line_id", "claim_line_id")), rule, optional=True) for s, rule in (("payment", "PAY-003"), ("denial", "DEN-003"))),
    R("payment_remittance", "payments", "remittances", (("remittance_source_system", "source_system"), ("remittance_id", "remittance_id")), "PAY-003", optional=True),
    R("payment_payer", "payments", "reference-data.payers", (("payer_id", "payer_id"),), "PAY-003", optional=True, as_of="payment_date"),
    R("payment_reversed", "payments", "payments", (("reverses_payment_source_system", "source_system"), ("reverses_payment_id", "payment_id")), "PAY-008", optional=True),
    R("denial_payer", "denials", "reference-data.payers", (("payer_id", "payer_id"),), "DEN-003", as_of="denial_date"),
    R("denial_reason", "denials", "reference-data.denial-reasons", (("denial_reason_code", "denial_reason_code"), ("denial_category", "denial_category")), "DEN-004", as_of="denial_date"),
    R("appeal_denial", "appeals", "denials", (("denial_source_system", "source_system"), ("denial_id", "denial_id"), ("claim_source_system", "claim_source_system"), ("claim_id", "claim_id"), ("claim_submission_sequence", "claim_submission_sequence")), "APL-003"),
    R("appeal_claim", "appeals", "claims", (("claim_source_system", "source_system"), ("claim_id", "claim_id"), ("claim_submission_sequence", "submission_sequence")), "APL-003"),
]


def classify(identity: str, rows: DataFrame, evaluated: Column) -> DataFrame:
    """Text rows with row_id, issues and disposition. Later repeats of a natural key are rejected; the key is taken
    from the rows as they came, before normalisation, in the order of the whole row."""
    contract = contracts()[identity]
    numbered = rows.withColumn("_copy", W.occurrence(list(KEYS[identity]), *(F.col(c) for c in contract.columns)))
    numbered = numbered.withColumn("row_id", F.sha2(F.to_json(F.array(F.lit(identity), *(F.col(k) for k in KEYS[identity]), F.col("_copy").cast("string"))), 256))
    repeated = Q.Rule(f"{contract.prefix}-002", "rejected", KEYS[identity][-1], "duplicate key", F.col("_copy") > 1)
    foreign = Q.Rule("CMN-001", "rejected", "source_system", "not synthetic", ~F.col("source_system").startswith("synthetic_"))
    judged = Q.classified(contract.normalised(numbered), [r.issue for r in (foreign, *contract.row_rules(), repeated, *row_rules(identity, evaluated))])
    return judged.drop("_copy")


def evaluate(frames: dict[str, DataFrame], evaluated: Column, keep) -> dict:
    """Rows, counts, findings and the gate of a batch of all fourteen sources. Rules and policy are bound before a row is read."""
    execution_inventory()
    absent = contracts().keys() - frames.keys()
    judged = {name: keep(classify(name, df, evaluated)) for name, df in frames.items() if name in contracts()}
    declared = [r for r in RELATIONSHIPS if r.source in judged and r.target in judged]
    judged, _ = marked(judged, reference_rules(judged), keep)
    judged = settle(judged, declared, keep)
    judged, lost = marked(judged, parent_rules(judged), keep)
    judged = settle(judged, declared, keep, lost)
    if {"payments", "claims", "claim-lines"} <= judged.keys():
        broken = [("payments", "PAY-008", "reverses_payment_id", "quarantined", reversal_failures(judged["payments"])), ("payments", "PAY-009", "amount", "quarantined", applied_failures(judged["payments"], judged["claims"], judged["claim-lines"]))]
        judged, lost = marked(judged, broken, keep)
        judged = settle(judged, declared, keep, lost)
    judged, _ = marked(judged, unasked_eligibility(judged), keep)
    every = union_all([df.select(F.lit(n).alias("identity"), "row_id", "issues", "disposition") for n, df in judged.items()])
    findings = every.filter("disposition = 'rejected'").select(F.lit("CMN-016").alias("rule_id"), "identity").distinct()
    if "remittances" in judged and "payments" in judged:
        findings = findings.unionByName(remittance_control(judged["remittances"], judged["payments"]).select(F.lit("REM-006").alias("rule_id"), F.lit("remittances").alias("identity")).distinct())
    for name in sorted(absent) + sorted(frames.keys() - contracts().keys()):
        findings = findings.unionByName(every.sparkSession.createDataFrame([("REF-008", name)], "rule_id string, identity string"))
    counts = Q.disposition_counts(every, "identity")
    return {"rows": judged, "counts": counts, "issues": Q.issue_distribution(every), "findings": findings, "freshness": batch_freshness(judged, evaluated), **Q.gate(counts, findings)}


def marked(judged: dict[str, DataFrame], broken, keep) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """``judged`` with an issue on the rows that each rule of ``broken`` found, all found before any is marked; and the rows of
    each source that were active and no longer are. One union and one join for each source."""
    by: dict[str, list[DataFrame]] = {}
    for place, (identity, rule, field, how, failed) in enumerate(broken):
        says = {"rule_id": rule, "disposition": how, "field": field, "reason": rule}
        by.setdefault(identity, []).append(failed.select("row_id", *(F.lit(v).alias(k) for k, v in says.items()), F.lit(place).alias("place")))
    after, lost = dict(judged), {}
    for identity, found in by.items():
        new = keep(union_all(found))
        if not new.isEmpty():
            blocked = new.filter(~F.col("disposition").isin(*Q.DISPOSITIONS[:2])).select("row_id").distinct()
            lost[identity] = Q.active(judged[identity]).select("row_id").join(blocked, "row_id", "left_semi")
            after[identity] = keep(Q.with_issues(judged[identity], new))
    return after, lost


def remittance_control(remittances: DataFrame, payments: DataFrame) -> DataFrame:
    """Active remittances whose payments do not add up to their count and amount."""
    money = lambda c: typed(F.col(c), "NUMERIC(18,2)")
    signed = F.when(F.col("direction") == "credit", money("amount")).otherwise(-money("amount"))
    paid = Q.active(payments).groupBy(F.col("remittance_source_system").alias("source_system"), "remittance_id").agg(F.count("*").alias("n"), F.sum(signed).alias("total"))
    declared = F.when(F.col("direction") == "credit", money("total_payment_amount")).otherwise(-money("total_payment_amount"))
    joined = Q.active(remittances).join(paid, ["source_system", "remittance_id"], "left")
    return joined.filter((F.coalesce("n", F.lit(0)) != typed(F.col("claim_transaction_count"), "INTEGER")) | (F.coalesce("total", F.lit(0)) != declared)).select("source_system", "remittance_id")
