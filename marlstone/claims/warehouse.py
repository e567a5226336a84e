"""Typed staging, dimensions, facts, gates and metrics of the claims pack."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import joins as J
from ..operators.aggregates import ordered_values
from ..operators.quality import active
from ..operators.sets import date_spine, union_all
from ..operators.windows import latest
from ..plans import metrics as M
from .contracts import contracts

UNRESOLVED = "__unresolved_dimension__"
#: Dimensions with effective dates: source, namespace and business key.
EFFECTIVE = {
    "dim_payer": ("reference-data.payers", "payer", ("payer_id",)),
    "dim_plan": ("reference-data.plans", "plan", ("plan_id",)),
    "dim_provider": ("reference-data.providers", "provider", ("provider_id",)),
    "dim_facility": ("reference-data.facilities", "facility", ("facility_id",)),
    "dim_diagnosis": ("reference-data.diagnoses", "diagnosis", ("code_system", "diagnosis_code")),
    "dim_procedure": ("reference-data.procedures", "procedure", ("code_system", "procedure_code")),
    "dim_denial_reason": ("reference-data.denial-reasons", "denial_reason", ("denial_reason_code",)),
}
_LINEAGE = ["source_system", "row_id", "disposition"]


def stage(rows: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Accepted and warned rows with contract types, one frame for each source."""
    return {name: contracts()[name].typed(active(df), *_LINEAGE) for name, df in rows.items()}


def version_key(namespace: str, keys: tuple[str, ...], prefix: str = "") -> Column:
    return S.deterministic_key(f"{namespace}_version", **{k: F.col(f"{prefix}{k}") for k in (*keys, "valid_from")})


def _fact_key(kind: str, *columns: str) -> Column:
    return S.deterministic_key(kind, **{f"k{i}": F.col(c) for i, c in enumerate(columns)})


def dimensions(staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    dims = {name: staged[source].withColumns({f"{name[4:]}_version_id": version_key(namespace, keys), "is_current": F.col("valid_to").isNull()}) for name, (source, namespace, keys) in EFFECTIVE.items()}
    payer = dims["dim_payer"].select("source_system", "payer_id", "valid_from", "valid_to", "payer_version_id")
    on = (F.col("i.payer_id") == F.col("o.payer_id")) & (F.col("i.source_system") == F.col("o.source_system"))
    dims["dim_plan"] = J.within(dims["dim_plan"], payer, on, ("valid_from", "valid_to"), ("valid_from", "valid_to")).select("i.*", F.col("o.payer_version_id").alias("payer_version_id"))
    seen = staged["eligibility"].groupBy("source_system", "patient_id").agg(
        F.min("verification_at").alias("first_verified_at"), F.max("verification_at").alias("last_verified_at"), F.min("coverage_start_date").alias("first_coverage_start"), F.max("coverage_end_date").alias("last_coverage_end"), F.count("*").alias("eligibility_rows"),
        F.sort_array(F.collect_set("payer_id")).alias("payer_ids"), F.sort_array(F.collect_set("plan_id")).alias("plan_ids"), F.sort_array(F.collect_set("coverage_type")).alias("coverage_types"), F.bool_and("primary_coverage_flag").alias("always_primary"),
    )
    dims["dim_patient"] = seen.withColumn("patient_key", _fact_key("patient", "source_system", "patient_id"))
    days = [df.select(F.to_date(f.name).alias("day")) for name, df in staged.items() for f in contracts()[name].fields if f.kind in ("DATE", "TIMESTAMP")]
    dims["dim_date"] = date_spine(union_all(days), "day").select("full_date", *(c.alias(n) for n, c in S.calendar(F.col("full_date")).items()))
    return dims


def _versioned(facts: DataFrame, dims: dict[str, DataFrame], name: str, pairs: list[tuple[str, str]], day: str) -> DataFrame:
    """``facts`` with the version id of an effective dimension; entities are matched by id and date."""
    column = f"{name[4:]}_version_id"
    versions = dims[name].select(*(d for _, d in pairs), "valid_from", "valid_to", column)
    return J.asof_join(facts, versions, pairs, day).select("f.*", F.col(f"v.{column}").alias(column))


def _date_keys(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({f"{c.rsplit('_', 1)[0]}_date_key" if c.endswith("_at") else f"{c}_key": S.date_key(F.col(c)) for c in columns})


def facts(staged: dict[str, DataFrame], dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    claim = staged["claims"]
    for name, pairs in (("dim_provider", [("provider_id", "provider_id")]), ("dim_facility", [("facility_id", "facility_id")]), ("dim_payer", [("payer_id", "payer_id")]), ("dim_plan", [("plan_id", "plan_id")]), ("dim_diagnosis", [("primary_diagnosis_code", "diagnosis_code"), ("primary_diagnosis_code_system", "code_system")])):
        claim = _versioned(claim, dims, name, pairs, "service_from_date")
    patients = dims["dim_patient"].select(F.col("source_system").alias("eligibility_source_system"), "patient_id", "patient_key")
    pointer = ("original_claim_source_system", "original_claim_id", "original_submission_sequence")
    claim = claim.join(patients, ["eligibility_source_system", "patient_id"], "left").withColumns({"claim_key": _fact_key("claim", "source_system", "claim_id", "submission_sequence"), "original_claim_key": S.optional_key(_fact_key("claim", *pointer), *(F.col(c) for c in pointer))})
    claim = _date_keys(claim, "service_from_date", "service_to_date", "submitted_at", "adjudicated_at", "filing_deadline_date")

    claim_keys = claim.select(F.col("source_system").alias("c_system"), F.col("claim_id").alias("c_id"), F.col("submission_sequence").alias("c_seq"), "claim_key")
    of_claim = lambda df, system, seq: df.join(claim_keys, (F.col(system) == F.col("c_system")) & (F.col("claim_id") == F.col("c_id")) & (F.col(seq) == F.col("c_seq")), "left").drop("c_system", "c_id", "c_seq")
    line = of_claim(staged["claim-lines"], "source_system", "submission_sequence").withColumn("claim_line_key", _fact_key("claim_line", "source_system", "claim_id", "submission_sequence", "line_number"))
    line = _versioned(line, dims, "dim_procedure", [("procedure_code", "procedure_code"), ("procedure_code_system", "code_system")], "service_from_date")
    line = _versioned(line, dims, "dim_denial_reason", [("denial_reason_code", "denial_reason_code")], "service_from_date")
    codes = line.select("claim_line_key", "service_from_date", "diagnosis_code_system", F.posexplode("diagnosis_codes").alias("position", "code"))
    codes = _versioned(codes, dims, "dim_diagnosis", [("code", "diagnosis_code"), ("diagnosis_code_system", "code_system")], "service_from_date")
    line = line.join(codes.groupBy("claim_line_key").agg(ordered_values(F.col("position"), F.col("diagnosis_version_id"), UNRESOLVED).alias("diagnosis_version_ids")), "claim_line_key", "left")
    line = _date_keys(line, "service_from_date", "service_to_date")

    line_key = ("claim_source_system", "claim_id", "claim_submission_sequence", "claim_line_number")
    pointed = lambda kind, *c: S.optional_key(_fact_key(kind, *c), *(F.col(x) for x in c))
    payment = of_claim(staged["payments"], "claim_source_system", "claim_submission_sequence").withColumns({"payment_key": _fact_key("payment", "source_system", "payment_id"), "claim_line_key": pointed("claim_line", *line_key), "remittance_key": pointed("remittance", "remittance_source_system", "remittance_id"), "reversed_payment_key": pointed("payment", "reverses_payment_source_system", "reverses_payment_id"), "signed_amount": S.signed_amount(F.col("direction"), F.col("amount"))})
    payment = _date_keys(_versioned(payment, dims, "dim_payer", [("payer_id", "payer_id")], "payment_date"), "payment_date", "posted_at")
    denial = of_claim(staged["denials"], "claim_source_system", "claim_submission_sequence").withColumns({"denial_key": _fact_key("denial", "source_system", "denial_id"), "claim_line_key": pointed("claim_line", *line_key)})
    for name, pairs in (("dim_payer", [("payer_id", "payer_id")]), ("dim_denial_reason", [("denial_reason_code", "denial_reason_code")])):
        denial = _versioned(denial, dims, name, pairs, "denial_date")
    denial = _date_keys(denial, "denial_date", "filing_deadline_date", "appeal_deadline_date")
    appeal = of_claim(staged["appeals"], "claim_source_system", "claim_submission_sequence").withColumns({"appeal_key": _fact_key("appeal", "source_system", "appeal_id"), "denial_key": _fact_key("denial", "denial_source_system", "denial_id")})
    appeal = _date_keys(appeal, "created_at", "filed_at", "appeal_deadline_date", "decision_date")
    return {"fact_claim": claim, "fact_claim_line": line, "fact_payment": payment, "fact_denial": denial, "fact_appeal": appeal}


#: Foreign keys of the facts: column, the relation it points at, and the column there.
FOREIGN = [
    ("fact_claim", "provider_version_id", "dim_provider", "provider_version_id"), ("fact_claim", "facility_version_id", "dim_facility", "facility_version_id"), ("fact_claim", "payer_version_id", "dim_payer", "payer_version_id"), ("fact_claim", "plan_version_id", "dim_plan", "plan_version_id"), ("fact_claim", "patient_key", "dim_patient", "patient_key"), ("fact_claim", "service_from_date_key", "dim_date", "date_key"),
    ("fact_claim_line", "claim_key", "fact_claim", "claim_key"), ("fact_claim_line", "procedure_version_id", "dim_procedure", "procedure_version_id"), ("fact_payment", "claim_key", "fact_claim", "claim_key"), ("fact_denial", "claim_key", "fact_claim", "claim_key"), ("fact_denial", "denial_reason_version_id", "dim_denial_reason", "denial_reason_version_id"), ("fact_appeal", "denial_key", "fact_denial", "denial_key"), ("fact_appeal", "claim_key", "fact_claim", "claim_key"),
]


def gates(staged: dict[str, DataFrame], dims: dict[str, DataFrame], built: dict[str, DataFrame]) -> DataFrame:
    """(gate, detail) of everything that is wrong; no rows mean that all gates are passed."""
    relations, found = {**dims, **built}, []
    say = lambda df, gate, detail: df.select(F.lit(gate).alias("gate"), detail.cast("string").alias("detail"))
    for fact, column, target, key in FOREIGN:
        missing = built[fact].filter(F.col(column).isNull()) if fact != target else built[fact].filter("false")
        lost = J.orphans(built[fact].filter(F.col(column).isNotNull()).select(F.col(column).alias("_fk")), relations[target], [("_fk", key)])
        found += [say(missing, f"{fact}.{column} missing", F.col("row_id")), say(lost, f"{fact}.{column} unresolved", F.col("_fk"))]
    for source, fact in (("claims", "fact_claim"), ("claim-lines", "fact_claim_line"), ("payments", "fact_payment"), ("denials", "fact_denial"), ("appeals", "fact_appeal")):
        count = lambda df: df.groupBy("row_id").agg(F.count("*").alias("n"))
        found.append(say(J.reconcile(count(staged[source]), count(built[fact]), ["row_id"], ["n"]), f"{fact} rows", F.col("row_id")))
    measures = ["billed_amount", "payer_paid_amount", "patient_paid_amount", "adjustment_amount", "outstanding_balance"]
    rolled = built["fact_claim_line"].groupBy("claim_key").agg(*(F.sum(m).cast("decimal(38,2)").alias(m) for m in measures))
    header = built["fact_claim"].select("claim_key", *(F.col(m).cast("decimal(38,2)").alias(m) for m in measures))
    found.append(say(J.reconcile(header, rolled, ["claim_key"], measures), "line rollup", F.col("claim_key")))
    recovered = built["fact_appeal"].groupBy("denial_key").agg(F.sum("recovered_amount").alias("recovered")).join(built["fact_denial"], "denial_key").filter("recovered > denied_amount")
    found.append(say(recovered, "recovered above denied", F.col("denial_key")))
    for name, (_, _, keys) in EFFECTIVE.items():
        found.append(say(J.overlapping(dims[name], list(keys), f"{name[4:]}_version_id"), f"{name} overlap", F.col("left_id")))
    return union_all(found)


_ADJUDICATED = ["accepted", "denied", "partially_paid", "paid"]
_SUBMISSION = ["source_system", "claim_id", "submission_sequence"]


def _current(claims: DataFrame) -> DataFrame:
    live = claims.filter("claim_status <> 'rejected'")
    return M.current_rows(live, ["source_system", "claim_id"], [F.desc("submission_sequence"), F.desc("source_updated_at")], F.col("submission_type") == "void")


def metrics(built: dict[str, DataFrame], start: Column, end: Column, as_of: Column, published: str = "source_updated_at", cutoff: Column | None = None) -> dict[str, DataFrame]:
    """The eight governed metrics of one period, from the facts known at the cutoff."""
    known = {n: M.known_at(df, published, cutoff) if cutoff is not None else df for n, df in built.items()}
    newest = lambda df, key: latest(df, [key], F.desc("source_updated_at"))
    claims, denials, appeals = newest(known["fact_claim"], "claim_key"), newest(known["fact_denial"], "denial_key"), newest(known["fact_appeal"], "appeal_key")
    payments = newest(known["fact_payment"], "payment_key")
    denied = denials.select("claim_key").distinct()
    adjudicated = M.in_period(claims.filter(F.col("claim_status").isin(*_ADJUDICATED)), "adjudicated_at", start, end)
    originals = M.in_period(claims.filter("submission_sequence = 1"), "submitted_at", start, end)
    settled = originals.filter(F.col("claim_status").isin(*_ADJUDICATED))
    replaced = claims.filter("submission_sequence > 1").select("source_system", "claim_id").distinct()
    clean = settled.filter("clean_claim_flag AND first_pass_accepted_flag AND claim_status <> 'denied'").join(denied, "claim_key", "left_anti").join(replaced, ["source_system", "claim_id"], "left_anti")
    answered = originals.filter("first_response_at IS NOT NULL AND first_response_disposition IS NOT NULL")
    current = _current(claims)
    billed = originals_between(claims, as_of)
    decided = M.in_period(appeals.filter(F.col("outcome").isin("overturned", "partially_overturned", "upheld")), "decision_date", start.cast("date"), end.cast("date"))
    favourable = decided.filter("outcome <> 'upheld'")
    return {
        "denial_rate": M.share_with(adjudicated, ["claim_key"], denied),
        "clean_claim_rate": M.share_with(settled, ["claim_key"], clean),
        "first_pass_acceptance_rate": M.share_with(answered, ["claim_key"], answered.filter("first_pass_accepted_flag AND first_response_disposition = 'accepted'")),
        "days_in_ar": M.days_outstanding(M.sum_or_zero(current, F.col("outstanding_balance")), M.sum_or_zero(billed, F.col("billed_amount"))),
        "outstanding_balance": M.sum_or_zero(current, F.col("outstanding_balance")),
        "net_collection_rate": net_collection(M.in_period(current, "service_to_date", start.cast("date"), end.cast("date")), payments),
        "appeal_success_rate": M.share_with(decided, ["appeal_key"], favourable),
        "recovered_revenue": M.sum_or_zero(favourable, F.col("recovered_amount")),
    }


def originals_between(claims: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    """Current claims whose original was submitted on one of the ``days`` dates up to and with ``as_of``."""
    first = claims.filter("submission_sequence = 1").select("source_system", "claim_id", F.to_date("submitted_at").alias("first_submitted"))
    return _current(claims).join(first, ["source_system", "claim_id"]).filter((F.col("first_submitted") > F.date_sub(as_of, days)) & (F.col("first_submitted") <= as_of))


def net_collection(identities: DataFrame, payments: DataFrame) -> DataFrame:
    """Signed payer and patient payments over billed less contractual adjustments; a debit counts in the bucket of the
    payment that it undoes; identities whose base is not positive do not count."""
    undone = payments.select(F.col("payment_key").alias("reversed_payment_key"), F.col("transaction_type").alias("undone_type"))
    ledger = payments.join(undone, "reversed_payment_key", "left").withColumn("bucket", F.coalesce("undone_type", "transaction_type"))
    sums = ledger.groupBy(F.col("claim_source_system").alias("source_system"), "claim_id").agg(
        F.sum(F.when(F.col("bucket").isin("payer_payment", "patient_payment"), F.col("signed_amount"))).alias("collected"), F.sum(F.when(F.col("bucket") == "contractual_adjustment", F.col("signed_amount"))).alias("adjusted")
    )
    base = identities.join(sums, ["source_system", "claim_id"], "left").withColumn("base", F.col("billed_amount") - F.coalesce("adjusted", F.lit(0))).filter("base > 0")
    return base.agg(F.coalesce(F.sum("collected"), F.lit(0)).alias("n"), F.coalesce(F.sum("base"), F.lit(0)).alias("d")).select(*M.ratio(F.col("n"), F.col("d")))
