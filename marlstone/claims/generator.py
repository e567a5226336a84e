"""A deterministic synthetic month of claims: fourteen text frames that satisfy every contract and relationship."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import stable_integer
from ..operators.windows import occurrence
from .contracts import contracts

#: Source system of each family, and rows of each reference.
SYSTEMS = {"claims": "synthetic_ehr", "claim-lines": "synthetic_ehr", "eligibility": "synthetic_patient_access", "remittances": "synthetic_payer_gateway", "payments": "synthetic_billing", "denials": "synthetic_payer_gateway", "appeals": "synthetic_denial_management"}
PAYERS, PROVIDERS, FACILITIES, CODES, REASONS, PER_REMITTANCE = 5, 25, 20, 8, 5, 25
MAX_CLAIMS = 100_000
COVERAGE = ["commercial", "medicare", "medicaid", "self_pay", "other"]


def generate(spark: SparkSession, seed: int, claim_count: int, month: date) -> dict[str, DataFrame]:
    if not 0 <= seed < 2**31 or not 1 <= claim_count <= MAX_CLAIMS or not 2000 <= month.year <= 9998 or month.day != 1:
        raise ValueError("seed, claim count or month out of bounds")
    start = F.lit(month.isoformat()).cast("date")
    following = (month + timedelta(days=32)).replace(day=1)
    updated = F.lit(f"{following.isoformat()}T00:00:00Z")
    draw = lambda low, high, name: stable_integer(low, high, F.lit(seed), F.lit(name), F.col("i"))
    ident = lambda kind, number: F.concat(F.lit(f"SYN-{kind}-"), F.lpad(number.cast("string"), 6, "0"))
    entity = lambda kind, number: F.concat(F.lit(f"SYN-{kind}-"), F.lpad(number.cast("string"), 2, "0"))
    instant = lambda day, hour: F.concat(day.cast("string"), F.lit(f"T{hour:02d}:00:00Z"))
    cents = lambda c: (c / 100).cast("decimal(18,2)").cast("string")
    own = lambda number: F.concat(F.lit("SYN-"), F.lit(f"{month:%Y%m}-{seed}-"), number.cast("string"))

    base = spark.range(1, claim_count + 1).withColumnRenamed("id", "i")
    base = base.withColumns({"payer": draw(1, PAYERS, "payer"), "day": F.date_add(start, draw(0, 24, "day").cast("int")), "billed": draw(10_000, 250_000, "billed"), "denied": draw(1, 8, "denied") == 1, "n_lines": draw(1, 3, "lines"), "diagnosis": draw(1, CODES, "diagnosis")})
    paid = F.when(F.col("denied"), 0).otherwise(F.expr("billed * 70 div 100"))
    patient = F.when(F.col("denied"), 0).otherwise(F.expr("billed * 10 div 100"))
    base = base.withColumns({"paid": paid, "patient": patient}).withColumn("adjusted", F.when(F.col("denied"), 0).otherwise(F.expr("billed - paid - patient"))).withColumn("outstanding", F.expr("billed - paid - patient - adjusted"))
    claim_id, system = own(F.col("i")), {k: F.lit(v) for k, v in SYSTEMS.items()}
    plan = entity("PLN", F.col("payer"))

    def amounts(part: Column | None = None, parts: Column | None = None) -> dict[str, Column]:
        """Cents as they are, or the part'th of ``parts`` shares: the first ones take the remainder."""
        split = lambda c: c if part is None else F.floor(c / parts) + F.when(part <= c % parts, 1).otherwise(0)
        money = {"payer_paid_amount": "paid", "patient_paid_amount": "patient", "patient_responsibility_amount": "patient", "adjustment_amount": "adjusted", "outstanding_balance": "outstanding"}
        out = {n: cents(split(F.col(c))) for n, c in money.items()}
        whole = split(F.col("paid")) + split(F.col("patient")) + split(F.col("adjusted")) + split(F.col("outstanding"))
        return out | {"billed_amount": cents(whole), "allowed_amount": cents(split(F.col("paid")) + split(F.col("patient")))}

    status = F.when(F.col("denied"), "denied").otherwise("paid")
    frames = {
        "claims": base.select(system["claims"].alias("source_system"), claim_id.alias("claim_id"), F.lit("1").alias("submission_sequence"), ident("PAT", draw(1, claim_count, "patient")).alias("patient_id"), system["eligibility"].alias("eligibility_source_system"), claim_id.alias("eligibility_id"), entity("PRV", draw(1, PROVIDERS, "provider")).alias("provider_id"), entity("FAC", draw(1, FACILITIES, "facility")).alias("facility_id"), entity("PAY", F.col("payer")).alias("payer_id"), plan.alias("plan_id"), F.lit("professional").alias("claim_type"), status.alias("claim_status"), F.lit("original").alias("submission_type"), F.col("day").cast("string").alias("service_from_date"), F.col("day").cast("string").alias("service_to_date"), instant(F.date_add("day", 1), 9).alias("submitted_at"), instant(F.date_add("day", 2), 9).alias("first_response_at"), F.lit("accepted").alias("first_response_disposition"), instant(F.date_add("day", 4), 9).alias("adjudicated_at"), entity("DX", F.col("diagnosis")).alias("primary_diagnosis_code"), F.lit("SYNTHETIC").alias("primary_diagnosis_code_system"), *(c.alias(n) for n, c in amounts().items()), F.lit("USD").alias("currency_code"), F.lit("true").alias("clean_claim_flag"), F.lit("true").alias("first_pass_accepted_flag"), F.date_add("day", 90).cast("string").alias("filing_deadline_date"), updated.alias("source_updated_at")),
        "eligibility": base.select(system["eligibility"].alias("source_system"), claim_id.alias("eligibility_id"), ident("PAT", draw(1, claim_count, "patient")).alias("patient_id"), entity("PAY", F.col("payer")).alias("payer_id"), plan.alias("plan_id"), own(F.col("i")).alias("member_reference"), instant(F.col("day"), 7).alias("verification_at"), F.lit("confirmed").alias("response_status"), F.lit("active").alias("coverage_status"), F.element_at(F.array(*map(F.lit, COVERAGE)), F.col("payer").cast("int")).alias("coverage_type"), F.date_sub(start, 200).cast("string").alias("coverage_start_date"), F.date_add(start, 200).cast("string").alias("coverage_end_date"), F.lit("true").alias("primary_coverage_flag"), F.lit("USD").alias("currency_code"), updated.alias("source_updated_at")),
    }
    lines = base.select("*", F.explode(F.sequence(F.lit(1), F.col("n_lines").cast("int"))).alias("line"))
    frames["claim-lines"] = lines.select(system["claim-lines"].alias("source_system"), claim_id.alias("claim_id"), F.lit("1").alias("submission_sequence"), F.col("line").cast("string").alias("line_number"), F.concat_ws("-", claim_id, F.col("line").cast("string")).alias("claim_line_id"), F.col("day").cast("string").alias("service_from_date"), F.col("day").cast("string").alias("service_to_date"), entity("PR", draw(1, CODES, "procedure")).alias("procedure_code"), F.lit("SYNTHETIC").alias("procedure_code_system"), entity("DX", F.col("diagnosis")).alias("diagnosis_codes"), F.lit("SYNTHETIC").alias("diagnosis_code_system"), F.lit("11").alias("place_of_service_code"), F.lit("1.0000").alias("units"), status.alias("line_status"), F.when(F.col("denied"), entity("RSN", F.col("i") % REASONS + 1)).alias("denial_reason_code"), *(c.alias(n) for n, c in amounts(F.col("line"), F.col("n_lines")).items()), F.lit("USD").alias("currency_code"), updated.alias("source_updated_at"))

    # paid claims are grouped into remittances of a payer by their position
    settled = base.filter("NOT denied").withColumn("position", occurrence(["payer"], F.col("i")))
    settled = settled.withColumn("remittance", own(F.concat_ws("-", F.col("payer"), F.ceil(F.col("position") / PER_REMITTANCE))))
    posted_day = F.date_add(start, 30)
    kinds = {"payer_payment": ("paid", "credit"), "patient_payment": ("patient", "credit"), "contractual_adjustment": ("adjusted", "credit")}
    payments = []
    for kind, (amount, direction) in kinds.items():
        by_payer = F.lit(kind == "payer_payment")
        payments.append(settled.filter(F.col(amount) > 0).select(system["payments"].alias("source_system"), F.concat_ws("-", claim_id, F.lit(kind)).alias("payment_id"), F.when(by_payer, system["remittances"]).alias("remittance_source_system"), F.when(by_payer, F.col("remittance")).alias("remittance_id"), system["claims"].alias("claim_source_system"), claim_id.alias("claim_id"), F.lit("1").alias("claim_submission_sequence"), F.when(by_payer, entity("PAY", F.col("payer"))).alias("payer_id"), F.lit(kind).alias("transaction_type"), F.lit(direction).alias("direction"), cents(F.col(amount)).alias("amount"), F.lit("USD").alias("currency_code"), posted_day.cast("string").alias("payment_date"), instant(posted_day, 8).alias("posted_at"), F.when(F.lit(kind == "contractual_adjustment"), "CO-45").alias("adjustment_reason_code"), F.lit("posted").alias("posting_status"), updated.alias("source_updated_at")))
    frames["payments"] = payments[0].unionByName(payments[1]).unionByName(payments[2])
    totals = settled.filter("paid > 0").groupBy("payer", "remittance").agg(F.sum("paid").alias("total"), F.count("*").alias("n"))
    frames["remittances"] = totals.select(system["remittances"].alias("source_system"), F.col("remittance").alias("remittance_id"), entity("PAY", F.col("payer")).alias("payer_id"), F.concat(F.col("remittance"), F.lit("-C")).alias("source_control_number"), F.concat(F.col("remittance"), F.lit("-T")).alias("payment_trace_number"), F.lit("eft").alias("payment_method"), F.lit("credit").alias("direction"), F.date_add(start, 29).cast("string").alias("remittance_date"), instant(F.date_add(start, 29), 12).alias("received_at"), cents(F.col("total")).alias("total_payment_amount"), F.col("n").cast("string").alias("claim_transaction_count"), F.lit("USD").alias("currency_code"), F.lit("posted").alias("remittance_status"), updated.alias("source_updated_at"))

    reason, denial_day = F.col("i") % REASONS + 1, F.date_add("day", 4)
    refused = base.filter("denied").withColumn("number", occurrence([], F.col("i")))  # one window over MAX_CLAIMS rows at most
    frames["denials"] = refused.select(system["denials"].alias("source_system"), claim_id.alias("denial_id"), system["claims"].alias("claim_source_system"), claim_id.alias("claim_id"), F.lit("1").alias("claim_submission_sequence"), entity("PAY", F.col("payer")).alias("payer_id"), entity("RSN", reason).alias("denial_reason_code"), F.concat(F.lit("category "), reason.cast("string")).alias("denial_category"), denial_day.cast("string").alias("denial_date"), instant(denial_day, 12).alias("received_at"), cents(F.col("outstanding")).alias("denied_amount"), F.lit("USD").alias("currency_code"), F.date_add(denial_day, 60).cast("string").alias("filing_deadline_date"), F.date_add(denial_day, 60).cast("string").alias("appeal_deadline_date"), F.lit("open").alias("denial_status"), F.lit("false").alias("preventable_flag"), F.lit("true").alias("documentation_ready_flag"), updated.alias("source_updated_at"))
    won = F.col("number") % 4 == 1
    frames["appeals"] = refused.filter("number % 2 = 1").select(system["appeals"].alias("source_system"), claim_id.alias("appeal_id"), system["denials"].alias("denial_source_system"), claim_id.alias("denial_id"), system["claims"].alias("claim_source_system"), claim_id.alias("claim_id"), F.lit("1").alias("claim_submission_sequence"), F.lit("1").alias("appeal_level"), F.when(won, "overturned").otherwise("upheld").alias("appeal_status"), instant(F.date_add(denial_day, 1), 9).alias("created_at"), instant(F.date_add(denial_day, 2), 9).alias("filed_at"), F.date_add(denial_day, 60).cast("string").alias("appeal_deadline_date"), F.date_add(denial_day, 20).cast("string").alias("decision_date"), F.when(won, "overturned").otherwise("upheld").alias("outcome"), cents(F.col("outstanding")).alias("requested_amount"), F.when(won, cents(F.col("outstanding"))).otherwise("0.00").alias("recovered_amount"), F.lit("USD").alias("currency_code"), F.lit("true").alias("documentation_ready_flag"), F.lit("synthetic appeals").alias("owner_queue"), updated.alias("source_updated_at"))

    valid = [F.lit(f"{month.year - 1}-01-01").alias("valid_from"), F.lit("true").alias("active_flag")]
    numbers = lambda n: spark.range(1, n + 1).withColumnRenamed("id", "i")
    i = F.col("i")
    coverage = F.element_at(F.array(*map(F.lit, COVERAGE)), i.cast("int"))
    named = lambda kind: F.concat(F.lit(f"Synthetic {kind} "), i.cast("string"))
    frames["reference-data.payers"] = numbers(PAYERS).select(entity("PAY", i).alias("payer_id"), named("payer").alias("payer_name"), coverage.alias("payer_type"), F.lit("90").alias("timely_filing_days"), F.lit("60").alias("appeal_window_days"), F.lit("14").alias("expected_response_days"), F.lit("0.5000").alias("historical_resolution_rate"), *valid)
    frames["reference-data.plans"] = numbers(PAYERS).select(entity("PLN", i).alias("plan_id"), entity("PAY", i).alias("payer_id"), named("plan").alias("plan_name"), coverage.alias("coverage_type"), *valid)
    frames["reference-data.providers"] = numbers(PROVIDERS).select(entity("PRV", i).alias("provider_id"), named("provider").alias("provider_name"), F.lit("SYN-GEN").alias("specialty_code"), *valid)
    frames["reference-data.facilities"] = numbers(FACILITIES).select(entity("FAC", i).alias("facility_id"), named("facility").alias("facility_name"), i.cast("string").alias("clinic_number"), F.lit("synthetic region").alias("region"), *valid)
    for name, kind in (("diagnoses", "DX"), ("procedures", "PR")):
        one = {"diagnoses": "diagnosis", "procedures": "procedure"}[name]
        frames[f"reference-data.{name}"] = numbers(CODES).select(entity(kind, i).alias(f"{one}_code"), F.lit("SYNTHETIC").alias("code_system"), named(one).alias(f"{one}_description"), *valid)
    frames["reference-data.denial-reasons"] = numbers(REASONS).select(entity("RSN", i).alias("denial_reason_code"), F.concat(F.lit("category "), i.cast("string")).alias("denial_category"), named("reason").alias("denial_reason_description"), F.lit("false").alias("preventable_default_flag"), F.lit("0.4000").alias("historical_resolution_rate"), *valid)
    return {name: _whole(frames[name], c) for name, c in contracts().items()}


def _whole(df: DataFrame, contract) -> DataFrame:
    """Contract columns in order, absent ones blank, with the source system in front."""
    have = set(df.columns)
    system = F.col("source_system") if "source_system" in have else F.lit("synthetic_reference")
    return df.select(system.alias("source_system"), *((F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("")).alias(c) for c in contract.columns))
