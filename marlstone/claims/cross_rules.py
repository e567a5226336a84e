"""Rules that look at other rows: versions of one reference, and rows against the one active row that they point at."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import typed
from ..operators.joins import unique_parents
from ..operators.quality import active, freshness
from .contracts import FRESHNESS, KEYS

#: (identity, rule, field, disposition, rows that break it: row_id)
Broken = tuple[str, str, str, str, DataFrame]
#: The rules below by the letters of their source; those of references hold for each of them.
ACROSS = ("CLM-011", "CLN-004", "ELG-004", "ELG-008", "DEN-005", "DEN-006", "APL-007", "APL-011", "REM-008", "REF-004", "REF-005", "REF-006")


def _day(name: str) -> Column:
    return typed(F.col(name), "DATE")


def _money(name: str) -> Column:
    return typed(F.col(name), "NUMERIC(18,2)")


def overlapping_versions(rows: DataFrame, entity: list[str], row_id: str = "row_id") -> DataFrame:
    """Rows whose interval meets that of another version of the entity: one sort by start, in which a row is held
    against the latest end before it and the next start, so that no pairs are formed. Two meet if each begins before the
    other ends. A null end is open."""
    end = F.coalesce(_day("valid_to"), F.lit("9999-12-31").cast("date"))
    spans = rows.select(row_id, *entity, _day("valid_from").alias("_from"), end.alias("_to")).filter("_from IS NOT NULL")
    sound, odd = spans.filter("_to > _from"), spans.filter("_to <= _from")
    order = Window.partitionBy(*entity).orderBy("_from", row_id)
    before, after = F.max("_to").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lead("_from").over(order)
    meeting = sound.withColumn("_meets", (F.coalesce(before, F.col("_from")) > F.col("_from")) | (F.coalesce(after, F.col("_to")) < F.col("_to"))).filter("_meets").select(row_id)
    # the few that end before they begin lie within another or meet nothing; two of them never meet
    within = odd.select(F.col(row_id).alias("_odd"), *entity, F.col("_from").alias("_a"), F.col("_to").alias("_b")).join(sound, entity).filter("_from < _b AND _a < _to")
    return meeting.unionByName(within.select(F.explode(F.array("_odd", row_id)).alias(row_id))).distinct()


def several_current(rows: DataFrame, entity: list[str], row_id: str = "row_id") -> DataFrame:
    """Rows that are one of several active open versions of an entity."""
    current = rows.filter((F.col("active_flag") == "true") & (F.coalesce("valid_to", F.lit("")) == ""))
    return current.withColumn("_n", F.count("*").over(Window.partitionBy(*entity))).filter("_n > 1").select(row_id)


def reference_rules(frames: dict[str, DataFrame]) -> Iterator[Broken]:
    for identity, rows in frames.items():
        if identity.startswith("reference-data."):
            entity = [k for k in KEYS[identity] if k not in ("source_system", "valid_from")]
            there = rows.filter("disposition <> 'rejected'")
            yield identity, "REF-004", "valid_from", "quarantined", overlapping_versions(there, entity)
            if "active_flag" in rows.columns:
                yield identity, "REF-005", "active_flag", "quarantined", several_current(there, entity)


def _pointing(rows: DataFrame, parents: DataFrame, keys: list[tuple[str, str]], columns: list[str]) -> DataFrame:
    """Active rows with the columns, as p_..., of the one active parent that they point at; others go."""
    named = active(parents).select(*(F.col(p).alias(f"pk_{i}") for i, (_, p) in enumerate(keys)), *(F.col(c).alias(f"p_{c}") for c in columns))
    one = unique_parents(named, [f"pk_{i}" for i in range(len(keys))], *(f"p_{c}" for c in columns))
    on = F.lit(True)
    for i, (child, _) in enumerate(keys):
        on = (F.col(child) == F.col(f"pk_{i}")) & on
    return active(rows).join(one, on)


def uncovered_plans(plans: DataFrame, payers: DataFrame) -> DataFrame:
    """Active plans whose whole validity does not lie within exactly one active version of their payer."""
    plan = active(plans).select("row_id", "payer_id", _day("valid_from").alias("_from"), _day("valid_to").alias("_to"))
    payer = active(payers).select(F.col("payer_id").alias("_payer"), _day("valid_from").alias("_begins"), _day("valid_to").alias("_ends"))
    holds = (F.col("payer_id") == F.col("_payer")) & (F.col("_begins") <= F.col("_from")) & (F.col("_ends").isNull() | (F.col("_to") <= F.col("_ends")))
    return plan.join(payer, holds, "left").groupBy("row_id").agg(F.count("_payer").alias("_n")).filter("_n <> 1").select("row_id")


def _differs(*names: str) -> Column:
    out = F.lit(False)
    for n in names:
        out = out | ~F.col(n).eqNullSafe(F.col(f"p_{n}"))
    return out


def parent_rules(frames: dict[str, DataFrame]) -> Iterator[Broken]:
    has = lambda *names: all(n in frames for n in names)
    claim_key = [("claim_source_system", "source_system"), ("claim_id", "claim_id"), ("claim_submission_sequence", "submission_sequence")]
    if has("claims", "eligibility"):
        cover = _pointing(frames["claims"], frames["eligibility"], [("eligibility_source_system", "source_system"), ("eligibility_id", "eligibility_id")], ["patient_id", "payer_id", "plan_id", "response_status", "coverage_status", "coverage_start_date", "coverage_end_date"])
        outside = (_day("service_from_date") < _day("p_coverage_start_date")) | ((_day("p_coverage_start_date") <= _day("service_from_date")) & (_day("service_to_date") >= _day("p_coverage_end_date")))
        wrong = _differs("patient_id", "payer_id", "plan_id") | ~F.col("p_response_status").eqNullSafe("confirmed") | ~F.col("p_coverage_status").eqNullSafe("active") | F.coalesce(outside, F.lit(False))
        yield "claims", "CLM-011", "eligibility_id", "quarantined", cover.filter(wrong).select("row_id")
    if has("claim-lines", "claims"):
        line = _pointing(frames["claim-lines"], frames["claims"], [("source_system", "source_system"), ("claim_id", "claim_id"), ("submission_sequence", "submission_sequence")], ["service_from_date", "service_to_date"])
        yield "claim-lines", "CLN-004", "service_from_date", "quarantined", line.filter((_day("service_from_date") < _day("p_service_from_date")) | (_day("service_to_date") > _day("p_service_to_date"))).select("row_id")
    if has("eligibility", "reference-data.plans"):
        plan = _pointing(frames["eligibility"], frames["reference-data.plans"], [("plan_id", "plan_id")], ["payer_id"])
        yield "eligibility", "ELG-004", "plan_id", "quarantined", plan.filter(_differs("payer_id")).select("row_id")
    if has("denials", "claims"):
        denial = _pointing(frames["denials"], frames["claims"], claim_key, ["outstanding_balance", "service_from_date", "submitted_at"])
        submitted = F.to_date(typed(F.col("p_submitted_at"), "TIMESTAMP"))
        early = F.coalesce(_day("denial_date") < _day("p_service_from_date"), F.lit(False)) | F.coalesce(_day("denial_date") < submitted, F.lit(False))
        yield "denials", "DEN-005", "denial_date", "quarantined", denial.filter(early).select("row_id")
        yield "denials", "DEN-006", "denied_amount", "quarantined", denial.filter(_money("denied_amount") > _money("p_outstanding_balance")).select("row_id")
    if has("appeals", "denials"):
        appeal = _pointing(frames["appeals"], frames["denials"], [("denial_source_system", "source_system"), ("denial_id", "denial_id")], ["appeal_deadline_date", "denied_amount"])
        yield "appeals", "APL-011", "appeal_deadline_date", "quarantined", appeal.filter(_differs("appeal_deadline_date")).select("row_id")
        yield "appeals", "APL-007", "requested_amount", "quarantined", appeal.filter(_money("requested_amount") > _money("p_denied_amount")).select("row_id")
    if has("reference-data.plans", "reference-data.payers"):
        yield "reference-data.plans", "REF-006", "payer_id", "quarantined", uncovered_plans(frames["reference-data.plans"], frames["reference-data.payers"])
    if has("remittances"):
        undoing = active(frames["remittances"]).filter("remittance_status = 'reversed'")
        undone = _pointing(undoing, frames["remittances"], [("reverses_remittance_source_system", "source_system"), ("reverses_remittance_id", "remittance_id")], ["row_id", "direction", "payer_id", "currency_code", "claim_transaction_count", "total_payment_amount"])
        offset = (F.col("p_row_id") != F.col("row_id")) & (F.col("p_direction") == "credit") & ~_differs("payer_id", "currency_code", "claim_transaction_count", "total_payment_amount")
        yield "remittances", "REM-008", "reverses_remittance_id", "quarantined", undoing.join(undone.filter(offset).select("row_id"), "row_id", "left_anti").select("row_id")


def unasked_eligibility(frames: dict[str, DataFrame]) -> Iterator[Broken]:
    """Unknown responses that no active claim refers to; only a warning, judged when all else is settled."""
    if "eligibility" in frames and "claims" in frames:
        unknown = active(frames["eligibility"]).filter("response_status = 'unknown' OR coverage_status = 'unknown'")
        claims = active(frames["claims"]).select(F.col("eligibility_source_system").alias("source_system"), "eligibility_id")
        yield "eligibility", "ELG-008", "coverage_status", "accepted_with_warning", unknown.join(claims, ["source_system", "eligibility_id"], "left_anti").select("row_id")


def batch_freshness(frames: dict[str, DataFrame], evaluated: Column, generated: Column | None = None) -> DataFrame | None:
    """(identity, age_seconds, late) of every source that has an event column, over all its rows. Late is a warning.
    A source without a readable event counts from when the batch was generated."""
    out = None
    for identity, (event, most) in FRESHNESS.items():
        if identity in frames:
            times = frames[identity].select(F.lit(identity).alias("identity"), typed(F.col(event), "TIMESTAMP").alias("event"))
            aged = freshness(times, "identity", "event", evaluated, most, evaluated if generated is None else generated)
            out = aged if out is None else out.unionByName(aged)
    return out
