"""Rules over several payments, and corrections of delivered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import typed
from ..operators.joins import unique_parents
from ..operators.quality import active
from .contracts import KEYS, contracts

#: Amount of the claim or line that each kind of transaction may use up.
ELIGIBLE = {"payer_payment": "payer_paid_amount", "patient_payment": "patient_paid_amount", "contractual_adjustment": "adjustment_amount", "write_off": "adjustment_amount"}


def _money(name: str) -> Column:
    return typed(F.col(name), "NUMERIC(18,2)")


def applied_failures(payments: DataFrame, claims: DataFrame, lines: DataFrame) -> DataFrame:
    """(row_id) of active payments whose claim or line has no eligible amount, or one that the signed total of the
    category leaves behind or goes below zero. A debit counts in the category of the payment that it undoes."""
    paid = active(payments)
    undone = unique_parents(paid.select(F.col("source_system").alias("_us"), F.col("payment_id").alias("_up"), F.col("transaction_type").alias("_ut")), ["_us", "_up"], "_ut")
    linked = paid.join(undone, (F.col("reverses_payment_source_system") == F.col("_us")) & (F.col("reverses_payment_id") == F.col("_up")), "left")
    kind = F.when(F.col("direction") == "debit", F.col("_ut")).otherwise(F.col("transaction_type"))
    category = F.coalesce(*(F.when(kind == k, v) for k, v in ELIGIBLE.items()))
    target = ["claim_source_system", "claim_id", "claim_submission_sequence", "claim_line_number"]
    ledger = linked.select("row_id", *target, category.alias("category"), F.when(F.col("direction") == "credit", _money("amount")).otherwise(-_money("amount")).alias("signed")).filter("category IS NOT NULL AND signed IS NOT NULL")
    totals = ledger.groupBy(*target, "category").agg(F.sum("signed").alias("applied"))

    def parents(rows: DataFrame, line: Column) -> DataFrame:
        keyed = active(rows).select(F.col("source_system").alias("claim_source_system"), "claim_id", F.col("submission_sequence").alias("claim_submission_sequence"), line.alias("claim_line_number"), *sorted(set(ELIGIBLE.values())))
        return unique_parents(keyed, target, *sorted(set(ELIGIBLE.values())))

    amounts = parents(claims, F.lit("")).unionByName(parents(lines, F.col("line_number")))
    eligible = F.coalesce(*(F.when(F.col("category") == c, _money(c)) for c in sorted(set(ELIGIBLE.values()))))
    judged = totals.join(amounts, target, "left").withColumn("eligible", eligible)
    failed = judged.filter("eligible IS NULL OR applied < 0 OR applied > eligible").select(*target, "category")
    return ledger.join(failed, [*target, "category"], "left_semi").select("row_id").distinct()


def reversal_failures(payments: DataFrame) -> DataFrame:
    """(row_id) of active refunds and reversals that do not undo one credit on the same target, other than themselves,
    or that together undo more than there was."""
    same = ["claim_source_system", "claim_id", "claim_submission_sequence", "claim_line_number", "payer_id"]
    paid = active(payments)
    child = paid.filter(F.col("transaction_type").isin("refund", "reversal")).select("row_id", F.col("reverses_payment_source_system").alias("_s"), F.col("reverses_payment_id").alias("_p"), *same, _money("amount").alias("amount"))
    parent = unique_parents(paid.select(F.col("source_system").alias("_s"), F.col("payment_id").alias("_p"), F.col("row_id").alias("_row"), "direction", "transaction_type", _money("amount").alias("_amount"), *(F.col(c).alias(f"_{c}") for c in same)), ["_s", "_p"], "_row", "direction", "transaction_type", "_amount", *(f"_{c}" for c in same))
    joined = child.join(parent, ["_s", "_p"], "left")
    fits = (F.col("direction") == "credit") & ~F.col("transaction_type").isin("refund", "reversal") & (F.col("_row") != F.col("row_id"))
    for c in same:
        fits = fits & (F.col(c) == F.col(f"_{c}"))
    judged = joined.withColumn("fits", F.coalesce(fits, F.lit(False)))
    over = judged.groupBy("_s", "_p").agg(F.sum("amount").alias("undone"), F.max("_amount").alias("there")).filter("undone > there").select("_s", "_p")
    return judged.filter("NOT fits").select("row_id").unionByName(judged.join(over, ["_s", "_p"], "left_semi").select("row_id")).distinct()


def payload_hash(identity: str) -> Column:
    """sha256 of a delivered row as JSON, fields in contract order."""
    return F.sha2(F.to_json(F.struct(*contracts()[identity].columns)), 256)


def corrected(identity: str, rows: DataFrame, corrections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with corrections (natural key columns, expected_sha256, changes: map of field to text, correction_id) put in,
    and their history (correction_id, state, before, after). A correction only takes effect on the one row of its key
    with the expected content; others are reported as stale or unknown."""
    contract, keys = contracts()[identity], list(KEYS[identity])
    if unknown := set(contract.key) - set(rows.columns):
        raise ValueError(f"no key columns {sorted(unknown)}")
    named = corrections.select(*(F.col(k).alias(f"_{k}") for k in keys), "expected_sha256", "changes", "correction_id")
    on = [F.col(k) == F.col(f"_{k}") for k in keys]
    hashed = rows.withColumn("_before", payload_hash(identity))
    joined = hashed.join(named, on, "left")
    holds = F.coalesce(F.col("expected_sha256") == F.col("_before"), F.lit(False))
    fixed = joined.select("source_system", *(F.when(holds, F.coalesce(F.element_at("changes", c), F.col(c))).otherwise(F.col(c)).alias(c) for c in contract.columns), "_before", "correction_id", holds.alias("_holds"))
    fixed = fixed.withColumn("_after", payload_hash(identity))
    history = fixed.filter("correction_id IS NOT NULL").select("correction_id", F.when(F.col("_holds"), "applied").otherwise("stale").alias("state"), F.col("_before").alias("before"), F.col("_after").alias("after"))
    lost = named.join(rows, on, "left_anti").select("correction_id", F.lit("unknown").alias("state"), F.lit(None).cast("string").alias("before"), F.lit(None).cast("string").alias("after"))
    return fixed.select(rows.columns), history.unionByName(lost)
