from pyspark.sql import functions as F

from marlstone.claims import ledger
from marlstone.claims.contracts import contracts
from marlstone.sources import files
from marlstone.streaming import windows


def text_rows(spark, identity, rows):
    columns = ["row_id", "disposition", "source_system", *contracts()[identity].columns]
    return spark.createDataFrame([tuple({"disposition": "accepted", "source_system": "s", **r}.get(c, "") for c in columns) for r in rows], ", ".join(f"`{c}` string" for c in columns))


def payment(i, kind, direction, amount, **more):
    return {"row_id": i, "payment_id": i, "claim_source_system": "s", "claim_id": "c", "claim_submission_sequence": "1", "transaction_type": kind, "direction": direction, "amount": amount, **more}


def claims(spark):
    return text_rows(spark, "claims", [{"row_id": "c", "claim_id": "c", "submission_sequence": "1", "payer_paid_amount": "70.00", "patient_paid_amount": "10.00", "adjustment_amount": "20.00"}])


def ids(df):
    return {r.row_id for r in df.collect()}


def test_applied_totals(spark):
    lines = text_rows(spark, "claim-lines", [])
    undo = {"reverses_payment_source_system": "s", "reverses_payment_id": "p1"}
    fine = [payment("p1", "payer_payment", "credit", "75.00"), payment("p2", "reversal", "debit", "5.00", **undo), payment("p3", "patient_payment", "credit", "10.00")]
    assert ids(ledger.applied_failures(text_rows(spark, "payments", fine), claims(spark), lines)) == set()
    assert ids(ledger.reversal_failures(text_rows(spark, "payments", fine))) == set()
    over = [*fine, payment("p4", "patient_payment", "credit", "0.01"), payment("p5", "write_off", "credit", "1.00", claim_id="other")]
    assert ids(ledger.applied_failures(text_rows(spark, "payments", over), claims(spark), lines)) == {"p3", "p4", "p5"}
    bad = [*fine, payment("p6", "refund", "debit", "71.00", **undo), payment("p7", "refund", "debit", "1.00", reverses_payment_source_system="s", reverses_payment_id="none")]
    assert ids(ledger.reversal_failures(text_rows(spark, "payments", bad))) == {"p2", "p6", "p7"}


def test_corrections_need_the_expected_content(spark):
    rows = text_rows(spark, "claims", [{"claim_id": k, "submission_sequence": "1", "billed_amount": "1.00"} for k in "abc"]).drop("row_id", "disposition")
    sha = {r.claim_id: r.h for r in rows.select("claim_id", ledger.payload_hash("claims").alias("h")).collect()}
    given = [("s", "a", "1", sha["a"], {"billed_amount": "2.00"}, "k1"), ("s", "b", "1", sha["a"], {"billed_amount": "2.00"}, "k2"), ("s", "z", "1", sha["a"], {}, "k3")]
    corrections = spark.createDataFrame(given, "source_system string, claim_id string, submission_sequence string, expected_sha256 string, changes map<string,string>, correction_id string")
    fixed, history = ledger.corrected("claims", rows, corrections)
    assert {r.claim_id: r.billed_amount for r in fixed.collect()} == {"a": "2.00", "b": "1.00", "c": "1.00"} and fixed.columns == rows.columns
    assert {r.correction_id: r.state for r in history.collect()} == {"k1": "applied", "k2": "stale", "k3": "unknown"}
    assert all((r.before != r.after) == (r.state == "applied") for r in history.filter("state <> 'unknown'").collect())


def test_recovery(tmp_path):
    target = str(tmp_path / "out")
    (tmp_path / "out.staging-1").mkdir()
    assert files.recover_folder(target) == "discarded" and files.recover_folder(target) == "absent"
    (tmp_path / "out").mkdir()
    assert files.recover_folder(target) == "complete"


def test_streaming_windows_equal_the_batch(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{source}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(source)
    run = windows.evaluation_windows(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "value", "event_type").writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    want = events.withColumn("ts", F.col("ts").cast("timestamp")).groupBy(F.window("ts", "1 hour").start.alias("window_start"), "event_type").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(38,2)").alias("amount"))
    got = spark.table("windows")
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    once = windows.first_of_key(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["user_id"], "60 days").writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "d")).trigger(availableNow=True).start()
    once.awaitTermination(120)
    assert spark.table("once").count() == events.select("user_id").distinct().count()
