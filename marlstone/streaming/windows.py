"""Event-time operators with bounded state: the watermark says how late an event may be."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import total


def evaluation_windows(events: DataFrame, ts: str, amount: str, by: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Count and exact amount of each kind of event in tumbling windows."""
    seen = events.withWatermark(ts, late).groupBy(F.window(ts, width), by).agg(F.count("*").alias("n"), total(F.col(amount)).alias("amount"))
    return seen.select(F.col("window.start").alias("window_start"), by, "n", "amount")


def first_of_key(events: DataFrame, ts: str, keys: list[str], late: str = "2 hours") -> DataFrame:
    """Later repeats of a key within the watermark are dropped."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)
