"""Set operators and spines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def symmetric_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    missing = expected.subtract(actual).withColumn("side", F.lit("missing"))
    return missing.unionByName(actual.subtract(expected).withColumn("side", F.lit("unexpected")))


def changed_keys(before: DataFrame, after: DataFrame, key: str, content: str) -> DataFrame:
    """(key, change: added, removed or changed) between two inventories."""
    b, a = before.select(key, F.col(content).alias("_b")), after.select(key, F.col(content).alias("_a"))
    change = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").otherwise("changed")
    return b.join(a, key, "full").filter(~F.col("_b").eqNullSafe(F.col("_a"))).select(key, change.alias("change"))


def date_spine(dates: DataFrame, column: str, limit: int = 36_600) -> DataFrame:
    """Every day from the first to the last date; the span is checked against ``limit``. Empty input gives no days."""
    bounds = dates.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    guarded = F.when(F.date_diff("hi", "lo") < limit, F.sequence("lo", "hi")).otherwise(F.raise_error(F.lit("date span too long")).cast("array<date>"))
    return bounds.filter("lo IS NOT NULL").select(F.explode(guarded).alias("full_date"))
