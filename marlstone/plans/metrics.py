"""Governed metrics: ratios over half-open periods, balances as of a date, and sums with a defined empty value.

A knowledge cutoff comes first, then the latest version of each key; numerators are semi joins, so nothing fans out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import total
from ..operators.windows import latest


def known_at(rows: DataFrame, published: str, cutoff: Column) -> DataFrame:
    return rows.filter(F.col(published) <= cutoff)


def in_period(rows: DataFrame, event: str, start: Column, end: Column) -> DataFrame:
    return rows.filter((F.col(event) >= start) & (F.col(event) < end))


def ratio(numerator: Column, denominator: Column) -> list[Column]:
    """numerator, denominator, unrounded (18,6), display percent (2 digits) and status of an aggregate ratio."""
    n, d = numerator.cast("decimal(38,2)"), denominator.cast("decimal(38,2)")
    exact = F.when(d != 0, F.round(n / F.nullif(d, F.lit(0)), 6).cast("decimal(18,6)"))
    display = F.when(d != 0, F.round(n * 100 / F.nullif(d, F.lit(0)), 2).cast("decimal(18,2)"))
    return [n.alias("numerator"), d.alias("denominator"), exact.alias("unrounded"), display.alias("display"), F.when(d != 0, "ok").otherwise("not_applicable").alias("status")]


def share_with(population: DataFrame, keys: list[str], events: DataFrame) -> DataFrame:
    """Percent of the distinct keys of a population that have an event."""
    flagged = population.select(*keys).distinct().join(events.select(*keys).distinct().withColumn("_hit", F.lit(1)), keys, "left")
    return flagged.agg(F.count("_hit").alias("n"), F.count("*").alias("d")).select(*ratio(F.col("n"), F.col("d")))


def current_rows(rows: DataFrame, identity: list[str], order: list[Column], dropped: Column) -> DataFrame:
    """The current row of each identity; an identity whose current row is void has none."""
    return latest(rows, identity, *order).filter(~dropped)


def sum_or_zero(rows: DataFrame, amount: Column) -> DataFrame:
    return rows.agg(total(amount).alias("amount"))


def days_outstanding(balance: DataFrame, billed: DataFrame, days: int = 90) -> DataFrame:
    """Outstanding balance over the mean billed amount of a day."""
    joined = balance.select(F.col("amount").alias("b")).crossJoin(billed.select(F.col("amount").alias("s")))  # a row each
    return joined.select(F.col("b").alias("balance"), F.col("s").alias("billed"), F.when(F.col("s") > 0, F.round(F.col("b").cast("decimal(18,2)") * days / F.nullif(F.col("s").cast("decimal(18,2)"), F.lit(0)), 6).cast("decimal(18,6)")).alias("days"))
