"""Ranking and window operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The last row of each key. Rank first, filter afterwards: a later tombstone must hide what came before it."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rank = 1").drop("_rank")


def latest_by_aggregate(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The same by max_by, which pre-aggregates: for keys that hold a large share of all rows."""
    value = F.struct(*[c for c in rows.columns if c not in keys])
    return rows.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias("_v")).select(*keys, "_v.*")


def occurrence(keys: list[str], *order: Column) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))


def copies(keys: list[str]) -> Column:
    return F.count("*").over(Window.partitionBy(*keys))


def tumbling_start(ts: Column, seconds: int) -> Column:
    return F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / seconds) * seconds)


def with_validity(rows: DataFrame, entity: list[str], start: str) -> DataFrame:
    """valid_from and valid_to (the next start, exclusive; null for the last) of the distinct starts of each entity."""
    w = Window.partitionBy(*entity).orderBy(start)
    return rows.select(*entity, start).distinct().select(*entity, F.col(start).alias("valid_from"), F.lead(start).over(w).alias("valid_to"))
