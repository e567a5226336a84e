"""Hot keys cut into ranges of time, so that one entity is many tasks.

A key is hot if it holds more rows than an even share of the shuffle partitions. There are at most as many hot keys as
partitions and about twice as many cuts, whatever the data: so the table of cuts may be collected and broadcast, and every
use sees the same cuts, also after a lost executor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows up to which no key is cut.
LEAST = 1_000_000


def clock(rows: DataFrame, name: str) -> Column:
    """A date, timestamp or number as bigint, in its own order."""
    kind = rows.schema[name].dataType.typeName()
    return {"date": F.unix_date, "timestamp": F.unix_micros}.get(kind, lambda c: c)(F.col(name)).cast("bigint")


def hot_splits(rows: DataFrame, keys: list[str], time: str, least: int = LEAST) -> DataFrame | None:
    """(keys, cuts): ascending times at which each hot key is cut into even shares; a time that holds several shares is
    there as often. None if no key is hot. ``time`` is a bigint."""
    spark = rows.sparkSession
    total = rows.count()
    if total <= least:
        return None
    most = max(least, total // int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > most).collect()  # fewer than total / most
    if not hot:
        return None
    fine = -(-max(r["_n"] for r in hot) // most)
    table = spark.createDataFrame(hot, rows.select(*keys).schema.add("_n", T.LongType()))
    quantiles = F.percentile_approx(time, [i / fine for i in range(1, fine)] or [0.5], 10_000)
    found = rows.join(F.broadcast(table), keys).groupBy(*keys, "_n").agg(quantiles.alias("cuts")).collect()
    step = lambda r: max(1, round(fine / -(-r["_n"] // most)))
    return spark.createDataFrame([(*(r[k] for k in keys), r["cuts"][step(r) - 1 :: step(r)]) for r in found], rows.select(*keys).schema.add("cuts", T.ArrayType(T.LongType())))


def before(cuts: str, time: Column) -> Column:
    """Cuts before a time; 0 for a key without cuts."""
    return F.coalesce(F.size(F.filter(cuts, lambda x: x < time)), F.lit(0))


def with_cuts(rows: DataFrame, keys: list[str], splits: DataFrame | None) -> DataFrame:
    """``rows`` with the cuts of their key, null for most keys."""
    if splits is None:
        return rows.withColumn("cuts", F.lit(None).cast("array<bigint>"))
    return rows.join(F.broadcast(splits), keys, "left")
