"""Join operators. A side is broadcast only by Spark's own size check (autoBroadcastJoinThreshold and AQE)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sweep import overlap_pairs

OPEN_END = "9999-12-31"


def covers(day: Column, start: Column, end: Column) -> Column:
    """start <= day < end; a null end is open."""
    return (day >= start) & (end.isNull() | (day < end))


def asof_join(facts: DataFrame, versions: DataFrame, keys: list[tuple[str, str]], day: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Each fact with the version of its entity that covers its day, left. Equality keys shuffle; the interval is a
    residual of the hash join. Versions of one entity must not overlap (see ``overlapping``)."""
    on = covers(F.col(f"f.{day}"), F.col(f"v.{start}"), F.col(f"v.{end}"))
    for left, right in keys:
        on = (F.col(f"f.{left}") == F.col(f"v.{right}")) & on
    return facts.alias("f").join(versions.alias("v"), on, "left")


def asof_lookup(facts: DataFrame, versions: DataFrame, key: tuple[str, str], day: str, start: str, value: str) -> DataFrame:
    """As-of by one sort instead of a join by interval: both sides are unioned and the last version before each fact
    is carried forward. For entities with very many versions, where the interval join would compare them all."""
    from pyspark.sql import Window

    left, right = key
    v = versions.select(F.col(right).alias("_k"), F.col(start).alias("_d"), F.lit(0).alias("_o"), F.struct(F.col(value).alias("v")).alias("_v"))
    f = facts.select(F.col(left).alias("_k"), F.col(day).alias("_d"), F.lit(1).alias("_o"), F.lit(None).alias("_v"), F.struct(*facts.columns).alias("_f"))
    both = v.unionByName(f, allowMissingColumns=True)
    w = Window.partitionBy("_k").orderBy("_d", "_o").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("_v", F.last("_v", ignorenulls=True).over(w)).filter("_o = 1").select("_f.*", F.col("_v.v").alias(value))


def within(inner: DataFrame, outer: DataFrame, on: Column, inner_span: tuple[str, str], outer_span: tuple[str, str]) -> DataFrame:
    """Inner intervals (alias i) with the outer interval (alias o) that holds them, left; null ends are open."""
    open_ = lambda c: F.coalesce(F.col(c).cast("date"), F.lit(OPEN_END).cast("date"))
    inside = (F.col(f"i.{inner_span[0]}") >= F.col(f"o.{outer_span[0]}")) & (open_(f"i.{inner_span[1]}") <= open_(f"o.{outer_span[1]}"))
    return inner.alias("i").join(outer.alias("o"), on & inside, "left")


def unique_parents(parents: DataFrame, keys: list[str], *values: str) -> DataFrame:
    """Parents whose key occurs exactly once."""
    return parents.groupBy(*keys).agg(F.count("*").alias("_n"), *(F.first(v).alias(v) for v in values)).filter("_n = 1").drop("_n")


def match_counts(rows: DataFrame, row_id: str, targets: DataFrame, on: Column) -> DataFrame:
    """(row id, matches) for every row (alias s) against the targets (alias t)."""
    counted = targets.withColumn("_hit", F.lit(1))
    return rows.alias("s").join(counted.alias("t"), on, "left").groupBy(F.col(f"s.{row_id}").alias(row_id)).agg(F.count("t._hit").alias("matches"))


def overlapping(versions: DataFrame, entity: list[str], version_id: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Pairs of versions of one entity, smaller id first, of which each begins before the other ends, by a sweep. A null start
    meets nothing, a null end is open."""
    return overlap_pairs(versions, entity, version_id, start, end)


def reconcile(expected: DataFrame, actual: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Keys missing on a side, or whose measures are distinct, by a full outer join."""
    on = F.lit(True)
    for k in keys:
        on = F.col(f"e.{k}").eqNullSafe(F.col(f"a.{k}")) & on
    differs = F.lit(False)
    for m in measures:
        differs = differs | ~F.col(f"e.{m}").eqNullSafe(F.col(f"a.{m}"))
    e, a = expected.withColumn("_e", F.lit(1)).alias("e"), actual.withColumn("_a", F.lit(1)).alias("a")
    state = F.when(F.col("e._e").isNull(), "unexpected").when(F.col("a._a").isNull(), "missing").otherwise("different")
    joined = e.join(a, on, "full").filter(F.col("e._e").isNull() | F.col("a._a").isNull() | differs)
    return joined.select(*(F.coalesce(f"e.{k}", f"a.{k}").alias(k) for k in keys), *(F.col(f"{s}.{m}").alias(f"{n}_{m}") for m in measures for s, n in (("e", "expected"), ("a", "actual"))), state.alias("state"))


def orphans(children: DataFrame, parents: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    on = [children[c] == parents[p] for c, p in keys]
    return children.join(parents, on, "left_anti")
