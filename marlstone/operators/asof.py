"""As-of lookup by one ordered scan, hot entities in many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .splits import LEAST, before, clock, hot_splits, with_cuts


def asof_scan(facts: DataFrame, versions: DataFrame, keys: list[tuple[str, str]], day: str, start: str = "valid_from", end: str = "valid_to", name: str = "version", least: int = LEAST) -> DataFrame:
    """Each fact with the version of its entity that covers its day as a struct under ``name``, null if none does.

    Facts and versions lie in one order of entity and time, and the last version that began is carried on to the facts
    behind it; so work is one sort and not facts times versions of an entity. A hot entity is cut into ranges of time: the
    last version of each range goes to the ranges behind it (a row for each range, a bounded table), so all ranges run at
    once. Where one instant holds more facts than a range should, they are dealt to several ranges.

    A null end is open; of versions that begin together the one with the latest end counts, versions must not overlap
    otherwise. Facts with a null key or day have no version; versions with a null key or start belong to no fact."""
    k = [f"_k{i}" for i in range(len(keys))]
    whole = lambda names: F.forall(F.array(*(F.col(n).isNotNull() for n in names)), lambda x: x)
    known = versions.filter(whole([r for _, r in keys] + [start]))
    v = known.select(*(F.col(r).alias(c) for c, (_, r) in zip(k, keys)), clock(versions, start).alias("_t"), F.coalesce(clock(versions, end), F.lit((1 << 63) - 1)).alias("_e"), F.struct(*known.columns).alias("_v"))
    v = v.groupBy(*k, "_t").agg(F.max_by(F.struct("_e", "_v"), "_e").alias("_v"))
    asked = [left for left, _ in keys] + [day]
    f = facts.filter(whole(asked)).select(*(F.col(left).alias(c) for c, (left, _) in zip(k, keys)), clock(facts, day).alias("_t"), F.struct(*facts.columns).alias("_f"))
    both = v.withColumn("_o", F.lit(0)).unionByName(f.withColumn("_o", F.lit(1)), allowMissingColumns=True)
    splits = hot_splits(both.select(*k, "_t"), k, "_t", least)
    if splits is None:
        here = both.withColumn("_part", F.lit(0))
    else:
        # facts of an instant at which several cuts lie are dealt over the ranges between them; versions go to the first
        at = F.coalesce(F.size(F.filter("cuts", lambda x: x == F.col("_t"))), F.lit(0))
        dealt = F.when(F.col("_o") == 1, F.pmod(F.xxhash64("_f"), at + 1)).otherwise(0)
        here = with_cuts(both, k, splits).withColumn("_part", (before("cuts", F.col("_t")) + dealt).cast("int")).drop("cuts")
    order = Window.partitionBy(*k, "_part").orderBy("_t", "_o").rowsBetween(Window.unboundedPreceding, 0)
    seen = here.withColumn("_v", F.last("_v", ignorenulls=True).over(order)).filter("_o = 1")
    if splits is not None:
        parts = splits.select(*k, F.explode(F.sequence(F.lit(0), F.size("cuts"))).alias("_part"))
        ends = with_cuts(v, k, splits).filter("cuts IS NOT NULL").select(*k, before("cuts", F.col("_t")).alias("_part"), "_t", "_v").groupBy(*k, "_part").agg(F.max_by("_v", "_t").alias("_last"))
        earlier = Window.partitionBy(*k).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        carried = parts.join(ends, [*k, "_part"], "left").withColumn("_last", F.last("_last", ignorenulls=True).over(earlier))
        seen = seen.join(F.broadcast(carried), [*k, "_part"], "left").withColumn("_v", F.coalesce("_v", "_last"))
    covered = F.when(F.col("_t") < F.col("_v._e"), F.col("_v._v"))
    found = seen.select("_f.*", covered.alias(name))
    return found.unionByName(facts.filter(~whole(asked)), allowMissingColumns=True)
