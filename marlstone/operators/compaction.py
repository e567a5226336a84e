"""Membership of a chain of publications kept as a base by bucket of key and the deltas since, merged when it is read.

A delta is small against what it changes, so a read takes the last word on each key out of base and deltas, and a compaction
writes only those buckets anew that a delta touches; all others keep their files. A bucket is written beside the old one, and
a commit, a table of where each bucket lies, makes the new state visible at once: a compaction that dies leaves files that
no commit names."""

from __future__ import annotations

from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
KEYS = ["relation", "key"]


def _bucket(buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(*KEYS), F.lit(buckets)).cast("int")


def last_words(changes: DataFrame) -> DataFrame:
    """The last change of each key by (chain_position, sequence), removals among them; pre-aggregated, so a key with very many
    changes is one row a task."""
    value = F.struct("chain_position", "sequence", "publication_id", "content")
    return changes.groupBy(*KEYS).agg(F.max(value).alias("v")).select(*KEYS, "v.*")


def _commits(spark: SparkSession, folder: str) -> DataFrame | None:
    """(number, bucket, path) of the newest commit, a row a bucket."""
    try:
        every = spark.read.parquet(f"{folder}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = every.agg(F.max("number")).first()[0]
    return every.filter(F.col("number") == newest)


def read_base(spark: SparkSession, folder: str) -> DataFrame | None:
    """The base as of the newest commit, with its bucket; None before the first."""
    known = _commits(spark, folder)
    if known is None:
        return None
    return spark.read.parquet(*(r.path for r in known.collect()))  # a path a bucket


def compact(spark: SparkSession, folder: str, deltas: DataFrame, buckets: int = BUCKETS) -> int:
    """Folds ``deltas`` (publication_id, chain_position, relation, key, sequence, content) into the base under ``folder`` and
    returns how many buckets were written. Removals stay in the base until ``content`` of a later change replaces them, so
    that a late delta can't bring a removed key back."""
    known, base = _commits(spark, folder), read_base(spark, folder)
    number = (known.first()["number"] if known is not None else 0) + 1
    at = f"{folder}/data/{number}-{uuid4().hex}"
    changes = last_words(deltas).withColumn("bucket", _bucket(buckets))
    if base is not None:
        touched = changes.select("bucket").distinct()
        changes = last_words(changes.drop("bucket").unionByName(base.join(F.broadcast(touched), "bucket", "left_semi").drop("bucket"))).withColumn("bucket", _bucket(buckets))
    if changes.isEmpty():
        return 0
    changes.withColumn("of", F.col("bucket")).repartition(buckets, "bucket").write.partitionBy("of").parquet(at)
    written = [r.of for r in spark.read.parquet(at).select("of").distinct().collect()]  # buckets at most
    places = spark.createDataFrame([(b, f"{at}/of={b}") for b in written], "bucket int, path string")
    if known is not None:
        places = places.unionByName(known.filter(~F.col("bucket").isin(written)).select("bucket", "path"))
    places.select(F.lit(number).alias("number"), "bucket", "path").coalesce(1).write.mode("append").parquet(f"{folder}/commits")
    return len(written)


def resolve(spark: SparkSession, folder: str, deltas: DataFrame | None = None) -> DataFrame:
    """(publication_id, relation, key, content) of what is there: the base with the deltas since, without what was removed."""
    base = read_base(spark, folder)
    parts = [df for df in (base.drop("bucket") if base is not None else None, deltas) if df is not None]
    if not parts:
        raise ValueError("neither a base nor a delta")
    return last_words(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])).filter("content IS NOT NULL").select("publication_id", *KEYS, "content")
