"""Several tables that become visible together.

A delivery's tables are written beside one another under a folder of their own, and then one commit of a row for each table
names them. Readers see only what a commit names, so a delivery that dies before it leaves nothing visible; one under a key
that is committed already changes nothing. If two writers commit a key at once, every reader takes the first of the two, by
the order of their folders' names; the other's files are named by no reader."""

from __future__ import annotations

import time
from collections.abc import Mapping
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import DeliveryError

COMMITS = "key string, content string, name string, path string, number bigint, id string"


def _commits(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the first commit of each key."""
    try:
        every = spark.read.schema(COMMITS).parquet(f"{folder}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMITS)
    first = every.groupBy("key").agg(F.min(F.struct("number", "id")).alias("first")).select("key", "first.*")
    return every.join(first, ["key", "number", "id"], "left_semi")


def commit(spark: SparkSession, folder: str, key: str, content: str, tables: Mapping[str, DataFrame]) -> str:
    """'committed', or 'duplicate_no_op' if the key is committed with the same content (a hash of what was delivered); another
    content under a committed key is an error. Nothing of ``tables`` is computed for a duplicate."""
    known = _commits(spark, folder).filter(F.col("key") == key).select("content").first()
    if known is not None:
        if known["content"] != content:
            raise DeliveryError(f"another content is committed under {key}")
        return "duplicate_no_op"
    number, mark = time.time_ns(), uuid4().hex
    placed = []
    for name, df in tables.items():
        at = f"{folder}/data/{name}/{mark}"
        df.write.parquet(at)
        placed.append((key, content, name, at, number, mark))
    spark.createDataFrame(placed, COMMITS).coalesce(1).write.mode("append").parquet(f"{folder}/commits")
    return "committed"


def committed(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """The rows of a table over all commits, with the key that brought them as ``delivery``; None if none has the table. Paths
    are a row for each delivery."""
    placed = _commits(spark, folder).filter(F.col("name") == name).select("key", "path", "id").collect()
    if not placed:
        return None
    keys = spark.createDataFrame([(r["id"], r["key"]) for r in placed], "_mark string, delivery string")
    rows = spark.read.parquet(*(r["path"] for r in placed)).withColumn("_mark", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    return rows.join(keys, "_mark").drop("_mark")
