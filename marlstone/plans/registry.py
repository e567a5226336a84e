from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a function of the tables under its name."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register
