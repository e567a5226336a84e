"""Aggregates: rollups, ordered arrays, digests, controls and duplicate keys. All pre-aggregate before the shuffle
except the ordered arrays and digests, which need the members of a group together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordered_values(order: Column, value: Column, missing: str) -> Column:
    """Values in the order of another column; a null value keeps its place under a sentinel."""
    pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), F.coalesce(value, F.lit(missing)).alias("v"))))
    return F.transform(pairs, lambda x: x["v"])


def digest(hashes: Column) -> Column:
    """sha256 of the sorted member hashes, one a line; of the empty text for no members."""
    return F.sha2(F.array_join(F.array_sort(F.collect_list(hashes)), "\n"), 256)


def bucketed_digest(rows: DataFrame, key: str, value: str, buckets: int) -> DataFrame:
    """One digest over any number of rows without gathering them: rows are dealt into ranges of their key's hash, each
    range has a digest, and the digest of the digests in order stands for the whole."""
    of = rows.select(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"), F.concat_ws(":", key, value).alias("member"))
    return of.groupBy("bucket").agg(digest(F.col("member")).alias("h")).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "h"))), lambda x: x["h"]), "\n"), 256).alias("digest"))


def inventory_digest(key: Column, content: Column) -> Column:
    """sha256 of <8 hex digits of the key's bytes>:key:content in key order."""
    members = F.array_sort(F.collect_list(F.struct(key.alias("k"), content.alias("c"))))
    return F.sha2(F.array_join(F.transform(members, lambda x: F.format_string("%08x:%s:%s", F.octet_length(x["k"]), x["k"], x["c"])), ""), 256)


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies <> 1")


def money(value: Column) -> Column:
    """Exact cents: a double is cast before it is summed."""
    return value.cast("decimal(18,2)")


def total(value: Column) -> Column:
    """Sum of money, 0 for none."""
    return F.coalesce(F.sum(money(value)), F.lit(0)).cast("decimal(38,2)")
