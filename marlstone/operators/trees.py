"""Commitments over inventories of any size: a hash tree, and order-free fingerprints by bucket.

Neither gathers a relation. The tree is an algorithm of its own: the members of a relation are dealt by the first bytes of
the sha256 of their key, as many bytes (the depth) as leave LEAF members a bucket on average; a leaf is the sha256 of its
members, a line each, in order; a node is the sha256 of its children's bytes and hashes; the root is hashed with the count
and the depth. So a task sees a leaf or 256 children, and two trees can be compared from the root down.

A fingerprint of a bucket is a count and a sum of hashes: equal for the same rows in any order and any partitioning, and
computed with partial sums, so a replay is compared without a row being moved."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAF = 1024
#: Levels of 256 children each; 1024 * 256^4 is 4 * 10^12 members a relation.
MAX_DEPTH = 4


def member(key: Column, content: Column) -> Column:
    """<8 hex digits of the key's bytes>:key:content; a null content is the empty text."""
    return F.concat_ws(":", F.lower(F.lpad(F.hex(F.octet_length(key).cast("bigint")), 8, "0")), key, F.coalesce(content, F.lit("")))


def depth_for(count: Column, leaf: int = LEAF) -> Column:
    """Bytes of the key's hash that make a bucket."""
    return reduce(lambda acc, d: acc + F.when(count > leaf * 256**d, 1).otherwise(0), range(MAX_DEPTH), F.lit(0))


def tree_nodes(rows: DataFrame, relation: str = "relation", key: str = "key", content: str = "content", leaf: int = LEAF) -> list[DataFrame]:
    """Nodes of every level as (relation, depth, prefix, members, hash), the leaves first and the roots (prefix "") last."""
    sized = rows.groupBy(relation).agg(F.count("*").alias("_n")).select(F.col(relation).alias("_relation"), depth_for(F.col("_n"), leaf).alias("depth"))
    of = rows.select(F.col(relation).alias("relation"), F.col(key).cast("string").alias("k"), F.col(content).cast("string").alias("c"))
    placed = of.join(F.broadcast(sized), F.col("relation") == F.col("_relation")).select("relation", "depth", F.substring(F.sha2("k", 256), F.lit(1), 2 * F.col("depth")).alias("prefix"), member(F.col("k"), F.col("c")).alias("m"))
    level = placed.groupBy("relation", "depth", "prefix").agg(F.count("*").alias("members"), F.sha2(F.array_join(F.sort_array(F.collect_list("m")), "\n"), 256).alias("hash"))
    levels = [level]
    for down in range(MAX_DEPTH, 0, -1):
        # one grouping for all: a relation whose nodes are higher has each of them in a group by itself, so no level is made twice
        below = level.filter("prefix IS NOT NULL").withColumn("here", F.length("prefix") == 2 * down).withColumn("up", F.when(F.col("here"), F.substring("prefix", 1, 2 * down - 2)).otherwise(F.col("prefix")))
        children = F.sort_array(F.collect_list(F.struct(F.when(F.col("here"), F.substring("prefix", -2, 2)).alias("at"), "hash")))
        folded = below.groupBy("relation", "depth", "up", "here").agg(F.sum("members").alias("members"), children.alias("children"))
        node = F.sha2(F.array_join(F.transform("children", lambda x: F.concat(x["at"], x["hash"])), ""), 256)
        level = folded.select("relation", "depth", F.col("up").alias("prefix"), "members", F.when(F.col("here"), node).otherwise(F.element_at("children", 1)["hash"]).alias("hash"))
        levels.append(level)
    return levels


def tree_commitment(rows: DataFrame, relation: str = "relation", key: str = "key", content: str = "content", leaf: int = LEAF) -> DataFrame:
    """(relation, row_count, depth, tree_sha256) of each relation; a relation without rows has none."""
    root = tree_nodes(rows, relation, key, content, leaf)[-1]
    return root.select("relation", F.col("members").alias("row_count"), "depth", F.sha2(F.concat_ws(":", F.lit("tree-v1"), F.col("members").cast("string"), F.col("depth").cast("string"), "hash"), 256).alias("tree_sha256"))


def fingerprints(rows: DataFrame, relation: str, keys: list[str], buckets: int = 256) -> DataFrame:
    """(relation, bucket, n, total) of a relation: the rows of each bucket of keys and the sum of their hashes. A row is hashed
    over all its columns by name, nulls apart from every text; the sum of 60-bit parts of sha256 is exact."""
    of = F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(rows.columns))), {"ignoreNullFields": "false"})
    part = F.conv(F.substring(F.sha2(of, 256), 1, 15), 16, 10).cast("decimal(19,0)")
    return rows.select(bucket_of(keys, buckets).alias("bucket"), part.alias("p")).groupBy("bucket").agg(F.count("*").alias("n"), F.sum("p").cast("decimal(38,0)").alias("total")).select(F.lit(relation).alias("relation"), "bucket", "n", "total")


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def differing(registered: DataFrame, recomputed: DataFrame) -> DataFrame:
    """(relation, bucket) that only one side has, or that have other rows."""
    of = lambda df, name: df.select("relation", "bucket", F.struct("n", "total").alias(name))
    return of(registered, "a").join(of(recomputed, "b"), ["relation", "bucket"], "full").filter("NOT a <=> b").select("relation", "bucket")


def replay_difference(before: DataFrame, after: DataFrame, registered: DataFrame, relation: str, keys: list[str], buckets: int = 256) -> DataFrame:
    """(keys, state) of what a replay changed: missing, unexpected or different. ``registered`` are the fingerprints of
    ``before`` as they were written with it. Rows are compared only in buckets whose fingerprints differ; of equal runs
    neither side is read again."""
    wrong = F.broadcast(differing(registered.filter(F.col("relation") == relation), fingerprints(after, relation, keys, buckets)).select("bucket"))  # a row a bucket
    some = lambda df: df.withColumn("bucket", bucket_of(keys, buckets)).join(wrong, "bucket", "left_semi").drop("bucket")
    both = some(before).withColumn("_was", F.lit(1)).unionByName(some(after.select(before.columns)).withColumn("_was", F.lit(-1)))
    apart = both.groupBy(*before.columns).agg(F.sum("_was").alias("n")).filter("n <> 0").select(*keys, (F.col("n") > 0).alias("was"), (F.col("n") < 0).alias("is"))
    states = apart.groupBy(*keys).agg(F.max("was").alias("was"), F.max("is").alias("is"))
    return states.select(*keys, F.when(~F.col("is"), "missing").when(~F.col("was"), "unexpected").otherwise("different").alias("state"))
