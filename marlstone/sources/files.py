"""Sources and sinks. Files are read and written by Spark; only manifests and pointers, a few rows each, by the driver."""

from __future__ import annotations

import json
import os
import re
import shutil
import tempfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DeliveryError(ValueError):
    """A delivery that must not be read further."""


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names. Only where all tasks run in this process, as in tests, may it name none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local(\[|$)", context.master):
            raise DeliveryError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def shared_checkpoint(df: DataFrame) -> DataFrame:
    """``df`` as files in the shared checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_table(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder. For loops: a checkpoint keeps the size that was estimated for its
    plan, which joins multiply from round to round, and a table has the size of its files."""
    at = f"{shared_folder(df.sparkSession)}/table-{uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def read_contract_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All-text rows under a fixed header; a ragged row or another header stops the read. Empty text stays empty."""
    header = spark.read.text(path).limit(1).collect()
    if not header or header[0][0].strip().split(",") != columns:
        raise DeliveryError(f"header of {path} differs from its contract")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("enforceSchema", False).option("nullValue", "\0").option("emptyValue", "").csv(path)
    return rows.fillna("")


def read_numbered_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows as ``read_contract_csv`` has them, with their file and row_number, from 1 after the header, as a plain reader
    counts. Files are read in splits; a split counts its lines (a row a split), and what lies before it is added. Fields hold
    no line breaks and lines are none of them empty, as in what ``write_contract_csv`` writes."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_at"))
    splits = lines.groupBy("file", "_split").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    numbered = lines.join(placed, ["file", "_split"]).withColumn("row_number", F.col("_before") + F.col("_at") - F.col("_first"))
    heads = numbered.filter((F.col("row_number") == 0) & (F.col("value") != ",".join(columns)))
    if not heads.isEmpty():
        raise DeliveryError(f"header of {path} differs from its contract")
    schema = ", ".join(f"`{c}` string" for c in columns)
    parsed = F.from_csv("value", schema, {"mode": "FAILFAST", "nullValue": "\0", "emptyValue": ""})
    rows = numbered.filter("row_number > 0").select("file", "row_number", parsed.alias("_row")).select("file", "row_number", "_row.*")
    return rows.fillna("", subset=columns)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def verify_manifest(spark: SparkSession, folder: str, manifest: dict) -> None:
    """Every listed file is there once with its sha256 and row count, and no other. Hashes are computed where the files are."""
    listed = {f["path"]: f for f in manifest["files"]}
    if len(listed) != len(manifest["files"]):
        raise DeliveryError("a file is listed twice")
    found = spark.read.format("binaryFile").load(folder).select(F.substring_index("path", "/", -1).alias("name"), F.sha2("content", 256).alias("sha"), F.size(F.split(F.decode("content", "UTF-8"), "\n")).alias("parts")).collect()  # a row for each file
    seen = {r.name: r for r in found if r.name.endswith(".csv")}
    if seen.keys() != listed.keys():
        raise DeliveryError(f"files differ from the manifest: {sorted(seen.keys() ^ listed.keys())}")
    for name, row in seen.items():
        if row.sha != listed[name]["sha256"]:
            raise DeliveryError(f"{name}: sha256 differs")
        if row.parts - 2 != listed[name]["rows"]:  # header and the text after the last line end
            raise DeliveryError(f"{name}: {row.parts - 2} rows, {listed[name]['rows']} declared")


def write_contract_csv(df: DataFrame, path: str, columns: list[str]) -> int:
    """One CSV with fixed columns; deliveries are small files by contract. Returns its rows."""
    if df.columns != columns:
        raise DeliveryError("columns differ from the contract")
    staging = f"{path}.staging"
    df.coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "").option("nullValue", "").csv(staging)
    part = next(Path(staging).glob("part-*.csv"))
    os.replace(part, path)
    shutil.rmtree(staging)
    return df.count()


def publish_folder(write, target: str) -> None:
    """Calls write(staging folder) and renames it to ``target``, which must not exist: all of it appears, or nothing."""
    if os.path.exists(target):
        raise FileExistsError(target)
    staging = f"{target}.staging-{os.getpid()}"
    try:
        write(staging)
        os.rename(staging, target)
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def recover_folder(target: str) -> str:
    """After an interrupted publish: 'complete' if the folder is there, else what was staged is discarded."""
    staged = [p for p in Path(target).parent.glob(f"{Path(target).name}.staging-*")]
    for p in staged:
        shutil.rmtree(p)
    return "complete" if os.path.exists(target) else "discarded" if staged else "absent"


def split_by_disposition(rows: DataFrame, target: str) -> None:
    """Validated, quarantined and rejected rows and all issues; one pass over a checkpointed frame each."""
    rows = shared_checkpoint(rows)
    parts = {"validated": F.col("disposition").isin("accepted", "accepted_with_warning"), "quarantined": F.col("disposition") == "quarantined", "rejected": F.col("disposition") == "rejected"}

    def write(folder: str) -> None:
        for name, wanted in parts.items():
            rows.filter(wanted).write.parquet(f"{folder}/{name}")
        rows.select("row_id", F.explode("issues").alias("issue")).select("row_id", "issue.*").write.parquet(f"{folder}/issues")

    publish_folder(write, target)


def append_once(rows: DataFrame, target: str, load_id: str) -> int:
    """Appends a load under its own partition; a load that is already there is left alone, so a replay is safe."""
    spark = rows.sparkSession
    at = f"{target}/load_id={load_id}"
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")):
        return 0
    rows.write.mode("overwrite").parquet(at)
    return spark.read.parquet(at).count()


class VersionCollision(ValueError):
    """The same key and version came with other content."""


def register_versions(known: DataFrame, offered: DataFrame, keys: list[str], content: str) -> DataFrame:
    """New rows of ``offered``: absent keys are added, equal content is passed over, other content is a collision."""
    k, o = known.select(*keys, F.col(content).alias("_known")), offered
    joined = o.join(k, keys, "left")
    clash = joined.filter(F.col("_known").isNotNull() & (F.col("_known") != F.col(content)))
    own = offered.groupBy(*keys).agg(F.countDistinct(content).alias("n")).filter("n > 1")
    if not clash.isEmpty() or not own.isEmpty():
        raise VersionCollision(str((clash.select(*keys).take(3), own.select(*keys).take(3))))
    return joined.filter("_known IS NULL").drop("_known").dropDuplicates(keys)


def partitioned_fact(df: DataFrame, target: str, date: str, cluster: list[str]) -> None:
    """Month partitions, sorted by the cluster columns within each file."""
    dated = df.withColumn("month", F.date_format(date, "yyyy-MM"))
    dated.repartition("month", *cluster[:1]).sortWithinPartitions("month", *cluster).write.partitionBy("month").parquet(target)


def write_json(path: str, value: dict) -> None:
    """Durable small file: written beside its place, then renamed into it."""
    temporary = f"{path}.{os.getpid()}.tmp"
    with open(temporary, "w", encoding="utf-8") as f:
        json.dump(value, f, sort_keys=True)
        f.flush()
        os.fsync(f.fileno())
    os.replace(temporary, path)
