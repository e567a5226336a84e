"""Makes this package importable in Python workers that do not have it installed."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once an application, hands the package's sources to Spark's own file server, from which every executor fetches them."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":  # made for numbers; texts are longer
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp()) / f"{package.name}_sources.zip"
    with zipfile.ZipFile(target, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names. Only where all tasks run in this process, as in tests, may it name none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` as files in the shared checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder. For loops: a checkpoint keeps the size that was estimated for its
    plan, which joins multiply from round to round, and a table has the size of its files."""
    at = f"{shared_folder(df.sparkSession)}/table-{uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


#: Rows of (a, b) or the like that a task takes where tables are small.
SMALL_ROWS = 50_000


def tasks_for(rows: int) -> int:
    return rows // SMALL_ROWS + 1


def compact(df: DataFrame) -> DataFrame:
    """``checkpointed``, read again by tasks in proportion to its rows, so that steps over few rows leave few files."""
    out = checkpointed(df)
    return out.coalesce(tasks_for(out.count()))


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> str:
    """A column name as one identifier, dots and all."""
    return "`" + name.replace("`", "``") + "`"
