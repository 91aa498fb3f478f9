"""Size checks before a broadcast, and cutting a plan that several branches read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def fits_in_broadcast(df: DataFrame, row_bytes: Column | int, limit: int = BROADCAST_BYTES) -> bool:
    """Measure a join side before it is broadcast: the sum of ``row_bytes`` is at most ``limit``.

    This runs a small job on that side alone, so the large side is neither read nor shuffled
    to find out.
    """
    weight = row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)
    total = df.agg(F.sum(weight.cast("bigint"))).first()[0]
    return (total or 0) <= limit


def settle(df: DataFrame) -> DataFrame:
    """Write an intermediate table once and read it back, so that branches do not recompute it.

    For tables that are much smaller than what they are made of, such as a panel out of raw
    events. It goes as Parquet to the checkpoint folder of the session, which all executors
    share: it outlives lost executors, its columns can still be pruned, and its size is known
    when a join is planned.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession) -> str:
    """A new path below the checkpoint folder of the session (local sessions may lack one)."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="panelkit-"))
        folder = context.getCheckpointDir()
    return f"{folder}/{_own_prefix(spark)}{uuid.uuid4().hex}"


def _own_prefix(spark: SparkSession) -> str:
    return f"panelkit-{spark.sparkContext.applicationId}-"


def drop_scratch(spark: SparkSession) -> int:
    """Delete what this application has settled, and return how many tables that were.

    Results that still read a settled table can no longer be computed, so call it at the end.
    Tables of other applications in the same folder stay.
    """
    folder = scratch_path(spark).rpartition("/")[0]
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{_own_prefix(spark)}*")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [status.getPath() for status in system.globStatus(path) or []]
    for one in found:
        system.delete(one, True)
    return len(found)
