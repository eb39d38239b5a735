"""Shared storage for intermediate tables, and size checks for broadcasts."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="corpusgrove-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read: ``spark.checkpoint.dir`` of the session.

    Only a local master may go without the setting (tests); a cluster must name
    a shared folder, because executors can be lost and rescheduled elsewhere.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return _local_scratch()
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


_created: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/corpusgrove/{label}-{uuid.uuid4().hex}"
    _created.append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables this program has written; returns how many.

    For the end of a run, when its outputs are written: tables that plans
    returned may still read from there.
    """
    paths, _created[:] = _created[:], []
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    targets = [jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return sum(bool(t.getFileSystem(conf).delete(t, True)) for t in targets)


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Cuts lineage and survives executor loss.  Used for completion responses
    (expensive, not repeatable) and between rounds of iterative plans.
    ``compression`` other than Spark's own is for tables of texts.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def rows_within(df: DataFrame, limit: int) -> bool:
    """True when ``df`` has at most ``limit`` rows; counts no further than that."""
    return df.limit(limit + 1).count() <= limit


def broadcast_within(df: DataFrame, limit: int) -> DataFrame:
    """Broadcast hint behind a size check; beyond it Spark joins by shuffle."""
    return F.broadcast(df) if rows_within(df, limit) else df


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
