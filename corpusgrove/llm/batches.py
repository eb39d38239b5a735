"""Smaller Arrow batches for steps whose rows are large."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1024) -> Iterator[None]:
    """Jobs run inside send ``rows`` rows at a time to Python; the setting is put back after."""
    before = spark.conf.get(ROWS)
    spark.conf.set(ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ROWS, before)
