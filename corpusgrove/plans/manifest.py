"""Commit records of the stages of a run, so that a run that was ended goes on where it stopped."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusgrove.storage import path_exists

Tables = dict[str, DataFrame]


def files_of(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Path, length and time of every file below ``path``; none if it is absent."""
    if not path_exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    listed = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(target, True)
    found = []
    while listed.hasNext():
        status = listed.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found)


class Manifest:
    """Stages in a folder of shared storage, each with a record written behind its tables.

    A record is found again under the stage's name and a digest of what went
    into it: the record before it, its template and its options.  Functions
    among the options count by name.  Without a folder every stage runs.
    """

    def __init__(self, spark: SparkSession, folder: str | None, *inputs):
        self.spark, self.folder = spark, folder.rstrip("/") if folder else None
        self.before = self._digest(inputs)

    @staticmethod
    def _digest(inputs) -> str:
        named = json.dumps(inputs, sort_keys=True, default=lambda o: getattr(o, "__qualname__", type(o).__qualname__))
        return hashlib.sha256(named.encode()).hexdigest()

    def stage(self, name: str, inputs, build: Callable[[], Tables]) -> Tables:
        """The tables of ``build``, from its record if there is one."""
        if self.folder is None:
            return build()
        self.before = self._digest([self.before, name, inputs])
        path = f"{self.folder}/{name}-{self.before[:32]}"
        if not path_exists(self.spark, f"{path}/record/_SUCCESS"):
            tables = build()
            for table, df in tables.items():
                df.write.mode("overwrite").parquet(f"{path}/{table}")
            record = json.dumps({"stage": name, "digest": self.before, "tables": sorted(tables)})
            self.spark.createDataFrame([(record,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/record")
        record = json.loads(self.spark.read.text(f"{path}/record").first()[0])
        return {table: self.spark.read.parquet(f"{path}/{table}") for table in record["tables"]}
