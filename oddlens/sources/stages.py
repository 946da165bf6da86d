"""Intermediate tables written to the cluster's shared checkpoint folder.

A written stage cuts lineage, survives the loss of executors, can be pruned by
column when read back, and carries a size the planner can use to decide whether a
join side is small enough to broadcast.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def _root(spark: SparkSession) -> str:
    """Shared folder named by the session; a temporary one only in local mode."""
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = spark.sparkContext.getCheckpointDir()
    if named is not None:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="spark-oddlens-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


class StageStore:
    """Named tables shared by the steps of one run (each written exactly once)."""

    def __init__(self, spark: SparkSession, run: str | None = None):
        self.spark = spark
        self.run = run or uuid.uuid4().hex[:12]
        self._schemas: dict[str, object] = {}

    def path(self, name: str) -> str:
        return f"{_root(self.spark)}/oddlens/{self.spark.sparkContext.applicationId}/{self.run}/{name}"

    def put(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        if name in self._schemas:
            raise ValueError(f"stage '{name}' is already written")
        df.write.partitionBy(*partition_by).parquet(self.path(name))
        self._schemas[name] = df.schema
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        # The folder is given with its schema, so no file footer is read to infer it.
        return self.spark.read.schema(self._schemas[name]).parquet(self.path(name))

    def __contains__(self, name: str) -> bool:
        return name in self._schemas

    def drop_all(self) -> None:
        """Delete the run's folder once its results are written elsewhere."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path("x")).getParent()
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self._schemas.clear()


def stage(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once and return the written table."""
    store = StageStore(df.sparkSession, run="steps")
    return store.put(uuid.uuid4().hex[:16], df, partition_by)
