"""Intermediate tables in the shared checkpoint folder.

Cutting lineage with a written table (rather than caching) means that a lost
executor costs one task's re-read, not a recomputation, and that a later join
sees a plain scan, whose exchange adaptive execution may split when it is skewed.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
_BATCHES = ("spark.sql.execution.arrow.maxBytesPerBatch", "2m")


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one of our own only where that is
    unset and all runs in this process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="lexstrata-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of two megabytes at most, so that long texts don't pile up in workers.

    For plans that are handed to the caller; ``Scratch.save`` does so for its own run only.
    """
    spark.conf.set(*_BATCHES)


class Scratch:
    """Tables written by one operator run, each under a name of its own."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return it as a scan; its shuffle files go as soon as it is written, Arrow batches are small."""
        path = f"{self.base}/{name}"
        before = {k: self.spark.conf.get(k, None) for k, _ in (_CLEANUP, _BATCHES)}
        self.spark.conf.set(*_CLEANUP)
        self.spark.conf.set(*_BATCHES)
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        finally:
            for key, value in before.items():
                if value is None:
                    self.spark.conf.unset(key)
                else:
                    self.spark.conf.set(key, value)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
