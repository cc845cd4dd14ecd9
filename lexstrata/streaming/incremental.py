"""Incremental variants (extensions): new files only, and windowed counts of event streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_parquet(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """A stream over the table ``name`` below ``folder``; files that come later are read once."""
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}*").option("recursiveFileLookup", "true").parquet(folder)


def tumbling_counts(events: DataFrame, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Events and their value per window and type; later than ``late`` is dropped."""
    by = F.window("ts", width)
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(by, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    return rows.select(F.col("window.start").alias("start"), "event_type", "n", "value")


def run_once(counts: DataFrame, name: str, checkpoint: str) -> DataFrame:
    """Drain what is there into a table in memory, and return it (for reports and tests)."""
    query = counts.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return counts.sparkSession.table(name)


def new_files(files: DataFrame, seen: DataFrame, key: str = "path") -> DataFrame:
    """Files not converted before: the batch form of the same idea."""
    return files.join(seen.select(key), key, "left_anti")
