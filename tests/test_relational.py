"""Relational extensions: whole results, spread over tasks."""

from lexstrata.operators import relational as R
from pyspark.sql import functions as F


def test_range_join_spreads_a_full_cell(spark):
    points = spark.range(0, 12000, numPartitions=1).select("id", (F.col("id") % 97 / 10 + 900).alias("at"))
    ranges = spark.range(0, 300, numPartitions=1).select(F.col("id").alias("r"), (F.col("id") + 500.5).alias("lo"), (F.col("id") + 1000.5).alias("hi"))
    out = R.range_join(points, ranges, "at", "lo", "hi", 500.0).cache()
    plain = points.crossJoin(ranges).where("at >= lo and at < hi")
    assert out.columns == ["id", "at", "r", "lo", "hi"]
    assert out.count() == plain.count() == out.distinct().count() and out.exceptAll(plain).isEmpty()
    in_tasks = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(in_tasks) < out.count() * 0.7


def test_range_join_without_matches(spark):
    points = spark.createDataFrame([(1, None), (2, 5.0), (3, float("nan"))], "id int, at double")
    ranges = spark.createDataFrame([(1, 5.5, 6.0), (2, None, 6.0), (3, 5.0, 5.0)], "r int, lo double, hi double")
    assert R.range_join(points, ranges, "at", "lo", "hi", 0.5).collect() == []
