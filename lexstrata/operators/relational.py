"""Extensions: relational operators that Spark lacks or that need care at scale.

None of them is part of the published behaviour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 2048  # rows of either side that range_join pairs at a time


def asof_join(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, value: str) -> DataFrame:
    """Each left row with the last ``value`` of ``right`` at or before its time.

    One shuffle of both sides' union by key, and one forward pass; no pair is formed.
    """
    a = left.withColumns({"_t": F.col(left_time), "_side": F.lit(1), "_v": F.lit(None).cast(right.schema[value].dataType)})
    b = right.select(by, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.col(value).alias("_v"))
    last = F.last("_v", ignorenulls=True).over(Window.partitionBy(by).orderBy("_t", "_side"))
    both = a.unionByName(b, allowMissingColumns=True).withColumn(f"{value}_asof", last)
    return both.where("_side = 1").select(*left.columns, f"{value}_asof")


def range_join(points: DataFrame, ranges: DataFrame, at: str, low: str, high: str, width: float) -> DataFrame:
    """Points with the ranges [low, high) that hold them, by an equi-join on blocks of cells.

    A range is copied to the cells of an eighth of ``width`` that it touches, so few pairs are
    formed in vain; ``width`` near the usual length keeps that to nine.  A cell is cut into
    blocks of about ``BLOCK`` points and ``BLOCK`` ranges, each a key of its own, so a cell that
    holds most rows is spread over all tasks.  The number of blocks is counted first, as the
    blocks' few bytes say nothing of the pairs that they make.  The result itself grows with
    the product of both sides.
    """
    cell = lambda c: F.floor(F.col(c) / (width / 8))
    points = points.withColumn("_cell", cell(at))
    spread = ranges.withColumn("_cell", F.explode(F.sequence(cell(low), cell(high))))
    parts = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    sizes = points.groupBy("_cell").agg(F.count("*").alias("_p")).join(spread.groupBy("_cell").agg(F.count("*").alias("_r")), "_cell")
    sizes = sizes.select("_cell", parts("_p").alias("_ps"), parts("_r").alias("_rs"))
    blocks = sizes.agg(F.sum(F.col("_ps").cast("long") * F.col("_rs"))).first()[0] or 1

    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = lambda rows, n: F.pmod(F.xxhash64(*rows.columns), F.col(n)).cast("int")
    a = points.join(sizes, "_cell").select(*points.columns, one(points, "_ps").alias("_i"), every("_rs").alias("_j"))
    b = spread.join(sizes, "_cell").select(*spread.columns, every("_ps").alias("_i"), one(spread, "_rs").alias("_j"))
    key, n = ["_cell", "_i", "_j"], min(blocks, 10000)
    both = a.repartition(n, *key).join(b.repartition(n, *key).hint("shuffle_hash"), key)
    return both.where((F.col(at) >= F.col(low)) & (F.col(at) < F.col(high))).drop(*key)


def salted_sum(rows: DataFrame, key: str, value: str, salts: int = 16) -> DataFrame:
    """Distinct values and their sum per key, for a hot key: dealt by value first, then combined."""
    part = rows.select(key, value, F.pmod(F.xxhash64(value), F.lit(salts)).alias("_s")).distinct()
    each = part.groupBy(key, "_s").agg(F.count(value).alias("n"), F.sum(value).alias("total"))
    return each.groupBy(key).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
