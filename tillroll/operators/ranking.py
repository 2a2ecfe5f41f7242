"""Positions over whole columns without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import materialize


def dense_index(
    values: DataFrame, group: str, value: str, out: str = "code", window_limit: int = 100_000
) -> DataFrame:
    """Number the distinct values of every group 0..n-1 in sorted order.

    The distinct values are written once.  Up to ``window_limit`` per group one window numbers them.  Beyond, values are range
    partitioned, written once, numbered inside each range, and shifted by the sizes of the ranges
    before (one row per group and range).
    """
    distinct = materialize(values.select(group, value).distinct())
    sizes = distinct.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    if largest <= window_limit:
        order = Window.partitionBy(group).orderBy(value)
        return distinct.withColumn(out, F.row_number().over(order) - 1)
    ranges = max(2, -(-largest // window_limit)) * 2
    ranged = materialize(
        distinct.repartitionByRange(ranges, group, value).withColumn(
            "range_no", F.spark_partition_id()
        )
    )
    before = Window.partitionBy(group).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(group, "range_no")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(group, "range_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy(group, "range_no").orderBy(value)
    return (
        ranged.withColumn("position", F.row_number().over(inside) - 1)
        .join(offsets, [group, "range_no"])
        .select(group, value, (F.col("position") + F.col("offset")).cast("int").alias(out))
    )
