"""Running sums and row numbers in an order, without a task that holds all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.sources.shared import shared_dir

# Rows of a partition count from 0 below this bit of monotonically_increasing_id; the partition stands above it.
_PARTITION_BIT = 33


def running_total(rows: DataFrame, value: str, *order: str | Column, name: str = "before") -> DataFrame:
    """``rows`` with the sum of ``value`` over all rows that come before in the order.

    The rows are dealt out by ranges of the order and frozen, so that both
    sums below see the same ranges. Each range is summed up for itself; what
    comes before a range is a sum of one number a range, of which there are at
    most as many as shuffle partitions. The order must tell rows apart.
    """
    shared_dir(rows.sparkSession)
    dealt = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).checkpoint()
    earlier = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumn("_inside", F.coalesce(F.sum(value).over(earlier), F.lit(0)))
    ranges = _before_ranges(dealt.groupBy("_range").agg(F.sum(value).alias("_sum")))
    whole = inside.join(F.broadcast(ranges), "_range")
    return whole.withColumn(name, F.col("_inside") + F.col("_before")).drop("_range", "_inside", "_before")


def numbered(rows: DataFrame, *order: str | Column, name: str = "row") -> DataFrame:
    """``rows`` numbered from 0 in the given order.

    Sorted once, by ranges of the order, and frozen; the number of a row is
    its place in its range and the length of all earlier ranges. Rows that the
    order does not tell apart stay in one range, so a frequent value wants a
    further column behind it.
    """
    shared_dir(rows.sparkSession)
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    frozen = placed.withColumn("_seq", F.monotonically_increasing_id()).checkpoint()
    frozen = frozen.withColumn("_range", F.shiftright("_seq", _PARTITION_BIT))
    ranges = _before_ranges(frozen.groupBy("_range").agg(F.count("*").alias("_sum")))
    inside = F.col("_seq").bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1))
    return frozen.join(F.broadcast(ranges), "_range").withColumn(name, inside + F.col("_before")).drop("_seq", "_range", "_before")


def _before_ranges(ranges: DataFrame) -> DataFrame:
    """``(_range, _before)``: the sum of all earlier ranges, from one ``_sum`` a range."""
    listed = ranges.agg(F.array_sort(F.collect_list(F.struct("_range", "_sum"))).alias("all"))

    def before(x: Column, i: Column) -> Column:
        total = F.aggregate(F.slice("all", F.lit(1), i), F.lit(0).cast("bigint"), lambda sum_, y: sum_ + y["_sum"])
        return F.struct(x["_range"].alias("_range"), total.alias("_before"))

    return listed.select(F.inline(F.transform("all", before)))
