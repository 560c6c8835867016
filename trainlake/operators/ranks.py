"""Positions in a total order, without one task holding all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trainlake.session import materialise

WINDOW_ROWS = 1_000_000


def positions(
    df: DataFrame,
    group: str,
    order: Sequence[Column],
    name: str,
    rows_in_largest_group: int,
    window_rows: int = WINDOW_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in its group; `order` must have no ties.

    Small groups are one window. A larger group is sorted by range into many
    partitions, which are numbered within; the position is that number plus the
    rows of the partitions before. The ranged rows are written first, so that
    both steps see the same range bounds.
    """
    if rows_in_largest_group <= window_rows:
        numbered = F.row_number().over(Window.partitionBy(group).orderBy(*order))
        return df.withColumn(name, (numbered - 1).cast("bigint"))

    spread = partitions or max(2, -(-rows_in_largest_group // window_rows) * 4)
    ranged = materialise(
        df.repartitionByRange(spread, F.col(group), *order).withColumn(
            "_range", F.spark_partition_id()
        ),
        "ranged",
    )
    # One row for each range and group in it: a few more rows than ranges.
    sizes = ranged.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sizes.select(
        group, "_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    inside = F.row_number().over(Window.partitionBy(group, "_range").orderBy(*order))
    return (
        ranged.withColumn("_inside", inside)
        .join(F.broadcast(starts), [group, "_range"])
        .withColumn(name, F.col("_start") + F.col("_inside") - 1)
        .drop("_start", "_inside", "_range")
    )


def rows_before(
    df: DataFrame,
    group: str,
    order: Sequence[Column],
    weight: str,
    name: str,
    rows_in_largest_group: int,
    window_rows: int = WINDOW_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """Add the sum of a whole-number weight over the rows before each row in its group; `order` must have no ties.

    As with positions(), a large group is sorted by range, summed within ranges and offset by the ranges before.
    """
    before = Window.unboundedPreceding, -1
    nothing = F.lit(0).cast("bigint")
    if rows_in_largest_group <= window_rows:
        earlier = Window.partitionBy(group).orderBy(*order).rowsBetween(*before)
        return df.withColumn(name, F.coalesce(F.sum(weight).over(earlier), nothing))

    spread = partitions or max(2, -(-rows_in_largest_group // window_rows) * 4)
    ranged = materialise(
        df.repartitionByRange(spread, F.col(group), *order).withColumn("_range", F.spark_partition_id()), "ranged"
    )
    sums = ranged.groupBy(group, "_range").agg(F.sum(weight).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(*before)
    starts = sums.select(group, "_range", F.coalesce(F.sum("_sum").over(earlier), nothing).alias("_start"))
    inside = Window.partitionBy(group, "_range").orderBy(*order).rowsBetween(*before)
    return (
        ranged.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), nothing))
        .join(F.broadcast(starts), [group, "_range"])
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_start", "_inside", "_range")
    )
