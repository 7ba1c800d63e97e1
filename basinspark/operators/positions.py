"""Row positions and running counts in a total order, without putting a whole group into one task.

A window that is partitioned by a group key sorts the whole group in one task. Here the rows are range-partitioned by
(group, order) instead, so that a large group is spread over many tasks; only the sizes of the slices, one row per
group and sort partition, are added up across tasks. The sorted rows are written first, because slice sizes and rows
must come from the same partition boundaries even when a task is run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basinspark.session import persisted

_SLICE = "_slice"
_ROW = "_row"
_ROW_BITS = (1 << 33) - 1


def with_position(df: DataFrame, order: Sequence[str], out: str = "position") -> DataFrame:
    """Number the rows 0, 1, 2, … in the order of the columns ``order``, which should identify a row."""
    placed = persisted(
        df.orderBy(*order).withColumns({_SLICE: F.spark_partition_id(), _ROW: F.monotonically_increasing_id()})
    )
    before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(_SLICE).agg(F.count(F.lit(1)).alias("_size"))
    # One row per sort partition, so both this window and the broadcast are bounded by the number of partitions.
    starts = sizes.select(_SLICE, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), _SLICE)
        .withColumn(out, F.col("_start") + F.col(_ROW).bitwiseAND(F.lit(_ROW_BITS)))
        .drop(_SLICE, _ROW, "_start")
    )


def value_counts_in_order(df: DataFrame, keys: Sequence[str], value: str) -> tuple[DataFrame, DataFrame]:
    """Distinct values of each group with their number of rows, cut into slices, and the table of slices.

    A slice is the part of one group in one sort partition. The slice table holds ``start``, the rows of the group in
    earlier slices, ``size`` and ``total``, the rows of the whole group.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    placed = persisted(counts.orderBy(*keys, value).withColumn(_SLICE, F.spark_partition_id()))
    sizes = placed.groupBy(*keys, _SLICE).agg(F.sum("n").alias("size"))
    # At most one row per sort partition in each window group.
    group = Window.partitionBy(*keys)
    earlier = group.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    slices = sizes.withColumns(
        {"start": F.coalesce(F.sum("size").over(earlier), F.lit(0)), "total": F.sum("size").over(group)}
    )
    return placed, slices


def running_counts(placed: DataFrame, slices: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows of the group before each distinct value (``before``), from slices of :func:`value_counts_in_order`."""
    within = (
        Window.partitionBy(*keys, _SLICE).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.join(slices, [*keys, _SLICE])
        .withColumn("before", F.col("start") + F.sum("n").over(within) - F.col("n"))
        .select(*keys, value, "n", "before", "total")
    )
