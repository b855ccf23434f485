"""Row numbers over an order that one task could not hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import materialize


def numbered(df: DataFrame, group: str, order: list[str], out: str = "n", label: str = "ordered") -> DataFrame:
    """Add 1-based ``out``: the place of each row in its ``group`` by ``order``.

    Rows are range-partitioned by group and order, so a group that holds much of the data
    is cut into several slices, and sorted in their slice. What is written is numbered in
    that order; a table with one row per slice and group carries the offsets. ``order``
    should name a unique key, which also lets a slice be cut anywhere.
    """
    ranged = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ranged = ranged.withColumns({"_slice": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    # Written once: the slice of a row must not change between the two uses.
    ranged = materialize(ranged, label)
    slices = ranged.groupBy(F.col(group).alias("_group"), F.col("_slice").alias("_of")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_rows")
    )
    before = Window.partitionBy("_group").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        slices.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows"), "offsets"
    )
    return (
        ranged.join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_slice") == F.col("_of")))
        .withColumn(out, F.col("_offset") + F.col("_at") - F.col("_first") + 1)
        .drop("_slice", "_at", "_group", "_of", "_first", "_offset")
    )
