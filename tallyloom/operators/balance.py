"""Placing groups on partitions by size."""

from __future__ import annotations

import heapq
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import materialize

#: Parts of a partition's fair share. A group below one part is folded into a hash slot
#: of about that size, so a plan has at most ``2 * PARTS`` rows per partition.
PARTS = 100


def group_sizes(df: DataFrame, key: str) -> DataFrame:
    """``key, count``, largest first."""
    return df.groupBy(key).count().orderBy(F.desc("count"), key)


class Placement(NamedTuple):
    """Where groups go: the larger ones by ``key``, all others by the ``slot`` of their hash."""

    groups: DataFrame
    slots: DataFrame
    n_slots: int

    def with_partition(self, df: DataFrame, key: str) -> DataFrame:
        """Add ``partition`` without a shuffle: both tables have a bound and are broadcast."""
        groups = self.groups.select(F.col(key).alias("_key"), F.col("partition").alias("_group"))
        slots = self.slots.select(F.col("slot").alias("_slot"), F.col("partition").alias("_rest"))
        return (
            df.join(F.broadcast(groups), F.col(key).eqNullSafe(F.col("_key")), "left")
            .join(F.broadcast(slots), _slot(key, self.n_slots) == F.col("_slot"), "left")
            .withColumn("partition", F.coalesce("_group", "_rest"))
            .drop("_key", "_group", "_slot", "_rest")
        )


def _slot(key: str, n_slots: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_slots)).cast("int")


def place(sizes: DataFrame, key: str, n: int) -> Placement:
    """Largest unit first, each to the lightest of ``n`` partitions.

    A unit is a group that holds at least one part of a share, or a slot of smaller
    groups. The rule is the same at any number of groups, and every row counts. Ties go
    to groups before slots, to the smaller key and to the lowest partition. The driver
    sees the units, at most ``2 * PARTS * n``.
    """
    n_slots = n * PARTS
    total = sizes.agg(F.sum("count")).first()[0] or 0
    large = F.col("count") * n_slots >= total
    slotted = sizes.where(~large).groupBy(_slot(key, n_slots).alias("slot")).agg(F.sum("count").alias("count"))
    groups = sizes.where(large).orderBy(F.desc("count"), key).collect()
    slots = slotted.orderBy(F.desc("count"), "slot").collect()
    units = [(-r["count"], 0, i) for i, r in enumerate(groups)] + [(-r["count"], 1, i) for i, r in enumerate(slots)]
    loads = [(0, p) for p in range(n)]
    placed = ([], [])
    for size, kind, i in sorted(units):
        load, p = heapq.heappop(loads)
        heapq.heappush(loads, (load - size, p))
        placed[kind].append(((groups[i][key] if kind == 0 else slots[i]["slot"]), p))
    frame = sizes.sparkSession.createDataFrame
    return Placement(
        frame(placed[0], f"{key} {sizes.schema[key].dataType.simpleString()}, partition int"),
        frame(placed[1], "slot int, partition int"),
        n_slots,
    )


def plan_partitions(sizes: DataFrame, key: str, n: int) -> DataFrame:
    """``key, count, partition`` of every group, by :func:`place`."""
    return place(sizes, key, n).with_partition(sizes, key).select(key, "count", "partition")


def split_heavy_groups(df: DataFrame, key: str, sizes: DataFrame, n: int, spread: Column) -> DataFrame:
    """Add ``slice``: 0 for ordinary groups, hashed from ``spread`` for heavy ones.

    A group larger than a fair share of ``n`` partitions gets as many slices as it
    has shares, so (key, slice) can be balanced where whole groups cannot. There
    are at most ``n`` such groups, which bounds the broadcast side.
    """
    total = sizes.groupBy().sum("count").scalar()
    heavy = sizes.where(F.col("count") * n > total).select(
        F.col(key).alias("_key"), F.ceil(F.col("count") * n / total).alias("_slices")
    )
    return (
        df.join(F.broadcast(heavy), F.col(key).eqNullSafe(F.col("_key")), "left")
        .withColumn(
            "slice",
            F.coalesce(F.pmod(F.xxhash64(spread), F.col("_slices")), F.lit(0)).cast("int"),
        )
        .drop("_key", "_slices")
    )


def route(df: DataFrame, sizes: DataFrame, key: str, n: int) -> DataFrame:
    """Send each row to the partition its group is planned for, with that ``partition``.

    The only shuffle is the one to the partitions.
    """
    return place(sizes, key, n).with_partition(df, key).repartitionById(n, "partition")


def balance(df: DataFrame, key: str, n: int, spread: Column | None = None) -> DataFrame:
    """Rows on ``n`` partitions of even size, each group whole.

    With ``spread`` a group heavier than one partition's share is sliced first. The rows
    are written once, as they are read for the sizes and again for their places.
    """
    df = materialize(df, "unbalanced")
    sizes = df.groupBy(key).count()
    if spread is None:
        return route(df, sizes, key, n)
    sliced = split_heavy_groups(df, key, sizes, n, spread).withColumn("_part", F.struct(key, "slice"))
    sizes = sliced.groupBy("_part").count()
    return route(sliced, sizes, "_part", n).drop("_part", "slice")


def spread_evenly(df: DataFrame, n: int) -> DataFrame:
    """Rows dealt out evenly over ``n`` partitions."""
    return df.repartition(n)


def partition_loads(routed: DataFrame) -> DataFrame:
    """``partition, rows, tasks``: rows per planned partition and tasks that hold them."""
    return (
        routed.select("partition", F.spark_partition_id().alias("task"))
        .groupBy("partition")
        .agg(F.count("*").alias("rows"), F.countDistinct("task").alias("tasks"), F.max("task").alias("task"))
    )
