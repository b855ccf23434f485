"""Text lines, with and without their position."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.session import materialize



class Parsed(NamedTuple):
    """Rows that parsed, and the source lines that did not."""

    rows: DataFrame
    rejects: DataFrame


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value``, one row per line; compressed files are read as they are."""
    return spark.read.text(path)


def split_rejects(
    parsed: DataFrame, valid, line: str, on_error: str = "quarantine", counter: Observation | str | None = None
) -> Parsed:
    """Separate rows by ``valid``; the rejects keep the source line in ``line``.

    ``on_error`` is ``quarantine`` (rejects returned), ``drop`` (rejects empty) or
    ``fail`` (the job stops at the first bad line). ``counter`` is an observation, or in a
    stream a name, that counts ``lines`` and ``rejects`` while the rows are computed: no
    pass of its own.
    """
    if on_error not in ("quarantine", "drop", "fail"):
        raise ValueError(f"on_error: {on_error!r}")
    ok = F.coalesce(valid, F.lit(False))
    if on_error == "fail":
        message = F.concat(F.lit("malformed line: "), F.col(line))
        ok = F.when(ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    rejects = parsed.where(~ok if on_error == "quarantine" else F.lit(False)).select(line)
    if counter is not None:
        parsed = parsed.observe(counter, F.count(F.lit(1)).alias("lines"), F.count_if(~ok).alias("rejects"))
    return Parsed(parsed.where(ok).drop(line), rejects)


def with_fields(lines: DataFrame, separator: str, limit: int = -1) -> DataFrame:
    """Add ``fields``, the line cut at ``separator``.

    The cut goes through a generator of one row, which keeps the optimizer from
    copying it into every filter and column that uses a field.
    """
    return lines.select("value", F.explode(F.array(F.split("value", separator, limit))).alias("fields"))


def _path_hash(file: str) -> Column:
    return F.unhex(F.md5(file)).alias("path")


def number_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``pos, value``: zero-based line number over all files, in path order.

    Pass one counts lines per input block; its result has one row per block and is
    written. Pass two adds the block's offset to the row's place inside the block. The
    offsets are written too and carry a hash for the path, so they stay narrow and the
    planner knows their size. Should the blocks differ between the passes, the job stops
    instead of numbering wrongly; pin ``spark.sql.files.minPartitionNum`` where executors
    come and go.
    """
    raw = read_lines(spark, path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    # One table of blocks, cut into slices of the path order, so no task sees a row per block
    # of everything: numbers are added up within slices, then over the slices.
    blocks = raw.groupBy("file", "block").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    blocks = materialize(
        blocks.repartitionByRange("file", "block").select("*", F.spark_partition_id().alias("slice")), "blocks"
    )
    before = lambda window: window.rowsBetween(Window.unboundedPreceding, -1)
    offset = lambda column, window: F.coalesce(F.sum(column).over(before(window)), F.lit(0))
    slices = blocks.groupBy("slice").agg(F.sum("n").alias("lines"))
    slices = slices.select("slice", offset("lines", Window.orderBy("slice")).alias("slice_offset"))
    in_slice = offset("n", Window.partitionBy("slice").orderBy("file", "block"))
    offsets = materialize(
        blocks.join(slices, "slice").select(_path_hash("file"), "block", "first", "n", (F.col("slice_offset") + in_slice).alias("offset")),
        "block-offsets",
    )
    in_block = F.col("row") - F.col("first")
    moved = F.col("offset").isNull() | (in_block < 0) | (in_block >= F.col("n"))
    stop = F.raise_error(F.lit("input blocks changed between passes")).cast("bigint")
    return raw.withColumn("path", _path_hash("file")).join(offsets, ["path", "block"], "left").select(
        F.when(moved, stop).otherwise(F.col("offset") + in_block).alias("pos"), "value"
    )
