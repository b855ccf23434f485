"""Sorting and comparing variant call sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.genome import variant_key
from tallyloom.sources.lines import with_fields


def sort_calls(calls: DataFrame) -> DataFrame:
    """By chromosome number and position; names without a number come last."""
    return calls.orderBy(F.asc_nulls_last("chrom_num"), "chrom", "pos", "line")


def call_keys(lines: DataFrame) -> DataFrame:
    """``key`` of each call line; comments, blank and short lines have none."""
    calls = with_fields(lines.where(~F.col("value").startswith("#")), r"\s+")
    fields = F.col("fields")
    return calls.where((F.size(fields) >= 5) & fields[0].contains("chr")).select(
        variant_key(fields).alias("key")
    )


def shared_keys(truth: DataFrame, calls: DataFrame) -> DataFrame:
    """Distinct keys of ``truth`` that ``calls`` has as well."""
    return truth.distinct().join(calls.distinct(), "key", "left_semi")


def missed_keys(truth: DataFrame, calls: DataFrame) -> DataFrame:
    """Distinct keys of ``truth`` that ``calls`` lacks."""
    return truth.distinct().join(calls.distinct(), "key", "left_anti")


def concordance(truth: DataFrame, calls: DataFrame) -> DataFrame:
    """``total, matches, diff, extra`` of distinct keys, from a single shuffle by key."""
    both = truth.select("key", F.lit(1).alias("t"), F.lit(0).alias("c")).unionAll(
        calls.select("key", F.lit(0).alias("t"), F.lit(1).alias("c"))
    )
    seen = both.groupBy("key").agg(F.max("t").alias("t"), F.max("c").alias("c"))
    n = lambda cond: F.count(F.when(cond, 1))
    in_truth, in_calls = F.col("t") == 1, F.col("c") == 1
    return seen.agg(
        n(in_truth).alias("total"),
        n(in_truth & in_calls).alias("matches"),
        n(in_truth & ~in_calls).alias("diff"),
        n(~in_truth & in_calls).alias("extra"),
    )
