"""Column expressions and small helpers that several operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Six characters, as the contracts name them: space, tab, line feed, vertical tab, form feed, return.
ASCII_SPACE = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z alone; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id gives null."""
    return F.crc32(doc_id.cast("string")) % divisor


def row_ids(df: DataFrame, out: str = "__row") -> DataFrame:
    """Number rows by input split and place in the split.

    The numbers are stable as long as the input files are: Spark forms the same
    splits from the same files. Callers that shuffle must write the rows first.
    """
    return df.withColumn(out, F.monotonically_increasing_id())
