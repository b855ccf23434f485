"""Cast lists: one block per person, blocks parted by an empty line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import FIRST_YEAR, movie_key
from tallyloom.sources.lines import Parsed, split_rejects


def read_cast_blocks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value``, one row per block; plain files are split, compressed ones are not."""
    return spark.read.option("lineSep", "\n\n").text(path)


def parse_cast_blocks(
    blocks: DataFrame, sex: bool, first_year: int = FIRST_YEAR, on_error: str = "quarantine"
) -> Parsed:
    """``name, sex, movies``; people without a kept movie are left out.

    A block without a TAB is a reject.
    """
    block = F.regexp_replace("value", "^\n+|\n+$", "")
    fields = F.split(block, "\t", 2)
    keys = F.transform(F.split(F.get(fields, 1), "\n"), lambda line: movie_key(line, first_year))
    parsed = blocks.where(block != "").select(
        "value",
        F.get(fields, 0).alias("name"),
        F.lit(sex).alias("sex"),
        F.filter(keys, lambda m: m.isNotNull()).alias("movies"),
    )
    rows, rejects = split_rejects(parsed, F.col("movies").isNotNull(), "value", on_error)
    return Parsed(rows.where(F.size("movies") > 0), rejects)
