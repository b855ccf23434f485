"""Page-count lines and retweet log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyloom.functions.text import language_of_project, to_bigint
from tallyloom.sources.lines import Parsed, split_rejects, with_fields


def parse_pagecounts(lines: DataFrame, on_error: str = "quarantine", counter: Observation | str | None = None) -> Parsed:
    """``project, lang, title, views, bytes`` of blank-separated lines."""
    fields = F.col("fields")
    parsed = with_fields(lines, " ").select(
        "value",
        F.get(fields, 0).alias("project"),
        language_of_project(F.get(fields, 0)).alias("lang"),
        F.get(fields, 1).alias("title"),
        to_bigint(F.get(fields, 2)).alias("views"),
        to_bigint(F.get(fields, 3)).alias("bytes"),
    )
    return split_rejects(parsed, F.col("views").isNotNull(), "value", on_error, counter)


# Fixed value: headings of the log.
RETWEET_LOG_HEADER = (
    "Seconds,Language,Language-code,TotalRetweetsInThatLang,IDOfTweet,"
    "MaxRetweetCount,MinRetweetCount,RetweetCount,Text"
)


def parse_retweet_log(lines: DataFrame, on_error: str = "quarantine", counter: Observation | str | None = None) -> Parsed:
    """Nine columns of a retweet log; the text keeps its commas, headers are dropped."""
    fields = F.col("fields")
    number = lambda i: to_bigint(F.get(fields, i))
    parsed = with_fields(lines.where(~F.col("value").startswith("Seconds,")), ",", 9).select(
        "value",
        to_bigint(F.regexp_replace(F.get(fields, 0), r"^\((.*)\)$", "$1")).alias("seconds"),
        F.get(fields, 1).alias("language"),
        F.get(fields, 2).alias("lang_code"),
        number(3).alias("total_in_language"),
        number(4).alias("tweet_id"),
        number(5).alias("max_rt"),
        number(6).alias("min_rt"),
        number(7).alias("retweets"),
        F.get(fields, 8).alias("text"),
    )
    numbers = ("tweet_id", "max_rt", "min_rt")
    valid = F.lit(True)
    for name in numbers:
        valid = valid & F.col(name).isNotNull()
    return split_rejects(parsed, valid & F.col("text").isNotNull(), "value", on_error, counter)
