"""Group totals with a top item, and retweet totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import materialize


def top_pages(pages: DataFrame) -> DataFrame:
    """Per language: all views, and the title and views of its largest line.

    Lines whose title is the language itself are dropped. Of equal lines the
    greatest title wins. One shuffle, after a partial aggregate per task.
    """
    return (
        pages.where(F.col("lang") != F.col("title"))
        .groupBy(F.col("lang").alias("lang_code"))
        .agg(
            F.sum("views").alias("total_views"),
            F.max(F.struct("views", "title")).alias("top"),
        )
        .select(
            "lang_code",
            "total_views",
            F.col("top.title").alias("top_title"),
            F.col("top.views").alias("top_views"),
        )
    )


def top_pages_k(pages: DataFrame, k: int) -> DataFrame:
    """Per language: all views, and its ``k`` largest lines with ``rank``, title and views.

    Lines as in :func:`top_pages`; of equal views the greatest title comes first. Each task
    passes on at most ``k`` lines of a language, so a hot language costs ``k`` rows a task.
    """
    kept = pages.where(F.col("lang") != F.col("title")).select(F.col("lang").alias("lang_code"), "title", "views")
    order = Window.partitionBy("lang_code").orderBy(F.desc("views"), F.desc("title"))
    top = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    totals = kept.groupBy("lang_code").agg(F.sum("views").alias("total_views"))
    return totals.join(top, "lang_code").select("lang_code", "total_views", "rank", "title", "views")


def retweets_in_span() -> Column:
    """Retweets between the lowest and the highest count seen."""
    return F.col("max_rt") - F.col("min_rt") + 1


def tweets_over_all_windows(log: DataFrame) -> DataFrame:
    """Per tweet: highest and lowest count; language and text of the latest row.

    Of rows logged at the same second the greatest text wins.
    """
    return (
        log.groupBy("tweet_id")
        .agg(
            F.max("max_rt").alias("max_rt"),
            F.min("min_rt").alias("min_rt"),
            F.max(F.struct("seconds", "text", "language", "lang_code")).alias("last"),
        )
        .select("tweet_id", "max_rt", "min_rt", "last.language", "last.lang_code", "last.text")
    )


def totals_by_language(tweets: DataFrame) -> DataFrame:
    """Retweets per language name, tweets seen once count as one."""
    return tweets.groupBy("language").agg(F.sum(retweets_in_span()).alias("total_in_language"))


def retweet_ranking(tweets: DataFrame) -> DataFrame:
    """Tweets retweeted more than once, with the total of their language.

    Tweets are written once, as the totals are taken before the filter, and so are the
    totals: small ones are broadcast, else a language that holds much of the data is
    split by the adaptive sort-merge join.
    """
    tweets = materialize(tweets, "tweets")
    return (
        tweets.where(F.col("max_rt") > F.col("min_rt"))
        .join(materialize(totals_by_language(tweets), "totals"), "language")
        .select(
            "language",
            "lang_code",
            "total_in_language",
            "tweet_id",
            retweets_in_span().alias("retweets"),
            "text",
        )
    )
