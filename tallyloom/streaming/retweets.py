"""Sliding-window retweet counts. The same functions serve batch and stream frames."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom.functions.langnames import with_language_name
from tallyloom.functions.text import one_line
from tallyloom.operators.ranking import retweets_in_span
from tallyloom.session import materialize, scratch_path, scratch_tables
from tallyloom.sources.single_file import write_single_file
from tallyloom.sources.weblogs import RETWEET_LOG_HEADER

# Window, slide and batch interval of the log.
WINDOW = "60 seconds"
SLIDE = "5 seconds"
BATCH_INTERVAL = "5 seconds"
WARM_UP = "60 seconds"

TWEET_SCHEMA = (
    "ts timestamp, id bigint, text string, "
    "retweeted_status struct<id: bigint, retweet_count: bigint, text: string, lang: string>"
)


def read_tweets(spark: SparkSession, path: str, fmt: str = "json", schema: str = TWEET_SCHEMA) -> DataFrame:
    """Status objects that arrive as files; any other stream of this schema will do."""
    return spark.readStream.schema(schema).format(fmt).load(path)


def retweeted(tweets: DataFrame) -> DataFrame:
    """``ts`` and the fields of the original tweet, of retweets only."""
    return tweets.where(F.col("retweeted_status").isNotNull()).select(
        "ts",
        F.col("retweeted_status.id").alias("tweet_id"),
        F.col("retweeted_status.retweet_count").alias("retweet_count"),
        F.col("retweeted_status.text").alias("text"),
        F.col("retweeted_status.lang").alias("lang"),
    )


def windowed(tweets: DataFrame, size: str = WINDOW, slide: str = SLIDE, watermark: str | None = None) -> DataFrame:
    """Per window and tweet: highest and lowest count; text and language of the latest row.

    Rows are folded once per pane, ``slide`` long; windows are made of panes. A row is
    thus copied to its windows only as part of its pane. ``size`` must be a multiple of
    ``slide``. ``watermark`` is how late a row may be; a batch frame needs none.
    """
    if pd.Timedelta(size) % pd.Timedelta(slide):
        raise ValueError(f"{size} is no multiple of {slide}")
    if not tweets.isStreaming:
        return _windowed_batch(tweets, size, slide)
    if watermark is not None:
        tweets = tweets.withWatermark("ts", watermark)
    panes = tweets.groupBy(F.window("ts", slide), "tweet_id").agg(
        F.max("retweet_count").alias("max_rt"),
        F.min("retweet_count").alias("min_rt"),
        F.max(F.struct("ts", "text", "lang")).alias("last"),
    )
    return (
        panes.groupBy(F.window("window", size, slide), "tweet_id")
        .agg(F.max("max_rt").alias("max_rt"), F.min("min_rt").alias("min_rt"), F.max("last").alias("last"))
        .select("window", "tweet_id", "max_rt", "min_rt", "last.text", "last.lang")
    )


def _windowed_batch(tweets: DataFrame, size: str, slide: str) -> DataFrame:
    """:func:`windowed` of a batch frame, in which a tweet's panes are in order, so no window is folded.

    A window's latest pane with rows has its latest row. Each pane thus makes the windows in
    which no later pane of its tweet lies, and finds their counts among the panes that end within
    ``size``. Only panes are shuffled and sorted, never their copies in windows.
    """
    length, step = (int(pd.Timedelta(x).value // 1000) for x in (size, slide))
    slots = length // step
    # Numbers and times as keys: they sort by prefix, a struct of bounds doesn't.
    panes = tweets.groupBy(F.unix_micros(F.window("ts", slide)["start"]).alias("pane"), "tweet_id").agg(
        F.max("retweet_count").alias("max_rt"),
        F.min("retweet_count").alias("min_rt"),
        F.max(F.struct("ts", "text", "lang")).alias("last"),
    )
    in_order = Window.partitionBy("tweet_id").orderBy("pane")
    held = F.collect_list(F.struct("pane", "max_rt", "min_rt")).over(in_order.rangeBetween(step - length, Window.currentRow))
    panes = panes.withColumns({"held": held, "next": F.lead("pane").over(in_order)})
    # The last pane of each window that this pane closes.
    ends = F.sequence("pane", F.least(F.col("pane") + (slots - 1) * step, F.col("next") - step), F.lit(step))
    rows = panes.withColumn("end_pane", F.explode(ends))
    inside = lambda field: F.transform(F.filter("held", lambda p: p["pane"] > F.col("end_pane") - length), lambda p: p[field])
    start = F.col("end_pane") + step - length
    window = F.struct(F.timestamp_micros(start).alias("start"), F.timestamp_micros(start + length).alias("end"))
    return rows.select(
        window.alias("window", metadata={"spark.timeWindow": True}),  # so that windows can be made of it
        "tweet_id",
        F.array_max(inside("max_rt")).alias("max_rt"),
        F.array_min(inside("min_rt")).alias("min_rt"),
        "last.text",
        "last.lang",
    )


def language_totals(
    tweets: DataFrame, compounded: bool = False, size: str = WINDOW, slide: str = SLIDE
) -> DataFrame:
    """Retweets per window and language.

    By default the total of the same window. ``compounded`` adds up all windows that
    ended within the last ``size``, as a window over a window does.
    """
    over = F.window("window", size, slide) if compounded else F.col("window")
    return tweets.groupBy(over.alias("window"), "lang").agg(
        F.sum(retweets_in_span()).alias("total_in_language")
    )


def with_language_totals(tweets: DataFrame, totals: DataFrame, salts: int | None = None) -> DataFrame:
    """Windowed tweets with the total of their language and window.

    Each total is copied once per salt and a tweet meets the copy of its own salt, so
    that one language spreads over as many join tasks as there are shuffle partitions. In a
    batch the totals are written: their size tells whether they are broadcast, and adaptive
    execution splits a hot language otherwise.
    """
    if not tweets.isStreaming and salts is None:
        return tweets.join(materialize(totals, "language-totals"), ["window", "lang"])
    salts = salts or int(tweets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = tweets.withColumn("salt", F.pmod(F.xxhash64("tweet_id"), F.lit(salts)))
    right = totals.withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    )
    return left.join(right, ["window", "lang", "salt"]).drop("salt")


def closed_with_totals(batch: DataFrame, session: SparkSession) -> DataFrame:
    """:func:`windowed` tweets of one micro-batch with the total of their language and window.

    All tweets of a window leave a stream in the micro-batch that closes it, so its totals are sums
    of that batch: the stream folds its windows once, and no row waits in a join of two streams.
    The rows are written; ``session`` goes on with them, since a micro-batch's own has adaptive execution off.
    """
    tweets = materialize(batch, "closed-windows", session)
    return with_language_totals(tweets, language_totals(tweets))


def after_warm_up(rows: DataFrame, start, warm_up: str = WARM_UP) -> DataFrame:
    """Windows that end no sooner than ``warm_up`` after ``start``."""
    return rows.where(F.col("window.end") >= F.lit(start) + F.expr(f"interval {warm_up}"))


def log_rows(rows: DataFrame, start) -> DataFrame:
    """Nine log columns, ordered by language total, language and retweets."""
    seconds = F.unix_timestamp(F.col("window.end")) - F.unix_timestamp(F.lit(start))
    return (
        with_language_name(rows, "lang")
        .select(
            seconds.alias("seconds"),
            "language",
            F.col("lang").alias("lang_code"),
            "total_in_language",
            "tweet_id",
            "max_rt",
            "min_rt",
            retweets_in_span().alias("retweets"),
            one_line(F.col("text")).alias("text"),
        )
        .orderBy("seconds", F.desc("total_in_language"), F.desc("lang_code"), F.desc("retweets"), "tweet_id")
    )


@contextmanager
def _log_rows_kept(batch: DataFrame, start, warm_up: str, written: bool) -> Iterator[DataFrame]:
    """Rows after the warm-up, persisted unless they are ``written``: their order is sampled before they are logged."""
    batch = after_warm_up(batch, start, warm_up)
    if written:
        yield batch
        return
    batch.persist()
    try:
        yield batch
    finally:
        batch.unpersist()


def write_log_batch(
    batch: DataFrame, batch_id: int, path: str, start, warm_up: str = WARM_UP, written: bool = False
) -> None:
    """One micro-batch as ordered Parquet below ``batch_id=<n>``, replacing an earlier try."""
    with _log_rows_kept(batch, start, warm_up, written) as kept:
        log_rows(kept, start).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_log_text(
    batch: DataFrame, batch_id: int, path: str, start, warm_up: str = WARM_UP, written: bool = False
) -> None:
    """One micro-batch as ordered text under the log's heading, in a file of its own that replaces an earlier try.

    Fields are set apart by commas; the text, which comes last, keeps its own. A batch
    without rows leaves no file. :func:`~tallyloom.sources.weblogs.parse_retweet_log` reads it.
    """
    with _log_rows_kept(batch, start, warm_up, written) as kept:
        if not kept.isEmpty():
            rows = log_rows(kept, start)
            lines = rows.select(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns]).alias("value"))
            write_single_file(lines, f"{path}/batch-{batch_id:09d}.csv", [RETWEET_LOG_HEADER])


def start_log(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    start,
    interval: str | None = BATCH_INTERVAL,
    warm_up: str = WARM_UP,
    text: bool = False,
) -> StreamingQuery:
    """Log each micro-batch with :func:`write_log_batch`, or as ``text`` with :func:`write_log_text`.

    Windowed tweets without totals get those of their micro-batch (:func:`closed_with_totals`). A batch that runs again after a failure replaces its own folder or file, so nothing is
    logged twice. ``interval=None`` processes what is there and stops.
    """
    how = write_log_text if text else write_log_batch
    spark, ranked = rows.sparkSession, "total_in_language" in rows.columns

    def write(batch: DataFrame, batch_id: int) -> None:
        if ranked:
            how(batch, batch_id, path, start, warm_up)
            return
        with scratch_tables():
            how(closed_with_totals(batch, spark), batch_id, path, start, warm_up, written=True)

    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def run_available(
    rows: DataFrame, label: str, each: Callable[[DataFrame, SparkSession], DataFrame] | None = None
) -> DataFrame:
    """Run a stream over what has arrived, append its rows to files and read them back.

    With ``each``, what it makes of every micro-batch, given that and the session; a batch that
    runs again replaces its own folder.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    schemas = [] if each else [rows.schema]

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch_tables():
            made = each(batch, spark)
            made.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        schemas.append(made.schema)

    writer = rows.writeStream.outputMode("append").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    writer = writer.foreachBatch(write) if each else writer.option("path", f"{path}/rows").format("parquet")
    writer.start().awaitTermination()
    if not schemas:  # nothing has arrived
        return each(spark.createDataFrame([], rows.schema), spark)
    return spark.read.schema(schemas[0]).parquet(f"{path}/rows").select(*schemas[0].names)
