"""Windowed retweets, as batch and as stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyloom.session import materialize, rocksdb_state, scratch_path
from tallyloom.sources.lines import read_lines
from tallyloom.sources.tail import tail_lines
from tallyloom.sources.weblogs import parse_retweet_log
from tallyloom.streaming import incremental
from tallyloom.streaming import retweets as S
from tallyloom.workload.registry import query, table
from tallyloom.workload.weblogs import LANG, NAMES, event_lang

SIZE, SLIDE = "6 hours", "30 minutes"
START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def statuses(events):
    """Status rows of events; views are no retweets."""
    original = F.struct(
        F.col("user_id").alias("id"),
        F.floor("value").alias("retweet_count"),
        F.concat("event_type", F.lit(",\n"), "props").alias("text"),
        event_lang().alias("lang"),
    )
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("id"),
        F.concat(F.lit("RT "), "props").alias("text"),
        F.when(F.col("event_type") != "view", original).alias("retweeted_status"),
    )


def batch_tweets(spark, sf_dir):
    return S.retweeted(statuses(table(spark, sf_dir, "events")))


def stream_tweets(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return S.retweeted(statuses(spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")))


def named(rows):
    """Window bounds as text, so that every engine prints them alike."""
    bound = lambda side: F.date_format(F.col(f"window.{side}"), "yyyy-MM-dd HH:mm:ss")
    return rows.select(
        bound("start").alias("window_start"),
        bound("end").alias("window_end"),
        *[c for c in rows.columns if c != "window"],
    )


BASE = f"""
t as (select ts, user_id as tweet_id, cast(floor(value) as bigint) as c, event_type || ',' || chr(10) || props as text, {LANG} as lang
      from events where event_type <> 'view'),
w as (select time_bucket(interval 30 minutes, ts, timestamp '1970-01-01') - k * interval 30 minutes as ws, t.*
      from t, unnest(generate_series(0, 11)) u(k)),
tw as (select ws, tweet_id, max(c) as max_rt, min(c) as min_rt, arg_max(text, ts) as text, arg_max(lang, ts) as lang
       from w group by ws, tweet_id),
tot as (select ws, lang, cast(sum(max_rt - min_rt + 1) as bigint) as total_in_language from tw group by ws, lang),
comp as (select time_bucket(interval 30 minutes, ws + interval 6 hours - interval 1 microsecond, timestamp '1970-01-01')
                - k * interval 30 minutes as ws, lang, cast(sum(max_rt - min_rt + 1) as bigint) as total_in_language
         from tw, unnest(generate_series(0, 11)) u(k) group by all),
joined as (select * from tw join tot using (ws, lang))
"""
BOUNDS = "strftime(ws, '%Y-%m-%d %H:%M:%S') as window_start, strftime(ws + interval 6 hours, '%Y-%m-%d %H:%M:%S') as window_end"
CLOSED = "ws + interval 6 hours <= (select max(ts) from t)"
TWEET_COLS = "tweet_id, max_rt, min_rt, text, lang"


@query(
    "retweets_only",
    f"""select strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, user_id as tweet_id, cast(floor(value) as bigint) as retweet_count,
    event_type || ',' || chr(10) || props as text, {LANG} as lang from events where event_type <> 'view'""",
)
def retweets_only(spark, sf_dir):
    """Through JSON, as the statuses would arrive."""
    form = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    rows = statuses(table(spark, sf_dir, "events")).select(F.to_json(F.struct("*"), form).alias("value"))
    parsed = rows.select(F.from_json("value", S.TWEET_SCHEMA, form).alias("s")).select("s.*")
    out = S.retweeted(parsed).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return out


@query("window_retweets_batch", f"with {BASE} select {BOUNDS}, {TWEET_COLS} from tw")
def window_retweets_batch(spark, sf_dir):
    return named(S.windowed(batch_tweets(spark, sf_dir), SIZE, SLIDE))


@query("window_retweets_stream", f"with {BASE} select {BOUNDS}, {TWEET_COLS} from tw where {CLOSED}")
def window_retweets_stream(spark, sf_dir):
    rows = S.windowed(stream_tweets(spark, sf_dir), SIZE, SLIDE, watermark="0 seconds")
    return named(S.run_available(rows, "windows"))


@query("window_totals_batch", f"with {BASE} select {BOUNDS}, lang, total_in_language from tot")
def window_totals_batch(spark, sf_dir):
    return named(S.language_totals(S.windowed(batch_tweets(spark, sf_dir), SIZE, SLIDE)))


@query("window_totals_stream", f"with {BASE} select {BOUNDS}, lang, total_in_language from tot where {CLOSED}")
def window_totals_stream(spark, sf_dir):
    tweets = S.windowed(stream_tweets(spark, sf_dir), SIZE, SLIDE, watermark="0 seconds")
    return named(S.run_available(S.language_totals(tweets), "totals"))


@query("window_totals_compounded", f"with {BASE} select {BOUNDS}, lang, total_in_language from comp")
def window_totals_compounded(spark, sf_dir):
    tweets = S.windowed(batch_tweets(spark, sf_dir), SIZE, SLIDE)
    return named(S.language_totals(tweets, True, SIZE, SLIDE))


@query(
    "window_totals_compounded_stream",
    f"with {BASE} select {BOUNDS}, lang, total_in_language from comp where {CLOSED}",
)
def window_totals_compounded_stream(spark, sf_dir):
    tweets = S.windowed(stream_tweets(spark, sf_dir), SIZE, SLIDE, watermark="0 seconds")
    return named(S.run_available(S.language_totals(tweets, True, SIZE, SLIDE), "compounded"))


@query(
    "window_totals_incremental_stream",
    f"with {BASE} select {BOUNDS}, lang, total_in_language from comp where {CLOSED}",
)
def window_totals_incremental_stream(spark, sf_dir):
    """The compounded totals, each from the one before by adding a window and subtracting one."""
    totals = S.language_totals(S.windowed(stream_tweets(spark, sf_dir), SIZE, SLIDE, watermark="0 seconds"))
    with rocksdb_state(spark):
        return named(S.run_available(incremental.compounded_totals(totals, SIZE, SLIDE), "incremental"))


@query("window_ranking_batch", f"with {BASE} select {BOUNDS}, {TWEET_COLS}, total_in_language from joined")
def window_ranking_batch(spark, sf_dir):
    tweets = materialize(S.windowed(batch_tweets(spark, sf_dir), SIZE, SLIDE), "windowed")
    return named(S.with_language_totals(tweets, S.language_totals(tweets)))


def _stream_windows(spark, sf_dir):
    """Windowed tweets; the totals are added to each micro-batch."""
    return S.windowed(stream_tweets(spark, sf_dir), SIZE, SLIDE, watermark="0 seconds")


@query("window_ranking_stream", f"with {BASE} select {BOUNDS}, {TWEET_COLS}, total_in_language from joined where {CLOSED}")
def window_ranking_stream(spark, sf_dir):
    return named(S.run_available(_stream_windows(spark, sf_dir), "ranking", S.closed_with_totals))


LOG_SQL = f"""with {BASE}
    select epoch(ws + interval 6 hours)::bigint - epoch(timestamp '2024-01-01')::bigint as seconds,
           coalesce(name, lang) as language, lang as lang_code, total_in_language, tweet_id, max_rt, min_rt,
           max_rt - min_rt + 1 as retweets, replace(text, chr(10), ' ') as text
    from joined left join {NAMES} on code = lang
    where {CLOSED} and ws + interval 6 hours >= timestamp '2024-01-01' + interval 30 hours"""


@query("window_log", LOG_SQL)
def window_log(spark, sf_dir):
    base = scratch_path(spark, "log")
    S.start_log(_stream_windows(spark, sf_dir), f"{base}/log", f"{base}/checkpoint", START, None, "30 hours").awaitTermination()
    return spark.read.parquet(f"{base}/log").drop("batch_id")


@query("window_log_text", LOG_SQL)
def window_log_text(spark, sf_dir):
    """The log as text with its heading, and parsed again."""
    base = scratch_path(spark, "text-log")
    query = S.start_log(_stream_windows(spark, sf_dir), f"{base}/log", f"{base}/checkpoint", START, None, "30 hours", text=True)
    query.awaitTermination()
    return parse_retweet_log(read_lines(spark, f"{base}/log")).rows


@query(
    "live_lines",
    "select doc_id || ' ' || source || ' ' || n_chars as value from documents",
)
def live_lines(spark, sf_dir):
    """Lines that arrive in two rounds at a live source; the second run goes on where the first one stopped."""
    base = scratch_path(spark, "live")
    lines = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws(" ", "doc_id", "source", "n_chars").alias("value"))
    for half in (0, 1):
        lines.where(F.col("doc_id") % 2 == half).select("value").write.mode("append").text(f"{base}/feed")
        writer = tail_lines(spark, f"{base}/feed", ".txt").writeStream.option("checkpointLocation", f"{base}/checkpoint")
        query = writer.option("path", f"{base}/taken").format("parquet").trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.schema("value string").parquet(f"{base}/taken")
