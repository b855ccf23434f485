"""Totals of a stream's windows, added where the windows close."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tallyloom.streaming import retweets as S

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "ts timestamp, tweet_id bigint, retweet_count bigint, text string, lang string"
ROUNDS = [
    [(2, 1, 10, "en"), (31, 1, 13, "en"), (40, 2, 5, "de"), (41, None, 4, "en"), (42, 5, 2, None), (62, 1, 20, "en"), (70, 3, 1, "fr")],
    [(200, 2, 9, "de"), (201, 2, 3, "de"), (201, 2, 3, "de"), (400, 4, 1, "en")],
    [(401, 4, 8, "en"), (900, 4, 1, "en")],
]


def feed(spark, folder):
    """A file per round, taken one by one, by age."""
    for i, part in enumerate(ROUNDS):
        rows = [(T0 + dt.timedelta(seconds=s), t, c, f"t{s}", lang) for s, t, c, lang in part]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/round={i}")
        for file in os.listdir(f"{folder}/round={i}"):
            os.utime(f"{folder}/round={i}/{file}", (T0.timestamp() + i,) * 2)
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/round=*")
    return S.windowed(source, watermark="0 seconds")


def wanted(spark, folder):
    tweets = S.windowed(spark.read.schema(SCHEMA).parquet(folder))
    ranked = S.with_language_totals(tweets, S.language_totals(tweets))
    return ranked.where(F.col("window.end") <= F.lit(T0 + dt.timedelta(seconds=900)))


def test_totals_of_closed_windows_equal_a_batch(spark, rows, tmp_path):
    folder = str(tmp_path / "feed")
    got = S.run_available(feed(spark, folder), "ranked", S.closed_with_totals)
    want = wanted(spark, folder)
    assert got.count() > 0
    assert rows(got.select(*want.columns)) == rows(want)


def test_log_adds_totals_without_a_join_of_streams(spark, rows, tmp_path):
    folder, out = str(tmp_path / "feed"), str(tmp_path / "log")
    query = S.start_log(feed(spark, folder), out, str(tmp_path / "checkpoint"), T0, None)
    query.awaitTermination()
    want = S.log_rows(S.after_warm_up(wanted(spark, folder), T0), T0)
    assert rows(spark.read.parquet(out).drop("batch_id")) == rows(want)
    # Panes and windows are folded once each; no operator holds rows for a join.
    assert [op.operatorName for op in query.lastProgress.stateOperators] == ["stateStoreSave", "stateStoreSave"]


def test_nothing_arrived(spark, tmp_path):
    folder = str(tmp_path / "feed")
    os.makedirs(folder)
    source = S.windowed(spark.readStream.schema(SCHEMA).parquet(folder), watermark="0 seconds")
    got = S.run_available(source, "ranked", S.closed_with_totals)
    assert got.count() == 0 and "total_in_language" in got.columns
