import datetime as dt

from pyspark.sql import functions as F

from tallyloom.streaming import retweets as S

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "ts timestamp, tweet_id bigint, retweet_count bigint, text string, lang string"


def tweets(spark):
    at = lambda second: T0 + dt.timedelta(seconds=second)
    rows = [(at(s), t, c, f"t{s % 7}", lang) for s, t, c, lang in [
        (0, 1, 5, "en"), (0, 1, 9, "de"), (4, 1, 2, "en"), (5, 1, None, "en"), (61, 1, 7, "fr"), (300, 1, 1, None),
        (33, None, 4, "en"), (34, None, 3, "en"), (-1, 2, 8, "en"), (-62, 2, 6, "xx"), (59, 2, 6, None),
    ]]
    return spark.createDataFrame([*rows, (None, 3, 1, "none", "en")], SCHEMA)


def test_batch_windows_equal_folded_rows(spark, rows):
    got = S.windowed(tweets(spark), "60 seconds", "5 seconds")
    want = tweets(spark).groupBy(F.window("ts", "60 seconds", "5 seconds"), "tweet_id").agg(
        F.max("retweet_count").alias("max_rt"), F.min("retweet_count").alias("min_rt"), F.max(F.struct("ts", "text", "lang")).alias("last")
    ).select("window", "tweet_id", "max_rt", "min_rt", "last.text", "last.lang")
    columns = ["window.start", "window.end", *want.columns[1:]]
    assert got.dtypes == want.dtypes
    assert rows(got, *columns) == rows(want, *columns)


def test_batch_windows_shuffle_and_sort_panes_alone(spark):
    plan = S.windowed(tweets(spark), "60 seconds", "5 seconds")._jdf.queryExecution().executedPlan().toString()
    copies = plan.index("Generate explode")
    assert "Exchange" not in plan[:copies] and "Sort" not in plan[:copies]
