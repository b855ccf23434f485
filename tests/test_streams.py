import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tallyloom.streaming import retweets as S

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def status(second, tweet=None, count=0, lang="en", text="hi"):
    ts = (T0 + dt.timedelta(seconds=second)).strftime("%Y-%m-%dT%H:%M:%SZ")
    row = {"ts": ts, "id": second, "text": "RT " + text}
    if tweet is not None:
        row["retweeted_status"] = {"id": tweet, "retweet_count": count, "text": text, "lang": lang}
    return row


FIRST = [
    status(1), status(2, 1, 10), status(31, 1, 13, text="hi\nyou"), status(40, 2, 5, "de"), status(62, 1, 20), status(70, 3, 1),
]
SECOND = [status(3, 1, 99), status(200, 2, 9, "de"), status(400, 4, 1)]


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()

    def add(name, statuses):
        file = folder / f"{name}.json"
        file.write_text("\n".join(json.dumps(s) for s in statuses))
        # Files are taken by age, in whole milliseconds.
        age = T0.timestamp() + len(list(folder.iterdir()))
        os.utime(file, (age, age))

    return str(folder), add


def ranked(spark, path, **options):
    tweets = S.windowed(S.retweeted(S.read_tweets(spark, path)), watermark="0 seconds", **options)
    return S.with_language_totals(tweets, S.language_totals(tweets))


def test_retweets_only(spark, feed, rows):
    path, add = feed
    add("a", FIRST)
    batch = spark.read.schema(S.TWEET_SCHEMA).json(path)
    assert rows(S.retweeted(batch), "tweet_id", "retweet_count", "lang")[:2] == [(1, 10, "en"), (1, 13, "en")]
    assert S.retweeted(batch).count() == 5


def test_window_values(spark, feed, rows):
    path, add = feed
    add("a", FIRST)
    batch = S.windowed(S.retweeted(spark.read.schema(S.TWEET_SCHEMA).json(path)))
    end = F.date_format("window.end", "mm:ss")
    at_minute = batch.where(end == "01:00")
    assert rows(at_minute, "tweet_id", "max_rt", "min_rt", "text", "lang") == [
        (1, 13, 10, "hi\nyou", "en"), (2, 5, 5, "hi", "de")
    ]
    totals = S.language_totals(batch).where(end == "01:00")
    assert rows(totals, "lang", "total_in_language") == [("de", 1), ("en", 4)]
    # Twelve windows end in the minute before 01:00: tweet 1 counts 1 until 00:30, 4 from 00:35 on.
    compounded = S.language_totals(batch, compounded=True).where(end == "01:00")
    assert dict(rows(compounded, "lang", "total_in_language"))["en"] == 6 * 1 + 6 * 4


def test_stream_equals_batch_and_drops_late_rows(spark, feed, rows, tmp_path):
    """Two runs on one checkpoint; the late row of the second run changes nothing."""
    path, add = feed
    out, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")

    def run():
        query = S.start_log(ranked(spark, path), out, checkpoint, T0, interval=None)
        query.awaitTermination()
        return sum(
            int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in map(dict, p["stateOperators"])
        )

    add("a", FIRST)
    assert run() == 0
    add("b", SECOND)
    assert run() > 0

    on_time = spark.createDataFrame(
        [json.dumps(s) for s in FIRST + SECOND[1:]], "string"
    ).select(F.from_json("value", S.TWEET_SCHEMA).alias("s")).select("s.*")
    tweets = S.windowed(S.retweeted(on_time))
    batch = S.with_language_totals(tweets, S.language_totals(tweets))
    closed = batch.where(F.col("window.end") <= F.lit(T0 + dt.timedelta(seconds=400)))
    want = S.log_rows(S.after_warm_up(closed, T0), T0)
    logged = spark.read.parquet(out).drop("batch_id")
    assert rows(logged) == rows(want)
    assert logged.agg(F.min("seconds")).first()[0] == 60
    assert logged.where(F.col("text").contains("\n")).count() == 0


def test_batch_written_twice_is_logged_once(spark, feed, rows, tmp_path):
    path, add = feed
    add("a", FIRST)
    tweets = S.windowed(S.retweeted(spark.read.schema(S.TWEET_SCHEMA).json(path)))
    joined = S.with_language_totals(tweets, S.language_totals(tweets))
    out = str(tmp_path / "log")
    for _ in range(2):
        S.write_log_batch(joined, 0, out, T0)
    assert spark.read.parquet(out).count() == S.after_warm_up(joined, T0).count()


@pytest.mark.parametrize("salts", [1, 5])
def test_salts_do_not_change_the_join(spark, feed, rows, salts):
    path, add = feed
    add("a", FIRST)
    tweets = S.windowed(S.retweeted(spark.read.schema(S.TWEET_SCHEMA).json(path)))
    totals = S.language_totals(tweets)
    got = S.with_language_totals(tweets, totals, salts)
    want = tweets.join(totals, ["window", "lang"])
    assert rows(got.select(*want.columns)) == rows(want)


GAPPED = [
    [status(1, 1, 10), status(2, 2, 5, "de"), status(14, 1, 30)],
    [status(33, 2, 8, "de"), status(61, 1, 31)],
    [status(150, 1, 40), status(151, 3, 2, "fr"), status(152, 1, 44)],
    [status(153, 3, 9, "fr"), status(420, 1, 50), status(421, 2, 70, "de")],
    [status(700, 4, 1, "es")],
]


def test_incremental_totals_over_gaps_and_a_restart(spark, feed, rows, tmp_path):
    """Files arrive one by one; the second run goes on with the first one's state."""
    from tallyloom.streaming import incremental

    path, add = feed
    out, checkpoint = str(tmp_path / "totals"), str(tmp_path / "checkpoint")

    def run():
        source = spark.readStream.schema(S.TWEET_SCHEMA).option("maxFilesPerTrigger", 1).json(path)
        totals = S.language_totals(S.windowed(S.retweeted(source), watermark="0 seconds"))
        writer = incremental.compounded_totals(totals, S.WINDOW, S.SLIDE).writeStream.outputMode("append")
        writer = writer.option("checkpointLocation", checkpoint).option("path", out).format("parquet")
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return [dict(op) for op in query.recentProgress[-1]["stateOperators"]]

    for i, part in enumerate(GAPPED[:3]):
        add(f"{i}", part)
    run()
    first = spark.read.parquet(out).count()
    assert first > 0
    for i, part in enumerate(GAPPED[3:], 3):
        add(f"{i}", part)
    operators = run()
    everything = [json.dumps(s) for part in GAPPED for s in part]
    batch = spark.createDataFrame(everything, "string").select(F.from_json("value", S.TWEET_SCHEMA).alias("s")).select("s.*")
    want = S.language_totals(S.windowed(S.retweeted(batch)), compounded=True)
    closed = want.where(F.col("window.end") <= F.lit(T0 + dt.timedelta(seconds=700)))
    got = spark.read.parquet(out)
    assert rows(got, "window", "lang", "total_in_language") == rows(closed, "window", "lang", "total_in_language")
    assert got.count() > first
    rings = next(op for op in operators if "transformWithState" in op["operatorName"])
    assert int(rings["numRowsTotal"]) <= 8  # silent languages have left; a ring and a timer for each of the others


def test_ring_needs_whole_slides(spark):
    from tallyloom.streaming import incremental

    with pytest.raises(ValueError):
        incremental.compounded_totals(spark.range(1), "60 seconds", "7 seconds")
