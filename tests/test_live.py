"""The live source, the single file and the counters."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallyloom.sources import single_file, sinks, tail
from tallyloom.sources.alignments import parse_sam, read_dictionary
from tallyloom.sources.weblogs import parse_pagecounts, parse_retweet_log
from tallyloom.streaming import retweets as S
from tallyloom.streaming.counters import count_streams, counted


def run(frame, out, checkpoint):
    writer = frame.writeStream.option("checkpointLocation", checkpoint).option("path", out).format("parquet")
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


@pytest.mark.parametrize("most", [7, 1 << 20])
def test_appended_lines_are_read_once(spark, rows, tmp_path, most):
    """Files grow between runs; a line under way waits; spans of a few bytes cut no line."""
    folder = tmp_path / "feed"
    folder.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    taken = lambda: rows(spark.read.schema("value string").parquet(out))
    go = lambda: run(tail.tail_lines(spark, str(folder), ".log", most), out, checkpoint)
    (folder / "a.log").write_text("one\ntwo is longer than a span\n\nunder w")
    (folder / "b.log").write_text("é😀\r\n")
    (folder / "other.txt").write_text("no\n")
    (folder / ".hidden.log").write_text("no\n")
    go()
    first = [("",), ("one",), ("two is longer than a span",), ("é😀",)]
    assert taken() == sorted(first)
    with open(folder / "a.log", "a") as file:
        file.write("ay\none\n")
    (folder / "c.log").write_text("new\nno end")
    go()
    want = sorted([*first, ("under way",), ("one",), ("new",)])
    assert taken() == want
    go()
    assert taken() == want
    (folder / "b.log").unlink()  # moved away
    with open(folder / "c.log", "a") as file:
        file.write("\n")
    go()
    assert taken() == sorted([*want, ("no end",)])


def test_offsets_replay_the_same_lines(tmp_path):
    (tmp_path / "x").write_text("".join(f"line {i}\n" for i in range(50)))
    reader = tail.TailReader({"path": f"file:{tmp_path}", "maxbytesperpartition": "40"})
    start, end = reader.initialOffset(), reader.latestOffset()
    (tmp_path / "x").open("a").write("later\n")
    read = lambda: [v for span in reader.partitions(start, end) for (v,) in reader.read(span)]
    assert read() == [f"line {i}" for i in range(50)] and read() == read()
    after = reader.latestOffset()
    assert [v for span in reader.partitions(end, after) for (v,) in reader.read(span)] == ["later"]
    (tmp_path / "x").write_text("short\n")
    with pytest.raises(ValueError, match="shrunk"):
        reader.latestOffset()


def test_single_file_of_many_parts(spark, tmp_path):
    path = tmp_path / "deep" / "all.txt"
    lines = spark.range(5000, numPartitions=9).select(F.format_string("%05d é", "id").alias("value"))
    for _ in range(2):  # replaced as a whole
        assert single_file.write_single_file(lines.orderBy(F.desc("value")), f"file:{path}", ["#a", "#b"]) == 5002
    assert path.read_text().split("\n") == ["#a", "#b", *[f"{i:05d} é" for i in range(4999, -1, -1)], ""]
    assert not list(path.parent.rglob("part-*")) and not list(path.parent.glob("*.tmp"))


def test_single_file_of_odd_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "value string")
    assert single_file.write_single_file(empty, str(tmp_path / "e"), ["#"]) == 1
    assert (tmp_path / "e").read_text() == "#\n"
    assert single_file.write_single_file(empty, str(tmp_path / "n")) == 0 and (tmp_path / "n").read_text() == ""
    odd = spark.createDataFrame([(None, 1), ("x" * 5_000_000, 2)], "value string, other int").coalesce(1)
    assert single_file.write_single_file(odd, str(tmp_path / "o")) == 2
    assert (tmp_path / "o").read_text() == "\n" + "x" * 5_000_000 + "\n"
    with pytest.raises(ValueError, match="POSIX"):
        single_file.write_single_file(empty, "s3a://bucket/x")


def test_sam_file_reads_back(spark, rows, lines, tmp_path):
    """Header and rows come back from the one file, in coordinate order."""
    dictionary = spark.createDataFrame([(0, "chrM", 50), (1, "chr1", 500), (2, "chr2", 400)], "ref_index int, name string, length int")
    text = "\n".join(
        f"r{i}\t0\t{chrom}\t{pos}\t60\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:0\tXR:Z:q"
        for i, (chrom, pos) in enumerate([("chr2", 9), ("chr1", 400), ("chr1", 7), ("chrM", 3), ("chr1", 7)])
    )
    parsed = parse_sam(lines(text)).rows
    placed = parsed.join(dictionary.select(F.col("name").alias("rname"), "ref_index"), "rname", "left")
    path = str(tmp_path / "all.sam")
    assert sinks.write_sam(placed, dictionary, path) == 4 + 5
    assert rows(read_dictionary(spark, path).where("ref_index < 3")) == rows(dictionary)
    again = parse_sam(spark.read.text(path)).rows
    assert rows(again) == rows(parsed.select(*again.columns))
    names = [x.split("\t")[0] for x in open(path).read().split("\n") if x and x[0] != "@"]
    assert names == ["r3", "r2", "r4", "r1", "r0"]


def test_parsers_count_what_they_reject(spark, lines):
    """The counts come with the rows and equal those of a second pass."""
    text = "en A 3 4\nen B x 4\nbroken\nde C 5 6"
    counter = Observation()
    parsed = parse_pagecounts(lines(text), counter=counter)
    assert parsed.rows.count() == 2
    assert counter.get == {"lines": 4, "rejects": parsed.rejects.count()} == {"lines": 4, "rejects": 2}
    log = Observation("log")
    rows = parse_retweet_log(lines("Seconds,Language\n(1),a,b,1,2,3,4,5,t\nbad,line"), counter=log).rows
    assert rows.groupBy("language").count().collect()
    assert log.get == {"lines": 2, "rejects": 1}


T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def test_stream_counters(spark, tmp_path):
    """Rows, rejects and late rows of a stream over two runs equal those of a second pass."""
    feed = tmp_path / "feed"
    feed.mkdir()
    line = lambda second, tweet: f"{second} {tweet} {tweet * 2}"
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    counters = count_streams(spark)

    def go():
        raw = tail.tail_lines(spark, str(feed)).select(F.concat_ws(" ", F.lit("en"), "value").alias("value"))
        parsed = parse_pagecounts(raw, counter="pages")  # title: second, views: tweet
        at = F.timestamp_seconds(F.lit(int(T0.timestamp())) + F.col("title").cast("int")).alias("ts")
        tweets = parsed.rows.select(at, F.col("views").alias("tweet_id"), F.lit(1).alias("retweet_count"), F.lit("x").alias("text"), "lang")
        windows = S.windowed(counted(tweets, "tweets", "ts"), watermark="0 seconds")
        return run(windows.select("tweet_id", "max_rt"), out, checkpoint)

    try:
        (feed / "a").write_text("\n".join([line(1, 1), line(100, 2), "7 none 1", line(101, 3)]) + "\n")
        query = go()
        (feed / "b").write_text(line(102, 7) + "\n")  # a batch drops what is late for the one before it
        go()
        (feed / "c").write_text("\n".join([line(2, 4), line(3, 5), line(200, 6), "bad"]) + "\n")
        go()
        deadline = time.time() + 20
        while time.time() < deadline and counters.totals[str(query.id)]["pages.lines"] < 9:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counters)
    total = counters.totals[str(query.id)]
    everything = parse_pagecounts(spark.read.text(str(feed)).select(F.concat_ws(" ", F.lit("en"), "value").alias("value")))
    assert total["pages.lines"] == 9 and total["pages.rejects"] == everything.rejects.count() == 2
    assert total["tweets.rows"] == everything.rows.count() == 7
    assert total["late"] == 2  # seconds 2 and 3 came after second 101
    assert total["input_rows"] == 9 and total["batches"] >= 3


def test_text_log(spark, rows, tmp_path):
    """A batch that runs again replaces its file; the heading is there once per file; an empty batch leaves none."""
    tweets = [(T0 + dt.timedelta(seconds=s), 1, c, f"a, b\n{c}", "en") for s, c in ((1, 10), (2, 12))]
    batch = S.windowed(spark.createDataFrame(tweets, "ts timestamp, tweet_id long, retweet_count long, text string, lang string"))
    joined = S.with_language_totals(batch, S.language_totals(batch))
    out = str(tmp_path / "log")
    for _ in range(2):
        S.write_log_text(joined, 3, out, T0)
    S.write_log_text(joined.limit(0), 4, out, T0)
    files = sorted(p.name for p in (tmp_path / "log").iterdir() if p.is_file())
    assert files == ["batch-000000003.csv"]
    text = (tmp_path / "log" / files[0]).read_text().split("\n")
    assert text[0].startswith("Seconds,") and text[1] == "60,English,en,3,1,12,10,3,a, b 12"
    assert parse_retweet_log(spark.read.text(out)).rows.count() == 1


def test_json_statuses_from_the_live_source(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    status = {"ts": "2024-01-01T00:00:01Z", "id": 1, "text": "RT x", "retweeted_status": {"id": 5, "retweet_count": 2, "text": "x", "lang": "en"}}
    (feed / "s").write_text(json.dumps(status) + "\n" + json.dumps({"ts": None, "id": 2}) + "\n")
    raw = tail.tail_lines(spark, str(feed)).select(F.from_json("value", S.TWEET_SCHEMA).alias("s")).select("s.*")
    out = str(tmp_path / "out")
    run(S.retweeted(raw), out, str(tmp_path / "checkpoint"))
    assert spark.read.parquet(out).select("tweet_id", "lang").collect() == [(5, "en")]
