import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.functions.langnames import LANGUAGE_NAMES
from tallyloom.plans.page_report import page_report, write_page_report
from tallyloom.plans.retweet_report import retweet_report
from tallyloom.operators.ranking import top_pages, top_pages_k, totals_by_language, tweets_over_all_windows
from tallyloom.sources.weblogs import parse_pagecounts, parse_retweet_log

PAGES = """en Alpha 10 500
en.b Beta 10 40
en.m Alpha 7 30
de de 99 1
de Gamma 3 20
xx Delta 1 5
fr Broken notanumber 5"""

LOG = """Seconds,Language,Language-code,TotalRetweetsInThatLang,IDOfTweet,MaxRetweetCount,MinRetweetCount,RetweetCount,Text
(60),English,en,9,1,12,10,3,hello, world
(65),English,en,9,1,15,11,5,hello, world
(65),English,en,9,2,4,4,1,single
(65),German,de,2,3,8,7,2,hallo,,"""


def test_page_report(lines):
    got = [tuple(r) for r in page_report(lines(PAGES)).rows.collect()]
    assert got == [
        ("English", "en", 27, "Beta", 10),
        ("German", "de", 3, "Gamma", 3),
        ("xx", "xx", 1, "Delta", 1),
    ]


def test_malformed_lines(lines, rows):
    assert rows(parse_pagecounts(lines(PAGES)).rejects) == [("fr Broken notanumber 5",)]
    assert parse_pagecounts(lines(PAGES), "drop").rejects.count() == 0
    assert parse_pagecounts(lines("en A 1.5 2\nshort")).rejects.count() == 2
    with pytest.raises(PySparkException, match="malformed line"):
        parse_pagecounts(lines(PAGES), "fail").rows.collect()
    with pytest.raises(ValueError):
        parse_pagecounts(lines(PAGES), "ignore")


def test_report_file_is_ordered(spark, lines, tmp_path):
    path = str(tmp_path / "out")
    write_page_report(lines(PAGES), path, f"{path}-rejects")
    read = [r.value for r in spark.read.text(path).collect()]
    headings = "Language,Language-code,TotalViewsInThatLang,MostVisitedPageInThatLang,ViewsOfThatPage"
    assert [x for x in read if x != headings] == ["English,en,27,Beta,10", "German,de,3,Gamma,3", "xx,xx,1,Delta,1"]


def test_retweet_report(lines, rows):
    parsed = parse_retweet_log(lines(LOG)).rows
    assert rows(totals_by_language(tweets_over_all_windows(parsed))) == [("English", 7), ("German", 2)]
    got = [tuple(r) for r in retweet_report(lines(LOG)).rows.collect()]
    assert got == [
        ("English", "en", 7, 1, 6, "hello, world"),
        ("German", "de", 2, 3, 2, "hallo,,"),
    ]


def test_retweet_log_seconds_with_and_without_brackets(lines, rows):
    parsed = parse_retweet_log(lines("(60),a,a,1,1,1,1,1,x\n65,a,a,1,1,1,1,1,x\n65,a,a,1,one,1,1,1,x"))
    assert rows(parsed.rows, "seconds") == [(60,), (65,)]
    assert parsed.rejects.count() == 1


def test_merged_tweet_takes_latest_then_greatest_text(lines, rows):
    log = "1,A,a,0,7,5,5,1,zz\n2,B,b,0,7,9,3,1,aa\n2,C,c,0,7,4,4,1,bb"
    tweets = tweets_over_all_windows(parse_retweet_log(lines(log)).rows)
    assert rows(tweets) == [(7, 9, 3, "C", "c", "bb")]


@pytest.mark.parametrize(
    "text, want",
    [
        ("RT @bob: RT again https://t.co/x end", " : RT again end"),
        ("no marks", "no marks"),
        ("startRT @ümit2 http://a", "start 2 "),
    ],
)
def test_clean_tweet(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(T.clean_tweet(F.col("t"))).first()[0] == want


def test_one_line(spark):
    assert spark.createDataFrame([("a\r\nb\nc",)], "t string").select(T.one_line(F.col("t"))).first()[0] == "a  b c"


@pytest.mark.parametrize(
    "line, want",
    [
        ("\t\tFilm One (2012)  (V)", "Film One (2012)"),
        ("Film Two (2013/II)", "Film Two (2013)"),
        ("Old Film (2010)", None),
        ("First Kept (2011)", "First Kept (2011)"),
        ('\t"Series" (2014) {Pilot}', None),
        ("Foo (x) (2012)", None),
        ("Foo (????)", None),
        ("no year", None),
        ("(2015)", "(2015)"),
    ],
)
def test_movie_key(spark, line, want):
    assert spark.createDataFrame([(line,)], "l string").select(T.movie_key(F.col("l"))).first()[0] == want


def test_language_table_is_small_and_unique():
    codes = [x.split(" ", 1)[0] for x in LANGUAGE_NAMES.strip().split("\n")]
    assert len(codes) == len(set(codes)) < 200


@pytest.mark.parametrize("k", [1, 5])
def test_top_pages_k(spark, rows, k):
    """Equal views go by title, repeated lines each count, and k = 1 is the plain report."""
    import random

    rng = random.Random(k)
    pages = [(rng.choice(["en", "de", "fr"]), f"t{rng.randrange(6)}", rng.randrange(4)) for _ in range(60)] + [("xx", "xx", 9), ("aa", "b", 0)]
    df = spark.createDataFrame(pages, "lang string, title string, views long").repartition(3)
    want = []
    for lang in {p[0] for p in pages if p[0] != p[1]}:
        own = sorted((p for p in pages if p[0] == lang and p[1] != lang), key=lambda p: (p[2], p[1]), reverse=True)
        want += [(lang, sum(p[2] for p in own), i + 1, p[1], p[2]) for i, p in enumerate(own[:k])]
    got = top_pages_k(df, k)
    assert rows(got) == sorted(want)
    if k == 1:
        assert rows(got, "lang_code", "total_views", "title", "views") == rows(top_pages(df))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("WindowGroupLimit") :].split("Exchange")[1]  # the limit stands below the shuffle
