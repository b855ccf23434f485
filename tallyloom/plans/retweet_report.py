"""Analysis of a retweet log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ranking import retweet_ranking, tweets_over_all_windows
from tallyloom.sources.lines import Parsed
from tallyloom.sources.sinks import RETWEET_REPORT, write_report
from tallyloom.sources.weblogs import parse_retweet_log


def retweet_report(lines: DataFrame, on_error: str = "quarantine") -> Parsed:
    """Tweets by language total, language code and retweets, all descending; and the lines that did not parse."""
    log = parse_retweet_log(lines, on_error)
    ranked = retweet_ranking(tweets_over_all_windows(log.rows)).orderBy(
        F.desc("total_in_language"), F.desc("lang_code"), F.desc("retweets"), "tweet_id"
    )
    return Parsed(ranked, log.rejects)


def write_retweet_report(lines: DataFrame, path: str, rejects_path: str) -> None:
    """The report as CSV, and the lines that did not parse as text."""
    report = retweet_report(lines)
    write_report(report.rows, RETWEET_REPORT, path)
    report.rejects.write.text(rejects_path)
