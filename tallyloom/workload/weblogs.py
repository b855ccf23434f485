"""Page counts and retweet logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions.langnames import with_language_name
from tallyloom.functions.text import clean_tweet, one_line
from tallyloom.operators.ranking import top_pages_k, totals_by_language, tweets_over_all_windows
from tallyloom.plans.page_report import page_report, write_page_report
from tallyloom.plans.retweet_report import retweet_report, write_retweet_report
from tallyloom.session import scratch_path
from tallyloom.sources.lines import read_lines
from tallyloom.sources.weblogs import RETWEET_LOG_HEADER, parse_pagecounts, parse_retweet_log
from tallyloom.workload.registry import query, table


def page_lines(spark, sf_dir):
    """Page-count lines of documents: one source is titled like its language, one has no number."""
    return table(spark, sf_dir, "documents").select(
        F.concat_ws(
            " ",
            F.concat("lang", F.lit(".m")),
            F.when(F.col("source") == "src7", F.col("lang")).otherwise(F.col("source")),
            F.when(F.col("source") == "src13", "n/a").otherwise(F.col("n_chars").cast("string")),
            F.col("n_chars") * 3,
        ).alias("value")
    )


NAMES = "(values ('en','English'),('de','German'),('fr','French'),('es','Spanish'),('ja','Japanese')) names(code, name)"

PAGES = """
pages_in as (
  select lang || '.m' as project, lang,
         case when source = 'src7' then lang else source end as title,
         n_chars as views, n_chars * 3 as bytes
  from documents where source <> 'src13')
"""

PAGE_REPORT_SQL = f"""
with {PAGES},
kept as (select * from pages_in where lang <> title),
ranked as (
  select lang, title, views,
         row_number() over (partition by lang order by views desc, title desc) as rn,
         sum(views) over (partition by lang) as total
  from kept)
select coalesce(name, lang) as language, lang as lang_code, cast(total as bigint) as total_views,
       title as top_title, views as top_views
from ranked left join {NAMES} on code = lang where rn = 1
"""


@query("pagecounts_report", PAGE_REPORT_SQL)
def pagecounts_report(spark, sf_dir):
    return page_report(page_lines(spark, sf_dir)).rows


TOP_K = 5


@query(
    "top_pages_k",
    f"""with {PAGES}, kept as (select * from pages_in where lang <> title),
    ranked as (select lang as lang_code, cast(sum(views) over (partition by lang) as bigint) as total_views,
      cast(row_number() over (partition by lang order by views desc, title desc) as integer) as rank, title, views from kept)
    select * from ranked where rank <= {TOP_K}""",
)
def top_pages(spark, sf_dir):
    return top_pages_k(parse_pagecounts(page_lines(spark, sf_dir)).rows, TOP_K)


@query("pagecounts_parse", f"with {PAGES} select project, lang, title, views, bytes from pages_in")
def pagecounts_parse(spark, sf_dir):
    path = scratch_path(spark, "pagecounts")
    page_lines(spark, sf_dir).write.option("compression", "gzip").text(path)
    return parse_pagecounts(read_lines(spark, path)).rows


@query(
    "pagecounts_rejects",
    "select lang || '.m src13 n/a ' || (n_chars * 3) as value from documents where source = 'src13'",
)
def pagecounts_rejects(spark, sf_dir):
    return parse_pagecounts(page_lines(spark, sf_dir)).rejects


@query(
    "pagecounts_csv",
    f"""select language as "Language", lang_code as "Language-code",
    cast(total_views as varchar) as "TotalViewsInThatLang", top_title as "MostVisitedPageInThatLang",
    cast(top_views as varchar) as "ViewsOfThatPage" from ({PAGE_REPORT_SQL})""",
)
def pagecounts_csv(spark, sf_dir):
    path = scratch_path(spark, "page-report")
    write_page_report(page_lines(spark, sf_dir), path, f"{path}-rejects")
    return spark.read.option("header", True).option("escape", '"').csv(path)


LANG = "case user_id % 6 when 0 then 'en' when 1 then 'de' when 2 then 'fr' when 3 then 'es' when 4 then 'ja' else 'xx' end"


def event_lang():
    return F.expr(LANG)


def retweet_log_lines(spark, sf_dir):
    """Log lines of events; the text holds commas and there is a header line per event type."""
    events = table(spark, sf_dir, "events").withColumn("lang", event_lang())
    rows = with_language_name(events, "lang").select(
        F.concat_ws(
            ",",
            F.concat(F.lit("("), F.col("event_id").cast("string"), F.lit(")")),
            "language",
            "lang",
            F.lit("0"),
            "user_id",
            F.floor("value"),
            F.floor(F.col("value") / 2),
            F.lit("1"),
            F.concat("event_type", F.lit(", "), "props", F.lit(",")),
        ).alias("value")
    )
    headers = events.select("event_type").distinct().select(F.lit(RETWEET_LOG_HEADER).alias("value"))
    return headers.unionAll(rows)


LOG = f"""
log as (
  select event_id as seconds, coalesce(name, lang) as language, lang as lang_code, 0::bigint as total_in_language,
         user_id as tweet_id, cast(floor(value) as bigint) as max_rt, cast(floor(value / 2) as bigint) as min_rt,
         1::bigint as retweets, event_type || ', ' || props || ',' as text
  from (select *, {LANG} as lang from events) left join {NAMES} on code = lang)
"""
TWEETS = f"""
{LOG},
tweets as (
  select tweet_id, max(max_rt) as max_rt, min(min_rt) as min_rt,
         arg_max(language, seconds) as language, arg_max(lang_code, seconds) as lang_code,
         arg_max(text, seconds) as text
  from log group by tweet_id)
"""
RETWEETS_SQL = f"""
with {TWEETS},
totals as (select language, cast(sum(max_rt - min_rt + 1) as bigint) as total_in_language from tweets group by language)
select language, lang_code, total_in_language, tweet_id, max_rt - min_rt + 1 as retweets, text
from tweets join totals using (language) where max_rt > min_rt
"""


@query("retweet_log_parse", f"with {LOG} select * from log")
def retweet_log_parse(spark, sf_dir):
    path = scratch_path(spark, "retweet-log")
    retweet_log_lines(spark, sf_dir).write.text(path)
    return parse_retweet_log(read_lines(spark, path)).rows


@query("retweets_per_tweet", f"with {TWEETS} select * from tweets")
def retweets_per_tweet(spark, sf_dir):
    return tweets_over_all_windows(parse_retweet_log(retweet_log_lines(spark, sf_dir)).rows)


@query(
    "retweet_totals",
    f"with {TWEETS} select language, cast(sum(max_rt - min_rt + 1) as bigint) as total_in_language from tweets group by language",
)
def retweet_totals(spark, sf_dir):
    return totals_by_language(retweets_per_tweet(spark, sf_dir))


@query("retweet_report", RETWEETS_SQL)
def retweet_report_query(spark, sf_dir):
    return retweet_report(retweet_log_lines(spark, sf_dir)).rows


@query(
    "retweet_csv",
    f"""select language as "Language", lang_code as "Language-code",
    cast(total_in_language as varchar) as "TotalRetweetsInThatLang", cast(tweet_id as varchar) as "IDOfTweet",
    cast(retweets as varchar) as "RetweetCount", text as "Text" from ({RETWEETS_SQL})""",
)
def retweet_csv(spark, sf_dir):
    path = scratch_path(spark, "retweet-report")
    write_retweet_report(retweet_log_lines(spark, sf_dir), path, f"{path}-rejects")
    return spark.read.option("header", True).option("escape", '"').csv(path)


@query(
    "clean_text",
    r"""select conv_id, turn,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      'x' || chr(10) || 'RT @' || role || ' RT ' || text || ' http://a.b/' || turn || ' end',
      '[\r\n]', ' ', 'g'), '^((?s).*?)RT', '\1'), '@\p{L}+', '', 'g'), 'https?://\S+\s?', '', 'g') as cleaned
    from conversations""",
)
def clean_text(spark, sf_dir):
    raw = F.concat(
        F.lit("x\nRT @"), "role", F.lit(" RT "), "text", F.lit(" http://a.b/"), F.col("turn").cast("string"), F.lit(" end")
    )
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", clean_tweet(one_line(raw)).alias("cleaned")
    )


@query(
    "language_names",
    f"select doc_id, lang, coalesce(name, lang) as language from documents left join {NAMES} on code = lang",
)
def language_names(spark, sf_dir):
    return with_language_name(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang")
