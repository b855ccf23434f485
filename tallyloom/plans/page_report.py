"""Page-count ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.langnames import with_language_name
from tallyloom.operators.ranking import top_pages
from tallyloom.sources.lines import Parsed
from tallyloom.sources.sinks import PAGE_REPORT, write_report
from tallyloom.sources.weblogs import parse_pagecounts


def page_report(lines: DataFrame, on_error: str = "quarantine") -> Parsed:
    """Languages by total views, each with its most visited page; and the lines that did not parse."""
    pages = parse_pagecounts(lines, on_error)
    ranked = with_language_name(top_pages(pages.rows), "lang_code")
    return Parsed(ranked.select(*PAGE_REPORT).orderBy(F.desc("total_views"), "lang_code"), pages.rejects)


def write_page_report(lines: DataFrame, path: str, rejects_path: str) -> None:
    """The report as CSV, and the lines that did not parse as text."""
    report = page_report(lines)
    write_report(report.rows, PAGE_REPORT, path)
    report.rejects.write.text(rejects_path)
