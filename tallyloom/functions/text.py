"""Text clean-up and parsing expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: First movie year that is kept.
FIRST_YEAR = 2011

_MOVIE_LINE = r"^\t*([^(]*)\(([0-9]{4})"


def language_of_project(project: Column) -> Column:
    """Text before the first dot, or all of it."""
    return F.substring_index(project, ".", 1)


def to_bigint(value: Column) -> Column:
    """Whole number, or NULL when the text is not one."""
    return value.try_cast("bigint")


def one_line(text: Column) -> Column:
    """Each line break becomes a blank."""
    return F.regexp_replace(text, "[\r\n]", " ")


def clean_tweet(text: Column) -> Column:
    """Drop the first ``RT``, then mentions, then links with one blank after them."""
    # The three patterns.
    text = F.regexp_replace(text, r"(?s)^(.*?)RT", "$1")
    text = F.regexp_replace(text, r"@\p{L}+", "")
    return F.regexp_replace(text, r"https?://\S+\s?", "")


def movie_key(line: Column, first_year: int = FIRST_YEAR) -> Column:
    """``title (year)`` of a cast-list line.

    NULL for lines without four digits after the first bracket, for years before
    ``first_year`` and for series, whose titles start with a quotation mark.
    """
    title = F.regexp_extract(line, _MOVIE_LINE, 1)
    year = F.regexp_extract(line, _MOVIE_LINE, 2).try_cast("int")
    return F.when(
        (year >= first_year) & ~title.startswith('"'),
        F.concat(title, F.lit("("), year.cast("string"), F.lit(")")),
    )


def percent_text(value: Column) -> Column:
    """One decimal and a percent sign."""
    return F.format_string("%.1f%%", value)
