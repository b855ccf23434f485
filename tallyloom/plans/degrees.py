"""Degrees of separation from cast lists to a report."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import percent_text
from tallyloom.operators import graph
from tallyloom.operators.numbering import numbered
from tallyloom.session import materialize


class Degrees(NamedTuple):
    """Results of one run: totals, number of movies, counts per distance, last names."""

    totals: DataFrame
    movies: DataFrame
    counts: DataFrame
    names: DataFrame
    last: int


def degrees_of_separation(people: DataFrame, source: str, max_distance: int = graph.MAX_DISTANCE) -> Degrees:
    """Totals, distance counts and the numbered names at the last distance.

    ``people`` holds ``name, sex, movies`` records of both lists. The results are written:
    a report has many parts, and each reads them again. So are the records.
    """
    people = materialize(people.select("name", "sex", "movies"), "people")
    edges = graph.written(graph.edges_of(people))
    names = materialize(graph.people_by_name(people), "names")
    reached = graph.distances(edges, source, max_distance)
    return Degrees(
        totals=materialize(graph.people_counts(people), "totals"),
        movies=materialize(edges.agg(F.countDistinct("movie").alias("movies")), "movies"),
        counts=materialize(graph.distance_counts(reached, names, max_distance), "distance-counts"),
        names=materialize(names_at(reached, names, max_distance), "numbered-names"),
        last=max_distance,
    )


def names_at(reached: DataFrame, people: DataFrame, distance: int) -> DataFrame:
    """``sex, n, name`` of everyone at ``distance``, numbered by name per sex."""
    there = reached.where(F.col("distance") == distance).join(
        people.select(F.col("name").alias("actor"), "sex"), "actor"
    )
    there = there.select("sex", F.col("actor").alias("name"))
    return numbered(there, "sex", ["name"], label="names").select("sex", "n", "name")


def report_lines(result: Degrees) -> DataFrame:
    """``part, n, line``: the report as ordered text lines."""
    # The wording of the lines.
    t = result.totals
    movies = result.movies.select("movies").scalar()
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    line = lambda part, n, value: [F.lit(part).alias("part"), n.cast("bigint").alias("n"), value.alias("line")]
    one = F.lit(1)
    col = F.col
    head = t.select(
        *line(0, one, text(
            "Total number of actors = ", col("people"), ", out of which ",
            col("males"), " (", percent_text(col("male_pct")), ") are male while ",
            col("females"), " (", percent_text(col("female_pct")), ") are females.",
        ))
    )
    movie_line = t.select(*line(1, one, text("Total number of movies = ", movies)))
    shares = graph.distance_shares(result.counts, t)
    per_distance = shares.select(
        *line(2, col("distance"), text(
            "There are ", col("males"), " actors (", percent_text(col("male_pct")), ") and ",
            col("females"), " actresses (", percent_text(col("female_pct")), ") at distance ", col("distance"),
        ))
    )
    reach = graph.reach_totals(result.counts, t)
    total = lambda n, label, count, ratio: reach.select(
        *line(3, F.lit(n), text(f"Total number of {label} from distance 1 to {result.last} = ", col(count), ", ratio = ",
                                F.format_string("%.6f", col(ratio))))
    )
    named = lambda part, sex: result.names.where(col("sex") == sex).select(
        *line(part, col("n"), text(col("n"), ". ", col("name")))
    )
    title = lambda part, value: t.select(*line(part, F.lit(0), F.lit(value)))
    parts = [
        head,
        movie_line,
        per_distance,
        total(1, "actors", "people", "ratio"),
        total(2, "male actors", "males", "male_ratio"),
        total(3, "female actors (actresses)", "females", "female_ratio"),
        title(4, f"List of male actors at distance {result.last}:"),
        named(4, True),
        title(5, f"List of female actors (actresses) at distance {result.last}:"),
        named(5, False),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def write_degrees(result: Degrees, path: str) -> None:
    """The report as text, in order over its part files."""
    report_lines(result).orderBy("part", "n").select(F.col("line").alias("value")).write.text(path)
