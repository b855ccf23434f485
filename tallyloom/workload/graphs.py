"""Cast lists and distances. Orders are the people, parts per quarter the movies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import graph as g
from tallyloom.plans import degrees as d
from tallyloom.session import materialize, scratch_path
from tallyloom.sources.castlists import parse_cast_blocks, read_cast_blocks
from tallyloom.workload.registry import query, table

SOURCE = "p1"


def links(spark, sf_dir):
    """``l_orderkey, sex, part, year, quarter`` of order lines; a movie with a part missing misses all three.

    Names are made after grouping: the bare key is grouped without another exchange than the join's.
    """
    known = F.col("l_partkey").isNotNull() & F.col("l_shipdate").isNotNull()
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(known, F.col("l_partkey")).alias("part"),
        F.when(known, F.year("l_shipdate")).alias("year"),
        F.when(known, F.quarter("l_shipdate")).alias("quarter"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", (F.col("o_orderstatus") != "O").alias("sex"), "part", "year", "quarter"
    )


def _person():
    return F.concat(F.lit("p"), F.col("l_orderkey").cast("string"))


def _movie():
    text = lambda name: F.col(name).cast("string")
    return F.concat(F.lit("m"), text("part"), F.lit("q"), text("year"), text("quarter"))


def edges(spark, sf_dir):
    """Distinct ``actor, movie`` rows."""
    lines = links(spark, sf_dir).select("l_orderkey", "part", "year", "quarter").distinct()
    return lines.select(_person().alias("actor"), _movie().alias("movie"))


def people(spark, sf_dir):
    """Cast records; an order has a handful of lines."""
    records = links(spark, sf_dir).groupBy("l_orderkey", "sex").agg(F.collect_set(_movie()).alias("movies"))
    return records.select(_person().alias("name"), "sex", "movies")


LINKS = """
links as (
  select 'p' || l_orderkey as actor, o_orderstatus <> 'O' as sex,
         'm' || l_partkey || 'q' || year(l_shipdate) || quarter(l_shipdate) as movie
  from lineitem join orders on l_orderkey = o_orderkey),
e as (select distinct actor, movie from links),
people as (select distinct actor as name, sex from links)
"""
BFS = f"""
recursive {LINKS},
walk(actor, d) as (
  select distinct actor, 0 from e where actor = '{SOURCE}'
  union
  select b.actor, d + 1 from walk join e a on a.actor = walk.actor join e b on b.movie = a.movie where d < 6),
reached as (select actor, min(d) as distance from walk group by actor)
"""
COUNTS = """
counts as (
  select r.d as distance, count(*) filter (where sex) as males, count(*) filter (where not sex) as females
  from (select unnest(generate_series(1, 6)) as d) r
  left join (select distance, sex from reached join people on actor = name) x on x.distance = r.d
  group by r.d),
totals as (select count(*) as people, count(*) filter (where sex) as males, count(*) filter (where not sex) as females from people)
"""


def cast_blocks(spark, sf_dir, sex):
    """Blocks of one list; returned items are series, years are shifted so that some are recent."""
    items = table(spark, sf_dir, "lineitem")
    quote = F.when(F.col("l_returnflag") == "R", '"').otherwise("")
    line = F.concat(
        quote, F.lit("part "), F.col("l_partkey").cast("string"), quote, F.lit(" ("),
        (F.year("l_shipdate") + 12).cast("string"), F.lit("/I) [x]"),
    )
    orders = table(spark, sf_dir, "orders").where((F.col("o_orderstatus") != "O") == F.lit(sex))
    return (
        items.select("l_orderkey", line.alias("line"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_orderkey")
        .agg(F.array_join(F.array_sort(F.collect_set("line")), "\n\t\t\t").alias("movies"))
        .select(F.concat(F.lit("p"), F.col("l_orderkey").cast("string"), F.lit("\t\t"), "movies", F.lit("\n")).alias("value"))
    )


@query(
    "cast_list_scan",
    """select 'p' || l_orderkey as name, o_orderstatus <> 'O' as sex,
    'part ' || l_partkey || ' (' || (year(l_shipdate) + 12) || ')' as movie
    from lineitem join orders on l_orderkey = o_orderkey
    where l_returnflag <> 'R' and year(l_shipdate) + 12 >= 2011 group by all""",
)
def cast_list_scan(spark, sf_dir):
    lists = []
    for sex in (True, False):
        path = scratch_path(spark, "cast")
        cast_blocks(spark, sf_dir, sex).write.text(path)
        lists.append(parse_cast_blocks(read_cast_blocks(spark, path), sex).rows)
    return g.all_people(*lists).select("name", "sex", F.explode("movies").alias("movie"))


@query(
    "people_counts",
    f"""with {LINKS} select count(*) as people, count(*) filter (where sex) as males, count(*) filter (where not sex) as females,
    round(100.0 * count(*) filter (where sex) / count(*), 1) as male_pct,
    round(100.0 * count(*) filter (where not sex) / count(*), 1) as female_pct from people""",
)
def people_counts(spark, sf_dir):
    return g.people_counts(people(spark, sf_dir))


@query("movie_casts", f"with {LINKS} select movie, count(*) as cast_size from e group by movie")
def movie_casts(spark, sf_dir):
    return g.casts(edges(spark, sf_dir))


@query(
    "graph_members",
    f"""with {LINKS}, c as (select movie, count(*) as n from e group by movie having count(*) > 1)
    select actor, count(*) as shared_movies, cast(sum(n - 1) as bigint) as appearances
    from e join c using (movie) group by actor""",
)
def graph_members(spark, sf_dir):
    return g.graph_members(edges(spark, sf_dir))


@query(
    "partners_of_source",
    f"""with {LINKS} select distinct b.actor from e a join e b using (movie)
    where a.actor = '{SOURCE}' and b.actor <> '{SOURCE}'""",
)
def partners_of_source(spark, sf_dir):
    return g.partners_of(edges(spark, sf_dir), SOURCE)


def _reached(spark, sf_dir):
    return g.distances(g.written(edges(spark, sf_dir)), SOURCE)


def _counted(spark, sf_dir):
    """Counts per distance and totals, both from names and sexes that are written once."""
    everyone = materialize(people(spark, sf_dir).select("name", "sex"), "people")
    return g.distance_counts(_reached(spark, sf_dir), g.people_by_name(everyone)), g.people_counts(everyone)


@query("distances", f"with {BFS} select actor, cast(distance as integer) as distance from reached")
def distances(spark, sf_dir):
    return _reached(spark, sf_dir)


@query(
    "distance_counts",
    f"""with {BFS}, {COUNTS} select cast(distance as integer) as distance, c.males,
    round(100.0 * c.males / t.males, 1) as male_pct, c.females, round(100.0 * c.females / t.females, 1) as female_pct
    from counts c, totals t""",
)
def distance_counts(spark, sf_dir):
    return g.distance_shares(*_counted(spark, sf_dir))


REACH = """
reach as (
  select cast(sum(males + females) as bigint) as people, cast(sum(males) as bigint) as males, cast(sum(females) as bigint) as females
  from counts)
"""


@query(
    "reach_totals",
    f"""with {BFS}, {COUNTS}, {REACH}
    select r.people, round(r.people / t.people, 6) as ratio, r.males, round(r.males / t.males, 6) as male_ratio,
           r.females, round(r.females / t.females, 6) as female_ratio from reach r, totals t""",
)
def reach_totals(spark, sf_dir):
    return g.reach_totals(*_counted(spark, sf_dir))


@query(
    "names_at_last_distance",
    f"""with {BFS} select sex, row_number() over (partition by sex order by name) as n, name
    from reached join people on actor = name where distance = 6""",
)
def names_at_last_distance(spark, sf_dir):
    return d.names_at(_reached(spark, sf_dir), g.people_by_name(people(spark, sf_dir)), 6)


@query(
    "degrees_report",
    f"""with {BFS}, {COUNTS}, {REACH},
    named as (select sex, row_number() over (partition by sex order by name) as n, name
              from reached join people on actor = name where distance = 6)
    select 0 as part, 1::bigint as n, printf('Total number of actors = %d, out of which %d (%.1f%%) are male while %d (%.1f%%) are females.',
           people, males, round(100.0 * males / people, 1), females, round(100.0 * females / people, 1)) as line from totals
    union all select 1, 1, 'Total number of movies = ' || count(distinct movie) from e
    union all select 2, distance, printf('There are %d actors (%.1f%%) and %d actresses (%.1f%%) at distance %d',
           c.males, round(100.0 * c.males / t.males, 1), c.females, round(100.0 * c.females / t.females, 1), distance) from counts c, totals t
    union all select 3, 1, printf('Total number of actors from distance 1 to 6 = %d, ratio = %.6f', r.people, round(r.people / t.people, 6)) from reach r, totals t
    union all select 3, 2, printf('Total number of male actors from distance 1 to 6 = %d, ratio = %.6f', r.males, round(r.males / t.males, 6)) from reach r, totals t
    union all select 3, 3, printf('Total number of female actors (actresses) from distance 1 to 6 = %d, ratio = %.6f', r.females, round(r.females / t.females, 6)) from reach r, totals t
    union all select 4, 0, 'List of male actors at distance 6:'
    union all select 4, n, n || '. ' || name from named where sex
    union all select 5, 0, 'List of female actors (actresses) at distance 6:'
    union all select 5, n, n || '. ' || name from named where not sex""",
)
def degrees_report(spark, sf_dir):
    return d.report_lines(d.degrees_of_separation(people(spark, sf_dir), SOURCE))


@query("partner_counts")
def partner_counts(spark, sf_dir):
    """Different partners of every actor, by sketches; exact for actors of one movie."""
    return g.partner_counts(edges(spark, sf_dir))
