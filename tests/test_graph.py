import random
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import graph as g
from tallyloom.operators.numbering import numbered
from tallyloom.plans import degrees as d
from tallyloom.sources.castlists import parse_cast_blocks, read_cast_blocks

MALE = (
    'Root, Actor (I)\t\t\tFilm One (2012)  (V)\n\t\t\tFilm Two (2013/II)\n\t\t\tOld Film (2009)\n\t\t\t"Series" (2014) {Pilot}\n'
    "\nSolo, Actor\tLonely (2015)\n\n\nGone, Actor\tAncient (1999)\n\nno tab here\n\nBoth, Name\tFilm One (2012)\n"
)
FEMALE = "Both, Name\tFilm Two (2013)\n\nFar, Away\tFilm Two (2013)\n\t\tFilm Three (2014)\n\nLast, One\tFilm Three (2014)\n"


@pytest.fixture
def people(spark, tmp_path):
    lists = []
    for name, text, sex in (("m", MALE, True), ("f", FEMALE, False)):
        path = tmp_path / f"{name}.list"
        path.write_text(text)
        lists.append(parse_cast_blocks(read_cast_blocks(spark, str(path)), sex))
    return lists


def test_cast_blocks(people, rows):
    male, _ = people
    assert rows(male.rows.withColumn("movies", F.array_join("movies", ";"))) == [
        ("Both, Name", True, "Film One (2012)"),
        ("Root, Actor (I)", True, "Film One (2012);Film Two (2013)"),
        ("Solo, Actor", True, "Lonely (2015)"),
    ]
    assert rows(male.rejects) == [("no tab here",)]


def test_report(people, rows):
    everyone = g.all_people(*(p.rows for p in people))
    result = d.degrees_of_separation(everyone, "Root, Actor (I)")
    assert rows(result.totals)[0][:3] == (6, 3, 3)
    assert rows(result.movies) == [(4,)]
    assert rows(result.counts)[:3] == [(1, 1, 1), (2, 0, 1), (3, 0, 0)]
    text = {(r.part, r.n): r.line for r in d.report_lines(result).collect()}
    assert text[0, 1] == (
        "Total number of actors = 6, out of which 3 (50.0%) are male while 3 (50.0%) are females."
    )
    assert text[2, 1] == "There are 1 actors (33.3%) and 1 actresses (33.3%) at distance 1"
    assert text[3, 1] == "Total number of actors from distance 1 to 6 = 3, ratio = 0.500000"


def test_report_reads_written_results_only(people):
    """No part of the report walks the graph or reads the lists again."""
    everyone = g.all_people(*(p.rows for p in people))
    plan = d.report_lines(d.degrees_of_separation(everyone, "Root, Actor (I)"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "LogicalRDD" not in plan and "LocalRelation [value" not in plan


def test_shares_of_an_empty_list(people, spark, rows):
    male = people[0].rows
    totals = g.people_counts(male)
    counts = g.distance_counts(spark.createDataFrame([("Both, Name", 1)], "actor string, distance int"), male, 1)
    assert rows(g.distance_shares(counts, totals)) == [(1, 1, 33.3, 0, None)]


def test_report_file(people, spark, tmp_path):
    everyone = g.all_people(*(p.rows for p in people))
    path = str(tmp_path / "report")
    d.write_degrees(d.degrees_of_separation(everyone, "Root, Actor (I)"), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines[0].startswith("Total number of actors = 6")
    assert lines[-1].startswith("List of female actors")


def brute(edges, source, limit):
    by_actor, by_movie = defaultdict(set), defaultdict(set)
    for a, m in edges:
        by_actor[a].add(m)
        by_movie[m].add(a)
    if source not in by_actor:
        return {}
    seen, queue = {source: 0}, deque([source])
    while queue:
        a = queue.popleft()
        if seen[a] == limit:
            continue
        for m in by_actor[a]:
            for b in by_movie[m]:
                if b not in seen:
                    seen[b] = seen[a] + 1
                    queue.append(b)
    return seen


def frame(spark, edges):
    return spark.createDataFrame(sorted(edges), "actor string, movie bigint")


def test_chain_stops_at_six(spark, rows):
    edges = {(f"a{i}", m) for m in range(9) for i in (m, m + 1)}
    assert rows(g.distances(frame(spark, edges), "a0")) == [(f"a{i}", i) for i in range(7)]


def test_missing_source(spark):
    assert g.distances(frame(spark, {("a", 1)}), "nobody").count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_distances_with_hub(spark, rows, seed):
    rnd = random.Random(seed)
    edges = {(f"a{rnd.randrange(120)}", rnd.randrange(90)) for _ in range(170)}
    edges |= {(f"a{i}", 1000) for i in range(60, 120)}
    got = dict(rows(g.distances(frame(spark, edges), "a3", 4)))
    assert got == brute(edges | set(), "a3", 4)


def test_members_and_partners(spark, rows):
    edges = {("a", 1), ("b", 1), ("c", 1), ("a", 2), ("b", 2), ("solo", 3)}
    assert rows(g.graph_members(frame(spark, edges))) == [("a", 2, 3), ("b", 2, 3), ("c", 1, 2)]
    assert rows(g.partners_of(frame(spark, edges), "a")) == [("b",), ("c",)]


def test_no_pair_join_in_plan(spark):
    """A step joins edges with a set of keys only."""
    plan = g.partners_of(frame(spark, {("a", 1)}), "a")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "Inner" not in plan


def test_numbered_over_slices(spark, rows):
    n = 5000
    df = spark.range(n).select((F.col("id") % 10 == 0).alias("sex"), F.format_string("n%06d", "id").alias("name"))
    got = rows(numbered(df, "sex", ["name"]), "sex", "n")
    assert got == sorted([(False, i + 1) for i in range(n * 9 // 10)] + [(True, i + 1) for i in range(n // 10)])
    first = numbered(df, "sex", ["name"]).where("n = 1")
    assert rows(first, "name") == [("n000000",), ("n000001",)]


def test_partner_counts(spark, rows):
    """Exact for actors of one movie; for the others within four standard errors, without listing a pair."""
    rnd = random.Random(8)
    pairs = {(f"a{rnd.randrange(3000)}", f"m{int(rnd.paretovariate(0.6)) % 300}") for _ in range(9000)} | {("lone", "own")}
    casts = defaultdict(set)
    movies = defaultdict(set)
    for a, m in pairs:
        casts[m].add(a)
        movies[a].add(m)
    got = {r.actor: r for r in g.partner_counts(spark.createDataFrame(sorted(pairs), "actor string, movie string")).collect()}
    assert set(got) == set(movies) and got["lone"].partners == 0
    for a, ms in movies.items():
        want = len(set().union(*(casts[m] for m in ms)) - {a})
        assert got[a].movies == len(ms)
        if len(ms) == 1:
            assert got[a].partners == want
        else:
            assert abs(got[a].partners - want) <= 1 + 4 * 1.04 / 2 ** (g.SKETCH_BITS / 2) * (want + 1)
    assert any(len(m) > 3 for m in movies.values())
    assert g.partner_counts(spark.createDataFrame([], "actor string, movie string")).count() == 0
