"""The steps of a search compare numbers, and its lists are grouped and read once."""

import datetime
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from test_graph import brute, frame

from tallyloom.operators import graph as g
from tallyloom.workload import graphs
from tallyloom.workload.registry import ORACLES

DAYS = [datetime.datetime(1997, 2, 3), datetime.datetime(1997, 8, 9), datetime.datetime(1998, 2, 3), None]


@pytest.fixture
def folder(spark, tmp_path):
    """Order lines with repeats, missing parts, days and orders; order 7 comes twice with two states."""
    rnd = random.Random(3)
    lines = [(rnd.choice([*range(40), None]), rnd.choice([*range(25), None]), rnd.choice(DAYS)) for _ in range(140)]
    lines += lines[:10] + [(1, 3, DAYS[0]), (2, 3, DAYS[0]), (7, None, DAYS[0]), (7, 3, None), (7, None, DAYS[2]), (99, 3, DAYS[0])]
    orders = [(k, rnd.choice("OFP")) for k in range(40)] + [(7, "O"), (7, "F"), (7, "F"), (None, "O")]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_shipdate timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_orderstatus string").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


@pytest.fixture
def shuffled(spark):
    """No side of a join is small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def sql(folder, query):
    con = duckdb.connect()
    for name in ("lineitem", "orders"):
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet/*.parquet'")
    return sorted(con.execute(query).fetchall(), key=lambda r: tuple((v is None, v) for v in r))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_steps_join_by_a_number(spark):
    """Before, each of the many edges that match nothing was compared as a string."""
    join = next(x for x in plan(g._casts_of(frame(spark, {("a", 1)}), spark.createDataFrame([(1,)], "movie bigint"))).split("\n") if "LeftSemi" in x)
    assert "[xxhash64(movie" in join and "[movie" not in join


@pytest.mark.parametrize("seed", [4, 5])
@pytest.mark.parametrize("joined", ["broadcast", "shuffled"])
def test_names_of_equal_hash_stay_apart(spark, rows, monkeypatch, request, seed, joined):
    if joined == "shuffled":
        request.getfixturevalue("shuffled")
    rnd = random.Random(seed)
    edges = {(f"a{rnd.randrange(60)}", rnd.randrange(70)) for _ in range(90)}
    monkeypatch.setattr(g.F, "xxhash64", lambda c: F.octet_length(F.col(c).cast("string")).cast("bigint"))
    assert dict(rows(g.distances(frame(spark, edges), "a3", 4))) == brute(edges, "a3", 4)


def test_missing_names_match_nothing(spark, rows):
    edges = spark.createDataFrame([("a", None), ("b", None), ("a", "m"), (None, "m"), (None, "n"), ("c", "n")], "actor string, movie string")
    assert rows(g.distances(edges, "a").where("actor is not null")) == [("a", 0)]


def test_names_are_made_after_grouping(shuffled, folder, rows):
    """Grouping takes no exchange of its own: one for the lines, one for the orders."""
    edges, records = graphs.edges(shuffled, folder), graphs.people(shuffled, folder).select("name", "sex")
    assert plan(edges).count("Exchange hashpartitioning") == 2
    assert plan(records).count("Exchange hashpartitioning") == 2
    assert rows(edges) == sql(folder, f"with {graphs.LINKS} select actor, movie from e")
    assert rows(records) == sql(folder, f"with {graphs.LINKS} select name, sex from people")
    movies = graphs.people(shuffled, folder).select("name", "sex", F.explode("movies").alias("movie"))
    assert rows(movies) == sql(folder, f"with {graphs.LINKS} select distinct actor, sex, movie from links where movie is not null")


@pytest.mark.parametrize("name", ["distance_counts", "reach_totals"])
def test_counts_read_written_names(spark, folder, rows, name):
    """Counts and totals don't join the order lines again."""
    result = getattr(graphs, name)(spark, folder)
    assert "l_orderkey" not in result._jdf.queryExecution().optimizedPlan().toString()
    if name == "reach_totals":
        assert rows(result)[0][0] > 10


@pytest.mark.parametrize("name", ["distance_counts", "reach_totals", "names_at_last_distance", "distances"])
def test_equal_to_sql(spark, tmp_path, rows, name):
    """On orders that come once; lines repeat or miss a part or a day, and a chain leads past distance 6."""
    rnd = random.Random(6)
    lines = [(rnd.randrange(20, 200), rnd.choice([*range(40), None]), rnd.choice(DAYS)) for _ in range(420)]
    lines += lines[:40] + [(k + i, 900 + k, DAYS[0]) for k in range(1, 9) for i in (0, 1)] + [(6, 5, DAYS[0]), (5, None, DAYS[1])]
    orders = [(k, "OFP"[k % 3]) for k in range(190)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    result = getattr(graphs, name)(spark, str(tmp_path))
    got = rows(result)
    assert got and got == sql(tmp_path, ORACLES[name])
