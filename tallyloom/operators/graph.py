"""Two-sided actor-movie graphs: members, links and shortest distances.

Nothing here lists the pairs of a cast. A step from actors to their partners goes
through the set of movies, so the work stays linear in the number of edges even
if one movie holds a third of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import materialize, scratch_path

#: Distances are followed this far.
MAX_DISTANCE = 6


def all_people(male: DataFrame, female: DataFrame) -> DataFrame:
    """Both cast lists, one row per record."""
    return male.unionByName(female)


def people_by_name(people: DataFrame) -> DataFrame:
    """One row per name; a name on both lists counts as male."""
    return people.groupBy("name").agg(F.max("sex").alias("sex"))


def edges_of(people: DataFrame) -> DataFrame:
    """Distinct ``actor, movie`` rows."""
    return people.select(F.col("name").alias("actor"), F.explode("movies").alias("movie")).distinct()


def people_counts(people: DataFrame) -> DataFrame:
    """Records per sex in one pass, and each sex's share in percent."""
    n = lambda cond: F.count(F.when(cond, 1))
    counts = people.agg(n(F.col("sex")).alias("males"), n(~F.col("sex")).alias("females"))
    total = F.col("males") + F.col("females")
    share = lambda name: F.round(F.try_divide(100.0 * F.col(name), total), 1)
    return counts.select(
        total.alias("people"),
        "males",
        "females",
        share("males").alias("male_pct"),
        share("females").alias("female_pct"),
    )


def casts(edges: DataFrame) -> DataFrame:
    """``movie, cast_size`` of distinct edges."""
    return edges.groupBy("movie").agg(F.count("*").alias("cast_size"))


def graph_members(edges: DataFrame) -> DataFrame:
    """Per actor with at least one partner: shared movies and shared appearances.

    ``appearances`` counts each (movie, partner) once; actors who were always
    alone are absent. Computed from cast sizes, never from pairs.
    """
    shared = casts(edges).where(F.col("cast_size") > 1)
    return (
        edges.join(shared, "movie")
        .groupBy("actor")
        .agg(
            F.count("*").alias("shared_movies"),
            F.sum(F.col("cast_size") - 1).alias("appearances"),
        )
    )


#: Registers of a partner sketch, as a power of two; the standard error is 1.04 / sqrt(2^12), 1.6 %.
SKETCH_BITS = 12


def partner_counts(edges: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """``actor, movies, partners``: how many different actors each one shared a movie with.

    Partners are never listed. A movie's cast is folded into a mergeable distinct-count
    sketch, and an actor's sketches are united: the count's standard error is
    1.04 / 2^(bits / 2). Actors of one movie need no sketch, and theirs are exact: the cast
    without themselves.
    """
    per_actor = materialize(edges.groupBy("actor").agg(F.count("*").alias("movies")), "movies-per-actor")
    placed = edges.join(per_actor, "actor")
    alone = placed.where("movies = 1").join(casts(edges), "movie").select("actor", "movies", (F.col("cast_size") - 1).alias("partners"))
    busy = placed.where("movies > 1")
    sketches = edges.groupBy("movie").agg(F.hll_sketch_agg("actor", bits).alias("cast"))
    united = busy.join(sketches, "movie").groupBy("actor").agg(F.first("movies").alias("movies"), F.hll_union_agg("cast").alias("cast"))
    return alone.unionByName(united.select("actor", "movies", (F.hll_sketch_estimate("cast") - 1).alias("partners")))


def _edges_at(edges: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Edges whose ``column`` is among ``keys``.

    Most edges of a step match nothing, and a join finds that out sooner by a number than
    by a string, so the join key is a hash. The range tells names of equal hash apart: an
    equality would become part of the join key.
    """
    wanted = keys.select(F.xxhash64(column).alias("_hash"), F.col(column).alias("_key"))
    same = (F.xxhash64(column) == F.col("_hash")) & F.col(column).between(F.col("_key"), F.col("_key"))
    return edges.select("actor", "movie").join(wanted, same, "left_semi")


def _movies_of(edges: DataFrame, actors: DataFrame) -> DataFrame:
    return _edges_at(edges, "actor", actors).select("movie").distinct()


def _casts_of(edges: DataFrame, movies: DataFrame) -> DataFrame:
    return _edges_at(edges, "movie", movies).select("actor").distinct()


def partners_of(edges: DataFrame, source) -> DataFrame:
    """Distinct actors who share a movie with ``source``."""
    start = edges.where(F.col("actor") == F.lit(source)).select("movie").distinct()
    return _casts_of(edges, start).where(F.col("actor") != F.lit(source))


def distances(edges: DataFrame, source, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``actor, distance`` of everyone within ``max_distance`` of ``source``.

    Breadth-first rounds. The new movies and the new actors of a round are written
    to the scratch folder, which cuts the lineage; read back, their measured size
    decides whether the next step broadcasts them or shuffles. Each movie and each
    actor is entered once, so all rounds together touch an edge twice.
    """
    spark = edges.sparkSession
    edges = edges.select("actor", "movie")
    actor_type, movie_type = (f.dataType for f in edges.schema.fields)
    base = scratch_path(spark, "distances")
    actors_path, movies_path = f"{base}/actors", f"{base}/movies"
    actor_schema = f"actor {actor_type.simpleString()}"
    movie_schema = f"movie {movie_type.simpleString()}"

    def level(path, schema, distance):
        return spark.read.schema(schema).parquet(f"{path}/distance={distance}")

    def seen(path, schema):
        return spark.read.schema(f"{schema}, distance int").parquet(path)

    start = edges.where(F.col("actor") == F.lit(source).cast(actor_type)).select("actor").distinct()
    start.write.parquet(f"{actors_path}/distance=0")
    for distance in range(1, max_distance + 1):
        frontier = level(actors_path, actor_schema, distance - 1)
        if frontier.isEmpty():
            break
        movies = _movies_of(edges, frontier)
        if distance > 1:
            movies = movies.join(seen(movies_path, movie_schema), "movie", "left_anti")
        movies.write.parquet(f"{movies_path}/distance={distance}")
        reached = _casts_of(edges, level(movies_path, movie_schema, distance)).join(
            seen(actors_path, actor_schema), "actor", "left_anti"
        )
        reached.write.parquet(f"{actors_path}/distance={distance}")
    return seen(actors_path, actor_schema)


def distance_counts(reached: DataFrame, people: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``distance, males, females`` for each distance from 1, zeros included.

    ``people`` has one row per name. One aggregate instead of one job per cell.
    """
    sexed = reached.where(F.col("distance").between(1, max_distance)).join(
        people.select(F.col("name").alias("actor"), "sex"), "actor"
    )
    counts = sexed.groupBy("distance").agg(
        F.count(F.when(F.col("sex"), 1)).alias("males"),
        F.count(F.when(~F.col("sex"), 1)).alias("females"),
    )
    every = reached.sparkSession.range(1, max_distance + 1).select(F.col("id").cast("int").alias("distance"))
    return every.join(counts, "distance", "left").fillna(0, ["males", "females"])


def distance_shares(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Add the percent of all men and of all women to each distance row (NULL of none).

    ``totals`` is the single row of :func:`people_counts`.
    """
    of = lambda name: totals.select(name).scalar()
    return counts.select(
        "distance",
        "males",
        F.round(F.try_divide(100.0 * F.col("males"), of("males")), 1).alias("male_pct"),
        "females",
        F.round(F.try_divide(100.0 * F.col("females"), of("females")), 1).alias("female_pct"),
    )


def reach_totals(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """People within reach and their share of all, for everyone, men and women."""
    of = lambda name: totals.select(name).scalar()
    sums = counts.agg(F.sum("males").alias("males"), F.sum("females").alias("females"))
    everyone = F.col("males") + F.col("females")
    ratio = lambda part, whole: F.round(F.try_divide(part, whole), 6)
    return sums.select(
        everyone.alias("people"),
        ratio(everyone, of("people")).alias("ratio"),
        "males",
        ratio(F.col("males"), of("males")).alias("male_ratio"),
        "females",
        ratio(F.col("females"), of("females")).alias("female_ratio"),
    )


def written(edges: DataFrame) -> DataFrame:
    """Distinct edges as a written two-column table, scanned by every round."""
    return materialize(edges, "edges")
