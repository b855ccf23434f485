import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.operators import balance as B
from tallyloom.operators.process import map_partitions, pipe_rows


def groups(spark, sizes):
    return spark.createDataFrame([(k, i) for k, n in sizes.items() for i in range(n)], "g int, i int")


def test_greedy_plan(spark, rows):
    df = groups(spark, {1: 50, 2: 30, 5: 30, 7: 10})
    plan = B.plan_partitions(B.group_sizes(df, "g"), "g", 2)
    assert rows(plan, "g", "partition") == [(1, 0), (2, 1), (5, 1), (7, 0)]
    assert rows(B.partition_loads(B.balance(df, "g", 2))) == [(0, 60, 1, 0), (1, 60, 1, 1)]


def test_many_small_groups_are_even(spark, rows):
    """Far more groups than units, one of them large; every row is planned."""
    df = groups(spark, {k: 3 for k in range(4000)} | {5000: 900})
    plan = B.plan_partitions(B.group_sizes(df, "g"), "g", 4)
    placed = dict(rows(plan, "g", "partition"))
    assert len(placed) == 4001 and placed[5000] == 0
    loads = [r[1] for r in rows(B.partition_loads(B.balance(df, "g", 4)))]
    assert sum(loads) == 12_900 and max(loads) - min(loads) < 0.01 * 12_900
    routed = B.balance(df, "g", 4)
    assert dict(rows(routed.select("g", "partition").distinct())) == placed


@pytest.mark.parametrize("spread", [False, True])
def test_null_keys_go_where_they_are_planned(spark, spread):
    df = spark.createDataFrame([(None if i % 3 else i % 5, i) for i in range(300)], "g int, i int")
    routed = B.balance(df, "g", 3, F.col("i") if spread else None)
    tasks = routed.select("partition", F.spark_partition_id().alias("t")).distinct().collect()
    assert all(r["partition"] == r["t"] for r in tasks) and routed.count() == 300
    nulls = routed.where("g is null").select("partition").distinct().count()
    assert nulls > 1 if spread else nulls == 1


def test_no_rows(spark):
    assert B.balance(groups(spark, {}), "g", 3).count() == 0


def test_heavy_group_is_sliced(spark, rows):
    df = groups(spark, {1: 4000, 2: 100, 3: 100})
    whole = [r[1] for r in rows(B.partition_loads(B.balance(df, "g", 4)))]
    sliced = [r[1] for r in rows(B.partition_loads(B.balance(df, "g", 4, F.col("i"))))]
    assert max(whole) == 4000
    assert sum(sliced) == 4200 and max(sliced) < 1400


def test_even_spread(spark):
    sizes = B.spread_evenly(spark.range(1000), 7).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 7 and max(r["count"] for r in sizes) < 160


def test_pipe(spark, rows):
    df = spark.range(25_000).select(F.format_string("é%d", "id").alias("value")).repartition(3)
    got = rows(pipe_rows(df, ["sed", "s/^/x/"]))
    assert len(got) == 25_000 and ("xé24999",) in got


def test_pipe_failure_fails_the_job(spark):
    df = spark.range(5).select(F.col("id").cast("string").alias("value"))
    with pytest.raises(PySparkException, match="ended with code 3"):
        pipe_rows(df, ["sh", "-c", "cat; exit 3"]).collect()


def test_partition_function_sees_sorted_rows(spark, rows):
    df = groups(spark, {1: 40, 2: 30, 3: 30})

    def largest_step(index, batches):
        values = [v for b in batches for v in zip(b["g"], b["i"], strict=True)]
        yield pd.DataFrame({"part": [index], "n": [len(values)], "ok": [values == sorted(values)]})

    routed = B.balance(df, "g", 2).select("g", "i")
    got = map_partitions(routed, ["g", "i"], largest_step, "part int, n int, ok boolean")
    assert rows(got) == [(0, 40, True), (1, 60, True)]
