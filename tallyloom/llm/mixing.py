"""Mixing sources to target weights by Poisson replication.

A source's target repetition rate is its share of the weights times all bytes, over its
own bytes, so that the expected bytes of the result equal those of the input. Each
document draws its number of copies by inverting a Poisson distribution with that mean
at a uniform number hashed from its id and a seed. Copies are exploded and dealt out by
the hash of id and copy number: a global shuffle that any rerun repeats exactly.

The distribution's table has one row per source. It is written before it is joined, so
the planner knows its size: few sources are broadcast, many are joined by a shuffle
whose hot sources adaptive execution splits.

Defined results: a null source is a source like any other; a null id or text is hashed
or measured as the empty string; equal ids draw equal numbers; a source that a given
weight table doesn't name, or names with null or nothing above zero, has weight 0 and
gives no rows; an empty table gives no rows; input columns stay, and one named like an
added column is replaced. Repeated weights of a source add up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import materialize

#: Hex digits of a digest that make a uniform number: 52 bits, exact in a double.
UNIFORM_DIGITS = 13


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the digest of ``parts``."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    digits = F.conv(F.substring(F.md5(text.cast("binary")), 1, UNIFORM_DIGITS), 16, 10)
    return (digits.cast("double") + 0.5) / F.lit(float(16**UNIFORM_DIGITS))


def poisson_tables(rates: DataFrame) -> DataFrame:
    """``__source``, ``rate`` and ``__sums``: P(count <= k) for k from 0 to where the rest is below the resolution of a double.

    Twelve deviations and forty more cover rates of any size; terms are kept as
    logarithms, so that a large mean doesn't underflow, and added up by a window, so that a
    large table takes time in proportion to its length. A rate of zero has no table.
    """
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 40).cast("int")
    terms = rates.where("rate > 0").select("__source", "rate", F.explode(F.sequence(F.lit(1), last)).alias("k"))
    so_far = Window.partitionBy("__source").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    factorial = F.sum(F.log(F.col("k").cast("double"))).over(so_far)
    terms = terms.withColumn("term", F.exp(F.col("k") * F.log("rate") - F.col("rate") - factorial))
    terms = terms.select("__source", "k", (F.exp(-F.col("rate")) + F.sum("term").over(so_far)).alias("sum"))
    listed = terms.groupBy(F.col("__source").alias("__of")).agg(F.sort_array(F.collect_list(F.struct("k", "sum"))).alias("listed"))
    sums = F.concat(F.array(F.exp(-F.col("rate"))), F.transform("listed", lambda x: x["sum"]))
    joined = rates.join(listed, F.col("__source").eqNullSafe(F.col("__of")), "left")
    return joined.select("__source", "rate", F.when(F.col("rate") > 0, sums).alias("__sums"))


def target_rates(docs: DataFrame, weights: DataFrame | None, temperature: float, source: str, text: str) -> DataFrame:
    """``__source``, ``rate`` and the Poisson table of each source.

    Without ``weights`` a source's weight is its bytes to the power ``temperature``.
    """
    sizes = docs.groupBy(F.col(source).alias("__source")).agg(
        F.sum((F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")).alias("bytes")
    )
    if weights is None:
        power = F.sqrt("bytes") if temperature == 0.5 else F.pow(F.col("bytes").cast("double"), F.lit(temperature))
        weighed = materialize(sizes.withColumn("weight", power), "source-weights")
    else:
        given = weights.groupBy(F.col("source").alias("__named")).agg(
            F.sum(F.when(F.col("weight") > 0, F.col("weight"))).alias("weight")
        )
        weighed = materialize(
            sizes.join(given, F.col("__source").eqNullSafe(F.col("__named")), "left").select(
                "__source", "bytes", F.coalesce(F.col("weight").cast("double"), F.lit(0.0)).alias("weight")
            ),
            "source-weights",
        )
    # Two sums: a bounded row on the driver.
    total = weighed.agg(F.sum("bytes").alias("bytes"), F.sum("weight").alias("weight")).first()
    if not total["weight"]:
        rate = F.lit(0.0)
    else:
        rate = F.col("weight") / F.lit(float(total["weight"])) * F.lit(float(total["bytes"])) / F.col("bytes")
    rates = weighed.select("__source", rate.alias("rate"))
    return materialize(poisson_tables(materialize(rates, "rates")), "source-rates")


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    temperature: float = 0.5,
    seed: int = 42,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """The columns of ``docs`` with ``n_copies``, ``copy`` (from 0) and ``shuffle_key``.

    Rows come in the order of ``shuffle_key`` within each partition, and partitions are
    dealt by it.
    """
    rates = target_rates(docs, weights, temperature, source, text)
    below = F.size(F.filter("__sums", lambda p: p < uniform(F.lit(seed), F.col(doc_id))))
    added = ["n_copies", "copy", "shuffle_key"]
    kept = [c for c in docs.columns if c not in added]
    copies = (
        docs.select(*[F.col(f"`{c}`") for c in kept])
        .join(rates, F.col(source).eqNullSafe(F.col("__source")))
        .withColumn("n_copies", F.coalesce(F.when(F.col("rate") > 0, below), F.lit(0)))
        .where("n_copies > 0")
        .select(*[F.col(f"`{c}`") for c in kept], "n_copies", F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)).alias("copy"))
    )
    key = F.md5(
        F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col("copy")).cast("binary")
    )
    copies = copies.withColumn("shuffle_key", key)
    return copies.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
