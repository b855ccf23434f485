"""FASTQ reads, mate pairs and gzip chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.lines import Parsed, number_lines

FIELDS = ("name", "seq", "plus", "qual")


def reads_from_lines(numbered: DataFrame) -> Parsed:
    """Four numbered lines make one read; reads with a missing line are rejects.

    The lines of a read lie next to each other in a split, so the partial
    aggregate joins nearly all of them before the shuffle.
    """
    place = F.col("pos") % 4
    picks = [F.max(F.when(place == k, F.col("value"))).alias(f) for k, f in enumerate(FIELDS)]
    reads = (
        numbered.groupBy(F.expr("pos div 4").alias("read_id"))
        .agg(*picks, F.count("*").alias("n_lines"))
    )
    whole = F.col("n_lines") == 4
    return Parsed(reads.where(whole).drop("n_lines"), reads.where(~whole))


def read_fastq(spark: SparkSession, path: str | list[str]) -> Parsed:
    return reads_from_lines(number_lines(spark, path))


def pair_mates(first: DataFrame, second: DataFrame) -> Parsed:
    """Mates with the same read number side by side; a read without a mate is a reject.

    Both inputs are already spread by ``read_id``, so the join adds no shuffle.
    """
    side = lambda df, n: df.select("read_id", *[F.col(f).alias(f"{f}{n}") for f in FIELDS])
    both = side(first, 1).join(side(second, 2), "read_id", "full")
    paired = F.col("name1").isNotNull() & F.col("name2").isNotNull()
    return Parsed(both.where(paired), both.where(~paired))


def pair_text() -> F.Column:
    """The eight lines of a pair, first mate first."""
    return F.concat_ws("\n", *[f"{f}{n}" for n in (1, 2) for f in FIELDS])


def plan_chunks(pairs: DataFrame, n_chunks: int, n_reads: int) -> DataFrame:
    """Add ``chunk_no`` and ``chunk``; a chunk is a run of equally many read numbers.

    ``n_reads`` is one more than the highest read number, so no sampling and no
    shuffle is needed to find the bounds.
    """
    size = max(1, -(-n_reads // n_chunks))
    number = F.expr(f"read_id div {size}")
    return pairs.withColumn("chunk_no", number.cast("int")).withColumn(
        "chunk", F.concat(F.lit("output"), (number * size).cast("string"))
    )


def write_chunks(pairs: DataFrame, path: str, n_chunks: int, n_reads: int) -> None:
    """One gzip file per chunk, in read order, below ``chunk=output<first read>``.

    All chunks have the same number of reads, so no task gets more than the others.
    """
    (
        plan_chunks(pairs, n_chunks, n_reads)
        .repartitionById(n_chunks, "chunk_no")
        .sortWithinPartitions("chunk", "read_id")
        .select("chunk", pair_text().alias("value"))
        .write.partitionBy("chunk")
        .option("compression", "gzip")
        .text(path)
    )


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """``chunk, file_name, row, value``: the lines of each chunk file, in order."""
    return spark.read.text(path).select(
        "chunk",
        F.col("_metadata.file_name").alias("file_name"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
