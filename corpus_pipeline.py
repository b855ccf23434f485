"""Documents to training shards: quality rules, near-duplicates, benchmark passages, mixing, sharding.

Each stage takes and returns the columns of its input, whatever they are called; the last
adds its own. In all of them a null text is an empty one, repeated rows are documents of
their own, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import decontamination, mixing, quality_rules, sharding, simhash
from tallyloom.session import drop_folder, scratch_path, scratch_tables


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the rules or the isolation forest reject, its threshold set by the labels.

    Texts of under 50 words go, null and empty ones among them. Without labels of both
    kinds the forest rejects nothing; a null id has no label.
    """
    return quality_rules.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by fingerprints at most three bits apart.

    The smallest id stays, a null one only if there is no other; of equal ids the first row.
    """
    return simhash.keep_one(docs, distance=3, shingle=3)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold ten consecutive words of a benchmark item, or all words of a shorter one.

    Null and wordless texts and items hold nothing.
    """
    return decontamination.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "documents", n=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that sources weigh as the square root of their bytes; shuffle globally.

    The id decides how often, so rows of one id and source are repeated alike; a null source
    is a source, a null id an id.
    """
    return mixing.mix(docs).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes, equal texts together; null texts are equal to each other.

    Adds what the sharding operator adds; a column of the input with such a name is replaced.
    """
    return sharding.with_shard(docs, n_shards=8)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", benchmark_passages),
    ("mixing", mix_sources),
    ("sharding", shards),
]

#: SQL can't express the isolation forest; the tests hold a small run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply :data:`STAGES` to ``documents``, each to what its predecessor wrote.

    A stage's own tables go when its result is written, and that goes when the next one is.
    """
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        written = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        with scratch_tables():
            done = stage(spark, docs, sf_dir)
            done.write.parquet(written)
        if read is not None:
            drop_folder(spark, read)
        docs, read = spark.read.schema(done.schema).parquet(written), written
    return STAGES[-1][1](spark, docs, sf_dir)
