import glob

from pyspark.sql import functions as F

from tallyloom.sources import sinks


def test_sorted_alignments_take_more_ranges_as_reads_grow(spark, tmp_path):
    at = F.col("id")
    reads = spark.range(1000).select(F.lit(1).alias("ref_index"), (at * 7 % 1000).alias("pos"), at.cast("string").alias("qname"), F.lit(0).alias("flag"))
    path = str(tmp_path / "sorted")
    sinks.write_sorted_alignments(reads, path, 2, rows_per_task=100)
    files = sorted(glob.glob(f"{path}/ref_index=1/*.parquet"))
    assert len(files) >= 8
    sizes = [spark.read.parquet(f).count() for f in files]
    assert max(sizes) <= 250 and sum(sizes) == 1000
    assert [r["pos"] for f in files for r in spark.read.parquet(f).collect()] == list(range(1000))
