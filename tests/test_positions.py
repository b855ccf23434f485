import random

import pytest
from pyspark.errors import PySparkException

from tallyloom.sources import fastq
from tallyloom.sources.alignments import read_dictionary
from tallyloom.sources.lines import number_lines


def write(path, n, mate, seed=0):
    rnd = random.Random(seed)
    with open(path, "w") as f:
        for i in range(n):
            seq = "".join(rnd.choices("ACGT", k=20))
            f.write(f"@r{i}/{mate}\n{seq}\n+\n@{'I' * 19}\n")


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_numbers_over_many_splits(spark, tmp_path, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    for k in range(3):
        (tmp_path / f"part-{k}.txt").write_text("".join(f"{k}-{i}\n" for i in range(4000 + k)))
    want = [f"{k}-{i}" for k in range(3) for i in range(4000 + k)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = number_lines(spark, str(tmp_path))
        got = {r.pos: r.value for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [got[i] for i in range(len(want))] == want and len(got) == len(want)


def test_changed_splits_are_noticed(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"line {i}\n" for i in range(5000)))
    df = number_lines(spark, str(tmp_path / "a.txt"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7001")
    try:
        with pytest.raises(PySparkException, match="input blocks changed"):
            df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_reads_and_incomplete_read(spark, tmp_path, rows):
    path = tmp_path / "a.fq"
    path.write_text("@r0\nAC\n+\n@I\n@r1\nGT\n")
    got = fastq.read_fastq(spark, str(path))
    assert rows(got.rows) == [(0, "@r0", "AC", "+", "@I")]
    assert rows(got.rejects, "read_id", "n_lines") == [(1, 2)]


def test_unpaired_reads(spark, tmp_path, rows):
    write(tmp_path / "1.fq", 5, 1)
    write(tmp_path / "2.fq", 3, 2)
    mates = [fastq.read_fastq(spark, str(tmp_path / f"{m}.fq")).rows for m in (1, 2)]
    both = fastq.pair_mates(*mates)
    assert rows(both.rows, "name1", "name2") == [(f"@r{i}/1", f"@r{i}/2") for i in range(3)]
    assert rows(both.rejects, "read_id") == [(3,), (4,)]


@pytest.mark.parametrize("n_reads, n_chunks, files", [(100, 4, 4), (3, 5, 3)])
def test_chunk_round_trip(spark, tmp_path, n_reads, n_chunks, files):
    for m in (1, 2):
        write(tmp_path / f"{m}.fq", n_reads, m)
    mates = [fastq.read_fastq(spark, str(tmp_path / f"{m}.fq")).rows for m in (1, 2)]
    out = str(tmp_path / "out")
    fastq.write_chunks(fastq.pair_mates(*mates).rows, out, n_chunks, n_reads)
    chunks = {}
    for r in fastq.read_chunks(spark, out).orderBy("row").collect():
        assert r.file_name.endswith(".gz")
        chunks.setdefault(r.chunk, []).append(r.value)
    assert len(chunks) == files
    texts = [(tmp_path / f"{m}.fq").read_text().split("\n") for m in (1, 2)]
    want = [line for i in range(n_reads) for t in texts for line in t[4 * i : 4 * i + 4]]
    in_order = [line for c in sorted(chunks, key=lambda c: int(c.removeprefix("output"))) for line in chunks[c]]
    assert in_order == want
    for c, text in chunks.items():
        assert text[0] == f"@r{c.removeprefix('output')}/1"


def test_dictionary(spark, tmp_path, rows):
    path = tmp_path / "ref.dict"
    path.write_text("@HD\tVN:1.0\tSO:unsorted\n@SQ\tSN:chrM\tLN:100\n@SQ\tSN:chr1\tLN:5000\n@SQ\tSN:chr2\tLN:oops\n")
    assert rows(read_dictionary(spark, str(path))) == [(0, "chrM", 100), (1, "chr1", 5000), (2, "chr2", 0)]


def test_scratch_folder_must_be_shared():
    from tallyloom.session import shared

    assert shared("local[8]", "file:/tmp/warehouse") and shared("yarn", "hdfs://names/warehouse") and shared("yarn", "s3a://bucket/w")
    assert not shared("yarn", "file:/home/me/warehouse") and not shared("spark://host:7077", "/home/me/warehouse")
