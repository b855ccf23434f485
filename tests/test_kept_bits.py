import pytest

from tallyloom.operators import reads as R
from tallyloom.plans.alignments import call_input
from tallyloom.session import DROP_SHUFFLES, materialize

SCHEMA = "library string, qname string, flag int, rname string, pos int, aln_end int, cigar string, seq string, quals array<int>"


def reads(spark):
    """Single reads, pairs, names of three lines and more, null names and libraries, lines that are left alone."""
    line = lambda library, name, pos, q, flag=0, rname="chr1": (library, name, flag, rname, pos, pos + 3, "4M", "ACGT", [q] * 4)
    rows = [line("a", f"r{i:03}", 5 + i % 7, i % 50) for i in range(300)]
    rows += [line("a", f"p{i}", 100 + i % 3, i % 5, 99) for i in range(20)] + [line("a", f"p{i}", 300, 9, 147) for i in range(20)]
    rows += [line("a", "often", 700, 1)] * 5 + [line("a", "twice", 700, 2)] * 2 + [line("b", "often", 700, 1)] * 3 + [line("b", "other", 700, 60)]
    rows += [line("a", None, 5, 35), line(None, "z", 5, 9), line(None, None, 5, 9), line(None, None, 900, 9), line("a", "r001", 5, 9, 2048)]
    rows += [line("a", "u", 5, 9, 4), line("a", "c", 5, 9, 1024, "chr2"), ("a", "n", None, "chr1", 5, 8, "4M", "ACGT", None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most", [R.MOST_BITS if hasattr(R, "MOST_BITS") else 1, 0])
def test_reads_are_marked_where_they_lie(spark, rows, monkeypatch, most):
    monkeypatch.setattr(R, "MOST_BITS", most, raising=False)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    written = materialize(reads(spark), "given")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marked = call_input(written, spark.createDataFrame([("chr1", 1, 900)], "chrom string, start int, end int")).reads
        plan = plan_of(marked)
        assert marked.columns == written.columns
        assert rows(marked) == rows(R.mark_duplicates(written))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    if most:
        assert "hashpartitioning" not in plan and "Sort" not in plan
    assert spark.conf.get(DROP_SHUFFLES) == "false"


def test_names_with_many_lines_keep_all_of_them(spark, rows):
    numbered = materialize(R.number_rows(reads(spark), "_row"), "numbered")
    got = [(r.library, r.qname) for r in R.mark_duplicates(numbered, "_row").where("pos = 700 and flag = 0").collect()]
    assert sorted(got) == [("a", "often")] * 5 + [("b", "other")]  # 5 x 4 beats 2 x 8


def test_qualities_beyond_a_byte_are_counted(spark, rows):
    one = lambda q: ("chr1", 10, "4M", "AAAA", q)
    df = spark.createDataFrame([one([30, 40, 50, 60]), one([200, -1, 128, 127]), one([-300, 9, -129, -128]), one([1000, None, 7, 7]), one(None), one([])], "rname string, pos int, cigar string, seq string, quals array<int>")
    got = rows(R.base_counts(df, -1000.0))
    assert [(r[1], r[3], r[4]) for r in got] == [(10, 5, 186.0), (11, 5, 9.6), (12, 5, 11.2), (13, 5, 13.2)]  # the empty list counts without a quality
