import re

from tallyloom.operators import reads as R

SCHEMA = "library string, qname string, flag int, rname string, pos int, aln_end int, cigar string, quals array<int>"


def reads(spark):
    line = lambda library, name, pos, q: (library, name, 0, "chr1", pos, pos + 3, "4M", [q] * 4)
    rows = [line("a", "x", 5, 30), line("a", "y", 5, 40), line("b", "y", 5, 10), line("a", None, 5, 35), line(None, "z", 5, 9), line(None, None, 5, 9), line("a", "w", 6, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def test_names_and_libraries_that_are_null_or_shared(spark, rows):
    got = rows(R.mark_duplicates(reads(spark)), "library", "qname", "flag")
    duplicates = sorted((r[:2] for r in got if r[2]), key=str)
    assert len(got) == 7 and duplicates == sorted([("a", "x"), ("a", None), (None, None)], key=str)


def test_sorts_compare_hashes_first(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = R.mark_duplicates(reads(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    sorts = re.findall(r"Sort \[(\w+)", plan)
    assert len(sorts) >= 3 and all(s.startswith(("_hash", "xxhash64", "_groupingexpression")) for s in sorts)  # the grouped hash has no name
