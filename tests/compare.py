"""Run registered queries beside their SQL: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(row[i] for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def compare(spark, con, query, sql, sf_dir):
    """None if equal, else what differs. Returns the row count as well."""
    frame = query(spark, sf_dir)
    got = [tuple(r) for r in frame.collect()]
    if sql is None:
        return None, len(got)
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}", len(got)
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}", len(got)
    for a, b in zip(sorted_rows(frame.columns, got), sorted_rows(columns, want), strict=True):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"row {a} != {b}", len(got)
    return None, len(got)


def session(cpus="8"):
    from pyspark.sql import SparkSession

    from tallyloom.session import configure

    # A local session is its own only executor, so its folder may be a temporary one.
    scratch = tempfile.mkdtemp(prefix="tests-")
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", scratch)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main():
    sys.path.insert(0, ROOT)
    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = session(), connect(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            problem, rows = compare(spark, con, query, oracles.get(name), sf_dir)
        except Exception as error:
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} rows={rows} {time.time() - begin:.1f}s {problem or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
