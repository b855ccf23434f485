"""Every registered query against its SQL, on whole tables."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from tallyloom.workload.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    problem, n = compare(spark, con, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert problem is None
    assert n > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["language", "lang_code", "total_views", "top_title", "top_views"]
    assert df.count() > 0


def test_every_exact_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == {"partner_counts"}  # estimates; test_graph.py holds them against brute force
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
