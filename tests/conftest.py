import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from compare import session

    spark = session("8")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield spark
    spark.stop()


@pytest.fixture
def lines(spark):
    """A frame of lines from text."""

    def make(text):
        return spark.createDataFrame([(x,) for x in text.split("\n")], "value string")

    return make


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def get(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, v) for v in r))

    return get
