from compare import compare, connect

from tallyloom.workload import streams  # noqa: F401
from tallyloom.workload.registry import ORACLES, QUERIES

NAME = "window_totals_incremental_stream"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
DEFAULT = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
SF = "/root/testdata/sf0.001"


def test_incremental_totals_in_a_session_with_the_default_state_store(spark):
    held = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, DEFAULT)
    try:
        problem, n = compare(spark, connect(SF), QUERIES[NAME], ORACLES[NAME], SF)
        assert problem is None and n > 0
        assert spark.conf.get(PROVIDER) == DEFAULT
    finally:
        spark.conf.set(PROVIDER, held)
