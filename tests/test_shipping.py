"""Functions reach Python workers that can't import the package; the entry stands without optional folders."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

FROM_ELSEWHERE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from tallyloom.operators.process import map_partitions, pipe_rows
def count(index, batches):
    yield from (b.assign(id=b["id"] + 1) for b in batches)
assert map_partitions(spark.range(5), ["id"], count, "id long").agg({{"id": "sum"}}).first()[0] == 15
assert pipe_rows(spark.range(3).selectExpr("cast(id as string) as value"), ["cat"]).count() == 3
"""

WITHOUT = """
import sys
sys.path.insert(0, {root!r})
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("tallyloom.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
assert "page" in " ".join(entry.queries()) and not any(q.startswith("op1_") for q in entry.queries())
"""


def run(code, folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code.format(root=ROOT)], cwd=folder, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]


def test_functions_run_from_another_folder(tmp_path):
    run(FROM_ELSEWHERE, tmp_path)


def test_entry_without_optional_folders(tmp_path):
    run(WITHOUT, tmp_path)
