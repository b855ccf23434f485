"""Rows through an external command or a user function, partition by partition."""

from __future__ import annotations

import subprocess
import threading
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: Lines per batch handed back to Spark.
BATCH = 10_000


def _pipe(batches: Iterator[pd.DataFrame], command: list[str]) -> Iterator[pd.DataFrame]:
    child = subprocess.Popen(command, stdin=subprocess.PIPE, stdout=subprocess.PIPE)
    failed: list[BaseException] = []

    def feed():
        try:
            with child.stdin:
                for batch in batches:
                    child.stdin.writelines(f"{line}\n".encode() for line in batch["value"])
        except BrokenPipeError:
            pass  # the command stopped reading; its exit code decides
        except BaseException as error:
            failed.append(error)
            child.kill()

    feeder = threading.Thread(target=feed, daemon=True)
    feeder.start()
    lines: list[str] = []
    try:
        for line in child.stdout:
            lines.append(line.removesuffix(b"\n").decode())
            if len(lines) >= BATCH:
                yield pd.DataFrame({"value": lines})
                lines = []
        feeder.join()
        code = child.wait()
    finally:
        child.kill()  # does nothing once the command has ended
    if failed:
        raise failed[0]
    if code:
        raise RuntimeError(f"{command[0]} ended with code {code}")
    yield pd.DataFrame({"value": pd.Series(lines, dtype="object")})


def pipe_rows(lines: DataFrame, command: list[str]) -> DataFrame:
    """``value`` lines through one child process per partition.

    Rows are streamed both ways, so a partition of any size needs little memory. A
    non-zero exit code fails the task.
    """
    return lines.select("value").mapInPandas(lambda batches: _pipe(batches, command), "value string")


def map_partitions(
    routed: DataFrame,
    order: list[str],
    fn: Callable[[int, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: str,
) -> DataFrame:
    """``fn(partition index, batches)`` over partitions sorted by ``order``.

    The sort spills and the batches are streamed: a partition is never held whole.
    """

    def run(batches):
        from pyspark import TaskContext

        yield from fn(TaskContext.get().partitionId(), batches)

    return routed.sortWithinPartitions(*order).mapInPandas(run, schema)
