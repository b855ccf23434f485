"""Counters of running streams, carried with their batches: no pass of their own."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def counted(rows: DataFrame, name: str, time: str | None = None) -> DataFrame:
    """``rows`` of a stream, counted as ``<name>.rows``; with ``time`` also how late the latest of them were."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    if time is not None:
        metrics += [F.min(time).alias("first"), F.max(time).alias("last")]
    return rows.observe(name, *metrics)


class StreamCounters(StreamingQueryListener):
    """Adds up, per stream, what its batches observed and what its state operators dropped.

    ``totals`` has, for each stream's id, sums of all observed whole numbers as
    ``<observation>.<metric>`` (``observe`` in parsers and :func:`counted`), ``batches``,
    ``input_rows`` and ``late``: rows that came after the watermark, as the state operators
    count them, which is after a task has folded its rows of one group. A batch counts once,
    also if it is run again.
    """

    def __init__(self) -> None:
        self.totals: dict[str, defaultdict[str, int]] = {}
        self._seen: set[tuple[str, int]] = set()
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self.totals.setdefault(str(event.id), defaultdict(int))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            stream = self.totals.setdefault(str(progress.id), defaultdict(int))
            if (str(progress.id), progress.batchId) in self._seen:
                return
            self._seen.add((str(progress.id), progress.batchId))
            stream["batches"] += 1
            stream["input_rows"] += progress.numInputRows
            stream["late"] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
            for name, row in (progress.observedMetrics or {}).items():
                for metric, value in row.asDict().items():
                    if isinstance(value, int):
                        stream[f"{name}.{metric}"] += value

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def count_streams(spark: SparkSession) -> StreamCounters:
    """Counters of all streams that the session runs from now on."""
    counters = StreamCounters()
    spark.streams.addListener(counters)
    return counters
