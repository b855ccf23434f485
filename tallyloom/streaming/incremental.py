"""Totals over a sliding window of windows, kept up to date by adding one and subtracting one.

:func:`tallyloom.streaming.retweets.language_totals` with ``compounded`` adds every window's
total to each of the ``size / slide`` longer windows that hold it. Here each language keeps
its last totals in a ring and their sum: a window that closes is added, the one that falls
out is subtracted, and a language that has been silent for ``size`` leaves no state behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE = "next long, total long, ring array<long>"
OUT = "lang string, start long, total_in_language long"


class RingOfTotals(StatefulProcessor):
    """Per key: the start of the next window, the ring's sum, and its totals (null where there was none).

    Times are microseconds. A total's slot follows from its window's start, so a new window
    overwrites what is ``size`` older.
    """

    def __init__(self, size: int, slide: int):
        self.size, self.slide, self.slots = size, slide, size // slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("ring", STATE)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # Rows are totals of closed windows; each window of a language comes once.
        arrived = sorted((r["start"], r["total_in_language"]) for r in rows)
        yield from self._advance(key, arrived, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(key, [], timerValues)

    def _advance(self, key, arrived: list[tuple[int, int]], timer_values) -> Iterator[Row]:
        held = self.state.get()
        after, total, ring = (held[0], held[1], list(held[2])) if held is not None else (0, 0, [None] * self.slots)
        live = sum(x is not None for x in ring)

        def step() -> Iterator[Row]:
            """The window from ``after`` on is complete; what the next one no longer holds goes."""
            nonlocal after, total, live
            yield Row(lang=key[0], start=after, total_in_language=total)
            after += self.slide
            oldest = after // self.slide % self.slots
            if ring[oldest] is not None:
                total, live = total - ring[oldest], live - 1
                ring[oldest] = None

        for start, value in arrived:
            while live and after < start:
                yield from step()
            after = start
            ring[start // self.slide % self.slots] = value
            total, live = total + value, live + 1
            yield from step()
        closed = timer_values.getCurrentWatermarkInMs() * 1000
        while live and after + self.size <= closed:
            yield from step()
        if live:
            self.state.update((after, total, ring))
            self.handle.registerTimer((after + self.size) // 1000)
        else:
            self.state.clear()


def compounded_totals(totals: DataFrame, size: str, slide: str) -> DataFrame:
    """Per window and language: the sum of the totals of all windows that ended within the last ``size``.

    ``totals`` is a stream of closed windows: ``window``, ``lang``, ``total_in_language``, as
    :func:`~tallyloom.streaming.retweets.language_totals` gives it. The state store has to be
    RocksDB: start the stream inside :func:`~tallyloom.session.rocksdb_state`. ``size`` must be a multiple of ``slide``.
    """
    length, step = (int(pd.Timedelta(x).value // 1000) for x in (size, slide))
    if length % step:
        raise ValueError(f"{size} is no multiple of {slide}")
    keyed = totals.select("lang", "window", F.unix_micros("window.start").alias("start"), "total_in_language").groupBy("lang")
    out = keyed.transformWithState(RingOfTotals(length, step), OUT, "Append", "EventTime")
    start, end = F.timestamp_micros("start"), F.timestamp_micros(F.col("start") + length)
    return out.select(F.struct(start.alias("start"), end.alias("end")).alias("window"), "lang", "total_in_language")
