"""A live source: the lines that are appended to the files of a folder.

Spark's own file stream takes a file once, when it appears. Here an offset is the number of
bytes taken of each file, so files may grow, and a batch that runs again after a failure
reads the same bytes again. A line counts when its line feed has been written.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

#: Bytes of a file that one task reads.
MOST_BYTES = 32 << 20


class Span(InputPartition):
    """Bytes ``begin`` to ``end`` of a file; a line belongs to the span that holds its first byte."""

    def __init__(self, file: str, begin: int, end: int, first: int):
        self.file, self.begin, self.end, self.first = file, begin, end, first


def whole_lines(path: str, known: int) -> int:
    """Bytes up to the last line feed, ``known`` of which are taken already."""
    size = os.path.getsize(path)
    if size < known:
        raise ValueError(f"{path} has shrunk from {known} to {size} bytes; lines may only be appended")
    with open(path, "rb") as file:
        end = size
        while end > known:
            begin = max(known, end - (1 << 16))
            file.seek(begin)
            found = file.read(end - begin).rfind(b"\n")
            if found >= 0:
                return begin + found + 1
            end = begin
    return known


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder = options["path"].removeprefix("file://").removeprefix("file:")
        self.suffix = options.get("suffix", "")
        self.most = int(options.get("maxbytesperpartition", MOST_BYTES))
        self.seen: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        names = sorted(n for n in os.listdir(self.folder) if n.endswith(self.suffix) and not n.startswith((".", "_")))
        # Files that are moved away are done with; their numbers go with them.
        self.seen = {n: whole_lines(os.path.join(self.folder, n), self.seen.get(n, 0)) for n in names}
        return {"files": json.dumps(self.seen, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        before, after = json.loads(start["files"]), json.loads(end["files"])
        spans = []
        for name in sorted(after):
            first = before.get(name, 0)
            for begin in range(first, after[name], self.most):
                spans.append(Span(os.path.join(self.folder, name), begin, min(begin + self.most, after[name]), first))
        return spans

    def read(self, span: Span) -> Iterator[tuple]:
        with open(span.file, "rb") as file:
            at = span.begin
            if at > span.first:  # the span before reads the line that is under way here
                file.seek(at - 1)
                at += len(file.readline()) - 1
            else:
                file.seek(at)
            while at < span.end:
                line = file.readline()
                at += len(line)
                yield (line.rstrip(b"\n").removesuffix(b"\r").decode("utf-8", "replace"),)

    def commit(self, end: dict) -> None:
        """Nothing is held for a batch."""


class TailSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema: StructType) -> TailReader:
        return TailReader(self.options)


def tail_lines(spark: SparkSession, folder: str, suffix: str = "", most_bytes: int = MOST_BYTES) -> DataFrame:
    """A stream of ``value``: lines appended to the files of a folder that all executors share.

    Files of other endings than ``suffix``, and those that begin with a dot or underscore, are
    left alone. A file may be moved away once it is read; it must never shrink.
    """
    spark.dataSource.register(TailSource)
    reader = spark.readStream.format("tail").option("suffix", suffix).option("maxBytesPerPartition", str(most_bytes))
    return reader.load(folder)
