"""One ordered text file with a header, written by many tasks.

Tasks write their partition as a part; the sink's commit lists the parts that count, in
order, with the place of each in the file. Then every task copies its parts to their
places in the one file, which appears under its name when all are done. Neither the driver
nor any task handles the whole. Needs a folder that all executors share and that allows
writing at a place (any POSIX file system); object stores don't.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

MANIFEST = "_parts.json"
BLOCK = 1 << 22
#: Lines of a header that may pass through the driver.
HEADER_LINES = 1 << 20


def local_path(path: str) -> str:
    """``path`` without its scheme; an error for stores that can't write at a place."""
    scheme, colon, rest = path.partition(":")
    if colon and scheme != "file":
        raise ValueError(f"{path}: a single file needs a shared POSIX folder")
    return "/" + rest.lstrip("/") if colon else os.path.abspath(path)


@dataclass
class Part(WriterCommitMessage):
    partition: int
    name: str
    size: int
    lines: int


class PartsWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.head = int(options["headerbytes"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        os.makedirs(self.folder, exist_ok=True)
        partition = TaskContext.get().partitionId()
        # Each attempt has a file of its own; only committed ones are listed.
        name = f"part-{partition:06d}-{uuid.uuid4().hex[:8]}"
        size = lines = 0
        with open(os.path.join(self.folder, name), "wb") as file:
            for batch in iterator:
                values = batch.column(0).to_pylist()
                size += file.write("".join(v + "\n" for v in values).encode())
                lines += len(values)
        return Part(partition, name, size, lines)

    def commit(self, messages: list[Part | None]) -> None:
        parts, at = [], self.head
        for part in sorted((m for m in messages if m is not None), key=lambda m: m.partition):
            parts.append({"name": part.name, "at": at, "size": part.size, "lines": part.lines})
            at += part.size
        os.makedirs(self.folder, exist_ok=True)
        temporary = os.path.join(self.folder, f".{uuid.uuid4().hex[:8]}")
        with open(temporary, "w") as file:
            json.dump({"size": at, "parts": parts}, file)
        os.replace(temporary, os.path.join(self.folder, MANIFEST))

    def abort(self, messages: list[Part | None]) -> None:
        for part in messages:
            if part is not None and os.path.exists(os.path.join(self.folder, part.name)):
                os.remove(os.path.join(self.folder, part.name))


class PartsSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ordered_parts"

    def writer(self, schema: StructType, overwrite: bool) -> PartsWriter:
        return PartsWriter(self.options)


def write_single_file(lines: DataFrame, path: str, header: list[str] | None = None) -> int:
    """Write ``value`` of an ordered frame as one file below ``header``; returns the number of lines.

    Null values become empty lines. A file of that name is replaced as a whole.
    """
    spark = lines.sparkSession
    target = local_path(path)
    header = header or []
    if len(header) > HEADER_LINES:
        raise ValueError(f"a header of {len(header)} lines")
    head = "".join(h + "\n" for h in header).encode()
    run = uuid.uuid4().hex[:8]
    staging, growing = f"{target}.{run}.parts", f"{target}.{run}.tmp"
    os.makedirs(os.path.dirname(target), exist_ok=True)
    spark.dataSource.register(PartsSink)
    filled = lines.na.fill("", ["value"]).select("value")
    filled.write.format("ordered_parts").option("headerBytes", str(len(head))).mode("append").save(staging)
    with open(os.path.join(staging, MANIFEST)) as file:
        listed = json.load(file)
    with open(growing, "wb") as file:
        file.write(head)
        file.truncate(listed["size"])

    def copy(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        with open(growing, "r+b") as file:
            for row in (r for batch in rows for r in batch.to_pylist()):
                file.seek(row["at"])
                with open(os.path.join(staging, row["name"]), "rb") as part:
                    while block := part.read(BLOCK):
                        file.write(block)
                done.append(row["size"])
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], names=["size"])

    if listed["parts"]:
        parts = spark.createDataFrame([(p["name"], p["at"], p["size"]) for p in listed["parts"]], "name string, at long, size long")
        # Dealt one by one: a task that runs again writes the same bytes at the same place.
        placed = parts.repartitionByRange(len(listed["parts"]), "at").mapInArrow(copy, "size long").groupBy().sum("size").first()[0]
        if placed != listed["size"] - len(head):
            raise OSError(f"{target}: {placed} of {listed['size'] - len(head)} bytes in place")
    os.replace(growing, target)
    for p in listed["parts"]:
        os.remove(os.path.join(staging, p["name"]))
    os.remove(os.path.join(staging, MANIFEST))
    return len(header) + sum(p["lines"] for p in listed["parts"])
