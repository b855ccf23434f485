"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators were designed for. Joins carry no broadcast hint on
#: data that grows: Spark broadcasts a side only when its measured size is under
#: the threshold, and splits hot partitions of a sort-merge join otherwise.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply :data:`RECOMMENDED` to a session builder."""
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, whatever the session says; its settings come back at the end.

    ``transformWithState`` works with no other state store, and a stream takes a copy of the
    settings when it starts.
    """
    wanted = {k: v for k, v in RECOMMENDED.items() if ".stateStore." in k}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """Folder for written intermediate tables, shared by all executors.

    Taken from ``spark.checkpoint.dir``, else a folder below the warehouse. On a cluster a
    warehouse on the driver's own disk won't do: that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not shared(spark.sparkContext.master, warehouse):
        raise ValueError(f"executors can't see {warehouse}: set spark.checkpoint.dir to a folder that all of them share")
    return f"{warehouse}/scratch"


def shared(master: str, folder: str) -> bool:
    """Whether all executors can see a folder: it lies in a store, or there is only one machine."""
    scheme, colon, _ = folder.partition(":")
    return master.startswith("local") or bool(colon) and scheme != "file"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str, session: SparkSession | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back, by ``session`` if another than that of ``df`` is to go on with it.

    ``compression`` names a codec for wide tables, where disk counts more than a little time.

    This cuts the lineage with data that survives lost executors, and the files
    tell the planner the real size, so that it can choose the next join.
    """
    session = session or df.sparkSession
    path = scratch_path(session, label)
    df.write.parquet(path, compression=compression)
    for held in _HELD:
        held.append((session, path))
    return session.read.schema(df.schema).parquet(path)


#: Lets an action delete at its end the shuffle files it made.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a table written inside leaves the disk as soon as the table is written.

    Otherwise those files stay until the driver happens to collect its garbage. A frame that
    is read inside and once more later makes them anew.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


#: Lists of written tables, one for each :func:`scratch_tables` under way.
_HELD: list[list[tuple[SparkSession, str]]] = []


@contextmanager
def scratch_tables() -> Iterator[None]:
    """Drop at the end whatever :func:`materialize` writes meanwhile.

    For jobs that write their result before they leave the block; a frame that is still
    read later must not be made inside.
    """
    held: list[tuple[SparkSession, str]] = []
    _HELD.append(held)
    try:
        yield
    finally:
        _HELD.remove(held)
        for spark, path in held:
            drop_folder(spark, path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a written table that is no longer read."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
