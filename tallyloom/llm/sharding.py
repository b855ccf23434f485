"""Sharding: minimax contiguous partition of ordered groups of equal texts.

Groups are ordered by the digest of their text. The smallest shard capacity for which
a greedy walk needs at most ``n_shards`` shards is searched by bisection, several
capacities to a pass, and the shards are cut where that walk cuts. A shard is thus a
range of digests, so a document's shard follows from its own text and the cut list:
documents are never joined with groups, and a group of any size stays one row.

Defined results: a null text has size 1, crc32 0 and forms a group of its own; an
empty text likewise with its own group; repeated rows are placed each for itself, in
the shard of their text; an empty table gives no rows; columns beyond id and text are
ignored by :func:`shard` and kept by :func:`with_shard`, where an input column named
``shard`` is replaced. With fewer groups than shards some shards stay empty.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import materialize

#: Capacities tried in one pass: six halvings.
FAN = 63
#: Hex digits of the digest that name a slice; 4,096 slices and the null group at most.
SLICE_DIGITS = 3


def text_key(text: Column) -> Column:
    """Identity and order of a group: 128 bits of the text, empty for null."""
    return F.coalesce(F.md5(text.cast("binary")), F.lit(""))


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


class GroupEnds:
    """Running sizes of the groups in digest order, looked up by value.

    ``ends`` is a written table with one row per group; only the borders of its
    slices are on the driver.
    """

    def __init__(self, digests: DataFrame):
        groups = digests.groupBy("__key").agg(F.sum("size").alias("bytes"))
        groups = groups.withColumn("slice", F.substring("__key", 1, SLICE_DIGITS))
        running = Window.partitionBy("slice").orderBy("__key").rowsBetween(Window.unboundedPreceding, 0)
        self.ends = materialize(
            groups.select("slice", "__key", "bytes", F.sum("bytes").over(running).alias("end")), "group-ends"
        )
        per_slice = self.ends.groupBy("slice").agg(F.max("end").alias("size"), F.max("bytes").alias("largest"))
        rows = sorted(per_slice.collect(), key=lambda r: r["slice"])
        self.largest = max((r["largest"] for r in rows), default=0)
        self.slices, self.starts, at = [], [], 0
        for r in rows:
            self.slices.append(r["slice"])
            self.starts.append(at)
            at += r["size"]
        self.total = at

    def slice_of(self, target: int) -> int:
        """The slice that holds the byte before ``target``, counted from 1."""
        return max(0, bisect_left(self.starts, target) - 1)

    def at_most(self, targets: list[int]) -> list[int]:
        """For each target the largest border that isn't above it, in one pass over the slices concerned."""
        at = [self.slice_of(t) for t in targets]
        order = sorted(range(len(targets)), key=lambda i: targets[i])
        sorted_targets = [targets[i] for i in order]
        wanted = sorted(set(at))
        starts = F.create_map(*[F.lit(x) for i in wanted for x in (self.slices[i], self.starts[i])])
        end = starts[F.col("slice")] + F.col("end")
        limits = F.array(*[F.lit(t).cast("long") for t in sorted_targets])
        found = (
            self.ends.where(F.col("slice").isin([self.slices[i] for i in wanted]))
            .select(end.alias("end"))
            .select("end", F.size(F.filter(limits, lambda t: t < F.col("end"))).alias("k"))
            .groupBy("k")
            .agg(F.max("end").alias("end"))
            .collect()
        )
        best = {r["k"]: r["end"] for r in found}
        out, top = [0] * len(targets), 0
        for k, i in enumerate(order):
            top = max(top, best.get(k, 0))
            out[i] = max(top, self.starts[at[i]])
        return out

    def walk(self, capacities: list[int], n_shards: int) -> list[list[int] | None]:
        """The greedy cuts of each capacity, None where it needs more than ``n_shards`` shards."""
        cuts: list[list[int]] = [[] for _ in capacities]
        begin = [0] * len(capacities)
        open_ = [i for i, c in enumerate(capacities) if c < self.total]
        for _ in range(n_shards - 1):
            if not open_:
                break
            for i, b in zip(open_, self.at_most([begin[i] + capacities[i] for i in open_]), strict=True):
                begin[i] = b
                cuts[i].append(b)
            open_ = [i for i in open_ if begin[i] + capacities[i] < self.total]
        return [None if i in open_ else cuts[i] for i in range(len(capacities))]

    def keys_at(self, cuts: list[int]) -> list[str]:
        """The last digest before each cut."""
        out = []
        for cut in cuts:
            i = self.slice_of(cut)
            row = self.ends.where((F.col("slice") == self.slices[i]) & (F.col("end") == cut - self.starts[i])).first()
            out.append(row["__key"])
        return out


def smallest_capacity(ends: GroupEnds, n_shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity and its cuts."""
    low = max(ends.largest, -(-ends.total // n_shards))
    high = low + ends.largest  # a greedy shard is short by less than one group
    best = None
    while low < high or best is None:
        step = max(1, -(-(high - low) // FAN))
        tried = sorted({*range(low, high, step), high} if best is None else {*range(low, high, step)})
        walked = ends.walk(tried, n_shards)
        k = next((i for i, cuts in enumerate(walked) if cuts is not None), len(tried))
        if k < len(tried):
            high, best = tried[k], walked[k]
        if k:
            low = tried[k - 1] + 1
        else:
            break
    return high, best


def cut_keys(digests: DataFrame, n_shards: int) -> list[str]:
    """Digests after which a new shard begins; ``digests`` has ``__key`` and ``size``."""
    ends = GroupEnds(digests)
    if not ends.total:
        return []
    _, cuts = smallest_capacity(ends, n_shards)
    return ends.keys_at(cuts)


def shard_of(key: Column, cuts: list[str]) -> Column:
    """Number of cuts before ``key``."""
    out = F.lit(0)
    for cut in cuts:
        out = out + (key > F.lit(cut)).cast("int")
    return out


def with_shard(docs: DataFrame, n_shards: int = 8, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``shard``; texts are read twice and not shuffled."""
    digests = docs.select(text_key(F.col(text)).alias("__key"), text_size(F.col(text)).alias("size"))
    return docs.withColumn("shard", shard_of(text_key(F.col(text)), cut_keys(digests, n_shards)))


def shard(docs: DataFrame, n_shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, size, checksum, shard and place in the shard.

    Places are given to the rows of one input split and shard together; a table with a
    row per split and shard carries the offsets.
    """
    digests = materialize(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            text_size(F.col(text)).alias("size"),
            F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            text_key(F.col(text)).alias("__key"),
            F.spark_partition_id().alias("__split"),
            F.monotonically_increasing_id().alias("__place"),
        ),
        "shard-digests",
    )
    placed = digests.withColumn("shard", shard_of(F.col("__key"), cut_keys(digests, n_shards)))
    before = Window.partitionBy("shard").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "__split")
        .agg(F.count("*").alias("n"))
        .select(
            F.col("shard").alias("__shard"),
            F.col("__split").alias("__of"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"),
        )
    )
    inside = Window.partitionBy("shard", "__split").orderBy("__place")
    return (
        placed.withColumn("__n", F.row_number().over(inside))
        .join(offsets, (F.col("shard") == F.col("__shard")) & (F.col("__split") == F.col("__of")))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("__offset") + F.col("__n") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
