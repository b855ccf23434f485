"""SimHash near-duplicates by multi-index hashing.

Fingerprints are cut into so few segments that two of them within the distance differ by
at most one bit in some segment. Each distinct fingerprint is filed under its segments'
values and probes them with the small Hamming ball around its own: the value itself and
each value that sets one bit more (of two values one bit apart, one sets a bit that the
other lacks, so each such pair meets once). Matches are verified over all bits. Exact
copies share a fingerprint and enter as one row, whatever their number. Values that many
fingerprints share are split by further segments; at distance 3 what then meets agrees in
48 bits but two, so no bucket can hold more than 65,536 fingerprints.

Components are found by passing smallest labels along links and jumping to the labels of
labels; every round is written, and only linked fingerprints take part.

Defined results: a null or wordless text has fingerprint zero and links like any other;
repeated rows are documents of their own; a null id never names a component unless all
its ids are null; an empty table gives no rows; columns beyond id and text are ignored by
:func:`components` and kept by :func:`keep_one`.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tallyloom.llm.common import row_ids
from tallyloom.session import materialize

BITS = 64
SEED = 42
#: Hashes counted at once: bounds the memory that a very long text takes.
BLOCK = 1 << 16
#: Fingerprints of one segment value that are compared without a further split.
LARGE = 512


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority bits of the hashes of all word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))  # each one past its space
    begins = [0, *ends[:-1]]
    spans = zip(begins, ends[shingle - 1 :], strict=False) if len(words) >= shingle else [(0, ends[-1])]
    hashes = np.fromiter((xxh64_intdigest(joined[a : b - 1], SEED) for a, b in spans), dtype=">u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a signed long with the same bits."""

    @F.pandas_udf("long")
    def signed(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return signed(text)


def segments(distance: int, bits: int = BITS) -> list[tuple[int, int]]:
    """(shift, width) of segments of ``bits``, few enough that one of them differs by at most one bit."""
    n = max(2, distance // 2 + 1)
    edges = [bits * i // n for i in range(n + 1)]
    return list(zip(edges, (b - a for a, b in zip(edges, edges[1:], strict=False)), strict=False))


def _bits(fp: str, shift: int, width: int) -> str:
    """SQL for ``width`` bits of a long above its lowest ``shift`` ones."""
    return f"(shiftrightunsigned({fp}, {shift}) & {(1 << width) - 1}L)"


def _others(fp: str, shift: int, width: int) -> str:
    """SQL for the bits outside a segment, moved together."""
    low = _bits(fp, 0, shift) if shift else "0L"
    top = shift + width
    return f"({low} | shiftleft({_bits(fp, top, BITS - top)}, {shift}))" if top < BITS else low


def _split(rows: DataFrame, fp: str, distance: int, ball: bool) -> DataFrame:
    """Each row once per segment of the bits outside its ``part``: ``sub`` and ``subvalue``, with their balls if asked."""
    entries = []
    for i, (shift, width) in enumerate(segments(distance)):
        others = _others(fp, shift, width)
        here = []
        for j, (at, wide) in enumerate(segments(distance, BITS - width)):
            value = _bits(others, at, wide)
            values = f"concat(array({value}), transform(sequence(0, {wide - 1}), b -> {value} ^ shiftleft(1L, b)))"
            here.append(f"transform({values if ball else f'array({value})'}, v -> named_struct('sub', {j}, 'subvalue', v))")
        entries.append(f"when {i} then concat({', '.join(here)})")
    keys = F.explode(F.expr(f"case part {' '.join(entries)} end")).alias("k")
    return rows.select("*", keys).select(*rows.columns, "k.sub", "k.subvalue")


def links(prints: DataFrame, distance: int, large: int = LARGE) -> DataFrame:
    """Pairs (``a``, ``b``) of distinct fingerprints at most ``distance`` bits apart; ``prints`` has ``fp``.

    A pair may come more than once. A segment's value that more than ``large`` fingerprints
    share, as in a family of near copies, is split by the bits outside the segment, which
    are cut and probed with balls in the same way. No link is lost: those bits differ by
    ``distance`` at most, so in one of their segments by one at most.
    """
    parts = segments(distance)
    filed, probed = [], []
    for i, (shift, width) in enumerate(parts):
        value = _bits("fp", shift, width)
        filed.append(f"named_struct('part', {i}, 'value', {value})")
        ball = f"array(named_struct('part', {i}, 'value', {value}, 'flips', 0))"
        if distance >= len(parts):
            ball = (
                f"concat({ball}, transform(filter(sequence(0, {width - 1}), b -> {value} & shiftleft(1L, b) = 0),"
                f" b -> named_struct('part', {i}, 'value', {value} | shiftleft(1L, b), 'flips', 1)))"
            )
        probed.append(ball)
    files = prints.selectExpr("fp as b", f"explode(array({', '.join(filed)})) as f").selectExpr("b", "f.part", "f.value")
    probes = prints.selectExpr("fp as a", f"explode(concat({', '.join(probed)})) as p").selectExpr(
        "a", "p.part", "p.value", "p.flips"
    )
    key = ["part", "value"]
    near = F.expr(f"bit_count(a ^ b) <= {distance} and a <> b and (flips = 1 or a < b)")
    # Written: at most 1 / large of the rows of files, and the planner sees how few.
    crowded = materialize(files.groupBy(*key).count().where(F.col("count") > large).select(*key), "large-buckets")
    small = probes.join(files.join(crowded, key, "left_anti"), key)
    if crowded.isEmpty():
        return small.where(near).select("a", "b")
    of = lambda rows, fp, ball: _split(rows.join(crowded, key, "left_semi"), fp, distance, ball)
    split = of(probes, "a", True).join(of(files, "b", False), [*key, "sub", "subvalue"])
    return small.select("a", "b", "flips").unionAll(split.select("a", "b", "flips")).where(near).select("a", "b")


def smallest_labels(pairs: DataFrame) -> DataFrame:
    """``v`` and ``label``, the smallest node reachable, for every node of ``pairs`` (a, b)."""
    both = materialize(pairs.union(pairs.select("b", "a")).distinct(), "links")
    labels = materialize(
        both.groupBy(F.col("a").alias("v")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels"
    )
    while True:
        heard = (
            both.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("heard"))
        )
        told = materialize(
            labels.join(heard, F.col("v") == F.col("a")).select(
                "v", F.col("label").alias("old"), F.least("label", "heard").alias("label")
            ),
            "labels",
        )
        further = told.select(F.col("v").alias("__at"), F.col("label").alias("__next"))
        jumped = told.join(further, F.col("label") == F.col("__at")).select(
            "v", "old", F.least("label", "__next").alias("label")
        )
        jumped = materialize(jumped, "labels")
        if jumped.where("label <> old").isEmpty():
            return jumped.select("v", "label")
        labels = jumped.select("v", "label")


def classes(prints: DataFrame, distance: int) -> DataFrame:
    """``fp`` and ``root`` (a fingerprint of its component) of every distinct fingerprint."""
    labels = smallest_labels(links(prints, distance))
    return prints.join(labels, F.col("fp") == F.col("v"), "left").select("fp", F.coalesce("label", "fp").alias("root"))


def components(
    docs: DataFrame, distance: int = 3, shingle: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document its fingerprint in hexadecimal digits and the smallest id of its component."""
    marked = materialize(
        docs.select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text), shingle).alias("fp")), "fingerprints"
    )
    prints = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = prints.join(classes(prints.select("fp"), distance), "fp")
    smallest = roots.groupBy(F.col("root").alias("__root")).agg(F.min("first").alias("component_id"))
    known = roots.join(smallest, F.col("root") == F.col("__root")).select(F.col("fp").alias("__fp"), "component_id")
    return marked.join(materialize(known, "components"), F.col("fp") == F.col("__fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, distance: int = 3, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component: the smallest id, of equal ids the first row.

    The rows that stay grow with the documents, so they are never broadcast: both sides meet
    by a shuffle at any size.
    """
    marked = materialize(
        row_ids(docs).select("__row", F.col(doc_id).alias("id"), fingerprints(F.col(text), shingle).alias("fp")),
        "fingerprints",
    )
    best = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "__row")).alias("best")
    prints = materialize(marked.groupBy("fp").agg(best), "distinct-fingerprints")
    roots = prints.join(classes(prints.select("fp"), distance), "fp")
    kept = materialize(roots.groupBy("root").agg(F.min("best").alias("best")).select("best.__row"), "kept-rows")
    return row_ids(docs).join(kept.hint("merge"), "__row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
