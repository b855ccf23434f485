"""Line deduplication: repeated runs of lines found by prefix doubling over line ids.

The corpus is a sequence of line ids with a border after each document. Suffixes are
ranked by their first line, then by their first 2, 4, 8 ... lines, each time from the
pair of ranks half the length apart: the distributed construction of a suffix array. A
suffix whose prefix is unique can't start a repeated run and leaves; doubling ends at
the depth that the shortest run asks for. Suffixes with the same least run ahead (the
fewest lines with ``min_words`` words) form an interval of the array whose common prefix
is at least that run. In each interval the first occurrence stays, and later ones are
copies. A copy's run goes on as long as it equals some earlier occurrence: if the next line
starts a copy too, that one reaches at least as far, so only the last start of each stretch
is followed on, through digests of the lines after its least run; these hold fewer than
``min_words`` words, or the next line would start a copy. All lines of the longest common
runs are deleted. Overlapping deletions of a document join into its maximal runs.

Ids and ranks travel, texts don't, until the runs meet their documents. A line that a
third of all documents share is one row per interval after partial aggregation, and its
copies are matched in joins that adaptive execution can split.

Defined results: "first" goes by document id (null last), then row, then line; the first
copy of any line is never deleted; a null text has no lines and stays null; an empty text
is one empty line; runs of fewer than ``min_words`` words stay, however often they occur;
a document all of whose lines go keeps its row with an empty text; repeated rows are
documents of their own; an empty table gives no rows; input columns named like an added
one are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest as digest

from tallyloom.llm.common import row_ids
from tallyloom.session import materialize

#: Lines handed to Spark at once.
MOST_LINES = 1 << 16


def least_runs(words: list[int], min_words: int) -> list[int]:
    """For each line the fewest lines from it on with ``min_words`` words; 0 where the text ends before."""
    out, end, held = [], 0, 0
    for begin, own in enumerate(words):
        while held < min_words and end < len(words):
            held += words[end]
            end += 1
        out.append(end - begin if held >= min_words else 0)
        held -= own
    return out


def rooms(need: list[int]) -> list[int]:
    """For each line how many lines after it hold fewer than ``min_words`` words, from the least runs."""
    following = [*need[1:], 0][: len(need)]
    return [n - 1 if n else len(need) - 1 - i for i, n in enumerate(following)]


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``most`` lines together, one text at least."""
    begin, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield begin, len(sizes)


def line_ids(docs: DataFrame, min_words: int) -> DataFrame:
    """One row per line: document, place, 128-bit id, length of the least run and lines it may go on for."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = batch[batch["__text"].notna()]
            texts = [t.encode("utf-8", "surrogatepass").split(b"\n") for t in kept["__text"]]
            for a, b in slices([len(t) for t in texts], MOST_LINES):
                rows, parts = kept.iloc[a:b], texts[a:b]
                sizes = [len(p) for p in parts]
                needs = [least_runs([len(x.split()) for x in p], min_words) for p in parts]
                yield pd.DataFrame(
                    {
                        "row": rows["__row"].repeat(sizes).to_numpy(),
                        "first": rows["__first"].repeat(sizes).to_numpy(),
                        "line": np.concatenate([np.arange(n) for n in sizes]),
                        "id": [digest(x) for p in parts for x in p],
                        "need": np.concatenate(needs),
                        "room": np.concatenate([rooms(n) for n in needs]),
                    }
                )

    # The id goes through as text: next to a null pandas would make it a rounded number.
    out = docs.mapInPandas(lines, "row long, first string, line int, id binary, need int, room int")
    return out.withColumn("first", F.col("first").cast("long"))


def ranked(keys: DataFrame, *by: str) -> DataFrame:
    """Order-preserving numbers for distinct keys: range partitions in order, sorted within."""
    ordered = keys.repartitionByRange(*by).sortWithinPartitions(*by)
    return materialize(ordered.withColumn("rank", F.monotonically_increasing_id()), "ranks")


def repeated(frame: DataFrame, *by: str) -> DataFrame:
    return frame.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1").drop("n")


def place() -> Column:
    """Order of occurrences: by id, those without one last, then by row and line."""
    return F.struct(F.col("first").isNull().alias("nameless"), "first", "row", "line")


def repeated_runs(lines: DataFrame) -> DataFrame:
    """Every one of :func:`line_ids` that starts a least run which occurs twice or more.

    ``row``, ``first``, ``line``, ``need``, ``room``, the run's ``interval`` of the suffix array, and
    whether it is a ``later`` one there.
    """
    ranks = ranked(materialize(repeated(lines, "id"), "repeated-lines"), "id")
    suffixes = materialize(lines.join(ranks, "id").select("row", "first", "line", "need", "room", "rank"), "suffixes")
    depth, found = 1, None
    while True:
        ends = suffixes.select("row", F.col("line").alias("end"), F.col("rank").alias("rank2"))
        # Runs between this depth and its double: two overlapping prefixes name them.
        due = suffixes.where(F.col("need").between(depth, 2 * depth - 1)).withColumn("end", F.expr(f"line + need - {depth}"))
        runs = due.join(ends, ["row", "end"]).select("row", "first", "line", "need", "room", "rank", "rank2")
        runs = materialize(runs, "runs")
        firsts = (
            runs.groupBy(F.col("need").alias("need_"), F.col("rank").alias("rank_"), F.col("rank2").alias("rank2_"))
            .agg(F.min(place()).alias("kept"), F.count("*").alias("n"))
            .where("n > 1")
        )
        # Written, so that the runs' own shuffle feeds the join alone and its hot run can be split.
        firsts = materialize(firsts, "first-runs")
        same = (F.col("need") == F.col("need_")) & (F.col("rank") == F.col("rank_")) & (F.col("rank2") == F.col("rank2_"))
        interval = F.concat_ws(":", "need", "rank", "rank2").alias("interval")
        copies = runs.join(firsts, same).select("row", "first", "line", "need", "room", interval, (place() > F.col("kept")).alias("later"))
        found = copies if found is None else found.union(copies)
        if suffixes.where(F.col("need") >= 2 * depth).isEmpty():
            return materialize(found, "repeated-runs")
        # The double's ranks: pairs of ranks, one depth apart.
        pairs = suffixes.withColumn("end", F.col("line") + depth).join(ends, ["row", "end"])
        pairs = materialize(pairs.select("row", "first", "line", "need", "room", F.col("rank").alias("l"), F.col("rank2").alias("r")), "pairs")
        ranks = ranked(materialize(repeated(pairs, "l", "r"), "repeated-pairs"), "l", "r")
        suffixes = materialize(pairs.join(ranks, ["l", "r"]).drop("l", "r"), "suffixes")
        depth *= 2


#: Digests of a run with one more line each, from those of the lines after its least run.
GROWING = """
aggregate(array_sort(ids), named_struct('seen', md5(cast(interval as binary)), 'out', cast(array() as array<struct<end: int, digest: string>>)),
  (a, x) -> transform(array(md5(concat(cast(a.seen as binary), x.id))), d -> named_struct(
    'seen', d, 'out', concat(a.out, array(named_struct('end', x.at + 1, 'digest', d)))))[0],
  a -> a.out)
"""


def longest_runs(lines: DataFrame, runs: DataFrame) -> DataFrame:
    """(``row``, ``line``, ``end``) of the runs of later copies, up to where no earlier occurrence agrees any more."""
    copies = runs.where("later")
    following = F.lead("line").over(Window.partitionBy("row").orderBy("line"))
    lasts = copies.withColumn("next", following).where("next is null or next > line + 1")
    lasts = materialize(lasts.select("row", "line", "interval"), "last-starts")
    wanted = materialize(lasts.select("interval").distinct(), "open-intervals")
    members = runs.where("room >= need").join(wanted, "interval", "left_semi")
    members = members.join(lasts.select("row", "line", F.lit(True).alias("asks")), ["row", "line"], "left")
    # Lines meet by a shuffle of their ids at any size, never their texts.
    ahead = members.withColumn("at", F.explode(F.sequence(F.expr("line + need"), F.expr("line + room"))))
    ids = lines.select("row", F.col("line").alias("at"), "id").hint("merge")
    met = ahead.join(ids, ["row", "at"]).groupBy("row", "first", "line", "interval", "asks").agg(F.collect_list(F.struct("at", "id")).alias("ids"))
    found = met.select("row", "first", "line", "asks", F.explode(F.expr(GROWING)).alias("t")).select("row", "first", "line", "asks", "t.*")
    found = materialize(found, "tails")
    firsts = found.groupBy(F.col("digest").alias("digest_")).agg(F.min(place()).alias("kept"), F.count("*").alias("n")).where("n > 1")
    firsts = materialize(firsts, "first-tails")
    longer = found.where("asks").join(firsts, F.col("digest") == F.col("digest_")).where(place() > F.col("kept"))
    longer = longer.groupBy("row", "line").agg(F.max("end").alias("end"))
    return copies.select("row", "line", F.expr("line + need").alias("end")).unionByName(longer)


def dedup(docs: DataFrame, min_words: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with later copies cut out of the text, ``n_lines``, ``n_deleted`` and ``deleted_runs``.

    ``deleted_runs`` lists maximal runs as first:end (lines from 0, end exclusive).
    """
    numbered = row_ids(docs)
    narrow = numbered.select("__row", F.col(doc_id).cast("string").alias("__first"), F.col(text).alias("__text"))
    lines = materialize(line_ids(narrow, min_words), "lines")
    runs = (
        longest_runs(lines, repeated_runs(lines))
        .groupBy("row")
        .agg(F.sort_array(F.collect_set(F.struct("line", "end"))).alias("spans"))
    )
    joined = F.expr(
        """aggregate(spans, cast(array() as array<struct<line: int, end: int>>), (a, s) ->
        if(size(a) > 0 and a[size(a) - 1].end >= s.line,
           concat(slice(a, 1, size(a) - 1),
                  array(named_struct('line', a[size(a) - 1].line, 'end', greatest(a[size(a) - 1].end, s.end)))),
           concat(a, array(s))))"""
    )
    runs = materialize(runs.select(F.col("row").alias("__of"), joined.alias("__runs")), "deleted-runs")
    parts = F.split(F.col(f"`{text}`"), "\n", -1)
    met = numbered.join(runs, F.col("__row") == F.col("__of"), "left").withColumn("__lines", parts)
    gone = F.expr("coalesce(aggregate(__runs, 0, (a, r) -> a + r.end - r.line), 0)")
    edges = (  # what lies between the runs
        "transform(concat(array(named_struct('line', 0, 'end', 0)), __runs), (r, i) ->"
        " named_struct('from', r.end, 'to', if(i < size(__runs), __runs[i].line, size(__lines))))"
    )
    rest = F.expr(f"array_join(flatten(transform({edges}, e -> slice(__lines, e.from + 1, e.to - e.from))), '\\n')")
    listed = F.expr("coalesce(array_join(transform(__runs, r -> concat_ws(':', r.line, r.end)), ','), '')")
    added = {
        text: F.when(F.col("__runs").isNotNull(), rest).otherwise(F.col(f"`{text}`")),
        "n_lines": F.coalesce(F.size("__lines"), F.lit(0)),
        "n_deleted": gone,
        "deleted_runs": listed,
    }
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    return met.select(*kept, *[v.alias(k) for k, v in added.items()])
