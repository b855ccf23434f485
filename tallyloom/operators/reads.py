"""Alignment records: cleaning, read groups, qualities, duplicates, base counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import genome as G
from tallyloom.session import materialize

# Read-group fields attached when none are given.
READ_GROUP = {
    "rg_id": "GROUP1",
    "library": "LIB1",
    "platform": "ILLUMINA",
    "platform_unit": "UNIT1",
    "sample": "SAMPLE1",
}


def clean_alignments(reads: DataFrame) -> DataFrame:
    """Clip what lies past the sequence's end, and set the mapping quality of unmapped reads to 0.

    Expects ``cigar`` and ``ref_length``; adds ``past_end``. The bases past the end become
    a soft clip, so that nothing counts them later, and the end follows the operations.
    """
    past = F.coalesce(F.col("aln_end") > F.col("ref_length"), F.lit(False))
    room = F.col("ref_length") - F.col("pos") + 1
    clipped = F.when(past, G.clip_past(F.col("cigar"), room)).otherwise(F.col("cigar"))
    end = F.when(F.col("past_end"), G.alignment_end(F.col("pos"), F.col("cigar"))).otherwise(F.col("aln_end"))
    quality = F.when(G.has_flag(F.col("flag"), G.UNMAPPED), 0).otherwise(F.col("mapq"))
    return reads.withColumns({"past_end": past, "cigar": clipped, "mapq": quality}).withColumn("aln_end", end)


def with_read_group(reads: DataFrame, **fields: str) -> DataFrame:
    """Add the read-group columns; keyword arguments replace the fixed values."""
    return reads.withColumns({k: F.lit(v) for k, v in {**READ_GROUP, **fields}.items()})


def sample_encoding(reads: DataFrame, sample: str = "sample") -> DataFrame:
    """``sample, max_quality, encoding`` decided from all reads of the sample."""
    top = reads.groupBy(sample).agg(F.max(F.array_max("quals")).alias("max_quality"))
    return top.withColumn("encoding", G.quality_encoding(F.col("max_quality")))


def fix_qualities(reads: DataFrame, encodings: DataFrame, sample: str = "sample") -> DataFrame:
    """Shift the qualities of Illumina samples; ``bad_quality`` marks negative results.

    The encodings, a row per sample, are written first: knowing their size the planner
    leaves the reads where they are.
    """
    encodings = materialize(encodings.select(sample, "encoding"), "encodings")
    fixed = F.when(F.col("encoding") == "ILLUMINA", G.shift_illumina(F.col("quals"))).otherwise(F.col("quals"))
    return (
        reads.join(encodings, sample, "left")
        .withColumn("quals", fixed)
        .withColumn("bad_quality", F.coalesce(G.has_negative(F.col("quals")), F.lit(False)))
    )


def _contends(flag: Column) -> Column:
    return ~G.has_flag(flag, G.UNMAPPED | G.SECONDARY | G.SUPPLEMENTARY)


def templates(reads: DataFrame, row: str | None = None) -> DataFrame:
    """``library, qname, ends, score`` of the primary mapped reads of each name: a pair, or one read.

    With ``row``, a column that numbers the reads, also ``low`` and ``apart``, the least number and
    how far on the greatest one is, and ``lines``, the number of reads.

    ``ends`` holds the unclipped 5' end of each mate, in order; ``score`` is the sum of all base
    qualities. An end is one number made of a 64-bit hash of the sequence's name, the place
    and the strand, so the raw reads go through a hash aggregate and are never sorted.
    """
    flag = F.col("flag")
    second = G.has_flag(flag, G.SECOND_IN_PAIR)
    total = F.aggregate(F.coalesce("quals", F.array().cast("array<int>")), F.lit(0), lambda a, q: a + q)
    five_prime = G.unclipped_five_prime(F.col("pos"), F.col("aln_end"), F.col("cigar"), flag).cast("long")
    place = F.shiftleft(five_prime, 1) + G.has_flag(flag, G.REVERSE).cast("long") + F.lit(1 << 33)  # 0 to 2^34
    end = F.xxhash64("rname").cast("decimal(20, 0)") * F.lit(1 << 34).cast("decimal(11, 0)") + place.cast("decimal(11, 0)")
    number = [F.col(row).alias("row")] if row else []
    numbers = [F.min("row").alias("low"), (F.max("row") - F.min("row")).alias("apart"), F.count("*").alias("lines")] if row else []
    return (
        reads.where(_contends(flag))
        .select("library", "qname", second.alias("second"), end.alias("at"), total.cast("long").alias("score"), *number)
        .groupBy("library", "qname")
        .agg(
            F.min(F.when(~F.col("second"), F.col("at"))).alias("first"),
            F.min(F.when(F.col("second"), F.col("at"))).alias("last"),
            F.sum("score").alias("score"),
            *numbers,
        )
        .select("library", "qname", F.array_sort(F.array_compact(F.array("first", "last"))).alias("ends"), "score", *_NUMBERS[: len(numbers)])
    )


_NUMBERS = ("low", "apart", "lines")


def mark_duplicates(reads: DataFrame, row: str | None = None) -> DataFrame:
    """Set the duplicate bit on all mapped reads but those of the best template of each fragment.

    Templates (see :func:`templates`) are copies if their unclipped 5' ends agree. The best
    has the highest sum of qualities, then the greatest name, and its mates share its
    verdict. Secondary and supplementary lines are left alone. Each read comes back once,
    whatever its name: names are folded to a row per template, and the winners, partially
    aggregated maxima, are joined by library and name. A hash leads the keys of both steps:
    their sorts then compare numbers, and not one library's name or a sequence's ends.

    ``row`` names a column that numbers the reads of a written table (:func:`number_rows`). The
    verdicts then come back as a bit per read (:func:`kept_bits`) and the reads stay where they are.
    """
    flag = F.col("flag")
    cleared = flag.bitwiseAND(F.lit(~G.DUPLICATE))
    marked = F.when(F.col("_kept"), cleared).otherwise(cleared.bitwiseOR(F.lit(G.DUPLICATE)))
    verdict = F.when(_contends(flag), marked).otherwise(flag)
    if row:
        bits = kept_bits(reads, row)
        if bits.count() <= MOST_BITS:
            bits = F.broadcast(bits)
        met = reads.join(bits, F.shiftright(row, SLICE) == F.col("_slice"), "left")
        return met.withColumn("_kept", _bit(row)).withColumn("flag", verdict).drop("_slice", "_words", "_kept")
    best = _best(templates(reads)).select(
        F.xxhash64("best.qname").alias("_hash"), F.col("library").alias("_library"), F.col("best.qname").alias("_qname"), F.lit(True).alias("_kept")
    )
    return reads.join(best, _same_name(), "left").withColumn("flag", verdict).drop("_hash", "_library", "_qname", "_kept")


def _best(names: DataFrame) -> DataFrame:
    """The ``best`` of the templates whose ends agree."""
    ranked = F.struct("score", "qname", *[c for c in _NUMBERS if c in names.columns])
    return names.groupBy(F.xxhash64("ends").alias("_hash"), "library", "ends").agg(F.max(ranked).alias("best"))


def _same_name() -> Column:
    return (F.xxhash64("qname") == F.col("_hash")) & F.col("library").eqNullSafe(F.col("_library")) & F.col("qname").eqNullSafe(F.col("_qname"))


#: Reads in one row of verdicts, as a power of two; a word holds 2^6 of them.
SLICE = 10
#: Rows of verdicts, about 200 bytes each, that may travel to every task; beyond that reads are joined to them.
MOST_BITS = 1 << 19


def number_rows(reads: DataFrame, row: str) -> DataFrame:
    """Number the reads, from a multiple of 2^33 on in each task. The numbers hold once the table is written."""
    return reads.withColumn(row, F.monotonically_increasing_id())


def _bit(row: str) -> Column:
    """Whether the read's bit is set in the ``_words`` beside it."""
    word = F.get("_words", F.shiftright(row, 6).bitwiseAND(F.lit((1 << SLICE - 6) - 1)).cast("int"))
    return F.coalesce(F.getbit(word, F.col(row).bitwiseAND(F.lit(63)).cast("int")) == 1, F.lit(False))


def kept_bits(reads: DataFrame, row: str) -> DataFrame:
    """``_slice, _words``: a bit for each read of the best template of a fragment, written.

    A template brings the least and the greatest number of its reads, so a name of one or two
    lines needs no second look; names with more lines, if there are any, are looked up.
    """
    named = lambda c: F.when(F.col("best.lines") > 2, F.col(c))
    kept = _best(templates(reads, row)).select(*[f"best.{c}" for c in _NUMBERS], named("library").alias("_library"), named("best.qname").alias("_qname"))
    kept = materialize(kept, "kept-templates")
    rows = kept.where("lines <= 2").select(F.explode(F.array_distinct(F.array("low", F.col("low") + F.col("apart")))).alias("row"))
    often = kept.where("lines > 2").select(F.xxhash64("_qname").alias("_hash"), "_library", "_qname")
    if not often.isEmpty():
        lines = reads.where(_contends(F.col("flag"))).select("library", "qname", F.col(row).alias("row"))
        rows = rows.unionAll(lines.join(often, _same_name(), "leftsemi").select("row"))
    at = F.shiftright("row", 6).bitwiseAND(F.lit((1 << SLICE - 6) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("row").bitwiseAND(F.lit(63)).cast("int"))
    words = [F.coalesce(F.bit_or(F.when(at == i, bit)), F.lit(0).cast("long")) for i in range(1 << SLICE - 6)]
    slices = rows.groupBy(F.shiftright("row", SLICE).alias("_slice"))
    return materialize(slices.agg(F.array(*words).alias("_words")), "kept-bits")


def duplicate_metrics(marked: DataFrame) -> DataFrame:
    """Mapped reads, duplicates and their percentage per library."""
    return (
        marked.where(~G.has_flag(F.col("flag"), G.UNMAPPED))
        .groupBy("library")
        .agg(
            F.count("*").alias("reads"),
            F.count(F.when(G.has_flag(F.col("flag"), G.DUPLICATE), 1)).alias("duplicates"),
        )
        .withColumn("duplicate_pct", F.round(100.0 * F.col("duplicates") / F.col("reads"), 4))
    )


#: Halvings of the bracket around a library's size.
HALVINGS = 60


def library_size(seen: Column, distinct: Column) -> Column:
    """Molecules of a library of which ``seen`` draws showed ``distinct`` ones; NULL without a repeat.

    Draws with replacement from X molecules show X (1 - exp(-seen / X)) distinct ones. With
    y = seen / X that is (1 - exp(-y)) / y = distinct / seen, whose left side falls from 1 and
    is below 1 / y, so y lies between 0 and seen / distinct; halving finds it.
    """
    ratio = distinct / seen
    bracket = F.struct(F.lit(0.0).alias("low"), (seen / distinct).alias("high"))

    def halve(b, _):
        mid = (b["low"] + b["high"]) / 2
        over = (1 - F.exp(-mid)) / mid > ratio
        return F.struct(F.when(over, mid).otherwise(b["low"]).alias("low"), F.when(over, b["high"]).otherwise(mid).alias("high"))

    y = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), bracket, halve, lambda b: (b["low"] + b["high"]) / 2)
    return F.when((seen > distinct) & (distinct > 0), F.round(seen / y).cast("long"))


def library_metrics(marked: DataFrame) -> DataFrame:
    """Per library: pairs, single reads, secondary and unmapped lines apart, duplicates and the library's size.

    A pair is counted once, by its two mapped primary lines; a read without a mapped mate is
    single. One pass over the marked reads, a row per library and task in the shuffle.
    """
    flag = F.col("flag")
    unmapped, extra = G.has_flag(flag, G.UNMAPPED), G.has_flag(flag, G.SECONDARY | G.SUPPLEMENTARY)
    duplicate = G.has_flag(flag, G.DUPLICATE)
    counted = ~unmapped & ~extra
    mated = counted & G.has_flag(flag, G.PAIRED) & ~G.has_flag(flag, G.MATE_UNMAPPED)
    single = counted & ~mated
    n = lambda condition: F.count_if(condition)
    half = lambda column: F.expr(f"{column} div 2")
    counts = marked.groupBy("library").agg(
        n(mated).alias("mates"),
        n(mated & duplicate).alias("duplicate_mates"),
        n(single).alias("singles"),
        n(single & duplicate).alias("single_duplicates"),
        n(extra & ~unmapped).alias("secondary_lines"),
        n(unmapped).alias("unmapped_lines"),
    )
    reads = F.col("singles") + F.col("mates")
    duplicates = F.col("single_duplicates") + F.col("duplicate_mates")
    return counts.select(
        "library",
        half("mates").alias("pairs"),
        half("duplicate_mates").alias("pair_duplicates"),
        "singles",
        "single_duplicates",
        "secondary_lines",
        "unmapped_lines",
        F.round(100.0 * F.try_divide(duplicates, reads), 4).alias("duplicate_pct"),
        library_size(half("mates"), half("mates") - half("duplicate_mates")).alias("library_size"),
    )


def copies_histogram(reads: DataFrame) -> DataFrame:
    """``library, paired, copies, fragments``: how many fragments were seen in how many copies."""
    groups = templates(reads).groupBy("library", "ends").agg(F.count("*").alias("copies"))
    return groups.groupBy("library", (F.size("ends") > 1).alias("paired"), "copies").agg(F.count("*").alias("fragments"))


#: Positions per tile when reads are brought together.
TILE = 1 << 12


def aligned_blocks(reads: DataFrame) -> Column:
    """The stretches aligned by M, = or X: offsets in the read and on the reference, and length."""
    start = F.struct(
        F.lit(0).alias("read_at"),
        F.lit(0).alias("ref_at"),
        F.array().cast("array<struct<read_at: int, ref_at: int, len: int>>").alias("blocks"),
    )

    def step(a, o):
        block = F.struct(a["read_at"].alias("read_at"), a["ref_at"].alias("ref_at"), o["len"].alias("len"))
        used = lambda kinds: F.when(o["op"].isin(*kinds), o["len"]).otherwise(0)
        return F.struct(
            (a["read_at"] + used("MIS=X")).alias("read_at"),
            (a["ref_at"] + used("MDN=X")).alias("ref_at"),
            F.when(o["op"].isin(*"M=X"), F.concat(a["blocks"], F.array(block))).otherwise(a["blocks"]).alias("blocks"),
        )

    return F.aggregate(G.cigar_steps(reads["cigar"]), start, step, lambda a: a["blocks"])


def aligned_spans(reads: DataFrame) -> DataFrame:
    """``chrom, start, end`` of every aligned block, for :func:`~tallyloom.operators.intervals.depth_runs`."""
    first = F.col("pos") + F.col("b.ref_at")
    return reads.select(F.col("rname").alias("chrom"), "pos", F.explode(aligned_blocks(reads)).alias("b")).select(
        "chrom", first.alias("start"), (first + F.col("b.len") - 1).alias("end")
    )


def aligned_bases(reads: DataFrame) -> DataFrame:
    """``rname, position, base, quality``: one row per base aligned by M, = or X."""
    return (
        reads.select("rname", "pos", "seq", "quals", F.explode(aligned_blocks(reads)).alias("b"))
        .select(
            "rname",
            (F.col("pos") + F.col("b.ref_at")).alias("at"),
            F.posexplode(
                F.arrays_zip(
                    F.split(F.substring("seq", F.col("b.read_at") + 1, F.col("b.len")), "").alias("base"),
                    F.slice("quals", F.col("b.read_at") + 1, F.col("b.len")).alias("quality"),
                )
            ).alias("i", "e"),
        )
        .select(
            "rname",
            (F.col("at") + F.col("i")).alias("position"),
            F.col("e.base").alias("base"),
            F.col("e.quality").alias("quality"),
        )
    )


def base_counts(reads: DataFrame, min_mean_quality: float = 30.0) -> DataFrame:
    """Depth and mean quality of each base at each position, above a threshold.

    Counts only; no genotype model. Reads are brought together by tile while they are
    still compact, so that a task folds the depth of its positions before the bases
    are shuffled. The rebalance is free to split a tile with very many reads; the
    partial aggregate then costs one row per position and task. Qualities travel as bytes
    where all of a read's fit.
    """
    fits = F.coalesce((F.array_max("quals") <= 127) & (F.array_min("quals") >= -128), F.lit(False))
    near = reads.select(
        "rname", "pos", "cigar", "seq", F.expr(f"pos div {TILE}").alias("tile"),
        F.when(fits, F.col("quals").cast("array<tinyint>")).alias("bytes"), F.when(~fits, F.col("quals")).alias("quals"),
    )
    near = near.hint("rebalance", "rname", "tile").withColumn("quals", F.coalesce(F.col("bytes").cast("array<int>"), "quals"))
    return (
        aligned_bases(near)
        .groupBy("rname", "position", "base")
        .agg(F.count("*").alias("depth"), F.sum("quality").alias("quality_sum"))
        .where(F.col("quality_sum") >= min_mean_quality * F.col("depth"))
        .select(
            "rname", "position", "base", "depth",
            F.round(F.col("quality_sum") / F.col("depth"), 3).alias("mean_quality"),
        )
    )
