"""From alignment lines to cleaned, marked and counted reads."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import genome as G
from tallyloom.operators import intervals
from tallyloom.operators import reads as R
from tallyloom.session import materialize, shuffles_dropped
from tallyloom.sources.alignments import mapped_reads, parse_sam, with_reference
from tallyloom.sources.lines import Parsed


def prepare(parsed: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Mapped reads of the main references, cleaned, with qualities and read group."""
    reads = mapped_reads(with_reference(parsed, dictionary))
    reads = R.clean_alignments(reads).withColumn("quals", G.base_qualities(F.col("qual")))
    return R.with_read_group(reads)


def usable_reads(lines: DataFrame, dictionary: DataFrame, on_error: str = "quarantine") -> Parsed:
    """:func:`prepare` of alignment lines, and the lines that are none."""
    parsed = parse_sam(lines, on_error)
    return Parsed(prepare(parsed.rows, dictionary), parsed.rejects)


def regions_of(reads: DataFrame, gap: int = intervals.REGION_GAP) -> DataFrame:
    """Covered regions of reads."""
    spans = reads.select(F.col("rname").alias("chrom"), F.col("pos").alias("start"), F.col("aln_end").alias("end"))
    return intervals.covered_regions(spans, gap)


class CallInput(NamedTuple):
    """What a variant caller needs: marked reads, call regions and base counts."""

    reads: DataFrame
    regions: DataFrame
    bases: DataFrame


def call_input(reads: DataFrame, targets: DataFrame, min_mean_quality: float = 30.0) -> CallInput:
    """Written reads, so that the lines are parsed once for all three results, and numbered, so that they are marked where they lie."""
    with shuffles_dropped(reads.sparkSession):
        numbered = materialize(R.number_rows(reads, "_row"), "reads", compression="zstd")
        marked = R.mark_duplicates(numbered, "_row").drop("_row")
        regions = intervals.intersect(targets, regions_of(numbered))
    unique = marked.where(~G.has_flag(F.col("flag"), G.DUPLICATE))
    return CallInput(marked, regions, R.base_counts(unique, min_mean_quality))
