"""Writers. Each one leaves sorting and formatting to Spark; none collects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import genome as G
from tallyloom.operators.callsets import sort_calls
from tallyloom.session import materialize
from tallyloom.sources.single_file import write_single_file

# Column headings of the two reports.
PAGE_REPORT = {
    "language": "Language",
    "lang_code": "Language-code",
    "total_views": "TotalViewsInThatLang",
    "top_title": "MostVisitedPageInThatLang",
    "top_views": "ViewsOfThatPage",
}
RETWEET_REPORT = {
    "language": "Language",
    "lang_code": "Language-code",
    "total_in_language": "TotalRetweetsInThatLang",
    "tweet_id": "IDOfTweet",
    "retweets": "RetweetCount",
    "text": "Text",
}


def write_report(ordered: DataFrame, headings: dict[str, str], path: str) -> None:
    """Quoted CSV with headings; an ordered frame stays ordered over its part files."""
    columns = [F.col(name).alias(heading) for name, heading in headings.items()]
    ordered.select(*columns).write.option("header", True).option("escape", '"').csv(path)


def write_bed(regions: DataFrame, path: str, legacy_end: bool = False) -> None:
    row = G.bed_text(F.col("chrom"), F.col("start"), F.col("end"), legacy_end)
    regions.orderBy("chrom", "start").select(row.alias("value")).write.text(path)


def write_region_list(regions: DataFrame, path: str) -> None:
    row = G.region_text(F.col("chrom"), F.col("start"), F.col("end"))
    regions.orderBy("chrom", "start").select(row.alias("value")).write.text(path)


def write_calls(sorted_calls: DataFrame, path: str) -> None:
    """Call lines without a header, in the order of the frame."""
    sorted_calls.select(F.col("line").alias("value")).write.text(path)


#: Alignments that one task sorts.
SORTED_ROWS = 1 << 20


def write_sorted_alignments(reads: DataFrame, path: str, n_partitions: int, rows_per_task: int = SORTED_ROWS) -> None:
    """Coordinate-sorted Parquet, one folder per reference.

    The ranges are cut over reference, position and read name, so a reference, or
    one position, that holds much of the data spans several files in order. There are
    ``n_partitions`` of them, or more where each would hold over ``rows_per_task`` rows, so
    a task's sort doesn't grow with the input. The reads are written first: they are
    counted and sampled before they are sorted.
    """
    order = ("ref_index", "pos", "qname", "flag")
    reads = materialize(reads, "unsorted")
    (
        reads.repartitionByRange(max(n_partitions, -(-reads.count() // rows_per_task)), *order)
        .sortWithinPartitions(*order)
        .write.partitionBy("ref_index")
        .parquet(path)
    )


# Header lines of the two formats.
SAM_VERSION = "@HD\tVN:1.6\tSO:coordinate"
VCF_VERSION = "##fileformat=VCFv4.2"
VCF_COLUMNS = ("#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO")


def _sequences(dictionary: DataFrame) -> list[tuple[str, int]]:
    """Names and lengths in order; a dictionary is a header, small enough for one machine."""
    rows = dictionary.select("ref_index", "name", "length").orderBy("ref_index").limit(1 << 20).collect()
    return [(r["name"], r["length"]) for r in rows]


def write_sam(reads: DataFrame, dictionary: DataFrame, path: str) -> int:
    """All reads as one alignment file in coordinate order, its header from the dictionary; returns its lines.

    Reads of unknown sequences come last. Expects ``ref_index`` and the eleven columns and tags.
    """
    header = [SAM_VERSION] + [f"@SQ\tSN:{name}\tLN:{length}" for name, length in _sequences(dictionary)]
    columns = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual", "tags")
    line = F.concat_ws("\t", *columns)
    lines = materialize(reads.select("ref_index", "pos", "qname", "flag", line.alias("value")), "sam-lines")
    return write_single_file(lines.orderBy(F.asc_nulls_last("ref_index"), "pos", "qname", "flag", "value"), path, header)


def write_vcf(calls: DataFrame, dictionary: DataFrame, path: str, samples: tuple[str, ...] = ()) -> int:
    """All calls as one file in order, its contigs from the dictionary; returns its lines."""
    columns = VCF_COLUMNS + (("FORMAT", *samples) if samples else ())
    contigs = [f"##contig=<ID={name},length={length}>" for name, length in _sequences(dictionary)]
    ordered = sort_calls(materialize(calls, "calls")).select(F.col("line").alias("value"))
    return write_single_file(ordered, path, [VCF_VERSION, *contigs, "\t".join(columns)])
