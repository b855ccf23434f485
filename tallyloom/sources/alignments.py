"""Alignment text, sequence dictionaries, target files and variant calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import genome as G
from tallyloom.functions.text import to_bigint
from tallyloom.session import materialize
from tallyloom.sources.lines import Parsed, number_lines, split_rejects, with_fields



def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``ref_index, name, length``: the first line is a header, order is the index.

    A length that is no number becomes 0. The result is a written table: its size is
    known when reads are joined to it, and each use reads it instead of parsing anew.
    """
    fields = F.split("value", r"\s+")
    after_colon = lambda c: F.regexp_replace(c, "^[^:]*:", "")
    parsed = (
        number_lines(spark, path)
        .where(F.col("pos") > 0)
        .select(
            (F.col("pos") - 1).cast("int").alias("ref_index"),
            after_colon(fields[1]).alias("name"),
            F.coalesce(after_colon(fields[2]).try_cast("int"), F.lit(0)).alias("length"),
        )
    )
    return materialize(parsed, "dictionary")


def parse_sam(lines: DataFrame, on_error: str = "quarantine", counter: Observation | str | None = None) -> Parsed:
    """The eleven alignment columns, ``tags`` and the last base covered."""
    fields = F.col("fields")
    text = lambda i: F.get(fields, i)
    whole = lambda i: F.get(fields, i).try_cast("int")
    parsed = with_fields(lines.where(~F.col("value").startswith("@")), "\t").select(
        "value",
        text(0).alias("qname"),
        whole(1).alias("flag"),
        text(2).alias("rname"),
        whole(3).alias("pos"),
        whole(4).alias("mapq"),
        text(5).alias("cigar"),
        text(6).alias("rnext"),
        whole(7).alias("pnext"),
        whole(8).alias("tlen"),
        text(9).alias("seq"),
        text(10).alias("qual"),
        F.slice(fields, 12, F.greatest(F.size(fields) - 11, F.lit(0))).alias("tags"),
    )
    parsed = parsed.withColumn("aln_end", G.alignment_end(F.col("pos"), F.col("cigar")))
    valid = F.col("qual").isNotNull()
    for name in ("flag", "pos", "mapq", "pnext", "tlen"):
        valid = valid & F.col(name).isNotNull()
    return split_rejects(parsed, valid, "value", on_error, counter)


def with_reference(reads: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Add ``ref_index`` and ``ref_length`` by sequence name (NULL if unknown).

    A written dictionary (:func:`read_dictionary`) tells its size: the planner sends a
    small one to every task and joins a long one by shuffle, where hot names are split.
    """
    dims = dictionary.select(
        F.col("name").alias("rname"), "ref_index", F.col("length").alias("ref_length")
    )
    return reads.join(dims, "rname", "left")


def mapped_reads(reads: DataFrame, first: int = 1, last: int = 24) -> DataFrame:
    """Mapped reads on the chosen references."""
    return reads.where(
        ~G.has_flag(F.col("flag"), G.UNMAPPED) & F.col("ref_index").between(first, last)
    )


_BED_HEADER = r"^(track|browser|#)"


def bed_header(lines: DataFrame) -> DataFrame:
    """The header lines of a target file."""
    return lines.where(F.col("value").rlike(_BED_HEADER))


def parse_bed(lines: DataFrame, on_error: str = "quarantine", counter: Observation | str | None = None) -> Parsed:
    """``chrom, start, end`` as one-based inclusive ranges, and the fields after them in ``rest``."""
    fields = F.split("value", "\t")
    parsed = lines.where(~F.col("value").rlike(_BED_HEADER) & (F.col("value") != "")).select(
        "value",
        F.get(fields, 0).alias("chrom"),
        (F.get(fields, 1).try_cast("int") + 1).alias("start"),
        F.get(fields, 2).try_cast("int").alias("end"),
        F.slice(fields, 4, F.greatest(F.size(fields) - 3, F.lit(0))).alias("rest"),
    )
    valid = F.col("start").isNotNull() & F.col("end").isNotNull()
    return split_rejects(parsed, valid, "value", on_error, counter)


def parse_vcf(lines: DataFrame, chr_only: bool = False, on_error: str = "quarantine", counter: Observation | str | None = None) -> Parsed:
    """Columns of variant calls, ``chrom_num`` and the whole ``line``.

    ``chr_only`` keeps lines that start with ``chr``; otherwise lines that do not
    start with ``#``.
    """
    value = F.col("value")
    keep = value.startswith("chr") if chr_only else ~value.startswith("#") & (F.trim(value) != "")
    fields = F.col("fields")
    text = lambda i: F.get(fields, i)
    parsed = with_fields(lines.where(keep), "\t").select(
        "value",
        text(0).alias("chrom"),
        text(1).try_cast("int").alias("pos"),
        text(2).alias("id"),
        text(3).alias("ref"),
        text(4).alias("alt"),
        text(5).alias("qual"),
        text(6).alias("filter"),
        text(7).alias("info"),
        text(8).alias("format"),
        F.slice(fields, 10, F.greatest(F.size(fields) - 9, F.lit(0))).alias("samples"),
        G.chromosome_number(text(0)).alias("chrom_num"),
        value.alias("line"),
    )
    valid = F.col("pos").isNotNull() & F.col("alt").isNotNull()
    return split_rejects(parsed, valid, "value", on_error, counter)
