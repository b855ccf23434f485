"""Expressions over alignment, interval and variant columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the alignment formats.
PAIRED = 1
UNMAPPED = 4
MATE_UNMAPPED = 8
REVERSE = 16
SECOND_IN_PAIR = 128
SECONDARY = 256
DUPLICATE = 1024
SUPPLEMENTARY = 2048
PHRED_OFFSET = 33
SANGER_MAX = 60
ILLUMINA_SHIFT = 31


def has_flag(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(bit)) != 0


def _sum_of(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda total, n: total + n.cast("int"))


def alignment_end(pos: Column, cigar: Column) -> Column:
    """Last reference base covered: operations M, D, N, = and X consume the reference."""
    spans = F.regexp_extract_all(cigar, F.lit(r"([0-9]+)[MDN=X]"), 1)
    return pos - 1 + _sum_of(spans)


def cigar_steps(cigar: Column) -> Column:
    """The operations as structs of ``len`` and ``op``."""
    step = F.lit(r"([0-9]+)([MIDNSHP=X])")
    return F.arrays_zip(
        F.regexp_extract_all(cigar, step, 1).cast("array<int>").alias("len"),
        F.regexp_extract_all(cigar, step, 2).alias("op"),
    )


def clip_past(cigar: Column, room: Column) -> Column:
    """The operations with what lies beyond ``room`` reference bases turned into a soft clip.

    Gaps and insertions before the clip go with it: a gap is dropped, an insertion is
    clipped. One fold; ``gap`` holds what counts only if aligned bases follow.
    """
    start = F.struct(
        room.cast("int").alias("room"),
        F.lit(0).alias("clip"),
        F.lit("").alias("out"),
        F.lit("").alias("gap"),
        F.lit(0).alias("inserted"),
        F.lit("").alias("hard"),
    )

    def step(a, o):
        n, op = o["len"], o["op"]
        text = F.concat(n.cast("string"), op)
        aligned, skips = op.isin("M", "=", "X"), op.isin("D", "N")
        fits = F.when(aligned, F.greatest(F.least(n, a["room"]), F.lit(0))).otherwise(0)
        leading = op.isin("S", "H") & ~a["out"].rlike("[M=X]") & (a["clip"] == 0)
        lost = F.when(aligned & (fits == 0), n + a["inserted"]).when(aligned, n - fits).when((op == "S") & ~leading, n)
        taken = F.concat(a["out"], a["gap"], fits.cast("string"), op)
        open_gap = (skips | (op == "I") | (op == "P")) & (a["clip"] == 0)
        return F.struct(
            F.when(aligned | skips, a["room"] - n).otherwise(a["room"]).alias("room"),
            (a["clip"] + F.coalesce(lost, F.lit(0)) + F.when((op == "I") & ~open_gap, n).otherwise(0)).alias("clip"),
            F.when(fits > 0, taken).when(leading, F.concat(a["out"], text)).otherwise(a["out"]).alias("out"),
            F.when(aligned, "").when(open_gap, F.concat(a["gap"], text)).otherwise(a["gap"]).alias("gap"),
            F.when(aligned, 0).when(open_gap & (op == "I"), a["inserted"] + n).otherwise(a["inserted"]).alias("inserted"),
            F.when((op == "H") & ~leading, text).otherwise(a["hard"]).alias("hard"),
        )

    def end(a):
        clip = a["clip"] + a["inserted"]
        return F.concat(a["out"], F.when(clip > 0, F.concat(clip.cast("string"), F.lit("S"))).otherwise(""), a["hard"])

    return F.aggregate(cigar_steps(cigar), start, step, end)


def unclipped_five_prime(pos: Column, end: Column, cigar: Column, flag: Column) -> Column:
    """Where the read's first base would align if nothing had been clipped."""
    lead = F.regexp_extract(cigar, r"^((?:[0-9]+[SH])+)", 1)
    tail = F.regexp_extract(cigar, r"((?:[0-9]+[SH])+)$", 1)
    clipped = lambda part: _sum_of(F.regexp_extract_all(part, F.lit("([0-9]+)"), 1))
    return F.when(has_flag(flag, REVERSE), end + clipped(tail)).otherwise(pos - clipped(lead))


def base_qualities(qual: Column) -> Column:
    """Phred numbers of a quality string; NULL where no qualities are stored."""
    codes = F.transform(F.split(qual, ""), lambda c: F.ascii(c) - PHRED_OFFSET)
    return F.when(qual != "*", codes)


def quality_encoding(max_quality: Column) -> Column:
    return F.when(max_quality <= SANGER_MAX, "SANGER").otherwise("ILLUMINA")


def shift_illumina(quals: Column) -> Column:
    return F.transform(quals, lambda q: q - ILLUMINA_SHIFT)


def has_negative(quals: Column) -> Column:
    return F.exists(quals, lambda q: q < 0)


def chromosome_number(chrom: Column) -> Column:
    """Number after the three-letter prefix, X is 23 and Y is 24; others are NULL."""
    name = F.substring(chrom, 4, 1 << 20)
    return F.when(name == "X", 23).when(name == "Y", 24).otherwise(name.try_cast("int"))


def bed_text(chrom: Column, start: Column, end: Column, legacy_end: bool = False) -> Column:
    """Zero-based half-open row of a one-based inclusive range.

    ``legacy_end`` lowers the end as well, which loses the last base.
    """
    stop = end - 1 if legacy_end else end
    return F.concat_ws("\t", chrom, start - 1, stop)


def region_text(chrom: Column, start: Column, end: Column) -> Column:
    return F.format_string("%s:%d-%d", chrom, start, end)


def variant_key(fields: Column) -> Column:
    """``chrom,pos,ref,alt`` of the fields of a call line."""
    return F.concat_ws(",", fields[0], fields[1], fields[3], fields[4])
