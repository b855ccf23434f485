"""FASTQ, alignments, intervals and calls, derived from documents and order lines."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.functions import genome as G
from tallyloom.operators import balance as B
from tallyloom.operators import callsets as C
from tallyloom.operators import intervals as I
from tallyloom.operators import reads as R
from tallyloom.plans.alignments import call_input, prepare, regions_of
from tallyloom.session import materialize, scratch_path
from tallyloom.sources import alignments as A
from tallyloom.sources import fastq, sinks
from tallyloom.sources.lines import number_lines, read_lines
from tallyloom.workload.registry import query, table

HEX = "0123456789abcdef"
BASES = "ACGTACGTACGTACGT"
QUALS = "#@)+.258;>ADGIJK"

# ---- FASTQ ---------------------------------------------------------------

N_CHUNKS = 7


def write_fastq(spark, sf_dir, mate: int) -> str:
    """One read per document, in document order, over several files."""
    digest = F.md5(F.concat("text", F.lit(str(mate))))
    read = F.concat_ws(
        "\n",
        F.concat(F.lit("@d"), F.col("doc_id").cast("string"), F.lit(f"/{mate}")),
        F.translate(digest, HEX, BASES),
        F.lit("+"),
        F.translate(digest, HEX, QUALS),
    )
    path = scratch_path(spark, "fastq")
    (
        table(spark, sf_dir, "documents")
        .select("doc_id", read.alias("value"))
        .repartitionByRange(3, "doc_id")
        .sortWithinPartitions("doc_id")
        .select("value")
        .write.text(path)
    )
    return path


def _mate_sql(mate: int) -> str:
    return f"""select row_number() over (order by doc_id) - 1 as read_id, '@d' || doc_id || '/{mate}' as name,
    translate(md5(text || '{mate}'), '{HEX}', '{BASES}') as seq, '+' as plus,
    translate(md5(text || '{mate}'), '{HEX}', '{QUALS}') as qual from documents"""


@query(
    "numbered_lines",
    f"""select 4 * read_id + k as pos, case k when 0 then name when 1 then seq when 2 then plus else qual end as value
    from ({_mate_sql(1)}), unnest(generate_series(0, 3)) u(k)""",
)
def numbered_lines(spark, sf_dir):
    return number_lines(spark, write_fastq(spark, sf_dir, 1))


@query("fastq_reads", _mate_sql(1))
def fastq_reads(spark, sf_dir):
    return fastq.read_fastq(spark, write_fastq(spark, sf_dir, 1)).rows


def pairs(spark, sf_dir):
    mates = [fastq.read_fastq(spark, write_fastq(spark, sf_dir, m)).rows for m in (1, 2)]
    return fastq.pair_mates(*mates).rows


PAIRS = f"""
pairs as (
  select a.read_id, a.name as name1, a.seq as seq1, a.plus as plus1, a.qual as qual1,
         b.name as name2, b.seq as seq2, b.plus as plus2, b.qual as qual2
  from ({_mate_sql(1)}) a join ({_mate_sql(2)}) b using (read_id))
"""


@query("fastq_pairs", f"with {PAIRS} select * from pairs")
def fastq_pairs(spark, sf_dir):
    return pairs(spark, sf_dir)


@query(
    "fastq_chunks",
    f"""with {PAIRS}, s as (select cast(ceil(count(*) / {N_CHUNKS}.0) as bigint) as size from documents)
    select 'output' || (read_id // size * size) as chunk, count(*) * 8 as lines, count(distinct read_id // size) as files,
           min(name1) as least_name, greatest(max(seq1), max(seq2)) as greatest_seq
    from pairs, s group by read_id // size, size""",
)
def fastq_chunks(spark, sf_dir):
    """Written as gzip chunks and read back, one row per chunk."""
    path = scratch_path(spark, "chunks")
    paired = materialize(pairs(spark, sf_dir), "pairs")
    fastq.write_chunks(paired, path, N_CHUNKS, paired.count())
    return (
        fastq.read_chunks(spark, path)
        .groupBy("chunk")
        .agg(
            F.count("*").alias("lines"),
            F.countDistinct("file_name").alias("files"),
            F.min(F.when(F.col("value").rlike(r"^@d[0-9]+/1$"), F.col("value"))).alias("least_name"),
            F.max(F.when(F.col("value").rlike("^[ACGT]+$"), F.col("value"))).alias("greatest_seq"),
        )
    )


# ---- Alignments ----------------------------------------------------------


def write_dictionary(spark, sf_dir) -> str:
    """Nations as sequences: chrM, chr1 to chr22, chrX, chrY."""
    line = F.concat(F.lit("@SQ\tSN:"), "name", F.lit("\tLN:"), F.col("length").cast("string"))
    lines = dictionary(spark, sf_dir).select(line.alias("value"), "ref_index")
    header = spark.range(1).select(F.lit("@HD\tVN:1.0\tSO:unsorted").alias("value"), F.lit(-1).alias("ref_index"))
    path = scratch_path(spark, "dictionary")
    header.unionAll(lines).orderBy("ref_index").select("value").write.text(path)
    return path


REF = "(l_suppkey % 25)"
CHROM = f"case {REF} when 0 then 'chrM' when 23 then 'chrX' when 24 then 'chrY' else 'chr' || cast({REF} as string) end"


def sam_columns(spark, sf_dir):
    """One alignment per order line, as columns; late shipments are unmapped."""
    q = F.col("l_quantity").cast("int").cast("string")
    number = F.col("l_linenumber")
    cigar = (
        F.when(number == 2, F.concat(F.lit("2S"), q, F.lit("M")))
        .when(number == 3, F.concat(q, F.lit("M1I2M")))
        .when(number == 4, F.concat(q, F.lit("M2D3M")))
        .when(number == 5, F.concat(q, F.lit("M3S")))
        .otherwise(F.concat(q, F.lit("M")))
    )
    extra = F.when(number == 2, 2).when(number.between(3, 5), 3).otherwise(0)
    unmapped = F.col("l_shipdate") >= F.lit("2001-06-01").cast("timestamp_ntz")
    items = table(spark, sf_dir, "lineitem").select(
        F.concat_ws(
            ":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd")
        ).alias("qname"),
        (F.when(F.col("l_linestatus") == "O", G.REVERSE).otherwise(0) + F.when(unmapped, G.UNMAPPED).otherwise(0)).alias("flag"),
        F.when(unmapped, "*").otherwise(F.expr(CHROM)).alias("rname"),
        F.when(unmapped, 0)
        .otherwise(F.expr(f"cast((l_partkey * 37 + l_linenumber) % (50000 + 1000 * {REF}) + 1 as int)"))
        .alias("pos"),
        F.lit(60).alias("mapq"),
        F.when(unmapped, "*").otherwise(cigar).alias("cigar"),
        F.lit("*").alias("rnext"),
        F.lit(0).alias("pnext"),
        F.lit(0).alias("tlen"),
        (F.col("l_quantity").cast("int") + extra).alias("length"),
        "l_returnflag",
    )
    digest = F.sha2("qname", 256).substr(F.lit(1), F.col("length"))
    return items.withColumn("digest", digest).select(
        *[c for c in items.columns if c not in ("length", "l_returnflag")],
        F.translate("digest", HEX, BASES).alias("seq"),
        F.when(F.col("l_returnflag") == "R", F.col("digest")).otherwise(F.upper("digest")).alias("qual"),
        F.array(F.lit("NM:i:0"), F.concat(F.lit("XR:Z:"), "l_returnflag")).alias("tags"),
    )


def write_sam(spark, sf_dir) -> str:
    """The alignments as text, with a header line."""
    header = spark.range(1).select(F.lit("@HD\tVN:1.0").alias("value"))
    path = scratch_path(spark, "sam")
    header.unionAll(sam_columns(spark, sf_dir).select(F.concat_ws("\t", "*").alias("value"))).write.text(path)
    return path


def sam_lines(spark, sf_dir):
    return read_lines(spark, write_sam(spark, sf_dir))


SAM = f"""
raw as (
  select l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey || ':' || strftime(l_shipdate, '%Y%m%d') as qname,
         l_shipdate >= timestamp '2001-06-01' as unmapped, l_linenumber as num, cast(l_quantity as integer) as q,
         cast({REF} as integer) as ref, {CHROM} as chrom, 50000 + 1000 * {REF} as ref_length,
         cast((l_partkey * 37 + l_linenumber) % (50000 + 1000 * {REF}) + 1 as integer) as p1,
         case when l_linestatus = 'O' then 16 else 0 end as strand, l_returnflag as rf
  from lineitem),
sam as (
  select qname, strand + case when unmapped then 4 else 0 end as flag,
         case when unmapped then '*' else chrom end as rname, case when unmapped then 0 else p1 end as pos, 60 as mapq,
         case when unmapped then '*' else case num when 2 then '2S' || q || 'M' when 3 then q || 'M1I2M'
              when 4 then q || 'M2D3M' when 5 then q || 'M3S' else q || 'M' end end as cigar,
         translate(substring(sha256(qname), 1, len), '{HEX}', '{BASES}') as seq,
         case when rf = 'R' then substring(sha256(qname), 1, len) else upper(substring(sha256(qname), 1, len)) end as qual,
         case when unmapped then -1 else p1 - 1 + q + case num when 3 then 2 when 4 then 5 else 0 end end as aln_end,
         ref, ref_length, rf, num, q, unmapped
  from (select *, q + case num when 2 then 2 when 3 then 3 when 4 then 3 when 5 then 3 else 0 end as len from raw)),
mapped as (select * from sam where not unmapped and ref between 1 and 24),
usable as (
  select *, case when num = 4 and aln_end - ref_length between 3 and 5 then pos - 1 + q else least(aln_end, ref_length) end as e,
         aln_end > ref_length as past_end, pos - case when num = 2 then 2 else 0 end as fwd,
         aln_end + case when num = 5 then 3 when num = 4 and aln_end - ref_length >= 3 then -2
                        when num = 3 and aln_end - ref_length >= 2 then 1 else 0 end as rev,
         list_transform(string_split(qual, ''), lambda c: ascii(c) - 33) as quals
  from mapped)
"""


def dictionary(spark, sf_dir):
    """The nations as a dictionary, without the text in between."""
    key = F.col("n_nationkey")
    name = F.when(key == 0, "M").when(key == 23, "X").when(key == 24, "Y").otherwise(key.cast("string"))
    return table(spark, sf_dir, "nation").select(
        key.alias("ref_index"), F.concat(F.lit("chr"), name).alias("name"), (50000 + 1000 * key).alias("length")
    )


def alignments(spark, sf_dir):
    """The alignments as parsed rows, without the text in between."""
    end = G.alignment_end(F.col("pos"), F.col("cigar"))
    return sam_columns(spark, sf_dir).withColumn("aln_end", end)


def reads(spark, sf_dir):
    return prepare(alignments(spark, sf_dir), dictionary(spark, sf_dir))


def mapped(spark, sf_dir):
    placed = A.mapped_reads(A.with_reference(alignments(spark, sf_dir), dictionary(spark, sf_dir)))
    return placed.select("qname", "flag", "ref_index", "pos", "aln_end")


@query(
    "sequence_dictionary",
    """select n_nationkey as ref_index, 'chr' || case n_nationkey when 0 then 'M' when 23 then 'X' when 24 then 'Y' else cast(n_nationkey as varchar) end as name,
    50000 + 1000 * n_nationkey as length from nation""",
)
def sequence_dictionary(spark, sf_dir):
    return A.read_dictionary(spark, write_dictionary(spark, sf_dir))


@query(
    "sam_parse",
    f"""with {SAM} select qname, flag, rname, pos, mapq, cigar, '*' as rnext, 0 as pnext, 0 as tlen, seq, qual,
    'NM:i:0 XR:Z:' || rf as tags, aln_end from sam""",
)
def sam_parse(spark, sf_dir):
    return A.parse_sam(sam_lines(spark, sf_dir)).rows.withColumn("tags", F.concat_ws(" ", "tags"))


@query("sam_mapped", f"with {SAM} select qname, flag, ref as ref_index, pos, aln_end from mapped")
def sam_mapped(spark, sf_dir):
    """From text: alignment lines and a dictionary file."""
    reference = A.read_dictionary(spark, write_dictionary(spark, sf_dir))
    parsed = A.with_reference(A.parse_sam(sam_lines(spark, sf_dir)).rows, reference)
    return A.mapped_reads(parsed).select("qname", "flag", "ref_index", "pos", "aln_end")


@query("reads_per_chrom", f"with {SAM} select ref as ref_index, count(*) as count from mapped group by ref")
def reads_per_chrom(spark, sf_dir):
    return B.group_sizes(mapped(spark, sf_dir), "ref_index")


@query(
    "clean_alignments",
    f"""with {SAM} select qname, flag, not unmapped and aln_end > ref_length as past_end,
    cast(case when unmapped then aln_end when num = 4 and aln_end - ref_length between 3 and 5 then pos - 1 + q
         else least(aln_end, ref_length) end as integer) as aln_end,
    case when unmapped then 0 else 60 end as mapq from sam""",
)
def clean_alignments(spark, sf_dir):
    parsed = A.with_reference(alignments(spark, sf_dir), dictionary(spark, sf_dir))
    out = R.clean_alignments(parsed)
    return out.select("qname", "flag", "past_end", "aln_end", "mapq")


@query(
    "read_groups",
    f"""with {SAM} select qname, flag, 'GROUP1' as rg_id, 'LIB1' as library, 'ILLUMINA' as platform,
    'UNIT1' as platform_unit, 'SAMPLE1' as sample from sam""",
)
def read_groups(spark, sf_dir):
    return R.with_read_group(alignments(spark, sf_dir)).select("qname", "flag", *R.READ_GROUP)


def _sampled(spark, sf_dir):
    """Three samples, one of them with shifted qualities."""
    return reads(spark, sf_dir).withColumn("sample", F.regexp_replace(F.col("tags")[1], "XR:Z:", ""))


@query(
    "quality_encoding",
    f"""with {SAM} select rf as sample, max(list_max(quals)) as max_quality,
    case when max(list_max(quals)) <= 60 then 'SANGER' else 'ILLUMINA' end as encoding from usable group by rf""",
)
def quality_encoding(spark, sf_dir):
    return R.sample_encoding(_sampled(spark, sf_dir))


@query(
    "quality_fix",
    f"""with {SAM}, fixed as (select qname, flag, case when rf = 'R' then list_transform(quals, lambda x: x - 31) else quals end as quals from usable)
    select qname, flag, array_to_string(quals, ' ') as quals, list_min(quals) < 0 as bad_quality from fixed""",
)
def quality_fix(spark, sf_dir):
    sampled = _sampled(spark, sf_dir)
    fixed = R.fix_qualities(sampled, R.sample_encoding(sampled))
    return fixed.select("qname", "flag", F.array_join(F.col("quals").cast("array<string>"), " ").alias("quals"), "bad_quality")


MARKED = f"""
{SAM},
ranked as (
  select *, row_number() over (
    partition by rname, flag & 16, case when flag & 16 <> 0 then rev else fwd end
    order by list_sum(quals) desc, qname desc) as rn
  from usable),
marked as (select *, case when rn > 1 then flag + 1024 else flag end as new_flag from ranked)
"""


@query("mark_duplicates", f"with {MARKED} select qname, new_flag as flag, rname, pos from marked")
def mark_duplicates(spark, sf_dir):
    return R.mark_duplicates(reads(spark, sf_dir)).select("qname", "flag", "rname", "pos")


def pair_lines(spark, sf_dir):
    """Each read as a pair, its mate on the other strand 100 positions on, and a supplementary line."""
    flag = F.col("flag")
    line = lambda f, shift: F.struct(f.alias("flag"), F.lit(shift).alias("shift"))
    lines = F.array(
        line(flag.bitwiseOR(65), 0), line(flag.bitwiseXOR(16).bitwiseOR(129), 100), line(flag.bitwiseOR(2113), 0)
    )
    return (
        reads(spark, sf_dir)
        .withColumn("line", F.explode(lines))
        .withColumns({c: F.col(c) + F.col("line.shift") for c in ("pos", "aln_end")} | {"flag": F.col("line.flag")})
    )


@query(
    "mark_duplicate_pairs",
    f"""with {SAM}, ranked as (
      select *, row_number() over (partition by rname, flag & 16, fwd, rev order by list_sum(quals) desc, qname desc) > 1 as dup from usable)
    select qname, cast(flag | 65 | case when dup then 1024 else 0 end as integer) as flag, rname, pos from ranked
    union all select qname, cast(xor(flag, 16) | 129 | case when dup then 1024 else 0 end as integer), rname, pos + 100 from ranked
    union all select qname, cast(flag | 2113 as integer), rname, pos from ranked""",
)
def mark_duplicate_pairs(spark, sf_dir):
    return R.mark_duplicates(pair_lines(spark, sf_dir)).select("qname", "flag", "rname", "pos")


@query(
    "duplicate_metrics",
    f"""with {MARKED} select 'LIB1' as library, count(*) as reads, count(*) filter (where rn > 1) as duplicates,
    round(100.0 * count(*) filter (where rn > 1) / count(*), 4) as duplicate_pct from marked""",
)
def duplicate_metrics(spark, sf_dir):
    return R.duplicate_metrics(R.mark_duplicates(reads(spark, sf_dir)))


# The bracket is halved as in the library: y = seen / size.
LIBRARY_SQL = f"""
with recursive {MARKED},
pair_marks as (
  select row_number() over (partition by rname, flag & 16, fwd, rev order by list_sum(quals) desc, qname desc) > 1 as dup from usable),
sums as (select count(*) as pairs, count(*) filter (where dup) as pair_duplicates from pair_marks),
halved(k, low, high, ratio) as (
  select 0, 0::double, pairs / (pairs - pair_duplicates)::double, (pairs - pair_duplicates)::double / pairs from sums
  union all
  select k + 1, case when (1 - exp(-(low + high) / 2)) / ((low + high) / 2) > ratio then (low + high) / 2 else low end,
         case when (1 - exp(-(low + high) / 2)) / ((low + high) / 2) > ratio then high else (low + high) / 2 end, ratio
  from halved where k < {R.HALVINGS})
select 'LIB1' as library, pairs, pair_duplicates, 0::bigint as singles, 0::bigint as single_duplicates, pairs as secondary_lines,
  0::bigint as unmapped_lines, round(100.0 * pair_duplicates / pairs, 4) as duplicate_pct,
  case when pair_duplicates > 0 then cast(round(pairs / ((low + high) / 2)) as bigint) end as library_size
from sums, halved where k = {R.HALVINGS}
"""


@query("duplicate_library_size", LIBRARY_SQL)
def duplicate_library_size(spark, sf_dir):
    return R.library_metrics(R.mark_duplicates(pair_lines(spark, sf_dir)))


@query(
    "duplicate_histogram",
    f"""with {SAM}, groups as (select rname, flag & 16 as strand, fwd, rev, count(*) as copies from usable group by all)
    select 'LIB1' as library, true as paired, copies, count(*) as fragments from groups group by copies""",
)
def duplicate_histogram(spark, sf_dir):
    return R.copies_histogram(pair_lines(spark, sf_dir))


# Read-relative blocks of the five CIGAR shapes: (read start, reference shift, length).
BASES_SQL = f"""
{MARKED},
blocks as (
  select rname, pos, seq, quals, rn, ref_length, unnest(case num
      when 2 then [{{'r': 2, 's': 0, 'n': q}}]
      when 3 then [{{'r': 0, 's': 0, 'n': q}}, {{'r': q + 1, 's': q, 'n': 2}}]
      when 4 then [{{'r': 0, 's': 0, 'n': q}}, {{'r': q, 's': q + 2, 'n': 3}}]
      else [{{'r': 0, 's': 0, 'n': q}}] end) as b
  from marked),
bases as (
  select rname, pos + b.s + i as position, substring(seq, b.r + i + 1, 1) as base, quals[b.r + i + 1] as quality, rn
  from (select *, unnest(generate_series(0, b.n - 1)) as i from blocks) where pos + b.s + i <= ref_length)
"""
COUNTED = """select rname, cast(position as integer) as position, base, count(*) as depth, round(sum(quality) / count(*), 3) as mean_quality
from bases {where} group by all having sum(quality) >= 30.0 * count(*)"""


@query("base_counts", f"with {BASES_SQL} {COUNTED.format(where='')}")
def base_counts(spark, sf_dir):
    return R.base_counts(reads(spark, sf_dir), 30.0)


@query("call_bases", f"with {BASES_SQL} {COUNTED.format(where='where rn = 1')}")
def call_bases(spark, sf_dir):
    """Base counts without duplicates, through the whole alignment plan."""
    return call_input(reads(spark, sf_dir), targets(spark, sf_dir)).bases


DEPTH_SQL = f"""
with {BASES_SQL},
stretches as (select rname as chrom, pos + b.s as s, least(pos + b.s + b.n - 1, ref_length) as e from blocks where pos + b.s <= ref_length),
events as (
  select chrom, place, sum(change) as change
  from (select chrom, s as place, 1 as change from stretches union all select chrom, e + 1, -1 from stretches) group by all having sum(change) <> 0),
swept as (select chrom, place, sum(change) over w as depth, lead(place) over w as following from events window w as (partition by chrom order by place))
select chrom, place::bigint as start, following::bigint - 1 as "end", depth::bigint as depth from swept where depth > 0
"""


@query("depth_runs", DEPTH_SQL)
def depth_runs(spark, sf_dir):
    """Depth of aligned bases, one row per stretch of equal depth."""
    return I.depth_runs(R.aligned_spans(reads(spark, sf_dir)))


# ---- Placement -----------------------------------------------------------

N_PARTS = 5

PLAN_SQL = f"""
sizes as (select ref, count(*) as c, row_number() over (order by count(*) desc, ref) as k from mapped group by ref),
place(k, loads, ref, c, p) as (
  select 0::bigint, [{", ".join(["0::bigint"] * N_PARTS)}], 0, 0::bigint, 0
  union all
  select s.k, list_transform(range({N_PARTS}), lambda j: loads[j + 1] + case when j = list_position(loads, list_min(loads)) - 1 then s.c else 0 end),
         s.ref, s.c, cast(list_position(loads, list_min(loads)) - 1 as integer)
  from place join sizes s on s.k = place.k + 1),
plan as (select ref as ref_index, c as count, p as partition from place where k > 0)
"""


@query("partition_plan", f"with recursive {SAM}, {PLAN_SQL} select * from plan")
def partition_plan(spark, sf_dir):
    return B.plan_partitions(reads_per_chrom(spark, sf_dir), "ref_index", N_PARTS)


@query(
    "balanced_partitions",
    f"""with recursive {SAM}, {PLAN_SQL} select partition, cast(sum(count) as bigint) as rows, 1::bigint as tasks, partition as task
    from plan group by partition""",
)
def balanced_partitions(spark, sf_dir):
    return B.partition_loads(B.balance(mapped(spark, sf_dir), "ref_index", N_PARTS))


@query(
    "balanced_many_groups",
    f"select count(*) as rows, {N_PARTS}::bigint as partitions, count(distinct l_orderkey) as groups, true as even from lineitem",
)
def balanced_many_groups(spark, sf_dir):
    """Orders as groups: each one whole, and the partitions within two parts of a share."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey")
    routed = B.balance(items, "l_orderkey", N_PARTS)
    loads = routed.groupBy(F.spark_partition_id()).agg(
        F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("groups")
    )
    return loads.agg(
        F.sum("n").alias("rows"),
        F.count("*").alias("partitions"),
        F.sum("groups").alias("groups"),  # as many as there are orders: none is in two partitions
        ((F.max("n") - F.min("n")) * N_PARTS * B.PARTS <= 2 * F.sum("n")).alias("even"),
    )


@query("even_partitions", f"with {SAM} select count(*) as rows, {N_PARTS}::bigint as partitions, true as even from mapped")
def even_partitions(spark, sf_dir):
    """Each task deals its rows out in turn, so no two partitions differ by more than one of its rows."""
    dealt = mapped(spark, sf_dir).select("qname", F.spark_partition_id().alias("task"))
    dealt = B.spread_evenly(dealt, N_PARTS).groupBy("task", F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
    per_task = dealt.groupBy("task").agg(
        F.sum("n").alias("rows"), F.count("*").alias("partitions"), (F.max("n") - F.min("n")).alias("apart")
    )
    return per_task.agg(
        F.sum("rows").alias("rows"), F.max("partitions").alias("partitions"), (F.max("apart") <= 1).alias("even")
    )


@query(
    "coordinate_sorted",
    f"""with {SAM} select ref as ref_index, row_number() over (partition by ref order by pos, qname, flag) as n, qname, flag, pos
    from mapped""",
)
def coordinate_sorted(spark, sf_dir):
    """Written sorted, read back and numbered by the place in the files."""
    path = scratch_path(spark, "sorted")
    sinks.write_sorted_alignments(mapped(spark, sf_dir), path, N_PARTS)
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    files = rows.groupBy("ref_index", "file").agg(F.count("*").alias("rows"))  # a row per file: the only ones a window sees
    before = Window.partitionBy("ref_index").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("ref_index", "file", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    n = (F.col("offset") + F.col("row") + 1).cast("int").alias("n")
    return rows.join(offsets, ["ref_index", "file"]).select("ref_index", n, "qname", "flag", "pos")


# ---- Intervals -----------------------------------------------------------


def spans(spark, sf_dir):
    """Intervals straight from order lines."""
    start = F.expr(f"cast((l_partkey * 37 + l_linenumber) % (50000 + 1000 * {REF}) + 1 as int)")
    return table(spark, sf_dir, "lineitem").select(
        F.expr(CHROM).alias("chrom"), start.alias("start"), (start + F.col("l_quantity").cast("int") - 1).alias("end")
    )


SPANS = f"""
spans as (
  select {CHROM} as chrom, cast((l_partkey * 37 + l_linenumber) % (50000 + 1000 * {REF}) + 1 as integer) as s,
         cast((l_partkey * 37 + l_linenumber) % (50000 + 1000 * {REF}) + cast(l_quantity as integer) as integer) as e
  from lineitem)
"""


def _merge_sql(source: str, gap: int, out: str) -> str:
    return f"""
{out}_f as (select *, case when s <= max(e) over w + {gap} then 0 else 1 end as opens from {source}
  window w as (partition by chrom order by s, e rows between unbounded preceding and 1 preceding)),
{out}_g as (select *, sum(opens) over (partition by chrom order by s, e rows unbounded preceding) as isle from {out}_f),
{out} as (select chrom, min(s) as s, max(e) as e, count(*) as n from {out}_g group by chrom, isle)
"""


MERGED = f"{SPANS}, {_merge_sql('spans', 2, 'm')}"


def merged(spark, sf_dir):
    """A narrow gap, so that many regions remain."""
    return I.merge_within(spans(spark, sf_dir), 2)


@query("interval_merge", f'with {MERGED} select chrom, s as start, e as "end", n from m')
def interval_merge(spark, sf_dir):
    return merged(spark, sf_dir)


@query(
    "covered_regions",
    f"""with {SAM}, aligned as (select rname as chrom, pos as s, cast(e as integer) as e from usable), {_merge_sql('aligned', 51, 'm')}
    select chrom, s as start, e as "end", n from m""",
)
def covered_regions(spark, sf_dir):
    return regions_of(reads(spark, sf_dir))


WIDENED = f"""{MERGED}, wide_in as (select chrom, s, e from m), {_merge_sql('wide_in', 9, 'w')},
wide as (select chrom, greatest(s - 10, 1) as s, e, n from w)"""


@query("interval_merge_widened", f'with {WIDENED} select chrom, s as start, e as "end", n from wide')
def interval_merge_widened(spark, sf_dir):
    return I.merge_widened(merged(spark, sf_dir), 10)


@query(
    "region_summary",
    f"""with {MERGED} select count(*) as regions, arg_min(chrom, (chrom, s)) as first_chrom, arg_min(s, (chrom, s)) as first_start,
    arg_max(e, (chrom, s)) as last_end from m""",
)
def region_summary(spark, sf_dir):
    return I.region_summary(merged(spark, sf_dir))


@query("bed_rows", f"with {WIDENED} select chrom || chr(9) || (s - 1) || chr(9) || e as value from wide")
def bed_rows(spark, sf_dir):
    path = scratch_path(spark, "bed")
    sinks.write_bed(I.merge_widened(merged(spark, sf_dir), 10), path)
    return read_lines(spark, path)


@query("region_list", f"with {MERGED} select chrom || ':' || s || '-' || e as value from m")
def region_list(spark, sf_dir):
    path = scratch_path(spark, "regions")
    sinks.write_region_list(merged(spark, sf_dir), path)
    return read_lines(spark, path)


def target_lines(spark, sf_dir):
    """Target file of orders, with header lines."""
    key = F.col("o_custkey")
    ref = key % 25
    name = F.when(ref == 0, "M").when(ref == 23, "X").when(ref == 24, "Y").otherwise(ref.cast("string"))
    start = (F.col("o_orderkey") * 61) % 60000
    rows = table(spark, sf_dir, "orders").select(
        F.concat_ws("\t", F.concat(F.lit("chr"), name), start, start + 10 + key % 90, "o_orderkey", "o_orderstatus").alias("value")
    )
    header = spark.range(1).select(F.explode(F.array(F.lit("track name=targets"), F.lit("#made from orders"))).alias("value"))
    return header.unionAll(rows)


TARGETS = """
targets as (
  select 'chr' || case o_custkey % 25 when 0 then 'M' when 23 then 'X' when 24 then 'Y' else cast(o_custkey % 25 as varchar) end as chrom,
         cast(o_orderkey * 61 % 60000 + 1 as integer) as s, cast(o_orderkey * 61 % 60000 + 10 + o_custkey % 90 as integer) as e, o_orderkey || ',' || o_orderstatus as rest
  from orders)
"""


def targets(spark, sf_dir):
    return A.parse_bed(target_lines(spark, sf_dir)).rows


@query("bed_parse", f'with {TARGETS} select chrom, s as start, e as "end", rest from targets')
def bed_parse(spark, sf_dir):
    path = scratch_path(spark, "targets")
    target_lines(spark, sf_dir).write.text(path)
    return A.parse_bed(read_lines(spark, path)).rows.withColumn("rest", F.concat_ws(",", "rest"))


@query(
    "interval_intersect",
    f"""with {MERGED}, {TARGETS} select t.chrom, greatest(t.s, m.s) as start, least(t.e, m.e) as "end", t.rest
    from targets t join m on t.chrom = m.chrom and t.s <= m.e and m.s <= t.e""",
)
def interval_intersect(spark, sf_dir):
    met = I.intersect(targets(spark, sf_dir), merged(spark, sf_dir))
    return met.withColumn("rest", F.concat_ws(",", "rest"))


# Suppliers as families of nested regions, from 10 bases to 100 million; orders as targets of three lengths.
NESTED_SQL = """
with regions as (
  select (s_suppkey % 25)::int as chrom, greatest(center - (10 ** k)::bigint // 2, 1) as s, center + (10 ** k)::bigint // 2 as e
  from (select s_suppkey, (s_suppkey * 7368787) % 200000000 + 1 as center from supplier), unnest(generate_series(1, 8)) u(k)),
places as (select o_orderkey, o_custkey, (o_orderkey * 1299709) % 200000000 + 1 as s from orders),
spots as (
  select (o_custkey % 25)::int as chrom, o_orderkey, s,
         s + case o_orderkey % 50 when 0 then 100000000 when 1 then 1500000 else o_custkey % 90 end as e from places)
select 'chr' || t.chrom as chrom, o_orderkey, greatest(t.s, r.s) as start, least(t.e, r.e) as "end"
from spots t join regions r on t.chrom = r.chrom and t.s <= r.e and r.s <= t.e
"""


@query("interval_intersect_nested", NESTED_SQL)
def interval_intersect_nested(spark, sf_dir):
    """Regions inside regions, up to 100 million bases long, against short and very long targets."""
    chrom = lambda key: F.concat(F.lit("chr"), (F.col(key) % 25).cast("string")).alias("chrom")
    center = (F.col("s_suppkey") * 7368787) % 200000000 + 1
    size = F.explode(F.array(*[F.lit(10**k) for k in range(1, 9)]).cast("array<bigint>")).alias("size")
    families = table(spark, sf_dir, "supplier").select(chrom("s_suppkey"), center.alias("center"), size)
    half = F.expr("size div 2")
    regions = families.select("chrom", F.greatest(F.col("center") - half, F.lit(1)).alias("start"), (F.col("center") + half).alias("end"))
    start = (F.col("o_orderkey") * 1299709) % 200000000 + 1
    kind = F.col("o_orderkey") % 50
    length = F.when(kind == 0, 100000000).when(kind == 1, 1500000).otherwise(F.col("o_custkey") % 90)
    spots = table(spark, sf_dir, "orders").select(chrom("o_custkey"), "o_orderkey", start.alias("start"), (start + length).alias("end"))
    return I.intersect(spots, regions)


# ---- Calls ---------------------------------------------------------------


def call_lines(spark, sf_dir, truth: bool):
    """Calls of all order lines; in the second set returned lines have another allele."""
    digest = F.md5(F.concat_ws(":", "l_orderkey", "l_partkey"))
    base = lambda i: F.translate(F.substring(digest, i, 1), HEX, BASES)
    alt = base(2) if truth else F.when(F.col("l_returnflag") == "R", "N").otherwise(base(2))
    line = F.concat_ws(
        "\t",
        F.expr(CHROM),
        F.expr(f"(l_partkey * 37 + l_linenumber) % (50000 + 1000 * {REF}) + 1"),
        F.lit("."), base(1), alt, F.lit("50"), F.lit("."), F.lit("AC=1"), F.lit("GT"), F.lit("0/1"),
    )
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    rows = items.select(line.alias("value"))
    header = spark.range(1).select(
        F.explode(F.array(F.lit("##contig=<ID=chr1>"), F.lit("#CHROM\tPOS\tID"), F.lit(""))).alias("value")
    )
    return header.unionAll(rows)


def _calls_sql(name: str, alt: str) -> str:
    digest = "md5(l_orderkey || ':' || l_partkey)"
    base = lambda i: f"translate(substring({digest}, {i}, 1), '{HEX}', '{BASES}')"
    return f"""
{name} as (
  select {CHROM} as chrom, cast((l_partkey * 37 + l_linenumber) % (50000 + 1000 * {REF}) + 1 as integer) as pos,
         {base(1)} as ref, {alt.format(base=base(2))} as alt, cast(nullif({REF}, 0) as integer) as chrom_num
  from lineitem)
"""


TRUTH = _calls_sql("truth", "{base}")
CALLS = _calls_sql("calls", "case when l_returnflag = 'R' then 'N' else {base} end")
LINE = "chrom || chr(9) || pos || chr(9) || '.' || chr(9) || ref || chr(9) || alt || chr(9) || '50' || chr(9) || '.' || chr(9) || 'AC=1' || chr(9) || 'GT' || chr(9) || '0/1'"


@query(
    "vcf_parse",
    f"""with {TRUTH} select chrom, pos, '.' as id, ref, alt, '50' as qual, '.' as filter, 'AC=1' as info, 'GT' as format,
    '0/1' as samples, chrom_num, {LINE} as line from truth""",
)
def vcf_parse(spark, sf_dir):
    path = scratch_path(spark, "vcf")
    call_lines(spark, sf_dir, True).write.text(path)
    return A.parse_vcf(read_lines(spark, path)).rows.withColumn("samples", F.concat_ws(" ", "samples"))


@query(
    "vcf_sorted",
    f"""with {TRUTH} select row_number() over (order by chrom_num nulls last, chrom, pos, {LINE}) - 1 as pos, {LINE} as value from truth""",
)
def vcf_sorted(spark, sf_dir):
    """Written in order; the line numbers of the written files show the order."""
    path = scratch_path(spark, "sorted-calls")
    # Written before the sort, which reads its rows twice: once to choose the ranges.
    calls = materialize(A.parse_vcf(call_lines(spark, sf_dir, True), chr_only=True).rows, "calls")
    sinks.write_calls(C.sort_calls(calls), path)
    return number_lines(spark, path)


CONTIGS = """
contigs as (
  select n_nationkey as k, 'chr' || case n_nationkey when 0 then 'M' when 23 then 'X' when 24 then 'Y' else cast(n_nationkey as varchar) end as name,
         50000 + 1000 * n_nationkey as length from nation)
"""


@query(
    "vcf_single_file",
    f"""with {TRUTH}, {CONTIGS}, heads as (
      select 0 as pos, '##fileformat=VCFv4.2' as value union all select k + 1, '##contig=<ID=' || name || ',length=' || length || '>' from contigs
      union all select 26, array_to_string(['#CHROM', 'POS', 'ID', 'REF', 'ALT', 'QUAL', 'FILTER', 'INFO', 'FORMAT', 'S1'], chr(9)))
    select pos::bigint as pos, value from heads
    union all select row_number() over (order by chrom_num nulls last, chrom, pos, {LINE}) + 26, {LINE} from truth""",
)
def vcf_single_file(spark, sf_dir):
    """One file with its header, read back with line numbers."""
    path = f"{scratch_path(spark, 'calls')}.vcf"
    calls = A.parse_vcf(call_lines(spark, sf_dir, True), chr_only=True).rows
    sinks.write_vcf(calls, dictionary(spark, sf_dir), path, ("S1",))
    return number_lines(spark, path)


@query(
    "sam_single_file",
    f"""with {SAM}, {CONTIGS}, heads as (
      select 0 as pos, '@HD' || chr(9) || 'VN:1.6' || chr(9) || 'SO:coordinate' as value
      union all select k + 1, '@SQ' || chr(9) || 'SN:' || name || chr(9) || 'LN:' || length from contigs),
    texts as (select ref, pos, qname, flag, concat_ws(chr(9), qname, flag, rname, pos, mapq, cigar, '*', '0', '0', seq, qual, 'NM:i:0', 'XR:Z:' || rf) as value from mapped)
    select pos::bigint as pos, value from heads
    union all select row_number() over (order by ref, pos, qname, flag, value) + 25, value from texts""",
)
def sam_single_file(spark, sf_dir):
    """Mapped reads in coordinate order as one alignment file with the dictionary as its header."""
    path = f"{scratch_path(spark, 'reads')}.sam"
    reference = dictionary(spark, sf_dir)
    placed = A.mapped_reads(A.with_reference(alignments(spark, sf_dir), reference))
    sinks.write_sam(placed, reference, path)
    return number_lines(spark, path)


@query("calls_per_chrom", f"with {TRUTH} select chrom_num, count(*) as calls from truth group by chrom_num")
def calls_per_chrom(spark, sf_dir):
    calls = A.parse_vcf(call_lines(spark, sf_dir, True)).rows
    return calls.groupBy("chrom_num").agg(F.count("*").alias("calls"))


KEYS = "select distinct chrom || ',' || pos || ',' || ref || ',' || alt as key from"


@query(
    "vcf_concordance",
    f"""with {TRUTH}, {CALLS}, t as ({KEYS} truth), c as ({KEYS} calls)
    select count(t.key) as total, count(*) filter (where t.key is not null and c.key is not null) as matches,
           count(*) filter (where c.key is null) as diff, count(*) filter (where t.key is null) as extra
    from t full join c on t.key = c.key""",
)
def vcf_concordance(spark, sf_dir):
    truth, calls = (C.call_keys(call_lines(spark, sf_dir, t)) for t in (True, False))
    return C.concordance(truth, calls)


@query("calls_missed", f"with {TRUTH}, {CALLS} {KEYS} truth except {KEYS} calls")
def calls_missed(spark, sf_dir):
    truth, calls = (C.call_keys(call_lines(spark, sf_dir, t)) for t in (True, False))
    return C.missed_keys(truth, calls)


@query("calls_shared", f"with {TRUTH}, {CALLS} {KEYS} truth intersect {KEYS} calls")
def calls_shared(spark, sf_dir):
    truth, calls = (C.call_keys(call_lines(spark, sf_dir, t)) for t in (True, False))
    return C.shared_keys(truth, calls)
