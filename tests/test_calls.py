from pyspark.sql import functions as F

from tallyloom.operators import callsets as C
from tallyloom.sources import sinks
from tallyloom.sources.alignments import parse_vcf

VCF = "\n".join(
    [
        "##contig=<ID=chr1>",
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",
        "chrX\t5\t.\tA\tG\t50\t.\t.",
        "chr2\t9\t.\tC\tT\t50\t.\t.",
        "chr1\t7\t.\tG\tA\t50\t.\t.",
        "chrM\t3\t.\tT\tC\t50\t.\t.",
        "",
        "other\t4\t.\tT\tC\t50\t.\t.\tGT\t0/1\t1/1",
        "chr3\tnowhere\t.\tT\tC",
    ]
)


def test_calls(lines, rows):
    parsed = parse_vcf(lines(VCF))
    assert rows(parsed.rejects) == [("chr3\tnowhere\t.\tT\tC",)]
    other = parsed.rows.where("chrom = 'other'").select("format", F.concat_ws(",", "samples").alias("s"))
    assert rows(other) == [("GT", "0/1,1/1")]
    assert parse_vcf(lines(VCF), chr_only=True).rows.count() == 4


def test_order(spark, lines, tmp_path):
    path = str(tmp_path / "calls")
    sinks.write_calls(C.sort_calls(parse_vcf(lines(VCF), chr_only=True).rows), path)
    got = [r.value.split("\t")[0] for r in spark.read.text(path).collect()]
    assert got == ["chr1", "chr2", "chrX", "chrM"]


def test_concordance(lines, rows):
    line = "chr1 {} . A G 50 . .".format
    truth = C.call_keys(lines("\n".join([line(1), line(2), line(3), line(3), "##contig=<ID=chr1>", "", "chr1 9"])))
    calls = C.call_keys(lines("\n".join([line(2), line(3).replace(" ", "\t"), line(8)])))
    assert rows(C.concordance(truth, calls)) == [(3, 2, 1, 1)]
    assert rows(C.missed_keys(truth, calls)) == [("chr1,1,A,G",)]
    assert rows(C.shared_keys(truth, calls)) == [("chr1,2,A,G",), ("chr1,3,A,G",)]
