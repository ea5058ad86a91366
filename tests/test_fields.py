"""Core columns, record validity and keys."""

import hashlib

import pytest
from pyspark.sql import functions as F

from genoframe import parse_vcf_lines, rejected_lines, sample_ids, vcf_header


def lines_of(spark, *values: str, file_path: str = "/d/f.vcf"):
    rows = [(value, file_path, file_path.rsplit("/", 1)[-1]) for value in values]
    return spark.createDataFrame(rows, "value string, file_path string, file_name string")


def tabbed(record: str) -> str:
    return record.replace(" ", "\t")


CHROM = tabbed("#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT S")


def parse_one(spark, record: str, **options):
    rows = parse_vcf_lines(lines_of(spark, CHROM, tabbed(record)), **options).collect()
    assert len(rows) == 1
    return rows[0]


def test_core_fields(spark):
    row = parse_one(spark, "chrM 999999999 rs1;rs2;rs3 ATTT A,<DEL>,G 0.001 q10;s50 .")
    assert (row.contig, row.start, row.end) == ("chrM", 999999998, 1000000002)
    assert row.names == ["rs1", "rs2", "rs3"]
    assert row.referenceAllele == "ATTT"
    assert row.alternateAlleles == ["A", "<DEL>", "G"]
    assert row.qual == 0.001
    assert row.filters == ["q10", "s50"]
    assert row.genotypes is None
    assert row.variant_id is None


def test_missing_values(spark):
    row = parse_one(spark, "1 1 . A . . . .")
    assert row.names == row.alternateAlleles == row.filters == []
    assert row.qual is None
    assert row.info.toPython() == {}


def test_end_ignores_info(spark):
    row = parse_one(spark, "1 100 . N <DEL> . PASS SVTYPE=DEL;END=200")
    assert (row.start, row.end) == (99, 100)
    assert row.info.toPython() == {"SVTYPE": "DEL", "END": 200}


def test_long_reference_counts_characters(spark):
    assert parse_one(spark, "1 1 . " + "A" * 1000 + " G . . .").end == 1000
    assert parse_one(spark, "1 1 . ÄÖ G . . .").end == 2


@pytest.mark.parametrize(
    "text, value",
    [("30", 30.0), ("9999.99", 9999.99), ("1e3", 1000.0), ("-.5", -0.5), ("5.", 5.0),
     ("inf", float("inf")), ("-Infinity", float("-inf")), ("1_0", 10.0)],
)
def test_quality_spellings(spark, text, value):
    assert parse_one(spark, f"1 1 . A G {text} . .").qual == value


def test_quality_nan(spark):
    quality = parse_one(spark, "1 1 . A G NaN . .").qual
    assert quality != quality


GOOD = "1 5 . A G . . ."
BAD = [
    "1 5", "1 5 . A G . .", "1 x . A G . . .", "1 5.0 . A G . . .", "1 . . A G . . .",
    "1 5 . A G high . .", "1 5 . A G 1.5d . .", "1 5 . A G 0x1 . .", "1 5 . A G  . .",
    "1 99999999999999999999 . A G . . .",
    # Start and end leave 64 bits.
    "1 -9223372036854775808 . A G . . .", "1 9223372036854775807 . ACG G . . .",
]


def test_malformed_records_are_dropped(spark):
    lines = lines_of(spark, CHROM, tabbed(GOOD), *map(tabbed, BAD))
    assert [row.start for row in parse_vcf_lines(lines).collect()] == [4]


def test_positions_at_the_edge(spark):
    row = parse_one(spark, "1 9223372036854775807 . A G . . .")
    assert (row.start, row.end) == (2**63 - 2, 2**63 - 1)
    row = parse_one(spark, "1 -9223372036854775807 . A G . . .")
    assert (row.start, row.end) == (-(2**63), 1 - 2**63)


def test_rejected_lines_are_the_rest(spark):
    lines = lines_of(spark, CHROM, tabbed(GOOD), "", "  ", "##x", *map(tabbed, BAD))
    rejected = {row.value for row in rejected_lines(lines).collect()}
    assert rejected == set(map(tabbed, BAD))


@pytest.mark.parametrize("text, start", [("+7", 6), ("0", -1), ("-3", -4), ("007", 6), ("1_0", 9)])
def test_position_spellings(spark, text, start):
    assert parse_one(spark, f"1 {text} . A G . . .").start == start


def test_lines_are_trimmed_before_splitting(spark):
    lines = lines_of(
        spark, CHROM, "　 " + tabbed("1 5 . A G . . DB") + "\t\t\xa0\r", tabbed("1 6 . A G . . ") + "\t"
    )
    rows = parse_vcf_lines(lines).collect()
    assert [(row.contig, row.info.toPython()) for row in rows] == [("1", {"DB": True})]


def test_hash_lines_after_the_header_are_skipped(spark):
    lines = lines_of(spark, CHROM, tabbed(GOOD), "#comment", tabbed("#1 5 . A G . . ."))
    assert parse_vcf_lines(lines).count() == 1


def test_variant_id(spark):
    row = parse_one(spark, "chr1 100 . ACG G . . .", generatePrimaryKey="true")
    assert row.variant_id == hashlib.sha256(b"/d/f.vcf|f.vcf|chr1|99|102").hexdigest()


def test_variant_id_without_metadata(spark):
    row = parse_one(spark, "chr1 100 . A G . . .", generatePrimaryKey=True, includeFileMetadata=False)
    assert (row.file_path, row.file_name) == ("", "")
    assert row.variant_id == hashlib.sha256(b"||chr1|99|100").hexdigest()


def test_sample_ids_take_the_first_header_line(spark):
    lines = lines_of(spark, "##a=1", CHROM, CHROM + "\tsecond")
    rows = sample_ids(lines.coalesce(1)).collect()
    assert [(row.file_path, row.sample_ids) for row in rows] == [("/d/f.vcf", ["S"])]


def test_sample_ids_keep_special_characters(spark):
    lines = lines_of(spark, CHROM + "\tA-1\tB_2\tC.3 x")
    assert sample_ids(lines).first().sample_ids == ["S", "A-1", "B_2", "C.3 x"]


@pytest.mark.parametrize("columns", [8, 9])
def test_header_without_samples(spark, columns):
    line = "\t".join(CHROM.split("\t")[:columns])
    assert sample_ids(lines_of(spark, line)).first().sample_ids == []


def test_header_metadata_is_distinct(spark):
    lines = lines_of(
        spark, "##fileformat=VCFv4.2", '##INFO=<ID=DP,Number=1,Type=Integer,Description="a, b">',
        "##fileformat=VCFv4.2", "##contig=<ID=chr1,length=5>", CHROM,
    )
    rows = vcf_header(lines).orderBy("line").collect()
    assert [(r.section, r.id, r.number, r.type) for r in rows] == [
        ("INFO", "DP", "1", "Integer"), ("contig", "chr1", None, None),
        ("fileformat", None, None, None),
    ]


def test_no_header_no_rows(spark):
    assert parse_vcf_lines(lines_of(spark, tabbed(GOOD))).count() == 0
    assert sample_ids(lines_of(spark, "##only=meta")).count() == 0


def test_given_headers_replace_the_scan(spark):
    lines = lines_of(spark, tabbed("1 5 . A G . . . GT 0/1"))
    headers = lines.select("file_path", F.array(F.lit("N")).alias("sample_ids"))
    assert parse_vcf_lines(lines, headers=headers).first().genotypes[0].sampleId == "N"
