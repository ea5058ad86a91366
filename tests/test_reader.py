"""Files, folders, options and header strategies of the batch reader."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from conftest import vcf_text, write_vcf
from genoframe import read_vcf, read_vcf_header, read_vcf_lines, rejected_lines, vcf_header
from genoframe.options import VcfOptions

# How the samples reach the lines: broadcast heads, head look-up, broadcast scan,
# salted join.
STRATEGIES = [
    {}, {"max_broadcast_bytes": 0}, {"scan_headers": True},
    {"scan_headers": True, "max_broadcast_bytes": 0},
]


def starts(df) -> list[int]:
    return sorted(row.start for row in df.select("start").collect())


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_read(spark, cohort, strategy):
    rows = read_vcf(spark, cohort, **strategy).orderBy("start").collect()
    assert [(r.contig, r.start, r.end, r.qual) for r in rows] == [
        ("chr1", 10, 11, 12.5), ("chr1", 20, 23, None), ("chr2", 30, 31, 99.0)
    ]
    assert [r.info.toPython() for r in rows[1:]] == [{"DP": 9, "DB": True}, {}]
    calls = [[(g.sampleId, g.calls) for g in r.genotypes] for r in rows]
    assert calls == [
        [("NA1", [0, 1]), ("NA2", [1, 1]), ("NA3", [-1, -1])],
        [("NA1", [1, 2]), ("NA2", [0, 0]), ("NA3", None)],
        [("NA1", [0, 0]), ("NA2", [0, 1]), ("NA3", [1, 1])],
    ]
    assert {(r.file_path, r.file_name) for r in rows} == {(cohort, "cohort.vcf")}


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_files_keep_their_own_samples(spark, tmp_path, strategy):
    record = ["1 5 . A G . . . GT 0/1 1/1"]
    write_vcf(tmp_path / "a.vcf", vcf_text(record, ("A1", "A2")))
    write_vcf(tmp_path / "sub" / "b.vcf.gz", vcf_text(record, ("B1",)))
    write_vcf(tmp_path / "sub" / "c.vcf", vcf_text(["1 5 . A G . . ."]))
    write_vcf(tmp_path / "sub" / "headless.vcf", "##fileformat=VCFv4.2\n1\t5\t.\tA\tG\t.\t.\t.\n")
    write_vcf(tmp_path / "empty.vcf", "")
    rows = read_vcf(spark, str(tmp_path), **strategy).collect()
    samples = {r.file_name: r.genotypes and [g.sampleId for g in r.genotypes] for r in rows}
    assert samples == {"a.vcf": ["A1", "A2"], "b.vcf.gz": ["B1"], "c.vcf": None}
    assert {r.file_path for r in rows} == {
        f"{tmp_path}/a.vcf", f"{tmp_path}/sub/b.vcf.gz", f"{tmp_path}/sub/c.vcf"
    }


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize(
    "options, names",
    [
        ({"includeSampleIds": "NA3, NA1,other"}, ["NA1", "NA3"]),
        ({"excludeSampleIds": "NA2"}, ["NA1", "NA3"]),
        ({"INCLUDESAMPLEIDS": ["NA1", "NA2"], "excludeSampleIds": "NA1"}, ["NA2"]),
        ({"includeSampleIds": "other"}, None),
        ({"includeSampleIds": "NA1", "excludeSampleIds": "NA1"}, None),
        ({"includeSampleIds": " ,", "excludeSampleIds": ""}, ["NA1", "NA2", "NA3"]),
    ],
)
def test_sample_options(spark, cohort, strategy, options, names):
    rows = read_vcf(spark, cohort, **strategy, **options).collect()
    assert len(rows) == 3
    for row in rows:
        assert (row.genotypes and [g.sampleId for g in row.genotypes]) == names


def test_option_parsing():
    defaults = VcfOptions.parse({})
    assert defaults == VcfOptions((), (), True, False)
    given = VcfOptions.parse(
        {"includeFileMetadata": "FALSE", "generatePrimaryKey": "True", "flattenInfoFields": "x"}
    )
    assert (given.file_metadata, given.primary_key) == (False, True)
    assert VcfOptions.parse({"generatePrimaryKey": "yes"}).primary_key is False


def test_metadata_off(spark, cohort):
    df = read_vcf(spark, cohort, includeFileMetadata="false")
    assert df.select("file_path", "file_name").distinct().collect() == [("", "")]


def test_single_file_may_have_any_name(spark, tmp_path):
    path = write_vcf(tmp_path / "variants.txt", vcf_text(["1 5 . A G . . ."]))
    assert starts(read_vcf(spark, path)) == [4]


def test_folder_takes_vcf_names_only(spark, tmp_path):
    text = vcf_text(["1 5 . A G . . ."])
    for name in ("a.vcf", "deep/b.vcf", "deep/er.vcf/c.vcf.gz"):
        write_vcf(tmp_path / name, text)
    for name in ("a.txt", "b.VCF", "c.vcf.bak", "d.vcf.bz2"):
        write_vcf(tmp_path / name, text)
    names = {row.file_name for row in read_vcf(spark, str(tmp_path)).collect()}
    assert names == {"a.vcf", "b.vcf", "c.vcf.gz"}


def test_missing_path_and_empty_folder(spark, tmp_path):
    (tmp_path / "other.txt").write_text("x")
    for path in (str(tmp_path / "none"), str(tmp_path), ""):
        df = read_vcf(spark, path)
        assert df.count() == 0
        assert len(df.columns) == 13


def test_paths_are_taken_literally(spark, tmp_path):
    for folder in ("a b+c", "100%25", "x[1]{2}", "é"):
        path = write_vcf(tmp_path / folder / "f #1.vcf", vcf_text(["1 5 . A G . . ."]))
        for given in (path, str(tmp_path / folder), str(tmp_path / folder) + "/"):
            row = read_vcf(spark, given, generatePrimaryKey=True).first()
            assert (row.file_path, row.file_name) == (path, "f #1.vcf")


def test_relative_path_stays_relative(spark, in_folder):
    write_vcf(in_folder / "data" / "x" / "a.vcf", vcf_text(["1 5 . A G . . ."]))
    assert read_vcf(spark, "data").first().file_path == "data/x/a.vcf"
    assert read_vcf(spark, "data/x/a.vcf").first().file_path == "data/x/a.vcf"
    assert read_vcf(spark, ".").first().file_path == "./data/x/a.vcf"


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_gzip_members_are_read_through(spark, tmp_path, strategy):
    text = vcf_text(["1 5 . A G . . . GT 0/1", "1 6 . A G . . . GT 0/1"], ("S",))
    cut = text.index("1\t6")
    data = gzip.compress(text[:20].encode()) + gzip.compress(text[20:cut].encode())
    (tmp_path / "m.vcf.gz").write_bytes(data + gzip.compress(text[cut:].encode()))
    rows = read_vcf(spark, str(tmp_path), **strategy).collect()
    assert sorted((r.start, len(r.genotypes)) for r in rows) == [(4, 1), (5, 1)]


def test_line_endings_and_blank_lines(spark, tmp_path):
    text = vcf_text(["1 5 . A G . . DB GT 0/1", "1 6 . A G . . DB GT 0/1"], ("S",))
    path = write_vcf(tmp_path / "crlf.vcf", text.replace("\n", "\r\n\r\n  \r\n"))
    rows = read_vcf(spark, path).collect()
    assert [(r.start, r.genotypes[0].sampleId, r.genotypes[0].calls) for r in rows] == [
        (4, "S", [0, 1]), (5, "S", [0, 1])
    ]


def test_malformed_lines_are_skipped(spark, tmp_path):
    text = vcf_text(["1 5 . A G . . .", "1 6", "1 7 . A G x . .", "1 8 . A G . . ."])
    assert starts(read_vcf(spark, write_vcf(tmp_path / "a.vcf", text))) == [4, 7]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_splits_inside_a_file(spark, tmp_path, strategy):
    """Every line is read once, whatever the split size; the header reaches all splits."""
    records = [f"1 {i} . A G . . DP={i} GT 0/1" for i in range(1, 2001)]
    path = write_vcf(tmp_path / "big.vcf", vcf_text(records, ("S",)))
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "5001b")
    try:
        df = read_vcf(spark, path, **strategy)
        lines = read_vcf_lines(spark, path)
        assert lines.select(F.spark_partition_id()).distinct().count() > 3
        kept = df.where("genotypes[0].sampleId = 'S'")
        assert starts(kept) == list(range(2000))
    finally:
        spark.conf.set(setting, before)


def test_second_header_line_changes_nothing(spark, tmp_path):
    text = vcf_text(["1 5 . A G . . . GT 0/1"], ("S",))
    later = vcf_text(["1 6 . A G . . . GT 0/1"], ("T",))
    path = write_vcf(tmp_path / "two.vcf", text + later)
    for strategy in STRATEGIES:
        rows = read_vcf(spark, path, **strategy).collect()
        assert [g.sampleId for r in rows for g in r.genotypes] == ["S", "S"]


def test_unreadable_heads_fall_back_to_the_scan(spark, cohort, monkeypatch):
    from genoframe.sources import heads

    def failing_reader():
        def fail(uri):
            raise OSError(uri)

        return fail

    monkeypatch.setattr(heads, "head_reader", failing_reader)
    assert read_vcf(spark, cohort).where("size(genotypes) = 3").count() == 3


def test_worker_opens_encoded_uris(tmp_path):
    from genoframe.sources.heads import head_reader

    path = write_vcf(tmp_path / "a b.vcf.gz", vcf_text([], ("S1", "S2")))
    head = (["##fileformat=VCFv4.2"], ["S1", "S2"])
    assert head_reader()(f"file:{path.replace(' ', '%20')}") == head
    assert head_reader()(path.replace(" ", "%20")) == head
    assert os.path.exists(path)


def test_headers_from_heads_equal_the_scan(spark, tmp_path):
    meta = ("##INFO=<ID=DP,Number=1,Type=Integer>", "##a", "##a")
    write_vcf(tmp_path / "x y.vcf", vcf_text([], ("S",), meta))
    write_vcf(tmp_path / "sub" / "z.vcf.gz", vcf_text(["1 5 . A G . . ."], meta=("##z",)))
    columns = ["file_path", "line", "section", "id", "number", "type"]
    heads = read_vcf_header(spark, str(tmp_path)).select(columns)
    scan = vcf_header(read_vcf_lines(spark, str(tmp_path))).select(columns)
    assert sorted(map(str, heads.collect())) == sorted(map(str, scan.collect()))
    assert heads.count() == 5
    assert read_vcf_header(spark, str(tmp_path / "none")).count() == 0


def test_rejected_lines_of_files(spark, tmp_path):
    write_vcf(tmp_path / "a.vcf", vcf_text(["1 5 . A G . . .", "1 6"]))
    rows = rejected_lines(read_vcf_lines(spark, str(tmp_path))).collect()
    assert [(row.file_name, row.value) for row in rows] == [("a.vcf", "1\t6")]
    assert rejected_lines(read_vcf_lines(spark, str(tmp_path / "none"))).count() == 0
