"""File heads: bounded look-ups, codecs, storage that workers cannot open."""

import bz2
import logging

import pyarrow as pa
import pytest
from conftest import vcf_text, write_vcf
from pyspark.sql import functions as F

from genoframe import (
    explode_genotypes,
    foreach_vcf_batch,
    parse_vcf_lines,
    read_genotypes,
    read_vcf,
    read_vcf_header,
    read_vcf_lines,
    read_vcf_stream,
    sample_ids,
)
from genoframe.options import VcfOptions
from genoframe.sources import heads

RECORD = "1 5 . A G . . . GT 0/1"


def test_wide_cohort_look_up_stays_within_arrow_arrays(spark, tmp_path):
    names = tuple(f"SAMPLE{i:06}" for i in range(20_000))
    path = write_vcf(tmp_path / "wide.vcf", vcf_text([], names))
    udf = heads.kept_samples_udf(VcfOptions.parse({}))
    rows = 0
    for part in udf.func(iter([pa.array([path] * 10_000)])):
        if rows < 200:
            part.validate(full=True)
        assert part.values.field(1).type == pa.string()
        assert part.nbytes < 2 * heads.BATCH_BYTES + 2_000_000
        rows += len(part)
    assert rows == 10_000


def test_look_up_of_alternating_files(spark, tmp_path):
    paths = [write_vcf(tmp_path / f"{s}.vcf", vcf_text([], (s,))) for s in "ABC"]
    udf = heads.kept_samples_udf(VcfOptions.parse({}))
    wanted = [paths[i] for i in (0, 1, 0, 0, 2, 2, 1)]
    found = [x for part in udf.func(iter([pa.array(wanted)])) for x in part.to_pylist()]
    assert [kept[0]["sampleId"] for kept in found] == list("ABAACCB")


def test_few_heads_are_remembered(tmp_path, monkeypatch):
    read = []
    head_of = heads._remembering(lambda uri: read.append(uri) or uri, 2)
    assert [head_of(u) for u in "aabbacca"] == list("aabbacca")
    assert read == ["a", "b", "c", "a"]


@pytest.mark.parametrize("options", [{}, {"scan_headers": True}, {"max_broadcast_bytes": 0}])
@pytest.mark.parametrize("name", ["a.vcf", "a.txt", "a.vcf.gz", "a.vcf.bz2"])
def test_single_file_of_any_codec(spark, tmp_path, name, options):
    text = vcf_text([RECORD, RECORD], ("S1", "S2"))
    path = write_vcf(tmp_path / name, text)
    if name.endswith("bz2"):
        (tmp_path / name).write_bytes(bz2.compress(text.encode()))
    df = read_vcf(spark, path, **options)
    assert df.where("genotypes[0].sampleId = 'S1'").count() == 2


def test_other_codecs_are_scanned(spark, tmp_path):
    lines = spark.createDataFrame([(x,) for x in vcf_text([RECORD], ("S",)).splitlines()], "v string")
    lines.coalesce(1).write.option("compression", "deflate").text(str(tmp_path / "out"))
    (path,) = (tmp_path / "out").glob("*.deflate")
    assert read_vcf(spark, str(path)).first().genotypes[0].sampleId == "S"


def test_only_the_unreadable_file_is_scanned(spark, tmp_path, monkeypatch, caplog):
    for name in "abc":
        write_vcf(tmp_path / f"{name}.vcf", vcf_text([RECORD], (name.upper(),)))
    plain = heads.head_reader

    def partly_failing(whole_file=False):
        read = plain(whole_file)

        def read_or_fail(uri):
            if uri.endswith("b.vcf"):
                raise OSError("no right to read")
            return read(uri)

        return read_or_fail

    monkeypatch.setattr(heads, "head_reader", partly_failing)
    with caplog.at_level(logging.WARNING):
        rows = read_vcf(spark, str(tmp_path)).collect()
        meta = read_vcf_header(spark, str(tmp_path))
    assert sorted(r.genotypes[0].sampleId for r in rows) == ["A", "B", "C"]
    assert "1 files are scanned" in caplog.text and "no right to read" in caplog.text
    assert meta.select("file_path").distinct().count() == 3


def test_header_below_a_record_and_headless_file(spark, tmp_path):
    text = vcf_text([RECORD], ("S",))
    write_vcf(tmp_path / "late.vcf", "1\t4\t.\tA\tG\t.\t.\t.\n" + text)
    write_vcf(tmp_path / "none.vcf", "1\t4\t.\tA\tG\t.\t.\t.\n")
    rows = read_vcf(spark, str(tmp_path)).collect()
    assert sorted((r.file_name, r.start) for r in rows) == [("late.vcf", 3), ("late.vcf", 4)]


@pytest.mark.parametrize("uri", ["dbfs:/x/a.vcf", "wasbs://c@h/a.vcf", "nosuch://h/a"])
def test_schemes_that_workers_do_not_know(uri):
    assert heads.can_open(uri)


@pytest.mark.parametrize("uri", ["/x/a.vcf", "file:/x/a.vcf", "file:///x"])
def test_local_files_can_be_opened(uri):
    assert heads.can_open(uri) is None


def test_stream_of_unknown_storage_is_refused_and_batches_are_not(spark, cohort, monkeypatch, tmp_path):
    from genoframe.streaming import reader

    monkeypatch.setattr(reader, "can_open", lambda uri: "no such scheme")
    with pytest.raises(ValueError, match="foreach_vcf_batch"):
        read_vcf_stream(spark, cohort)
    scratch = spark.conf.get("spark.checkpoint.dir")
    removed, seen = [], []
    plain = reader.remove
    monkeypatch.setattr(reader, "remove", lambda s, p: removed.append(p) or plain(s, p))
    query = (
        foreach_vcf_batch(spark, cohort, lambda df, i: seen.append(df.count()))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert seen == [3]
    assert removed and all(path.startswith(scratch) for path in removed)


def test_batches_of_readable_files_leave_nothing_behind(spark, cohort, tmp_path):
    import os

    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    query = (
        foreach_vcf_batch(spark, cohort, lambda df, i: df.count())
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert (set(os.listdir(folder)) if os.path.isdir(folder) else set()) == before


def test_given_headers_are_evaluated_once(spark, cohort):
    counter = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        counter.add(1)
        return value

    lines = read_vcf_lines(spark, cohort)
    headers = sample_ids(lines).withColumn("file_uri", counted("file_uri"))
    df = parse_vcf_lines(lines, headers=headers)
    assert df.count() == 3 and df.count() == 3
    assert counter.value == 1


def test_files_with_one_header_share_it(spark, tmp_path):
    for i in range(12):
        write_vcf(tmp_path / f"{i}.vcf", vcf_text([RECORD + " 1/1"], ("S", "T") if i % 2 else ("T", "S")))
    rows = read_vcf(spark, str(tmp_path)).collect()
    for row in rows:
        odd = int(row.file_name.split(".")[0]) % 2
        assert [g.sampleId for g in row.genotypes] == (["S", "T"] if odd else ["T", "S"])
    assert len(rows) == 12


@pytest.mark.parametrize("options", [{}, {"includeSampleIds": "NA3,NA1"}, {"excludeSampleIds": "NA1,NA2,NA3"}])
def test_genotype_rows_equal_exploded_rows(spark, cohort, tmp_path, options):
    odd = ["1 5 . A G . . . GT:DP:DP:GT 0/1:1:.:1/1 :2", "1 6 . A G . . .", "1 7 . A G . . . AD 1,x"]
    folder = write_vcf(tmp_path / "odd.vcf", vcf_text(odd, ("NA1", "NA3")))
    for path in (cohort, folder):
        exploded = explode_genotypes(read_vcf(spark, path, **options))
        rows = read_genotypes(spark, path, **options)
        assert rows.schema["genotype"].dataType.names == exploded.schema["genotype"].dataType.names
        assert rows.columns == exploded.columns
        as_text = [sorted(r[0] for r in d.selectExpr("to_json(struct(*))").collect()) for d in (rows, exploded)]
        assert as_text[0] == as_text[1]
    assert read_genotypes(spark, str(tmp_path / "none")).count() == 0
