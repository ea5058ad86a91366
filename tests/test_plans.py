"""Plans stay cheap: no shuffle, early filters, pruned columns."""

import pytest
from pyspark.sql import functions as F

from conftest import vcf_text, write_vcf
from genoframe import in_region, read_genotypes, read_vcf, read_vcf_lines
from genoframe.functions.text import literal, strip
from genoframe.options import VcfOptions
from genoframe.plans.header_join import look_up_headers
from genoframe.plans.parse import record_lines, vcf_columns
from genoframe.sources.headers import file_listing
from genoframe.sources.paths import resolve


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_batch_parse_has_no_shuffle(spark, cohort):
    text = plan(read_vcf(spark, cohort))
    # The stored headers are grouped by their key; no line is.
    assert text.count("Exchange hashpartitioning") == text.count("Exchange hashpartitioning(header_key") == 1
    # One for the keys of the files, one for the distinct headers.
    assert text.count("BroadcastExchange") == 2
    assert "SortMergeJoin" not in text


def test_large_header_tables_are_not_broadcast(spark, cohort):
    for options in ({}, {"scan_headers": True}):
        salted = plan(read_vcf(spark, cohort, max_broadcast_bytes=0, **options))
        assert salted.count("ShuffledHashJoin") == 2 and "BroadcastExchange" not in salted


@pytest.mark.parametrize("most", [0, 1 << 26])
def test_samples_are_carried_only_to_genotypes(spark, cohort, most):
    df = read_vcf(spark, cohort, max_broadcast_bytes=most)
    for narrow in (df.agg(F.count("*")), df.select("contig", "start", "info")):
        assert "sampleId" not in plan(narrow)
    assert "sampleId" in plan(df.select("genotypes"))


def test_stream_carries_samples_only_to_genotypes(spark, cohort):
    options = VcfOptions.parse({})
    looked_up = look_up_headers(record_lines(read_vcf_lines(spark, cohort)), options)
    rows = vcf_columns(looked_up, options)
    for narrow in (rows.select("contig", "start", "info"), rows.agg(F.count("*"))):
        assert "kept_samples_of_file" not in plan(narrow)
        assert "file_has_header" in plan(narrow)
    assert "kept_samples_of_file" in plan(rows.select("genotypes"))


def test_genotype_rows_parse_what_is_read(spark, cohort):
    rows = read_genotypes(spark, cohort)
    calls = plan(rows.select("contig", "genotype.sampleId", "genotype.calls")).lower()
    assert "parsejson" not in calls
    assert "parsejson" in plan(rows.select("genotype.data")).lower()


def test_region_filter_runs_before_the_join(spark, cohort):
    for options in ({}, {"max_broadcast_bytes": 0}):
        df = in_region(read_vcf(spark, cohort, **options), "chr1", 0, 100)
        lines = plan(df).splitlines()
        filters = [i for i, line in enumerate(lines) if "= chr1" in line]
        joins = [
            i for i, line in enumerate(lines) if "HashJoin" in line
        ]
        assert filters and min(filters) > joins[0]


def test_unread_columns_are_not_parsed(spark, cohort):
    df = read_vcf(spark, cohort)
    assert "parsejson" not in plan(df.select("contig", "start")).lower()
    assert "url_decode" not in plan(df.groupBy("contig").count()).lower()
    counted = plan(df.agg(F.count("*")))
    assert "transform" not in counted


def test_header_lines_are_filtered_in_the_scan(spark, cohort):
    assert "StringStartsWith(value,#)" in plan(read_vcf(spark, cohort))


def test_header_files_are_listed_without_content(spark, cohort):
    text = plan(file_listing(spark, resolve(spark, cohort)))
    scan = next(line for line in text.splitlines() if "binaryFile" in line)
    assert "ReadSchema: struct<>" in scan


@pytest.mark.parametrize("text", ["", "a", "it's", "\\", "\t|\n", "é　", "\U0001f9ec", "%_{}"])
def test_literals_round_trip(spark, text):
    assert spark.range(1).selectExpr(f"{literal(text)} AS t").first().t == text


@pytest.mark.parametrize("text", ["a", " a ", "\ta\t", "a\r", " a b　", "\x1ca\x85", "   ", ""])
def test_strip_matches_unicode_white_space(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.selectExpr(f"{strip('t')} AS t").first().t == text.strip()


def test_wide_cohort(spark, tmp_path):
    names = tuple(f"S{i}" for i in range(1500))
    record = "1 5 . A G . . . GT:DP " + " ".join(f"0/1:{i}" for i in range(1500))
    path = write_vcf(tmp_path / "wide.vcf", vcf_text([record] * 3, names))
    df = read_vcf(spark, path, includeSampleIds="S7,S1499")
    depths = df.selectExpr(
        "transform(genotypes, g -> try_variant_get(g.data, '$.DP', 'int')) AS d"
    ).collect()
    assert [row.d for row in depths] == [[7, 1499]] * 3


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        result = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_a_read_opens_the_heads_in_one_job(spark, cohort):
    df, jobs = jobs_of(spark, "define", lambda: read_vcf(spark, cohort))
    assert jobs <= 2
    assert df.count() == 3


def test_storage_of_the_jvm_collects_no_names(spark, cohort):
    """No head is tried, and the plan of the scan names no file."""
    import uuid

    name = f"m{uuid.uuid4().hex}"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder, file = cohort.rsplit("/", 1)
    conf.set(f"fs.viewfs.mounttable.{name}.link./data", f"file://{folder}")
    df = read_vcf(spark, f"viewfs://{name}/data/{file}")
    assert df.count() == 3 and df.where("size(genotypes) = 3").count() == 3
    assert " IN (" not in plan(df) and "INSET" not in plan(df)


def test_many_files_without_a_head_are_joined(spark, tmp_path, monkeypatch):
    from genoframe.sources import headers

    monkeypatch.setattr(headers, "MAX_NAMED_FILES", 1)
    for i in range(3):
        write_vcf(tmp_path / f"{i}.vcf", f"1\t5\t.\tA\tG\t.\t.\t.\n#CHROM\tx\n1\t{i + 7}\t.\tA\tG\t.\t.\t.\n")
    write_vcf(tmp_path / "whole.vcf", vcf_text(["1 99 . A G . . ."]))
    starts = sorted(r["start"] for r in read_vcf(spark, str(tmp_path)).collect())
    assert starts == [4, 4, 4, 6, 7, 8, 98]


def test_stored_headers_go_with_the_session(spark, cohort, monkeypatch):
    from genoframe.sources import headers

    marked = []
    monkeypatch.setattr(headers, "remove_at_end", lambda spark, folder: marked.append(folder))
    assert read_vcf(spark, cohort).count() == 3
    assert len(marked) == 1 and "heads-" in marked[0]
