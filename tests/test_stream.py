"""The streaming reader delivers what the batch reader does, once."""

import pytest

from conftest import vcf_text, write_vcf
from genoframe import foreach_vcf_batch, read_vcf, read_vcf_stream


def run(stream, out, checkpoint) -> None:
    query = (
        stream.writeStream.format("parquet")
        .option("path", str(out))
        .option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def comparable(df) -> list[str]:
    return sorted(
        row[0] for row in df.selectExpr("to_json(struct(*))").collect()
    )


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "in"
    for i, name in enumerate(["b.vcf", "sub/c.vcf.gz", "d.vcf"]):
        records = [f"1 {100 * i + n} rs{n} A G 5 PASS DP={n};DB GT:DP 0/1:{n} ." for n in range(1, 9)]
        write_vcf(source / name, vcf_text(records + ["1 x"], (f"S{i}", f"T{i}")))
    write_vcf(source / "headless.vcf", "1\t5\t.\tA\tG\t.\t.\t.\n")
    return source


def test_stream_equals_batch(spark, tmp_path, folder):
    options = {"generatePrimaryKey": "true"}
    stream = read_vcf_stream(spark, str(folder), maxFilesPerTrigger=1, **options)
    assert stream.isStreaming
    batch = read_vcf(spark, str(folder), **options)
    assert stream.columns == batch.columns
    run(stream, tmp_path / "out", tmp_path / "cp")
    streamed = comparable(spark.read.parquet(str(tmp_path / "out")))
    assert streamed == comparable(batch)
    assert len(streamed) == 24


def test_new_files_are_picked_up_once(spark, tmp_path, folder):
    for name in (None, "a.vcf", "z.vcf"):
        if name is not None:
            text = vcf_text([f"9 {ord(name[0])} . A G . . . GT 1/1"], (name,))
            write_vcf(folder / name, text)
        stream = read_vcf_stream(spark, str(folder))
        run(stream, tmp_path / "out", tmp_path / "cp")
    streamed = comparable(spark.read.parquet(str(tmp_path / "out")))
    assert streamed == comparable(read_vcf(spark, str(folder)))
    assert len(streamed) == 26


def test_single_file_and_samples(spark, tmp_path, cohort):
    stream = read_vcf_stream(spark, cohort, includeSampleIds="NA1, NA3")
    run(stream, tmp_path / "out", tmp_path / "cp")
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(rows) == 3
    assert {tuple(g.sampleId for g in r.genotypes) for r in rows} == {("NA1", "NA3")}


def test_memory_sink(spark, cohort):
    query = (
        read_vcf_stream(spark, cohort).select("contig", "start")
        .writeStream.format("memory").queryName("cohort_rows").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("cohort_rows").count() == 3


def test_missing_path_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_vcf_stream(spark, str(tmp_path / "none"))


def test_foreach_batch(spark, tmp_path, folder):
    out = tmp_path / "out"

    def save(batch, batch_id):
        batch.write.parquet(str(out / f"batch={batch_id}"))

    writer = foreach_vcf_batch(spark, str(folder), save, maxFilesPerTrigger=2)
    query = (
        writer.option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    saved = spark.read.parquet(str(out))
    assert saved.select("batch").distinct().count() == 2
    assert comparable(saved.drop("batch")) == comparable(read_vcf(spark, str(folder)))
