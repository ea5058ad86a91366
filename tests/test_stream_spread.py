"""Lines of a micro-batch with fewer files than cores are parsed by all cores."""

from __future__ import annotations

from conftest import vcf_text, write_vcf
from pyspark.sql import functions as F

from genoframe import read_vcf, read_vcf_stream


def streamed(spark, folder, out, **options):
    stream = read_vcf_stream(spark, folder, **options)
    writer = stream.writeStream.format("parquet").option("path", f"{out}/rows")
    writer.option("checkpointLocation", f"{out}/cp").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def comparable(df):
    columns = [F.to_json(F.struct(c)) if c in ("info", "genotypes") else F.col(c) for c in df.columns]
    return sorted(map(repr, df.select(*columns).collect()))


def test_one_gzip_file_is_parsed_by_all_cores(spark, tmp_path):
    records = [f"chr1 {i} . A G 1.5 PASS DP={i} GT:DP 0/1:{i}" for i in range(1, 401)]
    # A line twice, one without enough fields and a file without a header.
    records += [records[0], "chr1 7"]
    write_vcf(tmp_path / "in" / "a.vcf.gz", vcf_text(records, ("NA1",)))
    write_vcf(tmp_path / "in" / "headless.vcf", "chr2\t5\t.\tA\tG\t.\t.\t.\n")
    folder = str(tmp_path / "in")
    rows = streamed(spark, folder, tmp_path / "few", maxFilesPerTrigger="1")
    assert comparable(rows) == comparable(read_vcf(spark, folder))
    assert rows.count() == 401
    assert rows.select("_metadata.file_path").distinct().count() == spark.sparkContext.defaultParallelism
    whole = streamed(spark, folder, tmp_path / "all")
    assert comparable(whole) == comparable(rows)
    assert whole.select("_metadata.file_path").distinct().count() == 1
