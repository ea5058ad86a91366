"""Reasons of dropped lines, counted in the pass that parses the others."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import vcf_text, write_vcf
from genoframe import RejectListener, read_vcf, read_vcf_lines, read_vcf_stream, reject_reasons, rejected_lines

GOOD = ["1 5 . A G 7 . .", "1 6 . A G . . .", "2 7 . A . 1e3 PASS DP=4"]
BAD = {
    "1 5": "few_fields", "1": "few_fields", "1 5 . A G 7 .": "few_fields",
    "1 x . A G 7 . .": "position", "1 1.5 . A G 7 . .": "position", "1 . . A G . . .": "position",
    f"1 {1 << 63} . A G . . .": "position", "1 x . A G bad . .": "position",
    "1 5 . A G bad . .": "quality", "1 5 . A G 1,5 . .": "quality", "1 5 . A G . . DP=1 GT": None,
}
EXPECTED = {"records": 4, "few_fields": 3, "position": 5, "quality": 2}


@pytest.fixture
def folder(tmp_path):
    lines = list(BAD)
    write_vcf(tmp_path / "in/a.vcf", vcf_text(GOOD + lines[:4]))
    write_vcf(tmp_path / "in/b.vcf", vcf_text(lines[4:]))
    return str(tmp_path / "in")


def test_reason_of_each_line(spark, folder):
    lines = read_vcf_lines(spark, folder)
    found = {r["value"].replace("\t", " "): r["reason"] for r in reject_reasons(lines).collect()}
    assert found == {line: reason for line, reason in BAD.items() if reason}
    assert reject_reasons(lines).drop("reason").exceptAll(rejected_lines(lines)).count() == 0


def test_batch_counts_in_one_pass(spark, folder):
    observation = Observation()
    df = read_vcf(spark, folder, observation=observation)
    assert df.count() == 4
    assert observation.get == EXPECTED
    again = Observation()
    rows = read_vcf(spark, folder, observation=again)
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan text") == 1 and text.count("CollectMetrics") == 1
    rows.where(F.col("start") > 5).collect()
    assert again.get == EXPECTED


def test_rows_are_those_without_an_observation(spark, folder):
    def rows(**options):
        df = read_vcf(spark, folder, **options)
        return sorted(r[0] for r in df.selectExpr("to_json(struct(*))").collect())

    assert rows(observation=Observation()) == rows()


def test_streams(spark, folder, tmp_path):
    listener = RejectListener("rejects")
    spark.streams.addListener(listener)
    try:
        for name in (None, "c.vcf"):
            if name:
                write_vcf(tmp_path / "in" / name, vcf_text(["1 5 . A G . . .", "1 y . A G . . ."]))
            stream = read_vcf_stream(spark, folder, observation="rejects", maxFilesPerTrigger=1)
            query = (
                stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp"))
                .trigger(availableNow=True).start()
            )
            query.awaitTermination()
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(listener)
    assert listener.totals() == {**EXPECTED, "records": 5, "position": 6}
