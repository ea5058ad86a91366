"""The pipeline over the small tables."""

import pytest
from helpers import clashing, documents
from pyspark.sql import functions as F

import corpus_pipeline
from genoframe.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, sizes = docs.columns, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        sizes.append(docs.count())
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        if name == "exact_dedup":
            assert docs.groupBy("text").count().where("count > 1").count() == 0
    assert sizes[0] >= sizes[1] >= sizes[2] > 0
    used = docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    assert used <= 4096


def test_run_returns_the_pieces(spark):
    found = queries.queries()["pipeline"](spark, SF_DIR)
    assert found.columns[0] == "doc_id" and "sequence_id" in found.columns
    assert found.count() > 0


@pytest.mark.parametrize("name", [n for n in queries.queries() if n != "pipeline"])
def test_queries_have_rows_and_agree_when_rerun(spark, name):
    query = queries.queries()[name]
    first, second = (sorted(map(repr, query(spark, SF_DIR).collect())) for _ in range(2))
    assert first and first == second


LONG = "word one two three four five six seven eight nine ten " * 20_000
ODD = {
    "empty": [],
    "nulls and repeats": [
        (1, None), (1, None), (2, ""), (3, " \n"), (None, "no id here, some words to read"),
        (None, None), (5, "same words again and again in here"), (5, "same words again and again in here"),
        (6, "same words  again and again in here"), (7, "é ä 中文 and others"),
    ],
    "very long": [(1, LONG), (2, LONG), (3, LONG + " end"), (4, "short")],
}


@pytest.mark.parametrize("name", ODD)
def test_odd_tables_go_through_all_stages(spark, name, tmp_path):
    docs = clashing(documents(spark, ODD[name]))
    columns = docs.columns
    texts = {" ".join((t or "").split()) for _, t in ODD[name]}
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, SF_DIR)
        made.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.schema(made.schema).parquet(str(tmp_path / str(i)))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            left = [" ".join((row["text"] or "").split()) for row in docs.select("text").collect()]
            assert set(left) <= texts and (not texts or left)
    pieces = docs.collect()
    assert bool(pieces) == bool(ODD[name])
    places = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == places.get(p["sequence_id"], 0)
        places[p["sequence_id"]] = p["offset"] + p["length"]
    assert all(n <= 4096 for n in places.values())
