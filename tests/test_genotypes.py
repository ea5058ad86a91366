"""Genotype calls, FORMAT data and sample selection."""

import json
import random

import pytest

from genoframe.functions.genotype import genotypes
from test_info import LISTS, SCALARS

# FORMAT differs from INFO in one point: a list with an item that is no number
# stays one string.
VALUES = dict(SCALARS)
for _text, _json in LISTS.items():
    VALUES[_text] = json.dumps(_text) if '"' in _json else _json
del VALUES["."]

CALLS = {
    "0/1": [0, 1], "1|2": [1, 2], "1": [1], "0/1/1": [0, 1, 1], "./.": [-1, -1], ".|1": [-1, 1],
    "0/.": [0, -1], "10/11": [10, 11], "+1/0": [1, 0], ".": None, "a/b": None, "0/": None,
    "": None, "/": None, "1.0/0": None, "0\\1": None,
}


def parsed(spark, records: list[tuple[str, list[str]]], kept: str | None = None):
    """Genotypes of (FORMAT, sample fields) records; samples are S0, S1, ..."""
    rows = []
    for i, (layout, fields) in enumerate(records):
        rows.append((i, "\t".join(["1", "5", ".", "A", "G", ".", ".", ".", layout, *fields])))
    df = spark.createDataFrame(rows, "i int, line string")
    chosen = kept or "transform(sequence(0, 4), i -> struct(i AS idx, concat('S', i) AS sampleId))"
    out = df.selectExpr("i", f"{chosen} AS kept", "line").selectExpr(
        "i", f"{genotypes('line', 'kept')} AS g"
    )
    return [row.g for row in out.orderBy("i").collect()]


def one(spark, layout: str, field: str):
    (genotype,) = parsed(spark, [(layout, [field])])[0]
    return genotype.sampleId, genotype.calls, genotype.data.toPython()


def test_calls(spark):
    # A trimmed line has no empty last field, so another sample follows.
    results = parsed(spark, [("GT", [text, "0"]) for text in CALLS])
    assert [result[0].calls for result in results] == list(CALLS.values())


def test_each_value(spark):
    results = parsed(spark, [("GT:X", [f"0/1:{text}", "0"]) for text in VALUES])
    for text, result in zip(VALUES, results):
        assert result[0].calls == [0, 1]
        assert float_json(result[0].data) == {"X": json.loads(VALUES[text])}, text


def float_json(variant) -> dict:
    return json.loads(variant.toJson())


def test_missing_values_are_left_out(spark):
    assert one(spark, "GT:DP:GQ", ".:.:.") == ("S0", None, {})
    assert one(spark, "GT:DP:GQ", "0/1:.:99") == ("S0", [0, 1], {"GQ": 99})
    assert one(spark, "GT:DP:GQ", "0/1") == ("S0", [0, 1], {})
    assert one(spark, "GT:DP", "./.:..") == ("S0", [-1, -1], {"DP": ".."})


def test_whole_genotype_missing(spark):
    dot, empty, last = parsed(spark, [("DP:GT", [".", "", "3:0/0"])])[0]
    assert (dot.calls, dot.data.toPython()) == (None, {})
    assert (empty.calls, empty.data.toPython()) == (None, {})
    assert (last.calls, last.data.toPython()) == ([0, 0], {"DP": 3})


def test_format_without_gt_and_extra_values(spark):
    assert one(spark, "DP:GQ", "14:99:5") == ("S0", None, {"DP": 14, "GQ": 99})


def test_repeated_keys(spark):
    assert one(spark, "GT:DP:DP", "0/1:1:2") == ("S0", [0, 1], {"DP": 2})
    assert one(spark, "GT:DP:DP", "0/1:1:.") == ("S0", [0, 1], {"DP": 1})
    assert one(spark, "GT:GT:DP", "0/1:.:4") == ("S0", [0, 1], {"DP": 4})
    assert one(spark, "GT:DP:GT", "0/1:4:1/1") == ("S0", [1, 1], {"DP": 4})
    assert one(spark, "GT:GT", "0/1:x") == ("S0", None, {})


def test_unusual_format_keys(spark):
    assert one(spark, 'GT:a"b', '0/1:x"y') == ("S0", [0, 1], {'a"b': 'x"y'})


def test_samples_beyond_the_record_are_dropped(spark):
    assert [g.sampleId for g in parsed(spark, [("GT", ["0/1", "1/1"])])[0]] == ["S0", "S1"]


def test_fields_beyond_the_header_are_ignored(spark):
    fields = ["0/1"] * 7
    assert len(parsed(spark, [("GT", fields)])[0]) == 5


def test_null_when_no_sample_is_left(spark):
    last_only = "array(struct(4 AS idx, 'S4' AS sampleId))"
    none = "cast(array() AS array<struct<idx:int,sampleId:string>>)"
    assert parsed(spark, [("GT", ["0/1"])], last_only) == [None]
    assert parsed(spark, [("GT", ["0/1"])], none) == [None]
    assert parsed(spark, [("GT", [])]) == [None]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_records(spark, seed):
    rng = random.Random(seed)
    records, expected = [], []
    texts = [text for text in VALUES if text]
    for _ in range(400):
        keys = rng.sample(["DP", "AD", "PL", "x-1"], rng.randint(0, 4))
        keys.insert(0 if rng.random() < 0.8 else len(keys), "GT")
        fields, result = [], []
        for s in range(4):
            calls, data, values = None, {}, []
            for key in keys[: rng.randint(1, len(keys))]:
                if key == "GT":
                    text = rng.choice([c for c in CALLS if c])
                    calls = CALLS[text]
                else:
                    text = rng.choice([*texts, "."])
                    if text != ".":
                        data[key] = json.loads(VALUES[text])
                values.append(text)
            fields.append(":".join(values))
            result.append((f"S{s}", calls, data))
        records.append((":".join(keys), fields))
        expected.append(result)
    for record, got, want in zip(records, parsed(spark, records), expected):
        assert [(g.sampleId, g.calls, float_json(g.data)) for g in got] == want, record
