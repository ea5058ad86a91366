"""INFO typing."""

import json
import random

import pytest

from genoframe.functions.variant import info_variant

# Value text and the JSON it stands for.
SCALARS = {
    "14": "14", "007": "7", "+3": "3", "-0": "0", "-12": "-12", "1_000": "1000", " 5": "5",
    "0.5": "0.5", "5.": "5.0", ".5": "0.5", "60.00": "60.0", "-1.250": "-1.25",
    "1.0e-5": "1e-5", "0.00012": "0.00012", "0.00001": "1e-5", "12345678.5": "12345678.5",
    "123456789012.25": "123456789012.25", "1.5e3": "1500.0", "0.1234567": "0.1234567",
    "123456789012345678": "123456789012345678", "99999999999999999999": "99999999999999999999",
    "1e-5": '"1e-5"', "nan": '"nan"', "inf": '"inf"', "1e5": '"1e5"', "0x10": '"0x10"',
    ".": '"."', "..": '".."', "": '""', "-": '"-"', "1.2.3": '"1.2.3"', "1.5d": '"1.5d"',
    "DEL": '"DEL"', "p.V600E": '"p.V600E"', "a=b=c": '"a=b=c"', "é": '"é"',
    "5\u2028": "5", "5\x85": "5", "\u30005 ": "5", "0.5\u2029": "0.5", "0.5\x1c": "0.5",
    "x\u2028": '"x\u2028"', "\u0665": '"\u0665"',
    'say "hi"': '"say \\"hi\\""', "back\\slash": '"back\\\\slash"', "[x]{y}": '"[x]{y}"',
}
LISTS = {
    "0.3,0.2": "[0.3,0.2]", "1,2,3": "[1,2,3]", "1,0.50": "[1,0.5]", "1.0e-5,2": "[1e-5,2]",
    "10,.": '["10","."]', "1,x": '["1","x"]', "x,1": '["x","1"]', ",": '["",""]',
    "1,": '["1",""]', "1e5,2": '["1e5","2"]', '1,"': '["1","\\""]', "007,1": "[7,1]",
    "0.1,5\u2028": "[0.1,5]", "5\x85,1": "[5,1]", "1,x\u2028": '["1","x\u2028"]',
}
VALUES = {**SCALARS, **LISTS}


def parsed(spark, texts: list[str]) -> list[dict]:
    df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, text string")
    rows = df.selectExpr("i", f"to_json({info_variant('text')}) AS json").orderBy("i").collect()
    return [json.loads(row.json) for row in rows]


def test_each_value(spark):
    results = parsed(spark, [f"K={text}" for text in VALUES])
    for text, result in zip(VALUES, results):
        assert result == {"K": json.loads(VALUES[text])}, text


def test_line_separators_inside_a_field(spark):
    assert parsed(spark, ["DP=5\u2028;AF=0.5", "DP=5\x85", "AF=0.1,5\u2028;B"]) == [
        {"DP": 5, "AF": 0.5}, {"DP": 5}, {"AF": [0.1, 5], "B": True},
    ]


def test_numbers_keep_their_kind(spark):
    df = spark.createDataFrame([("A=5.;B=5;C=60.00;D=15000000.5",)], "text string")
    schema = df.selectExpr(f"schema_of_variant({info_variant('text')}) AS s").first().s
    assert schema == "OBJECT<A: DECIMAL(1,0), B: BIGINT, C: DECIMAL(2,0), D: DECIMAL(9,1)>"


def test_overflow_is_infinite(spark):
    df = spark.createDataFrame([("A=1.0e999;B=-1.0e999",)], "text string")
    variant = info_variant("text")
    row = df.selectExpr(
        f"variant_get({variant}, '$.A', 'double') AS a",
        f"variant_get({variant}, '$.B', 'double') AS b",
    ).first()
    assert (row.a, row.b) == (float("inf"), float("-inf"))


@pytest.mark.parametrize("text", [".", ""])
def test_missing(spark, text):
    assert parsed(spark, [text]) == [{}]


def test_flags(spark):
    assert parsed(spark, ["DB;H2", "DB;", ";", "A=1;DB;B=x", '"q"']) == [
        {"DB": True, "H2": True}, {"DB": True, "": True}, {"": True},
        {"A": 1, "DB": True, "B": "x"}, {'"q"': True},
    ]


def test_last_of_repeated_keys_wins(spark):
    assert parsed(spark, ["A=1;B=2;A=3", "A=1;A", "A;A=x;A=0.5", 'A=";A=1']) == [
        {"A": 3, "B": 2}, {"A": True}, {"A": 0.5}, {"A": 1},
    ]


def test_many_keys(spark):
    info = ";".join(f"KEY{i}={i}" for i in range(100))
    assert parsed(spark, [info]) == [{f"KEY{i}": i for i in range(100)}]


def test_random_fields(spark):
    rng = random.Random(7)
    texts, expected = [], []
    for _ in range(1500):
        items, result = [], {}
        for _ in range(rng.randint(1, 7)):
            key = rng.choice(["A", "B", "C", "DP", "x y", 'q"'])
            if rng.random() < 0.2:
                items.append(key)
                result[key] = True
            else:
                text = rng.choice(list(VALUES))
                items.append(f"{key}={text}")
                result[key] = json.loads(VALUES[text])
        texts.append(";".join(items))
        expected.append(result)
    for text, got, want in zip(texts, parsed(spark, texts), expected):
        assert got == want, text
