"""Genotypes that are exploded before they are parsed."""

import json

import pytest
from pyspark.sql import functions as F

import genoframe as gf
from conftest import write_vcf
from test_genotypes import CALLS, VALUES

KEYS = [f"K{i}" for i in range(9)]


def plain_text(values):
    return [v for v in values if not {"\t", "\n", "\r", ":"} & set(v) and v.strip() == v]


@pytest.fixture
def odd(spark, tmp_path):
    """Samples of every spelling of calls and values, under FORMAT fields of all kinds."""
    values = plain_text(VALUES) + ["PASS", "a.b-c|d", "10,.", ".,.", ".,7", "1,2.5,-3", "1,02", "1.50", "x,1", "é", '"q"']
    layouts = {
        "GT:DP:AD": [f"0/1:{v}:{w}" for v in values for w in (".", "12", v)] + [f"1|0:{v}" for v in values],
        "GT": [c for c in plain_text(CALLS)] + ["0/1:5"],
        "GT:DP": [f"{c}:7" for c in plain_text(CALLS)] + ["0/1:7:8", "", "0/1:"],
        "DP:GT": [f"{v}:0/1" for v in values],
        "GT:DP:GT:DP": [f"0/1:{v}:1|1:{w}" for v in values for w in (".", "3")],
        'GT:a"b:DP': [f"0/1:{v}:4" for v in values],
        "GT::DP": ["0/1:1:2"],
        ":".join(["GT", *KEYS]): [":".join(["0/1", *[v] * 9]) for v in values],
        ":".join(["GT", *KEYS[:7]]): [":".join(["0/1", *[v] * 7]) for v in values],
    }
    lines = ["##fileformat=VCFv4.2", "\t".join("#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT S1 S2 S3".split())]
    n = 0
    for layout, samples in layouts.items():
        for sample in samples:
            n += 1
            alts = ("G", "G,T", ".")[n % 3]
            lines.append("\t".join(["chr1", str(n), ".", "A", alts, ".", ".", ".", layout, "0|0", sample, "./."]))
    lines.append("\t".join(["chr1", "9999", ".", "A", "G", ".", ".", "."]))
    return write_vcf(tmp_path / "odd.vcf", "\n".join(lines) + "\n")


def as_text(rows):
    found = rows.select("start", F.to_json("alternateAlleles").alias("alts"), F.to_json("genotype").alias("g"))
    return sorted((r.start, r.alts, r.g) for r in found.collect())


def test_exploding_first_gives_the_same_genotypes(spark, odd):
    variants = gf.read_vcf(spark, odd)
    # A selection is no longer what the reader gave, so its arrays are parsed.
    arrays = variants.select("*")
    first = gf.explode_genotypes(variants)
    assert first.columns == gf.explode_genotypes(arrays).columns
    assert as_text(first) == as_text(gf.explode_genotypes(arrays))
    assert any(json.loads(g)["data"] for _, _, g in as_text(first))


def test_splitting_first_gives_the_same_genotypes(spark, odd):
    variants = gf.read_vcf(spark, odd, includeSampleIds="S2")
    numbers = {"AD": "R", "DP": "A"}
    first = gf.explode_genotypes(gf.split_multiallelic(variants, format_numbers=numbers))
    arrays = gf.explode_genotypes(gf.split_multiallelic(variants.select("*"), format_numbers=numbers))
    assert first.columns == arrays.columns
    assert as_text(first) == as_text(arrays)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_what_is_not_read_of_exploded_samples_is_not_parsed(spark, cohort):
    for rows in (
        gf.explode_genotypes(gf.read_vcf(spark, cohort)),
        gf.explode_genotypes(gf.split_multiallelic(gf.read_vcf(spark, cohort))),
    ):
        assert "parseJson" in plan(rows.select("genotype.data"))
        assert "parseJson" not in plan(rows.select("genotype.sampleId", "genotype.calls"))


def test_samples_are_split_off_once(spark, cohort):
    rows = gf.read_genotypes(spark, cohort).select("genotype.sampleId")
    assert plan(rows).count("transform(filter(") == 1
