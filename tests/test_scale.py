"""Work that may not grow beyond the input."""

import pytest

import __spark_entry__ as registered
import genoframe as gf
from conftest import vcf_text, write_vcf

SCHEMA = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber bigint, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
)


@pytest.fixture
def tables(spark, tmp_path):
    """A folder with lineitem in four files and orders."""
    rows = [
        (i, i, i, 1 + i % 6, 7.0, 10.5, 0.25, 0.5, "ANNR"[i % 4], "O") for i in range(400)
    ]
    lineitem = spark.createDataFrame(rows, SCHEMA).repartition(4)
    lineitem.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = spark.createDataFrame([(i, i) for i in range(50)], "o_orderkey bigint, o_custkey bigint")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    return tmp_path


def test_regions_are_joined_to_variants_that_were_parsed_once(spark, tables, monkeypatch):
    inputs, join = [], registered.gf.join_regions

    def joined(variants, *args, **options):
        inputs.append(variants.inputFiles())
        return join(variants, *args, **options)

    monkeypatch.setattr(registered.gf, "join_regions", joined)
    assert registered.regions_join(spark, str(tables)).count() > 0
    assert len(inputs) == 4
    assert not any("lineitem" in file for files in inputs for file in files)


def test_balanced_input_is_not_one_file_per_flag(spark, tables, monkeypatch):
    monkeypatch.setattr(registered, "_scratch", lambda spark: f"{tables}/scratch")
    saved = registered.save_balanced(spark, str(tables)).first()
    assert saved["n"] == 400
    # Whole partitions: no task has all rows of a flag.
    monkeypatch.undo()
    for flag in "ANR":
        files = list((tables / "scratch" / "in" / flag).glob("*.vcf.gz"))
        assert len(files) > 1


def test_samples_without_values_are_empty_objects(spark, tmp_path):
    samples = ["0/1:.:.", "0/1", ".", "./.:", "0/1:.:.:.:5", "0/1:7:a,1", "0/1:7:1,.", "0/1:,5:."]
    record = "chr1 11 . A G . . . GT:DP:AD " + " ".join(samples)
    names = tuple(f"S{i}" for i in range(len(samples)))
    path = write_vcf(tmp_path / "odd.vcf", vcf_text([record], names))
    wanted = [
        "{}", "{}", "{}", '{"DP":""}', "{}", '{"AD":"a,1","DP":7}', '{"AD":"1,.","DP":7}', '{"DP":",5"}',
    ]
    for rows in (gf.explode_genotypes(gf.read_vcf(spark, path)), gf.read_genotypes(spark, path)):
        found = rows.selectExpr("genotype.sampleId AS s", "to_json(genotype.data) AS d").collect()
        assert [row["d"] for row in sorted(found)] == wanted


def test_info_is_parsed_once_for_its_types_and_its_columns(spark, tables, monkeypatch):
    inputs, found, flatten = [], registered.gf.discovered_info_types, registered.gf.flatten_info

    def types_of(variants, *args):
        inputs.append(variants.inputFiles())
        return found(variants, *args)

    def flattened(variants, types):
        inputs.append(variants.inputFiles())
        return flatten(variants, types)

    monkeypatch.setattr(registered.gf, "discovered_info_types", types_of)
    monkeypatch.setattr(registered.gf, "flatten_info", flattened)
    rows = registered.discovered_info(spark, str(tables)).collect()
    assert sum(row["n"] for row in rows) == 400
    assert {row["types"] for row in rows} == {"DP:bigint FLAG:boolean LIST:array<double> MIX:string"}
    assert len(inputs) == 2 and all(inputs)
    assert not any("lineitem" in file for files in inputs for file in files)
