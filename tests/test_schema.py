from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, VariantType

from conftest import vcf_text, write_vcf
from genoframe import read_vcf, vcf_schema

NAMES = [
    "contig", "start", "end", "names", "referenceAllele", "alternateAlleles", "qual",
    "filters", "info", "genotypes", "file_path", "file_name", "variant_id",
]


def test_names_and_order():
    assert vcf_schema().names == NAMES


def test_types():
    types = {field.name: field.dataType for field in vcf_schema()}
    for name in ("contig", "referenceAllele", "file_path", "file_name", "variant_id"):
        assert types[name] == StringType()
    for name in ("names", "alternateAlleles", "filters"):
        assert types[name] == ArrayType(StringType())
    assert types["start"] == types["end"] == LongType()
    assert types["qual"] == DoubleType()
    assert types["info"] == VariantType()


def test_genotype_type():
    genotype = vcf_schema()["genotypes"].dataType.elementType
    assert genotype.names == ["sampleId", "calls", "data"]
    assert [f.dataType for f in genotype] == [StringType(), ArrayType(LongType()), VariantType()]


def test_required_columns():
    required = {field.name for field in vcf_schema() if not field.nullable}
    assert required == {"contig", "start", "end", "referenceAllele", "alternateAlleles"}
    assert not vcf_schema()["genotypes"].dataType.elementType["sampleId"].nullable


def test_parsed_frame_has_the_schema(spark, tmp_path):
    path = write_vcf(tmp_path / "a.vcf", vcf_text(["c 1 . A G . . ."]))
    for df in (read_vcf(spark, path), read_vcf(spark, str(tmp_path / "none"))):
        assert df.columns == NAMES
        expected = [field.dataType.simpleString() for field in vcf_schema()]
        assert [field.dataType.simpleString() for field in df.schema] == expected
