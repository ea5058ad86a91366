"""The fixed 13-column schema of parsed VCF records."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    VariantType,
)


def genotype_type() -> StructType:
    """One genotype: sample, allele indexes (-1 = missing), other FORMAT values."""
    return StructType(
        [
            StructField("sampleId", StringType(), nullable=False),
            StructField("calls", ArrayType(LongType())),
            StructField("data", VariantType()),
        ]
    )


def vcf_schema() -> StructType:
    """Names, order, types and intended nullability of a VCF DataFrame.

    A parsed DataFrame has these names and types; Spark reports its columns as
    nullable, since they come out of text.
    """
    text, texts = StringType(), ArrayType(StringType())
    return StructType(
        [
            StructField("contig", text, nullable=False),
            StructField("start", LongType(), nullable=False),
            StructField("end", LongType(), nullable=False),
            StructField("names", texts),
            StructField("referenceAllele", text, nullable=False),
            StructField("alternateAlleles", texts, nullable=False),
            StructField("qual", DoubleType()),
            StructField("filters", texts),
            StructField("info", VariantType()),
            StructField("genotypes", ArrayType(genotype_type())),
            StructField("file_path", text),
            StructField("file_name", text),
            StructField("variant_id", text),
        ]
    )
