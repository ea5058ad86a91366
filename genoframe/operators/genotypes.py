"""Queries over genotypes: one row per variant and sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.operators.variants import variant_field
from genoframe.plans.unparsed import rows_of


def explode_genotypes(df: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Replace ``genotypes`` by one ``genotype`` struct per row.

    Variants without genotypes give no row, unless ``keep_empty`` is set. Variants
    straight from a batch reader, or split after it, are parsed behind the explode.
    """
    rows = None if keep_empty else rows_of(df)
    if rows is not None:
        return rows
    explode = F.explode_outer if keep_empty else F.explode
    others = [F.col(name) for name in df.columns if name != "genotypes"]
    # Exploding a bare column makes Spark add filters on it, which would parse the
    # genotypes once more for each.
    present = F.coalesce("genotypes", F.array().cast(df.schema["genotypes"].dataType))
    return df.select(*others, explode(present).alias("genotype"))


def genotype_details(exploded: DataFrame) -> DataFrame:
    """Sample, calls and read depth of exploded genotypes."""
    return exploded.select(
        "contig",
        "start",
        F.col("genotype.sampleId").alias("sampleId"),
        F.col("genotype.calls").alias("calls"),
        variant_field(F.col("genotype.data"), "DP", "bigint").alias("read_depth"),
    )
