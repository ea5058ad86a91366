"""The parse plan: lines with their samples to the 13 VCF columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.functions import fields
from genoframe.functions.genotype import (
    format_layout,
    genotypes,
    parsed_sample,
    raw_genotypes,
    record_format,
    split_sample,
)
from genoframe.functions.text import strip
from genoframe.functions.variant import info_variant
from genoframe.options import VcfOptions
from genoframe.plans.header_join import (
    MAX_BROADCAST_BYTES,
    join_headers,
    join_scanned_headers,
)
from genoframe.plans.unparsed import with_rows


def body_lines(lines: DataFrame) -> DataFrame:
    """Trimmed lines that are neither header nor blank.

    The trimmed line comes out of a one-element ``explode``. Filters on it stay
    above, so Catalyst does not copy the expression that produces the line into
    every predicate.
    """
    body = lines.where(~F.startswith("value", F.lit("#")))
    others = [name for name in lines.columns if name != "value"]
    trimmed = F.expr(f"explode(array({strip('value')}))").alias("value")
    return body.select(*others, trimmed).where(F.col("value") != "")


def record_lines(lines: DataFrame) -> DataFrame:
    """Trimmed lines that hold a well formed record."""
    return body_lines(lines).where(fields.is_record("value"))


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Body lines that are dropped as malformed, for audits."""
    return body_lines(lines).where(f"NOT {fields.is_record('value')}")


def vcf_columns(
    records: DataFrame, options: VcfOptions, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The VCF columns of record lines that carry their ``kept`` samples, and the
    columns to ``keep``.

    Every column is its own expression over the line, so a query pays for the
    columns it reads and its filters run before anything else is parsed.
    """
    file_path, file_name = (
        ("file_path", "file_name") if options.file_metadata else ("''", "''")
    )
    key = fields.variant_id(file_path, file_name, "value")
    columns = {
        "contig": fields.contig("value"),
        "start": fields.start("value"),
        "end": fields.end("value"),
        "names": fields.names("value"),
        "referenceAllele": fields.reference_allele("value"),
        "alternateAlleles": fields.alternate_alleles("value"),
        "qual": fields.qual("value"),
        "filters": fields.filters("value"),
        "info": info_variant(fields.info_text("value")),
        "genotypes": genotypes("value", "kept"),
        "file_path": file_path,
        "file_name": file_name,
        "variant_id": key if options.primary_key else "cast(NULL AS string)",
    }
    return records.selectExpr(*(f"{sql} AS `{name}`" for name, sql in columns.items()), *keep)


def genotype_rows(records: DataFrame, options: VcfOptions) -> DataFrame:
    """One row per record and kept sample: the VCF columns with ``genotype`` in place
    of ``genotypes``.

    The text of the samples is exploded and each is parsed in its own row, so no row
    holds the parsed genotypes of a whole cohort, and what a query does not read of a
    genotype is not parsed. The line itself does not go into the exploded rows.
    """
    columns = vcf_columns(
        records.select(
            "*",
            F.expr(raw_genotypes("value", "kept")).alias("raw"),
            F.expr(record_format("value")).alias("format"),
        ),
        options,
        keep=("raw", "format"),
    )
    others = [name for name in columns.columns if name not in ("genotypes", "raw", "format")]
    laid_out = columns.select(*others, "raw", F.expr(format_layout("format")).alias("layout"))
    # Exploding a bare column makes Spark add filters on it, which would split the
    # samples off once more for each.
    present = F.coalesce("raw", F.array().cast(laid_out.schema["raw"].dataType))
    exploded = laid_out.select(*others, "layout", F.explode(present).alias("sample"))
    # Columns of their own are evaluated once and compiled, other than bound variables.
    for step in (split_sample, parsed_sample):
        found = step("sample", "layout")
        exploded = exploded.withColumns({name: F.expr(sql) for name, sql in found.items()})
    genotype = F.struct(F.col("sample.sampleId").alias("sampleId"), "calls", "data")
    return exploded.select(*others, genotype.alias("genotype"))


def parsed_variants(staged: DataFrame, options: VcfOptions) -> DataFrame:
    """The VCF columns of a batch, which ``explode_genotypes`` may take as genotype rows."""
    return with_rows(vcf_columns(staged, options), lambda: genotype_rows(staged, options))


def parse_vcf_lines(
    lines: DataFrame,
    headers: DataFrame | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    **options: object,
) -> DataFrame:
    """Parse a batch DataFrame of VCF lines (``value``, ``file_path``, ``file_name``).

    ``headers`` is a table of file key and ``sample_ids`` as ``sample_ids(lines)``
    returns it; without it the header lines are looked for in ``lines``.
    """
    parsed = VcfOptions.parse(options)
    records = record_lines(lines)
    if headers is None:
        staged = join_scanned_headers(records, lines, parsed, max_broadcast_bytes)
    else:
        staged = join_headers(records, headers, parsed, max_broadcast_bytes)
    return parsed_variants(staged, parsed)
