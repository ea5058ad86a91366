"""VCF files as Spark DataFrames and streams."""

from genoframe.operators.genotypes import explode_genotypes, genotype_details
from genoframe.operators.layout import region_from_table, save_by_region
from genoframe.operators.regions import join_regions
from genoframe.operators.tables import read_variants, save_variants
from genoframe.operators.variants import (
    declared_info_types,
    discovered_info_types,
    flatten_info,
    in_region,
    info_field,
    join_header,
    min_quality,
    per_allele_numbers,
    split_multiallelic,
    trim_alleles,
    variant_field,
    variants_per_file,
)
from genoframe.plans.parse import parse_vcf_lines, rejected_lines
from genoframe.plans.rejects import RejectListener, reject_reasons
from genoframe.schema import vcf_schema
from genoframe.sources.headers import read_vcf_header, sample_ids, vcf_header
from genoframe.sources.reader import read_genotypes, read_vcf, read_vcf_lines
from genoframe.streaming.commit import commit_batch, read_committed, read_committed_stream
from genoframe.streaming.counts import count_stream, latest_counts
from genoframe.streaming.reader import foreach_vcf_batch, read_vcf_stream, relay_vcf, write_vcf_once

__all__ = [
    "RejectListener",
    "commit_batch",
    "count_stream",
    "declared_info_types",
    "discovered_info_types",
    "explode_genotypes",
    "flatten_info",
    "foreach_vcf_batch",
    "genotype_details",
    "in_region",
    "info_field",
    "join_header",
    "join_regions",
    "latest_counts",
    "min_quality",
    "parse_vcf_lines",
    "per_allele_numbers",
    "read_committed",
    "read_committed_stream",
    "read_genotypes",
    "read_variants",
    "read_vcf",
    "read_vcf_header",
    "read_vcf_lines",
    "read_vcf_stream",
    "region_from_table",
    "reject_reasons",
    "rejected_lines",
    "relay_vcf",
    "sample_ids",
    "save_by_region",
    "save_variants",
    "split_multiallelic",
    "trim_alleles",
    "variant_field",
    "variants_per_file",
    "vcf_header",
    "vcf_schema",
    "write_vcf_once",
]
