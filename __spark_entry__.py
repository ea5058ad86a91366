"""

The driver's tables hold no VCF. Every query runs on VCF lines or files that
Spark derives from the whole ``lineitem`` table (``synthetic_vcf.py``),
one data line per row and one file per return flag; the SQL computes the expected
values from the columns directly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

import genoframe as gf
import synthetic_vcf as synth
from genoframe.plans.shared import shared_path
from genoframe.sources.headers import stored

FLAGSHIP_DIR = "/root/testdata/sf0.001"


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth.lines_of(_lineitem(spark, sf_dir))


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gf.sample_ids(synth.header_lines_of(_lineitem(spark, sf_dir)))


def _variants(spark: SparkSession, sf_dir: str, **options: object) -> DataFrame:
    return gf.parse_vcf_lines(
        _lines(spark, sf_dir), headers=_headers(spark, sf_dir), **options
    )


def _scratch(spark: SparkSession) -> str:
    """A new folder that all executors see."""
    return shared_path(spark, "run")


def _read(spark: SparkSession, sf_dir: str, **options: object) -> DataFrame:
    """The variants of written files."""
    return gf.read_vcf(spark, _written(spark, sf_dir), **options)


def _written(spark: SparkSession, sf_dir: str, compression: str = "none") -> str:
    """Folder of VCF files with a data line for every lineitem row."""
    folder = f"{_scratch(spark)}/variants"
    records = synth.record_lines_of(_lineitem(spark, sf_dir))
    synth.write_vcf_files(records, folder, compression)
    return folder


def _joined(column: str) -> Column:
    return F.array_join(column, "|")


def _by_contig(df: DataFrame) -> DataFrame:
    return df.groupBy("contig").agg(F.count("*").alias("n"), F.sum("start").alias("sum_start"))


def scan_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = gf.read_vcf(spark, _written(spark, sf_dir))
    return variants.agg(F.count("*").alias("n"), F.sum("start").alias("sum_start"))


def discover_dir_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _scratch(spark)
    records = synth.record_lines_of(_lineitem(spark, sf_dir))
    synth.write_vcf_files(records, f"{root}/plain")
    synth.write_vcf_files(records, f"{root}/deep/er/packed", "gzip")
    records.select("value").write.text(f"{root}/other")
    variants = gf.read_vcf(spark, root)
    packed = F.endswith("file_name", F.lit(".vcf.gz")).alias("packed")
    return variants.groupBy(packed).agg(F.count("*").alias("n"))


def missing_path_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = gf.read_vcf(spark, f"{sf_dir}/no-such-folder")
    return _by_contig(missing.unionByName(_variants(spark, sf_dir)))


def gzip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_contig(gf.read_vcf(spark, _written(spark, sf_dir, "gzip")))


def scanned_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = gf.read_vcf(spark, _written(spark, sf_dir), scan_headers=True)
    return _by_contig(variants.where(F.size("genotypes") == 3))


def looked_up_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = gf.read_vcf(spark, _written(spark, sf_dir), max_broadcast_bytes=0)
    return _by_contig(variants.where(F.size("genotypes") == 3))


def salted_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = gf.parse_vcf_lines(_lines(spark, sf_dir), max_broadcast_bytes=0)
    return _by_contig(variants.where(F.size("genotypes") == 3))


def header_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = gf.sample_ids(_lines(spark, sf_dir))
    return headers.select("file_path", F.posexplode("sample_ids").alias("position", "sample_id"))


def header_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gf.vcf_header(_lines(spark, sf_dir)).drop("attributes")


def header_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of structured lines, commas, brackets and quotes in their texts."""
    lineitem = _lineitem(spark, sf_dir)
    lines = synth.described_header_lines_of(lineitem).unionByName(synth.lines_of(lineitem))
    header = gf.vcf_header(lines).where("section = 'INFO' AND id LIKE 'Q%'")
    return header.select("file_path", "id", "number", "type", F.explode("attributes").alias("key", "value"))


def header_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = gf.read_vcf_header(spark, _written(spark, sf_dir))
    return header.select("line", "section", "id", "number", "type").distinct()


def malformed_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = _variants(spark, sf_dir)
    return variants.groupBy("file_name", "contig").agg(F.count("*").alias("n_valid"))


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gf.rejected_lines(_lines(spark, sf_dir)).select("file_name", "value")


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropped lines by reason: from the lines, and as counted while others were parsed."""
    lines = synth.flawed_lines_of(_lineitem(spark, sf_dir))
    by_line = gf.reject_reasons(lines).groupBy("reason").agg(F.count("*").alias("n"))
    folder = f"{_scratch(spark)}/flawed"
    synth.write_vcf_files(lines, folder)
    observation = Observation()
    gf.read_vcf(spark, folder, observation=observation).write.format("noop").mode("overwrite").save()
    counted = [("observed", reason, n) for reason, n in observation.get.items()]
    observed = spark.createDataFrame(counted, "way string, reason string, n bigint")
    return by_line.select(F.lit("lines").alias("way"), "reason", "n").union(observed)


def core_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _variants(spark, sf_dir).select(
        "contig", "start", F.col("end").alias("end_pos"), F.col("referenceAllele").alias("ref")
    )


def names_alts_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _variants(spark, sf_dir).select(
        "contig",
        "start",
        _joined("names").alias("names"),
        F.size("names").alias("n_names"),
        _joined("alternateAlleles").alias("alts"),
        F.size("alternateAlleles").alias("n_alts"),
        _joined("filters").alias("filters"),
        F.size("filters").alias("n_filters"),
    )


def qual_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _variants(spark, sf_dir).select("contig", "start", "qual")


def info_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir).select(
        "contig", "start", gf.info_field("DP", "bigint").alias("depth")
    )


def info_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    frequencies = gf.info_field("AF", "array<double>")
    return _read(spark, sf_dir).select(
        "contig",
        "start",
        F.get(frequencies, 0).alias("af_first"),
        F.get(frequencies, 1).alias("af_second"),
        F.size(frequencies).alias("n_af"),
    )


def info_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _variants(spark, sf_dir).select(
        "contig", "start", gf.info_field("DB", "boolean").alias("known")
    )


def info_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir).select(
        "contig", "start", gf.info_field("GENE").alias("gene")
    )


def info_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    depth = gf.info_field("DP", "bigint").alias("depth")
    return _variants(spark, sf_dir).groupBy(depth).agg(F.count("*").alias("n"))


def _genotypes(spark: SparkSession, sf_dir: str, **options: object) -> DataFrame:
    return gf.explode_genotypes(_read(spark, sf_dir, **options))


def genotype_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _genotypes(spark, sf_dir).select(
        "contig",
        "start",
        F.col("genotype.sampleId").alias("sample_id"),
        _joined("genotype.calls").alias("calls"),
    )


def genotype_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.col("genotype.data")
    return _genotypes(spark, sf_dir).select(
        "contig",
        "start",
        F.col("genotype.sampleId").alias("sample_id"),
        gf.variant_field(data, "DP", "bigint").alias("depth"),
        gf.variant_field(data, "AD", "string").alias("ad_text"),
    )


def genotype_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _genotypes(spark, sf_dir).groupBy(F.col("genotype.sampleId").alias("sample_id")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("genotype.calls").isNull()).alias("n_no_calls"),
        F.count_if(F.to_json("genotype.data") == "{}").alias("n_no_data"),
    )


def _sample_counts(spark: SparkSession, sf_dir: str, **options: object) -> DataFrame:
    genotypes = _genotypes(spark, sf_dir, **options)
    return genotypes.groupBy("contig", F.col("genotype.sampleId").alias("sample_id")).agg(
        F.count("*").alias("n")
    )


def sample_include(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample_counts(spark, sf_dir, includeSampleIds="S3, S1,unknown")


def sample_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample_counts(spark, sf_dir, excludeSampleIds="S2")


def sample_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = _variants(
        spark, sf_dir, includeSampleIds="S1,S2", excludeSampleIds="S2,S1"
    )
    return variants.groupBy("contig").agg(
        F.count("*").alias("n"), F.count("genotypes").alias("n_with_genotypes")
    )


def file_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _variants(spark, sf_dir).groupBy("file_path", "file_name").agg(
        F.count("*").alias("n")
    )


def file_metadata_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = _variants(
        spark, sf_dir, includeFileMetadata="false", generatePrimaryKey="true"
    )
    return variants.select("contig", "start", "file_path", "file_name", "variant_id")


def variant_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = _variants(spark, sf_dir, generatePrimaryKey=True)
    return variants.select("contig", "start", "file_name", "variant_id")


def region_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = gf.in_region(_variants(spark, sf_dir), "chr3", 100, 5000)
    return inside.select("contig", "start", F.col("end").alias("end_pos"))


def regions_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of every order, many per variant, some on places that all variants share."""
    regions = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "concat('chr', 1 + o_custkey % 7) AS chrom", "o_orderkey AS region_start",
        "o_orderkey + CASE o_orderkey % 50 WHEN 0 THEN 3000 ELSE 4 END AS region_end",
    )
    names = {"contig": "chrom", "start": "region_start", "end": "region_end"}
    # Parsed once: the ways read the variants eight times together.
    variants = stored(_variants(spark, sf_dir).select("contig", "start", "end", "referenceAllele"), "variants")
    found = None
    for way, options in REGION_WAYS.items():
        pairs = gf.join_regions(variants, regions, **names, **options)
        counted = pairs.groupBy("contig", F.col("region.region_start").alias("region_start")).agg(
            F.count("*").alias("n"), F.sum("start").alias("sum_start")
        )
        counted = counted.withColumn("way", F.lit(way))
        found = counted if found is None else found.union(counted)
    return found


def region_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A region out of files by place; the manifest knows every variant."""
    folder = f"{_scratch(spark)}/by-region"
    gf.save_by_region(_variants(spark, sf_dir).select("contig", "start", "end", "referenceAllele", "qual"), folder)
    known = spark.read.parquet(f"{folder}/_regions").agg(F.sum("variants").alias("n")).first()["n"]
    inside = gf.region_from_table(spark, folder, "chr3", 100, 5000)
    return inside.select(
        "contig", "start", F.col("end").alias("end_pos"), "qual", F.lit(known).alias("n_saved")
    )


def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gf.min_quality(_variants(spark, sf_dir), 50000.0).select("contig", "start", "qual")


def variants_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gf.variants_per_file(_variants(spark, sf_dir))


def explode_genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample_counts(spark, sf_dir)


def genotype_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = gf.genotype_details(_genotypes(spark, sf_dir))
    return details.select(
        "contig",
        "start",
        F.col("sampleId").alias("sample_id"),
        _joined("calls").alias("calls"),
        "read_depth",
    )


def global_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _variants(spark, sf_dir).agg(F.count("*").alias("n"))


def first_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = _variants(spark, sf_dir).select(
        "file_path", "contig", "start", F.col("end").alias("end_pos")
    )
    return ordered.orderBy("file_path", "contig", "start", "end_pos").limit(20)


def save_and_read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"variants_{uuid.uuid4().hex}"
    gf.save_variants(
        _variants(spark, sf_dir), table, mode="overwrite", path=f"{_scratch(spark)}/table"
    )
    saved = gf.read_variants(spark, table).select(
        "contig", "start", "qual", gf.info_field("DP", "bigint").alias("depth"),
        F.size("genotypes").alias("n_genotypes"),
    )
    return _dropped(spark, saved, table)


def _dropped(spark: SparkSession, saved: DataFrame, table: str) -> DataFrame:
    """``saved`` without its catalog entry: the files are external and stay."""
    spark.sql(f"DROP TABLE {table}")
    return saved


def save_fails_if_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, folder = f"variants_{uuid.uuid4().hex}", _scratch(spark)
    variants = _variants(spark, sf_dir).select("contig", "start")
    gf.save_variants(variants, table, mode="error", path=f"{folder}/table")
    try:
        gf.save_variants(variants, table, mode="error", path=f"{folder}/table")
        failed = False
    except AnalysisException:
        failed = True
    counted = gf.read_variants(spark, table).agg(F.count("*").alias("n"))
    return _dropped(spark, counted.withColumn("failed", F.lit(failed)), table)


def save_in_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"variants_{uuid.uuid4().hex}"
    gf.save_variants(
        _variants(spark, sf_dir), table, mode="overwrite", partitions=4,
        path=f"{_scratch(spark)}/table",
    )
    files = gf.read_variants(spark, table).agg(
        F.count("*").alias("n"), F.countDistinct("_metadata.file_path").alias("n_files")
    )
    return _dropped(spark, files, table)


def padded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = synth.padded_lines_of(_lineitem(spark, sf_dir))
    return gf.parse_vcf_lines(lines, headers=_headers(spark, sf_dir)).select(
        "contig", "start", F.col("end").alias("end_pos"), F.col("referenceAllele").alias("ref")
    )


def headless_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without a header give no rows beside files that have one."""
    root = _scratch(spark)
    records = synth.record_lines_of(_lineitem(spark, sf_dir))
    synth.write_vcf_files(records, f"{root}/whole")
    synth.write_vcf_files(records, f"{root}/headless", header=())
    return _by_contig(gf.read_vcf(spark, root))


def single_file_any_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file by itself, of every codec and by every header way."""
    found = None
    for codec in ("none", "gzip", "bzip2"):
        folder = _written(spark, sf_dir, codec)
        files = [row.path for row in spark.read.format("binaryFile").load(folder).select("path").collect()]
        for way, options in HEADER_WAYS.items():
            for path in files:
                rows = gf.read_vcf(spark, path, **options).where(F.size("genotypes") == 3)
                rows = rows.select(F.lit(codec).alias("codec"), F.lit(way).alias("way"), "start")
                found = rows if found is None else found.union(rows)
    return found.groupBy("codec", "way").agg(
        F.count("*").alias("n"), F.sum("start").alias("sum_start")
    )


def odd_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = gf.parse_vcf_lines(
        synth.odd_lines_of(_lineitem(spark, sf_dir)), headers=_headers(spark, sf_dir)
    )
    tags = gf.info_field("TAGS", "array<string>")
    return variants.select(
        "contig", "start", (F.to_json("info") == "{}").alias("is_empty"),
        F.get(tags, 0).alias("first_tag"), F.get(tags, 1).alias("second_tag"),
    )


def repeated_format_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = gf.parse_vcf_lines(
        synth.odd_lines_of(_lineitem(spark, sf_dir)), headers=_headers(spark, sf_dir)
    )
    genotype = F.get("genotypes", 0)
    return variants.select(
        "contig", "start", _joined(genotype["calls"]).alias("calls"),
        gf.variant_field(genotype["data"], "DP", "bigint").alias("depth"),
        F.size("genotypes").alias("n_genotypes"),
    )


def file_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of files in one folder per return flag."""
    root = _scratch(spark)
    lineitem = _lineitem(spark, sf_dir)
    for flag in "ANR":
        records = synth.record_lines_of(lineitem.where(F.col("l_returnflag") == flag))
        synth.write_vcf_files(records, f"{root}/{flag}")
    flag = F.regexp_extract("file_path", "/([ANR])/[^/]*$", 1)
    whole = F.concat(F.lit(f"{root}/"), flag, F.lit("/"), F.col("file_name"))
    return gf.read_vcf(spark, root).groupBy(flag.alias("flag")).agg(
        F.count("*").alias("n"), F.every(F.col("file_path") == whole).alias("same")
    )


def wide_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hundreds of samples by every header way, by stream and as genotype rows."""
    root = _scratch(spark)
    header = ("##fileformat=VCFv4.2", synth.chrom_line(synth.wide_samples()))
    synth.write_vcf_files(synth.wide_lines_of(_lineitem(spark, sf_dir)), f"{root}/in", header=header)
    _run_to_end(gf.read_vcf_stream(spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint")
    ways = {
        way: gf.explode_genotypes(gf.read_vcf(spark, f"{root}/in", **options))
        for way, options in HEADER_WAYS.items()
    }
    ways["stream"] = gf.explode_genotypes(spark.read.parquet(f"{root}/out"))
    ways["rows"] = gf.read_genotypes(spark, f"{root}/in")
    depth = gf.variant_field(F.col("genotype.data"), "DP", "bigint")
    found = None
    for way, rows in ways.items():
        summed = rows.groupBy("start").agg(
            F.count("*").alias("n_samples"),
            F.sum(depth).alias("sum_depth"),
            F.max_by("genotype.sampleId", depth).alias("deepest"),
        )
        summed = summed.withColumn("way", F.lit(way))
        found = summed if found is None else found.union(summed)
    return found


def genotype_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gf.read_genotypes(spark, _written(spark, sf_dir))
    data = F.col("genotype.data")
    return rows.select(
        "contig",
        "start",
        F.col("genotype.sampleId").alias("sample_id"),
        gf.variant_field(data, "DP", "bigint").alias("depth"),
        gf.variant_field(data, "AD", "string").alias("ad_text"),
    )


def stream_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of streamed rows, compared with SQL and not with the batch reader."""
    root = _scratch(spark)
    stream = gf.read_vcf_stream(spark, _written(spark, sf_dir), maxFilesPerTrigger=2)
    _run_to_end(stream, f"{root}/out", f"{root}/checkpoint")
    return gf.explode_genotypes(spark.read.parquet(f"{root}/out")).select(
        "contig", "start", F.col("genotype.sampleId").alias("sample_id"),
        _joined("genotype.calls").alias("calls"), gf.info_field("GENE").alias("gene"),
    )


def _run_to_end(stream: DataFrame, folder: str, checkpoint: str) -> None:
    query = (
        stream.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive after the first run are read by the second, once."""
    root = _scratch(spark)
    lineitem = _lineitem(spark, sf_dir)
    for run, wanted in enumerate((F.col("l_returnflag") == "N", F.col("l_returnflag") != "N")):
        records = synth.record_lines_of(lineitem.where(wanted))
        synth.write_vcf_files(records, f"{root}/in/{run}")
        stream = gf.read_vcf_stream(spark, f"{root}/in")
        _run_to_end(stream, f"{root}/out", f"{root}/checkpoint")
    return _by_contig(spark.read.parquet(f"{root}/out"))


def stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _scratch(spark)
    folder = _written(spark, sf_dir, "gzip")
    stream = gf.read_vcf_stream(spark, folder, maxFilesPerTrigger=2)
    _run_to_end(stream, f"{root}/out", f"{root}/checkpoint")

    def summary(df: DataFrame, name: str) -> DataFrame:
        rows = F.hash(
            "contig", "start", "names", "qual", F.to_json("info"),
            F.to_json(F.struct("genotypes")), "file_path",
        )
        return df.groupBy("contig").agg(
            F.count("*").alias(f"n_{name}"), F.sum(rows).alias(f"sum_{name}")
        )

    streamed = summary(spark.read.parquet(f"{root}/out"), "stream")
    batch = summary(gf.read_vcf(spark, folder), "batch")
    both = streamed.join(batch, "contig", "full")
    same = F.col("sum_stream").eqNullSafe(F.col("sum_batch"))
    return both.select("contig", "n_stream", "n_batch", same.alias("same"))


def foreach_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _scratch(spark)

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    writer = gf.foreach_vcf_batch(spark, _written(spark, sf_dir), append)
    query = (
        writer.option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _by_contig(spark.read.parquet(f"{root}/out"))


def _mounted(spark: SparkSession, folder: str) -> str:
    """The folder under a scheme that Hadoop's client knows and Python workers do not."""
    name = f"mount{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    located = hadoop.Path(folder)
    qualified = located.getFileSystem(conf).makeQualified(located).toString()
    conf.set(f"fs.viewfs.mounttable.{name}.link./data", qualified)
    return f"viewfs://{name}/data"


def stream_native_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over storage that only the JVM opens; its second run sees new files."""
    root = _scratch(spark)
    lineitem = _lineitem(spark, sf_dir)
    mounted = None
    for run, wanted in enumerate((F.col("l_returnflag") == "N", F.col("l_returnflag") != "N")):
        synth.write_vcf_files(synth.record_lines_of(lineitem.where(wanted)), f"{root}/data/in/{run}")
        mounted = mounted or _mounted(spark, f"{root}/data")
        stream = gf.read_vcf_stream(
            spark, f"{mounted}/in", relay=f"{mounted}/relay", maxFilesPerTrigger=3,
            includeSampleIds="S1,S3",
        )
        _run_to_end(stream, f"{root}/out", f"{root}/checkpoint")
    return gf.explode_genotypes(spark.read.parquet(f"{root}/out")).select(
        "contig", "start", F.col("genotype.sampleId").alias("sample_id"),
        _joined("genotype.calls").alias("calls"),
    )


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts over two runs with one checkpoint, in the state of the query."""
    root = _scratch(spark)
    lineitem = _lineitem(spark, sf_dir)
    for run, wanted in enumerate((F.col("l_returnflag") == "N", F.col("l_returnflag") != "N")):
        synth.write_vcf_files(synth.record_lines_of(lineitem.where(wanted)), f"{root}/in/{run}")
        stream = gf.read_vcf_stream(spark, f"{root}/in", maxFilesPerTrigger=2)
        writer = gf.count_stream(stream, f"{root}/counts", ("contig",))
        query = writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
    return gf.latest_counts(spark, f"{root}/counts", stream.select("contig").schema)


def stream_commit_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that run twice, and a second query that lost its checkpoint, add no rows."""
    root = _scratch(spark)
    folder = _written(spark, sf_dir)

    def twice(batch: DataFrame, batch_id: int) -> None:
        gf.commit_batch(batch, batch_id, f"{root}/out")
        gf.commit_batch(batch, batch_id, f"{root}/out")

    writers = {
        "twice": gf.foreach_vcf_batch(spark, folder, twice, maxFilesPerTrigger=3),
        "lost": gf.write_vcf_once(spark, folder, f"{root}/out", maxFilesPerTrigger=3),
    }
    for name, writer in writers.items():
        writer = writer.option("checkpointLocation", f"{root}/checkpoint-{name}")
        writer.trigger(availableNow=True).start().awaitTermination()
    return _by_contig(gf.read_committed(spark, f"{root}/out", gf.vcf_schema()))


def flatten_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = gf.declared_info_types(gf.vcf_header(_lines(spark, sf_dir)))
    flat = gf.flatten_info(_variants(spark, sf_dir), types)
    return flat.select(
        "contig",
        "start",
        F.col("INFO_DP").alias("info_dp"),
        F.col("INFO_GENE").alias("info_gene"),
        F.col("INFO_DB").alias("info_db"),
        F.get("INFO_AF", 0).alias("info_af_first"),
    )


def split_multiallelic(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = gf.split_multiallelic(_variants(spark, sf_dir))
    return gf.explode_genotypes(split).select(
        "contig",
        "start",
        F.col("altIndex").alias("alt_index"),
        _joined("alternateAlleles").alias("alt"),
        F.col("genotype.sampleId").alias("sample_id"),
        _joined("genotype.calls").alias("calls"),
    )


def split_per_allele(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values per allele, as the header declares them, follow their allele."""
    numbers = gf.per_allele_numbers(gf.vcf_header(_lines(spark, sf_dir)))
    split = gf.split_multiallelic(_variants(spark, sf_dir), info_numbers=numbers)
    return split.where("altIndex IS NOT NULL").select(
        "contig", "start", F.col("altIndex").alias("alt_index"),
        gf.info_field("AF", "double").alias("frequency"),
        gf.info_field("DP", "bigint").alias("depth"),
    )


def _genotype_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = synth.genotype_lines_of(_lineitem(spark, sf_dir))
    return gf.parse_vcf_lines(lines, headers=_headers(spark, sf_dir))


def split_per_genotype(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values per genotype follow the pairs of their allele and the reference."""
    split = gf.split_multiallelic(_genotype_variants(spark, sf_dir), format_numbers={"PL": "G"})
    likelihoods = gf.variant_field(F.get("genotypes", 0)["data"], "PL", "array<bigint>")
    return split.select(
        "contig", "start", F.col("altIndex").alias("alt_index"), _joined(likelihoods).alias("pl")
    )


def trimmed_alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    trimmed = gf.trim_alleles(gf.split_multiallelic(_genotype_variants(spark, sf_dir)))
    return trimmed.select(
        "contig", "start", F.col("end").alias("end_pos"), F.col("referenceAllele").alias("ref"),
        _joined("alternateAlleles").alias("alt"), F.col("altIndex").alias("alt_index"),
    )


def discovered_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types out of the values; no header declares any of the keys."""
    # Parsed once: finding the types and flattening both read all of INFO.
    variants = stored(_genotype_variants(spark, sf_dir).select("info"), "variants")
    types = gf.discovered_info_types(variants)
    flat = gf.flatten_info(variants, types)
    lists = F.coalesce(F.array_join("INFO_LIST", "|"), F.lit("none"))
    return flat.groupBy("INFO_DP", "INFO_MIX", "INFO_FLAG", lists.alias("info_list")).agg(
        F.count("*").alias("n")
    ).select(
        F.col("INFO_DP").alias("info_dp"), F.col("INFO_MIX").alias("info_mix"),
        F.col("INFO_FLAG").alias("info_flag"), "info_list", "n",
        F.lit(" ".join(f"{key}:{kind}" for key, kind in sorted(types.items()))).alias("types"),
    )


def save_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of most rows beside small ones, saved as files that are alike.

    A gzip file cannot be split, so none holds more than a partition of the table.
    """
    table, root = f"variants_{uuid.uuid4().hex}", _scratch(spark)
    lineitem = _lineitem(spark, sf_dir)
    for flag in "ANR":
        records = synth.record_lines_of(lineitem.where(F.col("l_returnflag") == flag))
        synth.write_vcf_files(records, f"{root}/in/{flag}", "gzip")
    variants = gf.read_vcf(spark, f"{root}/in").select("contig", "start", "qual", "file_name")
    gf.save_variants(variants, table, mode="overwrite", path=f"{root}/table", balanced=True)
    per_file = gf.read_variants(spark, table).groupBy("_metadata.file_path").agg(
        F.count("*").alias("rows"), F.sum("start").alias("sum_start")
    )
    saved = per_file.agg(
        F.sum("rows").alias("n"), F.sum("sum_start").alias("sum_start"),
        (F.max("rows") <= 2 * F.median("rows")).alias("even"),
    )
    return _dropped(spark, saved, table)


def header_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = gf.vcf_header(_lines(spark, sf_dir))
    return gf.join_header(_variants(spark, sf_dir), header).select(
        "file_path", "section", "id", "variants"
    )


# Options of the reader that take each way to a file's header.
HEADER_WAYS = {
    "heads": {}, "scan": {"scan_headers": True}, "salted": {"max_broadcast_bytes": 0},
}
# Broadcast regions and shuffled bins with the hot ones split, each by both tests.
REGION_WAYS = {
    "within": {}, "overlap": {"overlap": True},
    "within_shuffled": {"max_broadcast_bytes": 0, "hot_variants": 1000},
    "overlap_shuffled": {"overlap": True, "max_broadcast_bytes": 0, "hot_variants": 1000},
}
QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    scan_count, discover_dir_count, missing_path_empty, gzip_scan, scanned_headers,
    looked_up_headers, salted_headers, header_samples, header_metadata, header_heads,
    malformed_dropped, rejected_lines, core_fields, names_alts_filters, qual_nulls, info_scalars, info_lists,
    info_flags, info_strings, info_duplicate_keys, genotype_calls, genotype_data,
    genotype_missing, sample_include, sample_exclude, sample_both, file_metadata,
    file_metadata_off, variant_id, region_filter, quality_filter, variants_per_file,
    explode_genotypes, genotype_details, global_count, first_variants, save_and_read_table,
    stream_append, stream_equals_batch, foreach_batch, flatten_info, split_multiallelic,
    header_join, save_fails_if_exists, save_in_partitions, padded_lines, headless_files,
    single_file_any_codec, odd_info, repeated_format_keys, file_paths, wide_cohort,
    genotype_rows, stream_values, split_per_allele, regions_join, region_from_table,
    stream_native_headers, stream_counts, stream_commit_once, reject_reasons, header_attributes,
    split_per_genotype, trimmed_alleles, discovered_info, save_balanced,
)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: variants per file."""
    return variants_per_file(spark, FLAGSHIP_DIR)


def _llm_queries():
    """The module with the training-data queries, None where it is not there."""
    try:
        from genoframe.llm import queries as llm_queries
    except ImportError:
        return None
    return llm_queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query by name."""
    found = {query.__name__: query for query in QUERIES}
    llm_queries = _llm_queries()
    return found | llm_queries.queries() if llm_queries else found


# One row per well formed record.
_VARIANTS = """
variants AS (
  SELECT 'chr' || l_linenumber AS contig,
         l_orderkey AS "start",
         l_orderkey + 1 + l_linenumber % 3 AS end_pos,
         repeat('A', 1 + l_linenumber % 3) AS ref,
         l_returnflag || '.vcf' AS file_name,
         '/synthetic/' || l_returnflag || '.vcf' AS file_path,
         CASE WHEN l_quantity >= 5 THEN l_extendedprice END AS qual,
         CASE WHEN l_partkey % 7 = 0 THEN 1 ELSE 0 END + CAST(l_quantity AS BIGINT) AS depth,
         CAST(l_quantity AS BIGINT) AS sample_depth,
         lineitem.*
  FROM lineitem WHERE l_linenumber <> 7
)"""

# One row per record and sample.
_GENOTYPES = f"""{_VARIANTS},
genotypes AS (
  SELECT contig, "start", l_suppkey, 'S1' AS sample_id, '0|1' AS calls,
         sample_depth AS depth, '[' || l_linenumber || ',' || l_partkey || ']' AS ad_text
  FROM variants
  UNION ALL
  SELECT contig, "start", l_suppkey, 'S2',
         CASE WHEN l_suppkey % 2 = 0 THEN '0|0' ELSE '-1|-1' END, NULL, NULL
  FROM variants
  UNION ALL
  SELECT contig, "start", l_suppkey, 'S3',
         CASE WHEN l_partkey % 4 <> 0 THEN '1|2' END,
         CASE WHEN l_partkey % 4 <> 0 THEN CAST(l_linenumber AS BIGINT) END,
         CASE WHEN l_partkey % 4 <> 0 THEN '10,.' END
  FROM variants
)"""

_BY_CONTIG = f"""WITH {_VARIANTS}
SELECT contig, count(*) AS n, CAST(sum("start") AS BIGINT) AS sum_start
FROM variants GROUP BY contig"""

_SAMPLE_COUNTS = f"""WITH {_GENOTYPES}
SELECT contig, sample_id, count(*) AS n FROM genotypes {{where}} GROUP BY contig, sample_id"""


def _sql_list(values: tuple[str, ...] | list[str]) -> str:
    return "[" + ", ".join("'" + value.replace("'", "''") + "'" for value in values) + "]"


def oracle_sql() -> dict[str, str]:
    """The same results in SQL."""
    llm_queries = _llm_queries()
    return _lineitem_sql() | (llm_queries.oracle_sql() if llm_queries else {})


def _lineitem_sql() -> dict[str, str]:
    """The same results from the ``lineitem`` columns, in SQL."""
    header = f"""header AS (
  SELECT DISTINCT '/synthetic/' || l_returnflag || '.vcf' AS file_path,
         unnest({_sql_list(synth.META_LINES)}) AS line
  FROM lineitem
),
declared AS (
  SELECT file_path, line, regexp_extract(line, '^##([^=]*)', 1) AS section,
         nullif(regexp_extract(line, '[<,]ID=([^,>]*)', 1), '') AS id,
         nullif(regexp_extract(line, '[<,]Number=([^,>]*)', 1), '') AS number,
         nullif(regexp_extract(line, '[<,]Type=([^,>]*)', 1), '') AS type
  FROM header
)"""
    return {
        "scan_count": f"""WITH {_VARIANTS}
            SELECT count(*) AS n, CAST(sum("start") AS BIGINT) AS sum_start FROM variants""",
        "discover_dir_count": f"""WITH {_VARIANTS}
            SELECT false AS packed, count(*) AS n FROM variants
            UNION ALL SELECT true, count(*) FROM variants""",
        "missing_path_empty": _BY_CONTIG,
        "gzip_scan": _BY_CONTIG,
        "scanned_headers": _BY_CONTIG,
        "looked_up_headers": _BY_CONTIG,
        "salted_headers": _BY_CONTIG,
        "header_samples": f"""SELECT DISTINCT '/synthetic/' || l_returnflag || '.vcf' AS file_path,
            unnest([0, 1, 2]) AS position, unnest({_sql_list(synth.SAMPLES)}) AS sample_id
            FROM lineitem""",
        "header_metadata": f"WITH {header} SELECT * FROM declared",
        "header_attributes": r"""WITH files AS (
              SELECT l_returnflag AS flag, CAST(count(*) AS VARCHAR) AS n FROM lineitem GROUP BY l_returnflag
            ),
            pairs AS (
              SELECT *, unnest(['ID', 'Number', 'Type', 'Description', 'Source', 'Version']) AS key,
                     unnest(['Q_' || flag, 'A', 'Float',
                       n || ' rows, Number=3,Type=x of <' || flag || '> are "good"', 'a\', n]) AS value
              FROM files
            )
            SELECT '/synthetic/' || flag || '.vcf' AS file_path, 'Q_' || flag AS id, 'A' AS number,
                   'Float' AS type, key, value FROM pairs""",
        "header_heads": f"""WITH {header}
            SELECT DISTINCT line, section, id, number, type FROM declared""",
        "malformed_dropped": f"""WITH {_VARIANTS}
            SELECT file_name, contig, count(*) AS n_valid FROM variants
            GROUP BY file_name, contig""",
        "rejected_lines": """SELECT l_returnflag || '.vcf' AS file_name,
            'chr' || l_linenumber || chr(9) || (l_orderkey + 1) AS value
            FROM lineitem WHERE l_linenumber = 7""",
        "reject_reasons": """WITH judged AS (
              SELECT CASE WHEN l_linenumber = 7 THEN 'few_fields'
                          WHEN l_partkey % 11 = 3 THEN 'position'
                          WHEN l_suppkey % 9 = 4 THEN 'quality' ELSE 'records' END AS reason
              FROM lineitem
            )
            SELECT 'observed' AS way, reason, count(*) AS n FROM judged GROUP BY reason
            UNION ALL
            SELECT 'lines', reason, count(*) FROM judged WHERE reason <> 'records' GROUP BY reason""",
        "core_fields": f"""WITH {_VARIANTS}
            SELECT contig, "start", end_pos, ref FROM variants""",
        "names_alts_filters": f"""WITH {_VARIANTS}
            SELECT contig, "start",
            CASE l_partkey % 5 WHEN 0 THEN '' WHEN 1
              THEN 'rs' || l_partkey || '|alt' || l_partkey ELSE 'rs' || l_partkey END AS names,
            CASE l_partkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS n_names,
            CASE l_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'T' ELSE 'C|G' END AS alts,
            l_suppkey % 3 AS n_alts,
            CASE l_orderkey % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'LowQual|q10' ELSE '' END
              AS filters,
            CASE l_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS n_filters
            FROM variants""",
        "qual_nulls": f'WITH {_VARIANTS} SELECT contig, "start", qual FROM variants',
        "info_scalars": f'WITH {_VARIANTS} SELECT contig, "start", depth FROM variants',
        "info_lists": f"""WITH {_VARIANTS}
            SELECT contig, "start", l_discount AS af_first, l_tax AS af_second, 2 AS n_af
            FROM variants""",
        "info_flags": f"""WITH {_VARIANTS}
            SELECT contig, "start", CASE WHEN l_linestatus = 'O' THEN true END AS known
            FROM variants""",
        "info_strings": f"""WITH {_VARIANTS}
            SELECT contig, "start", 'G' || l_suppkey AS gene FROM variants""",
        "info_duplicate_keys": f"""WITH {_VARIANTS}
            SELECT depth, count(*) AS n FROM variants GROUP BY depth""",
        "genotype_calls": f"""WITH {_GENOTYPES}
            SELECT contig, "start", sample_id, calls FROM genotypes""",
        "genotype_data": f"""WITH {_GENOTYPES}
            SELECT contig, "start", sample_id, depth, ad_text FROM genotypes""",
        "genotype_missing": f"""WITH {_GENOTYPES}
            SELECT sample_id, count(*) AS n, count(*) FILTER (calls IS NULL) AS n_no_calls,
            count(*) FILTER (depth IS NULL AND ad_text IS NULL) AS n_no_data
            FROM genotypes GROUP BY sample_id""",
        "sample_include": _SAMPLE_COUNTS.format(where="WHERE sample_id IN ('S1', 'S3')"),
        "sample_exclude": _SAMPLE_COUNTS.format(where="WHERE sample_id <> 'S2'"),
        "sample_both": f"""WITH {_VARIANTS}
            SELECT contig, count(*) AS n, CAST(0 AS BIGINT) AS n_with_genotypes
            FROM variants GROUP BY contig""",
        "file_metadata": f"""WITH {_VARIANTS}
            SELECT file_path, file_name, count(*) AS n FROM variants
            GROUP BY file_path, file_name""",
        "file_metadata_off": f"""WITH {_VARIANTS}
            SELECT contig, "start", '' AS file_path, '' AS file_name,
            sha256('||' || contig || '|' || "start" || '|' || end_pos) AS variant_id
            FROM variants""",
        "variant_id": f"""WITH {_VARIANTS}
            SELECT contig, "start", file_name,
            sha256(file_path || '|' || file_name || '|' || contig || '|' || "start" || '|'
              || end_pos) AS variant_id
            FROM variants""",
        "region_filter": f"""WITH {_VARIANTS}
            SELECT contig, "start", end_pos FROM variants
            WHERE contig = 'chr3' AND "start" >= 100 AND end_pos <= 5000""",
        "regions_join": f"""WITH {_VARIANTS},
            regions AS (
              SELECT 'chr' || (1 + o_custkey % 7) AS chrom, o_orderkey AS a,
                     o_orderkey + CASE o_orderkey % 50 WHEN 0 THEN 3000 ELSE 4 END AS b
              FROM orders
            ),
            pairs AS (
              SELECT contig, a, "start", 'within' AS way FROM variants JOIN regions
                ON contig = chrom AND "start" >= a AND end_pos <= b
              UNION ALL
              SELECT contig, a, "start", 'overlap' FROM variants JOIN regions
                ON contig = chrom AND "start" < b AND end_pos > a
            )
            SELECT contig, a AS region_start, count(*) AS n, CAST(sum("start") AS BIGINT) AS sum_start,
                   way || suffix AS way
            FROM pairs, (SELECT unnest(['', '_shuffled']) AS suffix) GROUP BY contig, a, way, suffix""",
        "region_from_table": f"""WITH {_VARIANTS}
            SELECT contig, "start", end_pos, qual,
                   (SELECT CAST(count(*) AS BIGINT) FROM variants) AS n_saved FROM variants
            WHERE contig = 'chr3' AND "start" >= 100 AND end_pos <= 5000""",
        "quality_filter": f"""WITH {_VARIANTS}
            SELECT contig, "start", qual FROM variants WHERE qual > 50000""",
        "variants_per_file": f"""WITH {_VARIANTS}
            SELECT file_name, count(*) AS "count" FROM variants GROUP BY file_name""",
        "explode_genotypes": _SAMPLE_COUNTS.format(where=""),
        "genotype_details": f"""WITH {_GENOTYPES}
            SELECT contig, "start", sample_id, calls, depth AS read_depth FROM genotypes""",
        "global_count": f"WITH {_VARIANTS} SELECT count(*) AS n FROM variants",
        "first_variants": f"""WITH {_VARIANTS}
            SELECT file_path, contig, "start", end_pos FROM variants
            ORDER BY file_path, contig, "start", end_pos LIMIT 20""",
        "save_and_read_table": f"""WITH {_VARIANTS}
            SELECT contig, "start", qual, depth, 3 AS n_genotypes FROM variants""",
        "stream_append": _BY_CONTIG,
        "stream_equals_batch": f"""WITH {_VARIANTS}
            SELECT contig, count(*) AS n_stream, count(*) AS n_batch, true AS same
            FROM variants GROUP BY contig""",
        "foreach_batch": _BY_CONTIG,
        "stream_native_headers": f"""WITH {_GENOTYPES}
            SELECT contig, "start", sample_id, calls FROM genotypes WHERE sample_id <> 'S2'""",
        "stream_counts": f"""WITH {_VARIANTS}
            SELECT contig, count(*) AS "count" FROM variants GROUP BY contig""",
        "stream_commit_once": _BY_CONTIG,
        "flatten_info": f"""WITH {_VARIANTS}
            SELECT contig, "start", depth AS info_dp, 'G' || l_suppkey AS info_gene,
            CASE WHEN l_linestatus = 'O' THEN true END AS info_db, l_discount AS info_af_first
            FROM variants""",
        "split_multiallelic": f"""WITH {_GENOTYPES},
            alleles AS (
              SELECT *, unnest(CASE l_suppkey % 3 WHEN 0 THEN [NULL] WHEN 1 THEN [1]
                               ELSE [1, 2] END) AS alt_index
              FROM genotypes
            )
            SELECT contig, "start", alt_index, sample_id,
            CASE WHEN alt_index IS NULL THEN '' WHEN l_suppkey % 3 = 1 THEN 'T'
                 WHEN alt_index = 1 THEN 'C' ELSE 'G' END AS alt,
            CASE WHEN alt_index IS NULL THEN calls
                 WHEN calls = '0|1' THEN CASE alt_index WHEN 1 THEN '0|1' ELSE '0|0' END
                 WHEN calls = '1|2' THEN CASE alt_index WHEN 1 THEN '1|0' ELSE '0|1' END
                 ELSE calls END AS calls
            FROM alleles""",
        "split_per_genotype": """WITH alleles AS (
              SELECT *, unnest(CASE l_suppkey % 3 WHEN 2 THEN [1, 2] ELSE [1] END) AS alt_index FROM lineitem
            ),
            places AS (SELECT *, CAST(alt_index * (alt_index + 1) // 2 AS BIGINT) AS p FROM alleles)
            SELECT 'chr' || l_linenumber AS contig, l_orderkey AS "start", alt_index,
                   l_linenumber || '|' || (10 * p + l_linenumber) || '|'
                     || (10 * (p + alt_index) + l_linenumber) AS pl FROM places""",
        "trimmed_alleles": """WITH alleles AS (
              SELECT *, 1 + l_linenumber % 3 AS k,
                     unnest(CASE l_suppkey % 3 WHEN 2 THEN [1, 2] ELSE [1] END) AS alt_index FROM lineitem
            ),
            cases AS (
              SELECT *, CASE WHEN l_suppkey % 3 = 1 THEN 'swap'
                             WHEN l_suppkey % 3 = 2 AND alt_index = 1 THEN 'whole' ELSE 'gap' END AS kind
              FROM alleles
            )
            SELECT 'chr' || l_linenumber AS contig, alt_index,
                   l_orderkey + CASE kind WHEN 'swap' THEN k ELSE 0 END AS "start",
                   l_orderkey + CASE kind WHEN 'swap' THEN k + 1 WHEN 'whole' THEN k + 2 ELSE k END AS end_pos,
                   CASE kind WHEN 'swap' THEN 'C' WHEN 'whole' THEN repeat('A', k) || 'CG'
                        ELSE repeat('A', k) END AS ref,
                   CASE kind WHEN 'swap' THEN 'T' ELSE 'A' END AS alt
            FROM cases""",
        "discovered_info": """SELECT CAST(l_quantity AS BIGINT) AS info_dp,
            CASE WHEN l_partkey % 2 = 0 THEN 'x' ELSE '1' END AS info_mix, true AS info_flag,
            CASE WHEN l_partkey % 3 = 0 THEN '1.5|2.0' ELSE '7.0' END AS info_list, count(*) AS n,
            'DP:bigint FLAG:boolean LIST:array<double> MIX:string' AS types
            FROM lineitem GROUP BY ALL""",
        "save_balanced": f"""WITH {_VARIANTS}
            SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum("start") AS BIGINT) AS sum_start, true AS even
            FROM variants""",
        "header_join": f"""WITH {_VARIANTS}, {header},
            counts AS (SELECT file_path, count(*) AS variants FROM variants GROUP BY file_path)
            SELECT file_path, section, id, variants FROM declared LEFT JOIN counts
            USING (file_path)""",
            "save_fails_if_exists": f"""WITH {_VARIANTS}
            SELECT count(*) AS n, true AS failed FROM variants""",
        "save_in_partitions": f"""WITH {_VARIANTS}
            SELECT count(*) AS n, CAST(4 AS BIGINT) AS n_files FROM variants""",
        "padded_lines": f"""WITH {_VARIANTS}
            SELECT contig, "start", end_pos, ref FROM variants""",
        "headless_files": _BY_CONTIG,
        "single_file_any_codec": f"""WITH {_VARIANTS}
            SELECT codec, way, count(*) AS n, CAST(sum("start") AS BIGINT) AS sum_start
            FROM variants, (SELECT unnest(['none', 'gzip', 'bzip2']) AS codec),
                 (SELECT unnest({_sql_list(list(HEADER_WAYS))}) AS way)
            GROUP BY codec, way""",
        "odd_info": """SELECT 'chr' || l_linenumber AS contig, l_orderkey AS "start",
            l_partkey % 4 = 0 AS is_empty,
            CASE l_partkey % 4 WHEN 1 THEN 'a' WHEN 2 THEN '1' END AS first_tag,
            CASE l_partkey % 4 WHEN 1 THEN 'b' || l_suppkey WHEN 2 THEN 'x' END AS second_tag
            FROM lineitem""",
        "repeated_format_keys": """SELECT 'chr' || l_linenumber AS contig, l_orderkey AS "start",
            CASE WHEN l_suppkey % 2 = 0 THEN '0|1' ELSE '1|1' END AS calls,
            CASE WHEN l_partkey % 2 = 0 THEN CAST(l_linenumber AS BIGINT)
                 ELSE CAST(l_quantity AS BIGINT) END AS depth,
            1 AS n_genotypes FROM lineitem""",
        "file_paths": f"""WITH {_VARIANTS}
            SELECT l_returnflag AS flag, count(*) AS n, true AS same
            FROM variants GROUP BY l_returnflag""",
        "wide_cohort": f"""WITH suppliers AS (
              SELECT l_suppkey, sum(CAST(l_quantity AS BIGINT)) AS q FROM lineitem
              GROUP BY l_suppkey
            )
            SELECT l_suppkey - 1 AS "start", CAST({synth.WIDE_SAMPLES} AS BIGINT) AS n_samples,
            CAST({synth.WIDE_SAMPLES} * q + {sum(range(synth.WIDE_SAMPLES))} AS BIGINT) AS sum_depth,
            '{synth.wide_samples()[-1]}' AS deepest, way
            FROM suppliers,
            (SELECT unnest({_sql_list([*HEADER_WAYS, "stream", "rows"])}) AS way)""",
        "genotype_rows": f"""WITH {_GENOTYPES}
            SELECT contig, "start", sample_id, depth, ad_text FROM genotypes""",
        "stream_values": f"""WITH {_GENOTYPES}
            SELECT contig, "start", sample_id, calls, 'G' || l_suppkey AS gene FROM genotypes""",
            "split_per_allele": f"""WITH {_VARIANTS}, alleles AS (
              SELECT *, unnest(CASE l_suppkey % 3 WHEN 1 THEN [1] WHEN 2 THEN [1, 2] ELSE [] END)
                AS alt_index FROM variants
            )
            SELECT contig, "start", alt_index,
            CASE alt_index WHEN 1 THEN l_discount ELSE l_tax END AS frequency, depth
            FROM alleles""",
    }
