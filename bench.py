"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default /root/testdata/sf0.1) and ``BENCH_CPUS``
the number of local cores. VCF files are written from the whole lineitem table
once, untimed; every query then runs on those files: one untimed run to warm up the
JVM, then two timed ones, of which the faster counts.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import genoframe as gf
import synthetic_vcf as synth

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SMALL_FILES = 2000


def _session(home: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("genoframe-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.checkpoint.dir", f"{home}/checkpoint")
        .config("spark.sql.warehouse.dir", f"{home}/warehouse")
        .getOrCreate()
    )


def _consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _stream_to_end(spark: SparkSession, path: str, home: str) -> None:
    run = tempfile.mkdtemp(dir=home)
    stream = gf.read_vcf_stream(spark, path).select("contig", "start", "end", "info")
    (
        stream.writeStream.format("parquet")
        .option("path", f"{run}/out")
        .option("checkpointLocation", f"{run}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _queries(spark: SparkSession, home: str) -> dict[str, Callable]:
    plain, packed, wide, small = (f"{home}/{name}" for name in ("plain", "packed", "wide", "small"))

    def read(**options: object) -> DataFrame:
        return gf.read_vcf(spark, plain, **options)

    def genotypes(**options: object) -> DataFrame:
        return gf.explode_genotypes(read(**options))

    core = ["contig", "start", "end", "names", "alternateAlleles", "qual", "filters"]
    return {
        "count": lambda: read().count(),
        "variants_per_file": lambda: gf.variants_per_file(read()).collect(),
        "region_count": lambda: gf.in_region(read(), "chr3", 1000, 200000).count(),
        "core_fields": lambda: _consume(read().select(*core)),
        "variant_id": lambda: _consume(read(generatePrimaryKey=True).select("variant_id")),
        "info": lambda: _consume(read().select("info")),
        "info_depth_by_contig": lambda: read()
        .groupBy("contig").agg(F.avg(gf.info_field("DP", "bigint"))).collect(),
        "genotypes": lambda: _consume(read().select("genotypes")),
        "one_sample": lambda: _consume(read(includeSampleIds="S2").select("genotypes")),
        "explode_genotypes": lambda: _consume(gf.genotype_details(genotypes())),
        "full_parse": lambda: _consume(read()),
        "gzip_core_fields": lambda: _consume(gf.read_vcf(spark, packed).select(*core)),
        "stream_info": lambda: _stream_to_end(spark, plain, home),
        "read_genotypes": lambda: _consume(gf.genotype_details(gf.read_genotypes(spark, plain))),
        "read_genotypes_calls": lambda: _consume(
            gf.read_genotypes(spark, plain).select("contig", "start", "genotype.calls")
        ),
        "genotypes_scanned_headers": lambda: _consume(read(scan_headers=True).select("genotypes")),
        "genotypes_salted_headers": lambda: _consume(
            read(max_broadcast_bytes=0).select("genotypes")
        ),
        "wide_count": lambda: gf.read_vcf(spark, wide).count(),
        "wide_explode": lambda: _consume(
            gf.genotype_details(gf.explode_genotypes(gf.read_vcf(spark, wide)))
        ),
        "wide_rows": lambda: _consume(gf.genotype_details(gf.read_genotypes(spark, wide))),
        "wide_stream": lambda: _stream_to_end(spark, wide, home),
        "small_files_count": lambda: gf.read_vcf(spark, small).count(),
    }


def _timed(run: Callable) -> float:
    started = time.perf_counter()
    run()
    return time.perf_counter() - started


def main() -> None:
    home = tempfile.mkdtemp(prefix="genoframe-bench-")
    spark = _session(home)
    spark.sparkContext.setLogLevel("ERROR")
    records = synth.record_lines_of(spark.read.parquet(f"{SF_DIR}/lineitem.parquet"))
    spread = records.repartition(int(CPUS))
    synth.write_vcf_files(spread, f"{home}/plain")
    synth.write_vcf_files(spread, f"{home}/packed", "gzip")
    synth.write_vcf_files(records.repartition(SMALL_FILES), f"{home}/small")
    wide = synth.wide_lines_of(spark.read.parquet(f"{SF_DIR}/lineitem.parquet"))
    header = ("##fileformat=VCFv4.2", synth.chrom_line(synth.wide_samples()))
    synth.write_vcf_files(wide.repartition(int(CPUS)), f"{home}/wide", header=header)

    seconds = {}
    for name, run in _queries(spark, home).items():
        run()
        seconds[name] = round(min(_timed(run), _timed(run)), 3)
    print(
        json.dumps(
            {
                "metric": "genoframe headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
