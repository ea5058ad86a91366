from __future__ import annotations

import gzip
import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

COLUMNS = "#CHROM POS ID REF ALT QUAL FILTER INFO".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("genoframe-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .config("spark.checkpoint.dir", str(home / "checkpoint"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def vcf_text(records: list[str], samples: tuple[str, ...] = (), meta: tuple[str, ...] = ()) -> str:
    """VCF file content; records are written with spaces for tabs."""
    columns = COLUMNS + (["FORMAT", *samples] if samples else [])
    lines = ["##fileformat=VCFv4.2", *meta, "\t".join(columns)]
    return "\n".join(lines + ["\t".join(r.split(" ")) for r in records]) + "\n"


def write_vcf(path: Path, text: str) -> str:
    """Write a file, compressed if its name says so."""
    path.parent.mkdir(parents=True, exist_ok=True)
    data = text.encode("utf-8")
    path.write_bytes(gzip.compress(data) if path.suffix == ".gz" else data)
    return str(path)


@pytest.fixture
def cohort(tmp_path) -> str:
    """Three samples, three records."""
    records = [
        "chr1 11 rs1 A G 12.5 PASS DP=7;AF=0.25 GT:DP 0/1:3 1|1:4 ./.:.",
        "chr1 21 rs2;x2 ACG G,T . q10;s50 DP=9;DB GT:DP 1/2:5 0/0:. .",
        "chr2 31 . T . 99 . . GT:DP 0|0:1 0/1:2 1/1:3",
    ]
    return write_vcf(tmp_path / "cohort.vcf", vcf_text(records, ("NA1", "NA2", "NA3")))


@pytest.fixture
def in_folder(tmp_path):
    """Run with the working directory at ``tmp_path``."""
    before = os.getcwd()
    os.chdir(tmp_path)
    yield tmp_path
    os.chdir(before)
