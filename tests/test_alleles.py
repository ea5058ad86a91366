"""Values per genotype, trimmed alleles, types found in the data, even files."""

import random

from pyspark.sql import functions as F

from conftest import vcf_text, write_vcf
from genoframe import (
    discovered_info_types,
    flatten_info,
    per_allele_numbers,
    read_variants,
    read_vcf,
    read_vcf_header,
    save_variants,
    split_multiallelic,
    trim_alleles,
    variant_field,
)


def test_values_of_genotypes(spark, tmp_path):
    records = [
        "1 1 . A C,G,T . . GL=9,8 GT:PL 0/1:0,1,2,3,4,5,6,7,8,9",
        "1 2 . A C,G . . . GT:PL 0/1:10,11,12",
        "1 3 . A C . . . GT:PL 0/1:5,6,7",
        "1 4 . A C,G . . . GT:PL 0/1:1,2",
        "1 5 . A . . . . GT:PL 0/0:1,2",
    ]
    meta = ('##FORMAT=<ID=PL,Number=G,Type=Integer,Description="x">',)
    path = write_vcf(tmp_path / "a.vcf", vcf_text(records, ("S",), meta))
    numbers = per_allele_numbers(read_vcf_header(spark, path), "FORMAT")
    assert numbers == {"PL": "G"}
    split = split_multiallelic(read_vcf(spark, path), format_numbers=numbers)
    pl = variant_field(F.get("genotypes", 0)["data"], "PL", "array<int>")
    found = [(r[0] + 1, r[1], r[2]) for r in split.select("start", "altIndex", pl).collect()]
    assert sorted(found, key=str) == [
        (1, 1, [0, 1, 2]), (1, 2, [0, 3, 5]), (1, 3, [0, 6, 9]),
        # One copy: a value per allele. Lists of another length stay.
        (2, 1, [10, 11]), (2, 2, [10, 12]), (3, 1, [5, 6, 7]), (4, 1, [1, 2]), (4, 2, [1, 2]), (5, None, [1, 2]),
    ]


def plain_trim(start, ref, alt):
    while min(len(ref), len(alt)) > 1 and ref[-1] == alt[-1]:
        ref, alt = ref[:-1], alt[:-1]
    while min(len(ref), len(alt)) > 1 and ref[0] == alt[0]:
        start, ref, alt = start + 1, ref[1:], alt[1:]
    return start, start + len(ref), ref, alt


def test_trimmed_alleles(spark):
    pick = random.Random(2)
    pairs = [("".join(pick.choices("AC", k=pick.randint(1, 9))), "".join(pick.choices("AC", k=pick.randint(1, 9)))) for _ in range(400)]
    rows = [("1", 7, 7 + len(r), r, [a]) for r, a in pairs]
    schema = "contig string, start bigint, end bigint, referenceAllele string, alternateAlleles array<string>"
    df = spark.createDataFrame(rows, schema)
    found = [(r.start, r.end, r.referenceAllele, r.alternateAlleles[0]) for r in trim_alleles(df).collect()]
    assert sorted(found) == sorted(plain_trim(7, r, a) for r, a in pairs)
    odd = [("1", 7, 9, "AC", alts) for alts in ([], ["ATC", "AC"], ["<DEL>"], ["*"], None, ["AC[1:5["])]
    kept = spark.createDataFrame(odd, schema)
    assert trim_alleles(kept).exceptAll(kept).count() == 0 and trim_alleles(kept).columns == kept.columns


def test_discovered_types(spark, tmp_path):
    infos = ["I=1;D=0.5;T=a;F;L=1,2;M=1;N=x;E=1", "I=2;D=3;T=7;L=3;M=2.5;N=1,2;K.1=4", "E=1e400;D=.", "."]
    path = write_vcf(tmp_path / "a.vcf", vcf_text([f"1 {i} . A C . . {x}" for i, x in enumerate(infos, 1)]))
    df = read_vcf(spark, path)
    types = discovered_info_types(df)
    assert {k: types[k] for k in "ITFLMN"} == {
        "I": "bigint", "T": "string", "F": "boolean", "L": "array<bigint>", "M": "double", "N": "array<string>",
    }
    assert types["K.1"] == "bigint"
    flat = flatten_info(df, types).orderBy("start").collect()
    assert [r["INFO_I"] for r in flat] == [1, 2, None, None] and [r["INFO_M"] for r in flat][:2] == [1.0, 2.5]
    assert [r["INFO_L"] for r in flat] == [[1, 2], [3], None, None]
    header = read_vcf_header(spark, write_vcf(tmp_path / "h.vcf", vcf_text([], (), ('##INFO=<ID=I,Number=1,Type=Float,Description="d">', '##INFO=<ID=Z,Number=0,Type=Flag,Description="d">'))))
    both = discovered_info_types(df, header)
    assert both["I"] == "double" and both["Z"] == "boolean" and both["T"] == "string"
    assert discovered_info_types(df.where("false")) == {}


def test_balanced_files(spark, tmp_path):
    """One gzip file ten times the others: files come out alike."""
    for i, n in enumerate([4000, 400, 400, 400]):
        write_vcf(tmp_path / f"in/{i}.vcf.gz", vcf_text([f"{i} {k} . A C . . DP={k}" for k in range(1, n + 1)]))
    df = read_vcf(spark, str(tmp_path / "in"))
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "60k", "spark.sql.files.openCostInBytes": "1k"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        save_variants(df, "balanced_variants", mode="overwrite", path=str(tmp_path / "t"), balanced=True)
    finally:
        for name in settings:
            spark.conf.unset(name)
    files = read_variants(spark, "balanced_variants").groupBy("_metadata.file_path").count().collect()
    spark.sql("DROP TABLE balanced_variants")
    sizes = sorted(r["count"] for r in files)
    assert sum(sizes) == 5200 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
