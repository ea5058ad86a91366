"""VCF lines derived from the ``lineitem`` table, and VCF files of such lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.functions.text import literal

SAMPLES = ("S1", "S2", "S3")
# Lines and columns as the file format has them.
META_LINES = (
    "##fileformat=VCFv4.2",
    '##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth">',
    '##INFO=<ID=AF,Number=A,Type=Float,Description="Frequencies">',
    '##INFO=<ID=GENE,Number=1,Type=String,Description="Gene">',
    '##INFO=<ID=DB,Number=0,Type=Flag,Description="Known">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
)
CHROM_COLUMNS = ("#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT")
CHROM_LINE = "\t".join((*CHROM_COLUMNS, *SAMPLES))
# Neither character occurs in these lines; they switch the writer's quoting off.
UNUSED_SEPARATOR, UNUSED_MARK = "\x01", "\x02"


# One expression per VCF column of a lineitem row; each covers the missing, the
# plain and the listed form of its column.
RECORD_FIELDS = (
    "concat('chr', l_linenumber)",
    "cast(l_orderkey + 1 AS string)",
    """CASE l_partkey % 5 WHEN 0 THEN '.'
         WHEN 1 THEN concat('rs', l_partkey, ';alt', l_partkey)
         ELSE concat('rs', l_partkey) END""",
    "repeat('A', 1 + l_linenumber % 3)",
    "CASE l_suppkey % 3 WHEN 0 THEN '.' WHEN 1 THEN 'T' ELSE 'C,G' END",
    "CASE WHEN l_quantity < 5 THEN '.' ELSE cast(l_extendedprice AS string) END",
    "CASE l_orderkey % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'LowQual;q10' ELSE '.' END",
    """concat('DP=', bigint(l_quantity), ';AF=', l_discount, ',', l_tax, ';GENE=G', l_suppkey,
         CASE WHEN l_linestatus = 'O' THEN ';DB' ELSE '' END,
         CASE WHEN l_partkey % 7 = 0 THEN concat(';DP=', bigint(l_quantity) + 1) ELSE '' END)""",
    "'GT:DP:AD'",
    "concat('0/1:', bigint(l_quantity), ':', l_linenumber, ',', l_partkey)",
    "CASE WHEN l_suppkey % 2 = 0 THEN '0|0' ELSE './.:.:.' END",
    "CASE WHEN l_partkey % 4 = 0 THEN '.' ELSE concat('1/2:', l_linenumber, ':10,.') END",
)
FILE_COLUMNS = (
    "concat('/synthetic/', l_returnflag, '.vcf') AS file_path",
    "concat(l_returnflag, '.vcf') AS file_name",
)


def record_text() -> str:
    """SQL of the data line of a lineitem row; line number 7 is malformed on purpose."""

    def line(parts: tuple[str, ...]) -> str:
        return f"concat_ws('\\t', {', '.join(parts)})"

    whole, short = line(RECORD_FIELDS), line(RECORD_FIELDS[:2])
    return f"CASE WHEN l_linenumber = 7 THEN {short} ELSE {whole} END"


def record_lines_of(lineitem: DataFrame) -> DataFrame:
    """Data lines, one file per return flag."""
    return lineitem.selectExpr(f"{record_text()} AS value", *FILE_COLUMNS)


def header_lines_of(lineitem: DataFrame) -> DataFrame:
    """Header lines of every such file."""
    lines = ", ".join(literal(line) for line in (*META_LINES, CHROM_LINE))
    files = lineitem.select("l_returnflag").distinct()
    return files.selectExpr(f"explode(array({lines})) AS value", *FILE_COLUMNS)


def described_header_lines_of(lineitem: DataFrame) -> DataFrame:
    """Declarations whose quoted texts hold numbers of the table and all special characters."""
    per_file = lineitem.groupBy("l_returnflag").agg(F.count("*").alias("n"))
    line = """concat('##INFO=<ID=Q_', l_returnflag, ',Number=A,Type=Float,Description="', n,
      ' rows, Number=3,Type=x of <', l_returnflag, '> are \\\\"good\\\\"",Source="a\\\\\\\\",Version=', n, '>') AS value"""
    return per_file.selectExpr(line, *FILE_COLUMNS)


def lines_of(lineitem: DataFrame) -> DataFrame:
    """Header and data lines together."""
    return header_lines_of(lineitem).unionByName(record_lines_of(lineitem))


# Other spellings of INFO and of repeated FORMAT keys.
ODD_FIELDS = (
    *RECORD_FIELDS[:7],
    """CASE l_partkey % 4 WHEN 0 THEN '.' WHEN 1 THEN concat('TAGS=a,b', l_suppkey)
         WHEN 2 THEN 'TAGS=1,x' ELSE concat('N=', l_suppkey) END""",
    "'GT:DP:GT:DP'",
    """concat('0/1:', l_linenumber, ':', CASE WHEN l_suppkey % 2 = 0 THEN '.' ELSE '1|1' END, ':',
         CASE WHEN l_partkey % 2 = 0 THEN '.' ELSE string(bigint(l_quantity)) END)""",
)


def odd_lines_of(lineitem: DataFrame) -> DataFrame:
    """Data lines of one sample with ``ODD_FIELDS``, all well formed."""
    return lineitem.selectExpr(f"concat_ws('\\t', {', '.join(ODD_FIELDS)}) AS value", *FILE_COLUMNS)


# Alleles with shared ends, and a value for each genotype.
ALLELES = (
    "concat(repeat('A', 1 + l_linenumber % 3), 'CG')",
    """CASE l_suppkey % 3 WHEN 0 THEN 'ACG' WHEN 1 THEN concat(repeat('A', 1 + l_linenumber % 3), 'TG')
         ELSE 'A,ACG' END""",
)
GENOTYPE_FIELDS = (
    *RECORD_FIELDS[:3], *ALLELES, "'.'", "'.'",
    """concat('DP=', bigint(l_quantity), ';MIX=', CASE WHEN l_partkey % 2 = 0 THEN 'x' ELSE '1' END,
         ';LIST=', CASE WHEN l_partkey % 3 = 0 THEN '1.5,2' ELSE '7' END, ';FLAG')""",
    "'GT:PL'",
    """concat('0/1:', array_join(transform(sequence(0, CASE l_suppkey % 3 WHEN 2 THEN 5 ELSE 2 END),
         i -> string(10 * i + l_linenumber)), ','))""",
)


def genotype_lines_of(lineitem: DataFrame) -> DataFrame:
    """Data lines of one sample with ``GENOTYPE_FIELDS``, all well formed."""
    return lineitem.selectExpr(f"concat_ws('\\t', {', '.join(GENOTYPE_FIELDS)}) AS value", *FILE_COLUMNS)


# Positions and qualities, some of them no numbers.
FLAWED_FIELDS = (
    RECORD_FIELDS[0],
    "CASE l_partkey % 11 WHEN 3 THEN concat(l_orderkey, 'x') ELSE string(l_orderkey + 1) END",
    *RECORD_FIELDS[2:5],
    "CASE l_suppkey % 9 WHEN 4 THEN 'high' ELSE '.' END",
    "'PASS'", "'.'",
)


def flawed_lines_of(lineitem: DataFrame) -> DataFrame:
    """Data lines, some with too few fields, a bad position or a bad quality."""
    fields = [f"concat_ws('\\t', {', '.join(part)})" for part in (FLAWED_FIELDS[:2], FLAWED_FIELDS)]
    value = f"CASE WHEN l_linenumber = 7 THEN {fields[0]} ELSE {fields[1]} END AS value"
    return lineitem.selectExpr(value, *FILE_COLUMNS)


def padded_lines_of(lineitem: DataFrame) -> DataFrame:
    """Data lines with white space around them and a carriage return at the end."""
    padded = f"concat({literal(chr(0x3000) + ' ')}, {record_text()}, {literal(' ' + chr(13))}) AS value"
    return lineitem.selectExpr(padded, *FILE_COLUMNS)


WIDE_SAMPLES = 300


def wide_samples() -> list[str]:
    return [f"PATIENT-{i:05}" for i in range(WIDE_SAMPLES)]


def wide_lines_of(lineitem: DataFrame) -> DataFrame:
    """One data line per supplier with its quantity as the depth of many samples."""
    per_supplier = lineitem.groupBy("l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("q")
    )
    samples = f"array_join(transform(sequence(0, {WIDE_SAMPLES - 1}), i -> concat('0/1:', q + i)), '\\t')"
    return per_supplier.selectExpr(
        f"concat_ws('\\t', 'chr1', l_suppkey, '.', 'A', 'T', '.', '.', '.', 'GT:DP', {samples}) AS value"
    )


def chrom_line(samples: list[str] | tuple[str, ...]) -> str:
    return "\t".join((*CHROM_COLUMNS, *samples))


def write_vcf_files(
    records: DataFrame,
    folder: str,
    compression: str = "none",
    header: tuple[str, ...] | None = None,
) -> None:
    """Write data lines as VCF files, one per partition, each with the header on top.

    Rows keep their partition: the first row of each carries the header lines
    with it, so nothing is shuffled.
    """
    header = (*META_LINES, CHROM_LINE) if header is None else header
    in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    lines_above = [F.lit(line) for line in header]
    numbered = records.select("value", in_partition.alias("n"))
    lines = numbered.select(
        F.explode(
            F.when(F.col("n") == 0, F.array(*lines_above, "value")).otherwise(F.array("value"))
        ).alias("value")
    )
    (
        lines.write.format("csv")
        .option("extension", "vcf")
        .option("compression", compression)
        .option("sep", UNUSED_SEPARATOR)
        .option("quote", UNUSED_MARK)
        .option("escape", UNUSED_MARK)
        .option("comment", UNUSED_MARK)
        .option("escapeQuotes", "false")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .save(folder)
    )
