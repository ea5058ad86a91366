"""Queries over variant rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.plans.unparsed import has_rows, rows_of, with_rows


def in_region(df: DataFrame, contig: str, start: int, end: int) -> DataFrame:
    """Variants that lie inside ``[start, end]`` of a contig; overlap is not enough."""
    inside = (F.col("contig") == contig) & (F.col("start") >= start) & (F.col("end") <= end)
    return df.where(inside)


def min_quality(df: DataFrame, threshold: float) -> DataFrame:
    """Variants with a quality above the threshold; unknown quality fails."""
    return df.where(F.col("qual") > threshold)


def variants_per_file(df: DataFrame) -> DataFrame:
    """Number of variants per ``file_name``."""
    return df.groupBy("file_name").count()


def variant_field(variant: Column, key: str, sql_type: str) -> Column:
    """Member ``key`` of a VARIANT object; NULL if absent or not castable to the type."""
    quote = '"' if "'" in key else "'"
    return F.try_variant_get(variant, f"$[{quote}{key}{quote}]", sql_type)


def info_field(key: str, sql_type: str = "string") -> Column:
    """INFO value by key, for example ``info_field("DP", "bigint")``."""
    return variant_field(F.col("info"), key, sql_type)


def flatten_info(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Add one ``INFO_<key>`` column per entry of ``types`` (key to SQL type).

    A single value of a key whose type is an array is an array of one.
    """

    def typed(key: str, sql_type: str) -> Column:
        value = info_field(key, sql_type)
        if not sql_type.startswith("array<"):
            return value
        single = info_field(key, sql_type.removeprefix("array<").removesuffix(">"))
        return F.coalesce(value, F.when(single.isNotNull(), F.array(single)))

    return df.withColumns({f"INFO_{key}": typed(key, t) for key, t in types.items()})


# SQL types of the types that INFO header lines declare.
HEADER_TYPES = {
    "Integer": "bigint",
    "Float": "double",
    "Flag": "boolean",
    "Character": "string",
    "String": "string",
}


def declared_info_types(header: DataFrame) -> dict[str, str]:
    """SQL type of every INFO key that a ``vcf_header`` table declares.

    Keys are distinct over all files first, so this collects one row per key.
    A key with ``Number=1`` or a flag is a scalar, any other an array. Files that
    disagree make the key a string.
    """
    info = header.where((F.col("section") == "INFO") & F.col("id").isNotNull())
    per_key = info.groupBy("id").agg(
        F.collect_set(F.struct("number", "type")).alias("declared")
    )
    types = {}
    for row in per_key.orderBy("id").collect():
        if len(row["declared"]) > 1:
            types[row["id"]] = "string"
            continue
        number, declared = row["declared"][0]
        scalar = HEADER_TYPES.get(declared, "string")
        types[row["id"]] = scalar if number in ("0", "1") else f"array<{scalar}>"
    return types


# SQL types of what a VARIANT of INFO holds.
FOUND_TYPES = {"BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean", "STRING": "string"}


def _found_type(kind: str | None) -> str | None:
    """SQL type of a schema text of VARIANT; whole-text decimals are doubles."""
    if kind is None or kind == "VOID":
        return None
    return "double" if kind.startswith(("DECIMAL", "FLOAT")) else FOUND_TYPES.get(kind, "string")


def discovered_info_types(df: DataFrame, header: DataFrame | None = None) -> dict[str, str]:
    """SQL type of every INFO key that the rows hold, for ``flatten_info``.

    What a ``header`` table declares comes first; the other keys get the narrowest type
    that all their values have, a list if any value is one, and text where values do not
    agree. One pass, added up per key before it is shuffled; one row per key is collected.
    """
    members = df.select(F.explode(F.col("info").cast("map<string,variant>")).alias("key", "value"))
    items = F.col("value").try_cast("array<variant>")
    kinds = members.select("key", "value", items.alias("items"))
    of_list = F.explode_outer(F.coalesce("items", F.array("value")))
    each = kinds.select("key", F.col("items").isNotNull().alias("is_list"), of_list.alias("value"))
    found = each.groupBy("key").agg(
        F.schema_of_variant_agg("value").alias("kind"), F.max("is_list").alias("is_list")
    )
    types = {}
    for row in found.orderBy("key").collect():
        scalar = _found_type(row["kind"])
        if scalar is not None:
            types[row["key"]] = f"array<{scalar}>" if row["is_list"] else scalar
    return types | (declared_info_types(header) if header is not None else {})


def per_allele_numbers(header: DataFrame, section: str = "INFO") -> dict[str, str]:
    """Keys that a ``vcf_header`` table declares with a value per alternate allele (A),
    per allele (R) or per genotype (G). One row per key is collected; files that disagree
    drop the key.
    """
    declared = header.where((F.col("section") == section) & F.col("id").isNotNull())
    numbers = declared.groupBy("id").agg(
        F.min("number").alias("number"), F.countDistinct("number").alias("n")
    )
    rows = numbers.where(F.col("number").isin("A", "R", "G") & (F.col("n") == 1)).collect()
    return {row["id"]: row["number"] for row in rows}


def _of_allele(variant: Column, numbers: dict[str, str]) -> Column:
    """VARIANT object in which lists of these keys keep the values of ``altIndex``, out of
    ``_alleles`` with the reference."""

    def chosen(key: Column, value: Column) -> Column:
        items = value.try_cast("array<variant>")
        alternate = F.get(items, F.col("altIndex") - 1)
        with_reference = F.to_variant_object(F.array(F.get(items, F.lit(0)), F.get(items, F.col("altIndex"))))
        has_both = F.size(items) > F.col("altIndex")
        of_a = key.isin([k for k, n in numbers.items() if n == "A"])
        of_r = key.isin([k for k, n in numbers.items() if n == "R"])
        of_g = key.isin([k for k, n in numbers.items() if n == "G"])
        # Genotypes of two alleles j <= k stand at k * (k + 1) / 2 + j, those of one at k.
        alt = F.col("altIndex")
        with_alt = F.expr("int(altIndex * (altIndex + 1) / 2)")
        of_pairs = F.array(F.lit(0), with_alt, with_alt + alt)
        every_pair = F.expr("int(_alleles * (_alleles + 1) / 2)")
        places = F.when(F.size(items) == every_pair, of_pairs).when(
            F.size(items) == F.col("_alleles"), F.array(F.lit(0), alt)
        )
        of_genotypes = F.to_variant_object(F.transform(places, lambda i: F.get(items, i)))
        picked = (
            F.when(of_a, alternate)
            .when(of_r & has_both, with_reference)
            .when(of_g & places.isNotNull(), of_genotypes)
        )
        # A value that is no list, or has none for this allele, stays.
        return F.coalesce(picked, value)

    members = F.transform_values(variant.cast("map<string,variant>"), chosen)
    return F.to_variant_object(members)


def split_multiallelic(
    df: DataFrame,
    info_numbers: dict[str, str] | None = None,
    format_numbers: dict[str, str] | None = None,
) -> DataFrame:
    """One row per alternate allele, with its 1-based ``altIndex``.

    ``alternateAlleles`` keeps the one allele. In ``calls`` that allele becomes
    1, the reference stays 0, a missing call stays -1 and any other allele
    becomes 0. A row without alternate alleles stays, with NULL ``altIndex``.

    ``info_numbers`` and ``format_numbers``, as ``per_allele_numbers`` returns them,
    name keys whose lists are split too: of an A list the allele's value stays, of
    an R list the reference's and the allele's, of a G list those of the genotypes of
    these two, for two copies or one.
    """
    alt_index = (F.col("altPosition") + 1).cast("int")

    def recode(call: Column) -> Column:
        code = F.when(call == -1, -1).when(call == F.col("altIndex"), 1).otherwise(0)
        return code.cast("bigint")

    def per_allele(genotype: Column | dict[str, Column]) -> dict[str, Column]:
        data = genotype["data"]
        return {
            "sampleId": genotype["sampleId"],
            "calls": F.transform(genotype["calls"], recode),
            "data": _of_allele(data, format_numbers) if format_numbers else data,
        }

    def struct_of(members: dict[str, Column]) -> Column:
        return F.struct(*(member.alias(name) for name, member in members.items()))

    one_allele = F.when(F.col("allele").isNotNull(), F.array("allele")).otherwise(
        F.col("alternateAlleles")
    )
    is_split = F.col("altIndex").isNotNull()

    def of_alleles(rows: DataFrame, changed: dict[str, Column]) -> DataFrame:
        info = F.col("info")
        if info_numbers:
            changed = changed | {"info": F.when(is_split, _of_allele(info, info_numbers)).otherwise(info)}
        return (
            rows.select("*", F.posexplode_outer("alternateAlleles").alias("altPosition", "allele"))
            .withColumns({"altIndex": alt_index, "_alleles": F.size("alternateAlleles") + 1})
            .withColumns({"alternateAlleles": one_allele} | changed)
            .drop("altPosition", "allele", "_alleles")
        )

    def genotype_rows() -> DataFrame:
        # Members are columns until the end, so that what is not read is not parsed.
        rows = rows_of(df)
        flat = {name: f"_{name}" for name in ("sampleId", "calls", "data")}
        others = [name for name in rows.columns if name != "genotype"]
        members = rows.select(*others, *(F.col("genotype")[name].alias(column) for name, column in flat.items()))
        recoded = {
            flat[name]: F.when(is_split, member).otherwise(F.col(flat[name]))
            for name, member in per_allele({name: F.col(column) for name, column in flat.items()}).items()
        }
        split = of_alleles(members, recoded)
        genotype = struct_of({name: F.col(column) for name, column in flat.items()})
        return split.select(*(name for name in split.columns if name not in flat.values()), genotype.alias("genotype"))

    genotypes = F.col("genotypes")
    parsed = F.when(is_split, F.transform(genotypes, lambda g: struct_of(per_allele(g)))).otherwise(genotypes)
    split = of_alleles(df, {"genotypes": parsed})
    return with_rows(split, genotype_rows) if has_rows(df) else split


def trim_alleles(df: DataFrame) -> DataFrame:
    """REF and the one ALT without the letters that they share at the end, then at the
    start, of which each keeps one at least; ``start`` and ``end`` move with them.

    Rows with several alternate alleles, none, or such that are no sequences stay as
    they are: ``split_multiallelic`` comes first.
    """
    shared = """CASE WHEN size(alternateAlleles) = 1
        AND referenceAllele RLIKE '^[ACGTNacgtn]+$' AND alternateAlleles[0] RLIKE '^[ACGTNacgtn]+$'
      THEN {} ELSE 0 END"""

    def count(letters: str, least: str) -> str:
        """How many pairs of letters from the first on are equal, but for one."""
        pairs = f"transform(sequence(1, {least} - 1), i -> {letters})"
        differs = f"array_position({pairs}, false)"
        return f"CASE WHEN {least} < 2 THEN 0 WHEN {differs} = 0 THEN {least} - 1 ELSE {differs} - 1 END"

    at_end = count(
        "substr(referenceAllele, -i, 1) = substr(alternateAlleles[0], -i, 1)",
        "least(length(referenceAllele), length(alternateAlleles[0]))",
    )
    at_start = count(
        "substr(referenceAllele, i, 1) = substr(alternateAlleles[0], i, 1)",
        "(least(length(referenceAllele), length(alternateAlleles[0])) - _tail)",
    )
    measured = df.withColumn("_tail", F.expr(f"int({shared.format(at_end)})"))
    measured = measured.withColumn("_head", F.expr(f"int({shared.format(at_start)})"))
    cut = "substr({0}, _head + 1, length({0}) - _head - _tail)"
    trimmed = measured.withColumns(
        {
            "start": F.expr("start + _head"),
            "end": F.expr("end - _tail"),
            "referenceAllele": F.expr(cut.format("referenceAllele")),
            "alternateAlleles": F.expr(
                f"CASE WHEN _head + _tail > 0 THEN transform(alternateAlleles, a -> {cut.format('a')}) ELSE alternateAlleles END"
            ),
        }
    )
    return trimmed.drop("_head", "_tail")


def join_header(df: DataFrame, header: DataFrame) -> DataFrame:
    """Rows of ``header`` with the variants of their file counted per file.

    The variants are counted before the join, so only one row per file meets
    the header table.
    """
    counts = df.groupBy("file_path").agg(F.count("*").alias("variants"))
    return header.join(counts, "file_path", "left")
