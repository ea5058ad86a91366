"""Variants of many regions at once: an interval join by bins.

A region stands in a few bins of a size near its own, a variant in the bins of each of
these sizes that it touches. Equal bins are an ordinary equi-join; the exact test comes
behind it, and a pair that meets in several bins counts in the first of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.plans.header_join import MAX_BROADCAST_BYTES

# Bins are powers of two: the smallest, and the step from one size to the next. A
# region touches at most nine bins of its size, so few variants of a bin miss it.
SMALLEST_BITS, STEP_BITS, LARGEST_BITS = 5, 3, 62
# Bins with more variants than this are split over several tasks, and the most bins
# that can be: a bin must hold one part in so many of all variants to be one of them.
HOT_VARIANTS = 1_000_000
MOST_HOT_BINS = 100_000


def _bits_of(length: Column) -> Column:
    """Bits of the bin size for regions of a length, which may be beyond 64 bits."""
    needed = F.ceil(F.log2(F.greatest(length, F.lit(1.0)))) - F.lit(STEP_BITS)
    steps = F.ceil(F.greatest(needed - SMALLEST_BITS, F.lit(0)) / STEP_BITS)
    bits = steps * STEP_BITS + SMALLEST_BITS
    return F.least(bits, F.lit(LARGEST_BITS)).cast("int")


def _bin(position: str | Column, bits: str) -> Column:
    value = F.col(position) if isinstance(position, str) else position
    return F.call_function("shiftright", value, F.col(bits))


def _touched(first: Column, last: Column, bits: str) -> Column:
    return F.sequence(_bin(first, bits), F.greatest(_bin(first, bits), _bin(last, bits)))


def _keyed_regions(regions: DataFrame, names: dict[str, str]) -> DataFrame:
    """One row per bin of each region. Regions without a place or a length match nothing."""
    a, b = F.col(names["start"]).cast("bigint"), F.col(names["end"]).cast("bigint")
    usable = regions.where(F.col(names["contig"]).isNotNull() & (a < b))
    sized = usable.select(
        F.struct(*(F.col(f"`{n}`") for n in regions.columns)).alias("_region"),
        F.col(names["contig"]).alias("_contig"), a.alias("_a"), b.alias("_b"),
        _bits_of(b.cast("double") - a.cast("double")).alias("_bits"),
    )
    return sized.withColumn("_bin", F.explode(_touched(F.col("_a"), F.col("_b"), "_bits")))


def _keyed_variants(df: DataFrame, bits: list[int], overlap: bool) -> DataFrame:
    """One row per size of bins and, where overlap counts, per bin that a variant touches."""
    sizes = F.explode(F.array(*(F.lit(b) for b in bits)).cast("array<int>")).alias("_bits")
    sized = df.select("*", sizes)
    if not overlap:
        return sized.withColumn("_bin", _bin("start", "_bits"))
    return sized.withColumn("_bin", F.explode(_touched(F.col("start"), F.col("end") - 1, "_bits")))


def _split_hot(
    variants: DataFrame, regions: DataFrame, hot_variants: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_part``: 0, or one of several in bins with very many variants."""
    keys = ["_contig", "_bits", "_bin"]
    counts = variants.groupBy(F.col("contig").alias("_contig"), "_bits", "_bin").agg(F.count("*").alias("_n"))
    total = variants.agg(F.count("*").alias("n")).first()["n"]
    # Fewer than MOST_HOT_BINS bins can have more than this.
    least = max(hot_variants, total // MOST_HOT_BINS)
    hot = counts.where(F.col("_n") > least).select(*keys, F.ceil(F.col("_n") / least).cast("int").alias("_parts"))
    hot = F.broadcast(hot)
    renamed = hot.select(F.col("_contig").alias("contig"), "_bits", "_bin", "_parts")
    spread = variants.join(renamed, ["contig", "_bits", "_bin"], "left")
    draw = F.pmod(F.xxhash64("start", "end", F.monotonically_increasing_id()), F.coalesce("_parts", F.lit(1)))
    copied = regions.join(hot, keys, "left")
    parts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    return (
        spread.withColumn("_part", draw.cast("int")).drop("_parts"),
        copied.withColumn("_part", F.explode(parts)).drop("_parts"),
    )


def join_regions(
    df: DataFrame,
    regions: DataFrame,
    overlap: bool = False,
    contig: str = "contig",
    start: str = "start",
    end: str = "end",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    hot_variants: int = HOT_VARIANTS,
) -> DataFrame:
    """Each variant with each region that it lies inside, as a struct ``region``.

    The test is that of ``in_region``: ``start`` and ``end`` within the region's; with
    ``overlap`` half-open ranges that share a place are enough. ``contig``, ``start``,
    ``end`` name the columns of ``regions``. Equal regions count each for itself; null
    and empty regions match nothing.

    The bins of the regions are measured: up to ``max_broadcast_bytes`` they are
    broadcast and the variants stay where they are. Beyond that both sides are shuffled
    by bin, and bins with more than ``hot_variants`` variants are split.
    """
    keyed = _keyed_regions(regions, {"contig": contig, "start": start, "end": end})
    row = F.length(F.to_json("_region")) + 64
    measured = keyed.agg(
        F.sum(row.cast("bigint")).alias("size"), F.array_sort(F.collect_set("_bits")).alias("bits")
    ).first()
    # Twenty sizes of bins at most.
    variants = _keyed_variants(df, measured["bits"] or [SMALLEST_BITS], overlap)
    if (measured["size"] or 0) <= max_broadcast_bytes:
        regions_side = F.broadcast(keyed.withColumn("_part", F.lit(0)))
        variants = variants.withColumn("_part", F.lit(0))
    else:
        variants, regions_side = _split_hot(variants, keyed, hot_variants)
        regions_side = regions_side.hint("shuffle_hash")
    regions_side = regions_side.select(
        "_region", "_a", "_b", "_part", F.col("_contig").alias("contig"), "_bits", "_bin"
    )
    met = variants.join(regions_side, ["contig", "_bits", "_bin", "_part"])
    if overlap:
        first = _bin(F.greatest("start", "_a"), "_bits")
        met = met.where((F.col("start") < F.col("_b")) & (F.col("end") > F.col("_a")) & (F.col("_bin") == first))
    else:
        met = met.where((F.col("start") >= F.col("_a")) & (F.col("end") <= F.col("_b")))
    return met.select(*(F.col(f"`{n}`") for n in df.columns), F.col("_region").alias("region"))
