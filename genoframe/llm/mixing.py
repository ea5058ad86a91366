"""Mixing sources to target weights.

Sizes are summed per source; a source's target over its size is its repetition
rate. A document is emitted floor(rate) times, and once more with the probability
of the remaining fraction, drawn from a hash of its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoframe.plans.shared import shared_folder

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = 20240229
# Up to this many sources (some 100 bytes each) the rates are broadcast.
BROADCAST_SOURCES = 100_000
SALTS = 64


def word_count(text: str | Column) -> Column:
    """Number of words, runs of other than ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_rates(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """Per source its size, weight, target and rate.

    ``sized`` has ``source`` and ``size``. Sources in code point order, null last,
    take the weights in turn and share the total of all sizes. A target stops at
    ``max_repeats`` times its source's size; what is over is shared by the others.
    That leaves one level: targets are ``min(cap, weight * level)``. With sources
    ordered by cap per weight the capped ones come first, and the level follows
    from running sums.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    listed = F.array(*(F.lit(w) for w in weights))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")
    capped = (
        sums.withColumn("weight", F.get(listed, turn).cast("double"))
        .withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
    )
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = capped.withColumn("total", F.sum("source_size").over(everything)).withColumn(
        "weights", F.sum("weight").over(everything)
    )
    # The level if this source and all after it were uncapped.
    room = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    shared = F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = levels.withColumn("level_here", room / shared)
    # The first source that stays below its cap fixes the level of all after it.
    fits = F.when(F.col("level_here") * F.col("weight") <= F.col("cap"), F.col("level_here"))
    so_far = by_cap.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = levels.withColumn("level", F.first(fits, ignorenulls=True).over(so_far))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(
        F.least("cap", F.col("level") * F.col("weight"))
    )
    size = F.col("source_size")
    return (
        levels.withColumn("target", target)
        .withColumn("rate", F.when(size > 0, F.col("target") / size).otherwise(F.lit(0.0)))
        .select("source", "source_size", "weight", "target", "rate")
    )


def _stored_rates(sized: DataFrame, max_repeats: int) -> DataFrame:
    """The rates, computed once: one row per source in the shared folder."""
    shared_folder(sized.sparkSession)
    return source_rates(sized, max_repeats=max_repeats).checkpoint()


def _with_rates(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Bring the rates (alias r) to the rows (alias s).

    There is no shuffle while there are few sources. With more, rows of a source spread over salts, so that one with a third of
    all rows does not meet in one task.
    """
    same = F.col("s.source").eqNullSafe(F.col("r.source"))
    if rates.count() <= BROADCAST_SOURCES:
        return rows.alias("s").join(F.broadcast(rates).alias("r"), same)
    salt = F.pmod(F.xxhash64("s.doc_id"), F.lit(SALTS)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_mix_salt")
    right = rates.select("*", every).hint("shuffle_hash").alias("r")
    return rows.alias("s").join(right, same & (salt == F.col("r._mix_salt")))


def copies_of(
    doc_id: str, rate: str, seed: int = SEED, max_repeats: int = MAX_REPEATS
) -> Column:
    """floor(rate) copies and one more with the probability of the fraction.

    Rates end at ``max_repeats``. The draw is a hash of seed and id: reruns agree, and equal ids agree.
    """
    rate = F.least(F.col(rate), F.lit(float(max_repeats)))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    # 13 hexadecimal digits are 52 bits, a double in [0, 1).
    bits = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint")
    draw = bits.cast("double") / F.lit(float(1 << 52))
    whole = F.floor(rate)
    return (whole + F.when(draw < rate - whole, 1).otherwise(0)).cast("bigint")


def assign_copies(docs: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies.

    A null or empty text has size 0 and takes no words; its copies follow the rate
    of its source all the same. A source whose documents are all empty has target
    and rate 0. No documents give no rows. Other columns are not read. ``doc_id``
    may be null or repeated: equal ids get equal draws.
    """
    sized = docs.select("doc_id", "source", word_count("text").alias("size"))
    joined = _with_rates(sized, _stored_rates(sized, max_repeats))
    picked = joined.select(
        "s.doc_id", "s.source", "s.size", "r.source_size", "r.target", "r.rate"
    )
    return picked.withColumn("copies", copies_of("doc_id", "rate", max_repeats=max_repeats))


def mix(docs: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, each row as often as it is taken.

    Rates are summed from one narrow pass; the second pass reads whole rows and
    repeats them in place, so texts are not shuffled. Columns named like the
    working ones are kept as they are.
    """
    sized = docs.select("doc_id", "source", word_count("text").alias("size"))
    joined = _with_rates(docs, _stored_rates(sized, max_repeats))
    copies = copies_of("s.doc_id", "r.rate", max_repeats=max_repeats)
    # Columns go in a struct while the rows are repeated, so no name of theirs clashes.
    row = F.struct(*(F.col(f"s.`{name}`") for name in docs.columns)).alias("_mix_row")
    times = F.array_repeat(F.lit(True), copies.cast("int"))
    return joined.select(row, F.explode(times)).select("_mix_row.*")
