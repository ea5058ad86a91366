"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.plans.shared import shared_folder


def _toward_smallest(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link neighbours of each node to the smallest node among them and itself.

    ``larger_only`` moves neighbours above the node (large star), otherwise the
    node and its neighbours below it (small star). Minima are aggregated before
    they are joined, so a centre with many neighbours is one row on its side.
    """
    if larger_only:
        around = edges.union(edges.select("v", "u"))
    else:
        around = edges.select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        )
    smallest = around.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    joined = around.join(smallest, "u")
    if larger_only:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.union(smallest.where("u <> m").select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the smallest node
    of its component.

    Each round is written to the shared folder, so a lost executor costs no more
    than a round. No edges give no rows. Rounds grow with the logarithm of the
    size of a component, and end when one changes nothing.
    """
    shared_folder(edges.sparkSession)
    now = edges.where("u <> v").distinct().checkpoint()
    before = None
    while True:
        stars = _toward_smallest(_toward_smallest(now, True), False).checkpoint()
        state = stars.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        now = stars
        if state == before:
            leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return leaves.union(roots)
        before = state
