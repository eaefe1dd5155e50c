"""Connected components of a graph too large for one machine: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelkiln.session import Scratch


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the least node it knows of."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the least of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    handed = edges.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return handed.union(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: any orderable type) that isn't a root itself.

    The root is the least node of the component. Each round is two aggregates
    with map-side minima and two joins that adaptive execution can split, and
    is written to the shared folder, so lineage stays short. The number of
    rounds grows with the logarithm of the longest path; only a count and a sum
    reach the driver. Loops and nulls are ignored, repeated edges count once.
    """
    spark = edges.sparkSession
    current = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    held = Scratch(spark)
    current = held.stored(current, "edges")
    seen = _signature(current)
    while seen[0]:
        following = Scratch(spark)
        current = following.stored(_small_star(_large_star(current)), "stars")
        held.clear()  # the round before, which nothing reads any more
        held, now = following, _signature(current)
        if now == seen:
            break
        seen = now
    return current.select(F.col("b").alias("node"), F.col("a").alias("root"))
