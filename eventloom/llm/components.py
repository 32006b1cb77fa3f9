"""Connected components by alternating large and small stars, in DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.session import cut_lineage, release


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """Node and smallest node of its component, for every node of ``edges`` (u, v of type long).

    Edges may be repeated, loops are ignored. Every step aggregates before it joins, so a node with very many
    neighbours is no group of one task, and is written to the shared folder before the next begins.
    """
    now = cut_lineage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), drop_shuffles=True)
    mark = _mark(now)
    while True:
        stars = _large_star(now).where("u <> v").distinct()
        before, now = now, cut_lineage(_small_star(stars).where("u <> v").distinct(), drop_shuffles=True)
        release(before)
        after = _mark(now)
        if after == mark:
            break
        mark = after
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    named = leaves.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    done = cut_lineage(named, drop_shuffles=True)
    release(now)
    return done


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and an order-free digest; stars at rest repeat both."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.xxhash64("v", "u") % 1000003).alias("s")).first()
    return tuple(row)
