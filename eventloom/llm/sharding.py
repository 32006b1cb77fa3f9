"""Proportional stratified interleaving of documents into shards.

Rows are shuffled by a seeded hash within their source and get the fraction of the source that lies before them; in
the order of that fraction every stretch has the mixture of the whole, so cutting it into equal runs gives shards that
match it. Both rankings are made by buckets of a range partitioning on the whole order, down to a number of each row:
however large or many the sources are and however often an id occurs, buckets are of about even size, and a row's rank
is its rank in the bucket plus the sizes of the buckets before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.session import cut_lineage, release

SHARDS = 24
SEED = "shards-1"
# Rows of a bucket; each is the work of one task.
BUCKET_ROWS = 200_000


def ranged(df: DataFrame, order: list[str | Column], bucket_rows: int) -> DataFrame:
    """Rows with the bucket they are in, ``__bucket``, in the order of ``order``; rows that are alike are told apart by
    ``__tie``. Written, since the bounds come from a sample."""
    buckets = max(1, -(-df.count() // bucket_rows))
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    return cut_lineage(tied.repartitionByRange(buckets, *order, "__tie").withColumn("__bucket", F.spark_partition_id()))


def ranked(rows: DataFrame, group: list[str], order: list[str | Column], name: str) -> DataFrame:
    """Add the rank from 0 by (bucket, order) within ``group``, and the group's size as ``<name>_of``.

    Only one row per group and bucket passes through the window that adds up the buckets.
    """
    keys = [*group, "__bucket"]
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
    # A constant stands for the group of all rows: as many rows as there are buckets.
    every = [F.col(c) for c in group] or [F.lit(0)]
    before = Window.partitionBy(*every).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)],
        F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"),
        F.sum("__size").over(Window.partitionBy(*every)).alias(f"{name}_of"),
    )
    same = [rows[c].eqNullSafe(offsets[f"__k{i}"]) for i, c in enumerate(keys)]
    own = Window.partitionBy(*keys).orderBy(*order, "__tie")
    met = rows.join(offsets, same)
    return met.withColumn(name, F.row_number().over(own) - 1 + F.col("__offset")).drop(
        "__bucket", "__tie", "__offset", *[f"__k{i}" for i in range(len(keys))]
    )


def assign_shards(docs: DataFrame, shards: int = SHARDS, seed: str = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Shard and slot of every row of ``docs`` (doc_id, text, source), with its size and checksum.

    Shard counts are at most one apart, slots are gapless from 0, and each shard holds its share of every source to
    within two rows, and what chance leaves where thousands of sources have a few rows each. Null sources are a source; null texts have size 8 and the checksum of nothing; repeated rows are
    rows. The text itself is not shuffled. Equal texts are not kept together, since counts have to be even.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        "source",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    ).withColumn("place", F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string")).cast("binary")))
    # Narrow rows, written once: counting, sampling and ranking read them without the texts.
    narrow = cut_lineage(rows)
    order = ["place", "doc_id", "text_crc32", "size"]
    by_source = ranged(narrow, [F.col("source").asc_nulls_first(), *order], bucket_rows)
    inside = ranked(by_source, ["source"], order, "rank")
    # Where a source begins within a step is hashed too, or all small sources would stand at the same few fractions.
    begin = F.md5(F.concat_ws("|", F.lit(seed), F.lit("source"), F.coalesce("source", F.lit(""))).cast("binary"))
    begin = F.conv(F.substring(begin, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    fractions = inside.withColumn("fraction", (F.col("rank") + begin) / F.col("rank_of"))
    order = ["fraction", F.col("source").asc_nulls_first(), *order]
    spread = ranged(cut_lineage(fractions), order, bucket_rows)
    release(narrow, by_source)
    placed = ranked(spread, [], order, "at")
    # Shard s holds the places p with floor(p * shards / n) = s; its first place is ceil(s * n / shards).
    exact = F.expr(f"CAST(at * {shards} DIV at_of AS INT)")
    return placed.withColumn("shard", exact).select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        "shard",
        F.expr(f"CAST(at - (shard * at_of + {shards - 1}) DIV {shards} AS BIGINT)").alias("slot"),
    )
