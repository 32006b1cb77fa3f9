"""Queries of the training-data operators; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import (
    bpe, decontam, extraction, jaccard, langid, pii, preference, sharding, spelling, toxicity, warc, whitening, winnowing
)
from eventloom.llm.common import crc_bucket, sha256_hex
from eventloom.llm.oracles import ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

__all__ = ["ORACLES", "QUERIES"]


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.decontaminate(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.drop("items", "spans")


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    index = toxicity.fit(docs, read(spark, folder, "labels"))
    return toxicity.score_documents(docs, index).drop("neighbours", "cosines", "toxic_votes")


@query
def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    found = langid.identify(docs, langid.fit(docs))
    return found.select("doc_id", (crc_bucket("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op4_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.resolve_revisits(warc.captures(read(spark, folder, "pages")))
    shown = F.filter(F.array_sort(F.map_entries("headers")), lambda e: e["value"].isNotNull())
    pairs = F.transform(shown, lambda e: F.concat_ws("=", e["key"], e["value"]))
    return found.select(
        "record_id",
        "canonical_url",
        F.col("ts").cast("long").alias("ts"),
        "response_id",
        F.col("response_ts").cast("long").alias("response_ts"),
        "resolution",
        F.array_join(pairs, "; ").alias("headers"),
    )


@query
def op5_preference(spark: SparkSession, folder: str) -> DataFrame:
    made = preference.format_pairs(*preference.pairs_of(read(spark, folder, "conversations")))
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return made.select(
        F.col("pair_id").alias("conv_id"),
        "n_prefix",
        *[sha256_hex(F.col(c)).alias(f"{c}_sha256") for c in ("prompt", "chosen", "rejected")],
        *[listed(c).alias(c) for c in ("chosen_spans", "rejected_spans")],
    )


@query
def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    made = sharding.assign_shards(read(spark, folder, "documents"))
    return made.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op6_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract_pages(read(spark, folder, "pages"))


@query
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_and_decode(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.compare_with_next(read(spark, folder, "documents"))


@query
def op7_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.jaccard_groups(read(spark, folder, "documents"), jaccard.Rule(words=3, part=90, whole=100))
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


@query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read(spark, folder, "embeddings"))


@query
def op12_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(read(spark, folder, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


@query
def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group_variants(read(spark, folder, "documents"))
