"""The stages of the corpus pipeline: each applies one operator to all documents it gets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import bpe, decontam, jaccard, langid, toxicity
from eventloom.llm.common import keep_rows

TOXIC = 0.5
NEAR = jaccard.Rule(words=5, part=4, whole=5)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter and those whose best language stays below its bar (``langid.least_scores``)."""
    net = langid.fit(docs)

    def judge():
        memory = langid.Memory(net)

        def verdicts(texts: list[str | None]) -> list[bool]:
            lettered = [t if t and langid.has_letter(t) else None for t in texts]
            if not net.langs:
                return [t is not None for t in lettered]
            known = langid.known_language(net, langid.document_probabilities(net, lettered, memory))
            return [t is not None and bool(ok) for t, ok in zip(lettered, known, strict=True)]

        return verdicts

    return keep_rows(docs, judge)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are likelier toxic than not by their nearest labelled examples."""
    index = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    sent = spark.sparkContext.broadcast(index.fields())

    def judge():
        scorer = toxicity.Scorer(toxicity.Index(**sent.value))
        return lambda texts: [scorer(t)[0] < TOXIC for t in texts]

    return keep_rows(docs, judge)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of every group of near duplicates."""
    return jaccard.one_of_each_group(docs, NEAR)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    import public_tokenizers

    made = bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")
