"""Corpus pipeline: language, toxicity, near duplicates, benchmark passages, tokens.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of documents. A stage's result is
written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventloom.llm import stages
from eventloom.session import cut_lineage

STAGES = [
    ("language", stages.keep_known_languages),
    ("toxicity", stages.drop_toxic),
    ("near_duplicates", stages.keep_one_of_each_group),
    ("decontamination", stages.drop_contaminated),
    ("tokens", stages.encode),
]

# A trained network and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES):
            docs = cut_lineage(docs)
    return docs
