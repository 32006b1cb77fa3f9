from __future__ import annotations

import numpy as np

import corpus_pipeline
from eventloom.llm import bpe, decontam, jaccard, langid, stages, toxicity

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_their_operators(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    by_id = {r.doc_id: r.text for r in documents.collect()}
    frames = {}
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        frames[name] = docs
        if name != "tokens":
            assert docs.columns == documents.columns
    ids = {name: {r.doc_id for r in frame.select("doc_id").collect()} for name, frame in frames.items()}
    net = langid.fit(documents)
    assert ids["language"] == {
        r.doc_id for r in langid.identify(documents, net).collect() if r.lang_pred != "und" and r.score >= net.bars[net.langs.index(r.lang_pred)]
    }
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    index = toxicity.fit(frames["language"], labels)
    assert ids["toxicity"] == {r.doc_id for r in toxicity.score_documents(frames["language"], index).collect() if r.score < stages.TOXIC}
    groups = jaccard.jaccard_groups(frames["toxicity"], stages.NEAR).collect()
    assert ids["near_duplicates"] == {r.component_id for r in groups if r.n_shingles} | {r.doc_id for r in groups if not r.n_shingles}
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    found = decontam.decontaminate(frames["near_duplicates"], bench).collect()
    assert ids["decontamination"] == {r.doc_id for r in found if not r.contaminated} == ids["tokens"]
    import public_tokenizers

    tokens = frames["tokens"].collect()
    codec = bpe.Codec(bpe.load(public_tokenizers.path("byte_bpe_50k.json")))
    assert all(codec.decode(r.ids) == by_id[r.doc_id] and r.n_tokens == len(r.ids) for r in tokens)


def test_pipeline_runs_over_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0


def test_many_languages_lose_no_clean_document(spark, docs):
    """Invented languages of 600 words each: with 30 of them the best score is far from 1, and no bar may rely on it."""
    rng = np.random.default_rng(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [["".join(rng.choice(list(letters), rng.integers(2, 8))) for _ in range(600)] for _ in range(30)]
    rows = [(i, " ".join(rng.choice(words[i % 30], 80)), f"l{i % 30:02d}") for i in range(900)]
    rows += [(2000, "12 34 !!", None), (2001, None, None), (2002, "", "l01")]
    kept = {r.doc_id for r in stages.keep_known_languages(spark, docs(rows), FOLDER).select("doc_id").collect()}
    assert kept == set(range(900))
