"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index of all their terms.

Examples are a bounded sample of labelled documents, as many of each label as there are, up to a limit. Every term
of an example is indexed; how many of all documents hold it is counted over the whole corpus, and it weighs the more
the better it tells the labels apart. Posting lists are cut into blocks of examples with the largest weight of a term
in each. A text's neighbours are found exactly: the maxima bound what any example of a block can reach, blocks are
read from the highest bound down, and those that cannot reach the last neighbour so far are skipped; lists of few
examples have no blocks and are read whole. Votes are weighted
by closeness and by the share of the label that an example stands for, then mapped to probabilities by isotonic
regression on the examples' votes, each with term weights and neighbours that have not seen its label.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import arrow_schema, crc_bucket, map_in_arrow, schema_of, slices

# Labelled examples taken of either label at most.
EXAMPLES_PER_LABEL = 1500
NEIGHBOURS = 15
# Examples of a block. Examples are ordered by their heaviest term, so that a block's maxima are those of few terms.
BLOCK = 128
# Lists of no more examples are read whole, without bounds.
SHORT = 2000
# Parts of the examples for calibration: a part's votes use term weights learned from the others.
FOLDS = 3
# Evidence is twice the log likelihood ratio of a term's label shares. A term with this much (chance below 1e-6) has
# about half of its full weight; one without any has a 25th, never nothing.
EVIDENCE = 24.0

_WORD = b"abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or b in _WORD else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of Latin letters and of characters beyond ASCII."""
    return text.encode("utf-8").translate(_FOLD).split() if text else []


def evidence(examples: list[tuple[list[bytes], int]]) -> dict[bytes, float]:
    """How much each term holds for or against a label: the likelihood ratio of its share among the examples with it."""
    totals = Counter(label for _, label in examples)
    n = len(examples)
    seen, bad = Counter(), Counter()
    for terms, label in examples:
        own = set(terms)
        seen.update(own)
        if label:
            bad.update(own)
    if not totals[0] or not totals[1]:
        return dict.fromkeys(seen, 0.0)
    share = totals[1] / n

    def part(a: float, b: float) -> float:
        return a * math.log(a / b) if a else 0.0

    found = {}
    for term, d in seen.items():
        b = bad[term]
        inside = part(b, d * share) + part(d - b, d * (1 - share))
        rest = n - d
        outside = part(totals[1] - b, rest * share) + part(totals[0] - d + b, rest * (1 - share)) if rest else 0.0
        found[term] = max(2 * (inside + outside), 0.0)
    return found


@dataclass
class Index:
    """Example vectors as posting lists in blocks.

    ``rows`` numbers the terms; ``weight`` is a term's IDF times its share of the full weight. The blocks of term ``t``
    are the entries ``starts[t]`` to ``starts[t + 1]``; an entry is a block of examples, the largest value of the term
    in it, and the place of its postings, which end where the next entry's begin. The whole list of a term is from
    ``lists[t]`` to ``ends[t]``.
    """

    rows: dict[bytes, int]
    weight: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    worth: np.ndarray
    prior: float
    starts: np.ndarray
    blocks: np.ndarray
    tops: np.ndarray
    firsts: np.ndarray
    places: np.ndarray
    values: np.ndarray
    steps: tuple[np.ndarray, np.ndarray]

    def __post_init__(self) -> None:
        self.lists = self.firsts[self.starts[:-1]] if len(self.firsts) else self.starts[:-1]
        self.ends = self.firsts[self.starts[1:]] if len(self.firsts) else self.starts[1:]

    def fields(self) -> dict:
        """What an index is made of, to send it."""
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def weigh(self, terms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Unit TF-IDF vector over the indexed terms, as numbers of terms and weights; empty without any."""
        known = self.rows
        counts = Counter(terms)
        own = [t for t in counts if t in known]
        if not own:
            return np.array([], np.intp), np.array([])
        at = np.array([known[t] for t in own])
        raw = (1 + np.log([counts[t] for t in own])) * self.weight[at]
        order = np.argsort(at)
        at, raw = at[order], raw[order]
        return at, raw / math.sqrt(raw @ raw)

    def vector(self, terms: list[bytes]) -> tuple[tuple[int, float], ...]:
        at, weights = self.weigh(terms)
        return tuple(zip(at.tolist(), weights.tolist(), strict=True))

    def nearest(
        self, vector: tuple[tuple[int, float], ...], k: int, leave_out: int = -1, read: list[int] | None = None
    ) -> list[tuple[float, int]]:
        """The k examples of highest cosine above 0, nearest first, equal ones by place in the index.

        ``read`` gets the numbers of the blocks whose postings were read, for whoever wants to see what was skipped.
        """
        terms = np.array([t for t, _ in vector], np.intp)
        return self.near(terms, np.array([w for _, w in vector]), k, leave_out, read)

    def near(
        self, terms: np.ndarray, weights: np.ndarray, k: int, leave_out: int = -1, read: list[int] | None = None
    ) -> list[tuple[float, int]]:
        """``nearest`` of a vector given as numbers of terms and weights."""
        n = len(self.ids)
        if not len(terms) or not n:
            return []
        # Short lists are read whole: what they give every example is exact.
        sizes = self.ends[terms] - self.lists[terms]
        short = sizes <= SHORT
        at = _runs(self.lists[terms[short]], sizes[short])
        scores = np.bincount(self.places[at], np.repeat(weights[short], sizes[short]) * self.values[at], n)
        terms, weights = terms[~short], weights[~short]
        sizes = self.starts[terms + 1] - self.starts[terms]
        entries = _runs(self.starts[terms], sizes)
        weights = np.repeat(weights, sizes)
        block = self.blocks[entries]
        bounds = np.bincount(block, weights * self.tops[entries], -(-n // BLOCK))
        bounds = bounds + np.maximum.reduceat(scores, np.arange(0, n, BLOCK))
        order = np.argsort(-bounds, kind="stable")
        exact = np.zeros(n)
        least, done, lot = 0.0, 0, max(2, -(-2 * k // BLOCK))
        while done < len(order):
            now = order[done : done + lot]
            # Sums differ in their last bits, so a block that might tie is read.
            now = now[(bounds[now] > 0) & (bounds[now] >= least - 1e-9)]
            if not len(now):
                break
            wanted = np.zeros(len(bounds), bool)
            wanted[now] = True
            mine = wanted[block]
            some = entries[mine]
            counts = self.firsts[some + 1] - self.firsts[some]
            at = _runs(self.firsts[some], counts)
            more = np.bincount(self.places[at], np.repeat(weights[mine], counts) * self.values[at], n)
            inside = np.repeat(wanted, BLOCK)[:n]
            exact[inside] = scores[inside] + more[inside]
            if read is not None:
                read += now.tolist()
            if leave_out >= 0:
                exact[leave_out] = 0
            least = np.partition(exact, n - k)[n - k] if n > k else 0.0
            done, lot = done + lot, 2 * lot
        scores = exact
        found = np.flatnonzero((scores >= least) & (scores > 0))
        found = found[np.argsort(-scores[found], kind="stable")][:k]
        return list(zip(scores[found].tolist(), found.tolist(), strict=True))

    def vote(self, found: list[tuple[float, int]]) -> float:
        """Share of label 1 among the neighbours; the prior has the weight of one far example."""
        good, total = 0.1 * self.prior, 0.1
        for cosine, place in found:
            weight = cosine * cosine * self.worth[place]
            total += weight
            good += weight * self.labels[place]
        return good / total

    def score(self, found: list[tuple[float, int]]) -> float:
        at, values = self.steps
        return float(np.interp(self.vote(found), at, values)) if len(at) else self.prior


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all runs, one after the other: ``starts[i]`` and those after it, ``sizes[i]`` in all."""
    some = sizes > 0
    starts, sizes = starts[some], sizes[some]
    if not len(starts):
        return np.array([], np.intp)
    steps = np.ones(sizes.sum(), np.intp)
    steps[0] = starts[0]
    steps[np.cumsum(sizes[:-1])] = starts[1:] - (starts[:-1] + sizes[:-1]) + 1
    return np.cumsum(steps)


def _isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted isotonic regression of y on x, as steps (mean x, mean y) of rising value."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for i in order:
        if blocks and blocks[-1][3] == x[i]:
            blocks[-1][0] += w[i] * x[i]
            blocks[-1][1] += w[i] * y[i]
            blocks[-1][2] += w[i]
        else:
            blocks.append([w[i] * x[i], w[i] * y[i], w[i], x[i]])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            for j in range(3):
                blocks[-1][j] += top[j]
            blocks[-1][3] = top[3]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def term_weights(examples: list[tuple[int, list[bytes], int]], terms: list[bytes], doc_counts: dict[bytes, int], n_docs: int) -> np.ndarray:
    """IDF of every term times the share of its full weight that the examples' labels give it."""
    told = evidence([(own, label) for _, own, label in examples])
    idf = np.array([math.log((1 + n_docs) / (1 + doc_counts[t])) + 1 for t in terms])
    strength = np.array([1 + told.get(t, 0.0) for t in terms])
    return idf * strength / (strength + EVIDENCE)


def _posted(rows: dict, weight: np.ndarray, examples: list, worth: dict[int, float], prior: float) -> tuple[Index, list]:
    """Index of the examples without calibration, and their vectors in its order."""
    nothing = np.array([], np.intp)
    bare = Index(rows, weight, nothing, nothing, nothing, prior, nothing, nothing, nothing, nothing, nothing, nothing, (nothing, nothing))
    made = [(bare.weigh(own), doc, label) for doc, own, label in examples]
    made.sort(key=lambda e: (int(e[0][0][e[0][1].argmax()]) if len(e[0][0]) else -1, e[1]))
    vectors = [v for v, _, _ in made]
    terms = np.concatenate([t for t, _ in vectors]) if vectors else nothing
    places = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors]) if vectors else nothing
    values = np.concatenate([w for _, w in vectors]) if vectors else np.array([])
    order = np.argsort(terms, kind="stable")
    terms, places, values = terms[order], places[order], values[order]
    entry = terms * (len(vectors) // BLOCK + 1) + places // BLOCK
    firsts = np.flatnonzero(np.concatenate([[True], entry[1:] != entry[:-1]])) if len(entry) else nothing
    labels = np.array([label for _, _, label in made], np.int8)
    index = Index(
        rows, weight, np.array([doc for _, doc, _ in made], np.int64), labels, np.array([worth[int(label)] for label in labels]), prior,
        np.searchsorted(terms[firsts], np.arange(len(rows) + 1)), places[firsts] // BLOCK,
        np.maximum.reduceat(values, firsts) if len(firsts) else np.array([]), np.append(firsts, len(terms)), places, values,
        (np.array([]), np.array([])),
    )
    return index, vectors


def build_index(
    examples: list[tuple[int, list[bytes], int]], totals: dict[int, int], doc_counts: dict[bytes, int], n_docs: int
) -> Index:
    """Index (doc_id, terms, label) examples; ``totals`` are all labelled rows by label, which examples stand for."""
    terms = sorted(doc_counts)
    rows = {t: i for i, t in enumerate(terms)}
    taken = Counter(label for _, _, label in examples)
    every = totals.get(0, 0) + totals.get(1, 0)
    prior = totals.get(1, 0) / every if every else 0.0
    share = {label: totals.get(label, 0) / n for label, n in taken.items()}
    worth = {label: own / max(share.values()) for label, own in share.items()}
    index, _ = _posted(rows, term_weights(examples, terms, doc_counts, n_docs), examples, worth, prior)
    votes, marks, weights = [], [], []
    for fold in range(FOLDS):
        held = {doc for doc, _, _ in examples if zlib.crc32(b"fold%d" % doc) % FOLDS == fold}
        if not held:
            continue
        others = [e for e in examples if e[0] not in held]
        blind, vectors = _posted(rows, term_weights(others, terms, doc_counts, n_docs), examples, worth, prior)
        for place, vector in enumerate(vectors):
            if int(blind.ids[place]) in held:
                votes.append(blind.vote(blind.near(*vector, NEIGHBOURS, leave_out=place)))
                marks.append(float(blind.labels[place]))
                weights.append(float(blind.worth[place]))
    if votes:
        index.steps = _isotonic(np.array(votes), np.array(marks), np.array(weights))
    return index


class Scorer:
    """Score and evidence of texts: (score, neighbours, cosines, votes); equal texts are looked up once."""

    def __init__(self, index: Index, k: int = NEIGHBOURS) -> None:
        self.index, self.k = index, k
        self.known: dict[bytes, tuple] = {}

    def __call__(self, text: str | None) -> tuple[float, list[int], list[float], int]:
        own = self.index
        key = hashlib.blake2b((text or "").encode("utf-8"), digest_size=16).digest()
        if key not in self.known:
            if len(self.known) > 20_000:
                self.known.clear()
            found = own.near(*own.weigh(terms_of(text)), self.k)
            self.known[key] = (
                own.score(found),
                [int(own.ids[p]) for _, p in found],
                [c for c, _ in found],
                sum(int(own.labels[p]) for _, p in found),
            )
        return self.known[key]


SCORES = schema_of(
    "doc_id bigint, held_out boolean, score double, predicted int, neighbours bigints, cosines doubles, toxic_votes int"
)


def fit(docs: DataFrame, labels: DataFrame, per_label: int = EXAMPLES_PER_LABEL) -> Index:
    """Index of at most ``per_label`` labelled examples of either label, picked by a hash of their id.

    Only rows whose crc32(doc_id) mod 5 is not 0 are learned from; rows with a null id or label, with a label other
    than 0 and 1, or without a document are ignored; of repeated labels the largest counts.
    """
    spark = docs.sparkSession
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .where(crc_bucket("doc_id", 5) != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    top = 1 << 32
    spread = F.xxhash64(F.lit("toxic"), "doc_id").bitwiseAND(F.lit(top - 1))
    # The threshold lets half as many again through, which the sort below cuts to the limit.
    limits = {label: min(top, 3 * per_label * top // (2 * n)) for label, n in totals.items()}
    picked = []
    for label, limit in limits.items():
        picked += known.where((F.col("toxic") == label) & (spread <= limit)).select("doc_id", "toxic", spread.alias("s")).orderBy("s", "doc_id").limit(per_label).collect()
    if not picked:
        return build_index([], totals, {}, 0)
    # At most twice the limit of rows: small enough to send to every task.
    chosen = F.broadcast(spark.createDataFrame([(r["doc_id"], r["toxic"]) for r in picked], "doc_id bigint, toxic int"))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id")
    found: dict[int, tuple[list[bytes], int]] = {}
    same: dict[bytes, bytes] = {}
    for r in rows.orderBy("doc_id", "text").toLocalIterator():
        # One object per term, however many examples hold it.
        found.setdefault(r["doc_id"], ([same.setdefault(t, t) for t in terms_of(r["text"])], r["toxic"]))
    counts, n_docs = document_counts(docs, sorted({t for terms, _ in found.values() for t in terms}))
    return build_index([(doc, terms, label) for doc, (terms, label) in found.items()], totals, counts, n_docs)


def document_counts(docs: DataFrame, terms: list[bytes]) -> tuple[dict[bytes, int], int]:
    """How many of all documents hold each term, and how many documents there are; one row per task is shuffled per term it holds."""
    wanted = set(terms)
    schema = schema_of("term binary, n bigint")
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = Counter(), 0
        for batch in batches:
            rows += batch.num_rows
            for text in batch.column(0):
                counts.update(wanted.intersection(terms_of(text.as_py())))
        cols = [pa.array([b"", *counts], pa.binary()), pa.array([rows, *counts.values()], pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    summed = map_in_arrow(docs.select("text"), run, schema).groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {bytes(r["term"]): r["n"] for r in summed}
    n_docs = found.pop(b"", 0)
    return {t: found.get(t, 0) for t in terms}, n_docs


def score_documents(docs: DataFrame, index: Index, k: int = NEIGHBOURS) -> DataFrame:
    """Score of every whole text, with its neighbours as evidence.

    Null and empty texts, and texts without an indexed term, have no neighbours and the score learned from such
    examples. Repeated rows give a row each. Documents are not shuffled.
    """
    arrow = arrow_schema(SCORES)
    sent = docs.sparkSession.sparkContext.broadcast(index.fields())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Index(**sent.value), k)
        for batch in batches:
            for start, end in slices(batch.column(0)):
                part = batch.slice(start, end - start)
                out: list[list] = [[] for _ in arrow]
                for doc, text in zip(part.column(1).to_pylist(), part.column(0).to_pylist(), strict=True):
                    score, near, cosines, votes = scorer(text)
                    held = None if doc is None else zlib.crc32(str(doc).encode()) % 5 == 0
                    for col, value in zip(out, (doc, held, score, int(score >= 0.5), near, cosines, votes), strict=True):
                        col.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)

    return map_in_arrow(docs.select("text", "doc_id"), run, SCORES)
