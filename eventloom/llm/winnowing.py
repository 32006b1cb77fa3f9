"""Document fingerprints by winnowing, and their likeness between a text, its edit and the next document.

Every k-gram of code points gets a rolling hash; of each window of ``w`` consecutive hashes the least is chosen, the
rightmost of equal ones. So two texts that share ``w + k - 1`` code points share a chosen hash, and its place is kept.

The next document in the order of ids is needed beside each document. Documents are dealt by ranges of ids, and the
first document of a range is also dealt to the range before it, so one shuffle brings together what is compared.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import arrow_schema, map_in_arrow, schema_of

K = 8
W = 12
# Documents of a range of ids.
RANGE_ROWS = 2048
# Code points hashed at a time; neighbouring pieces overlap by a window, so the result does not depend on it.
PIECE = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(0xFFFFFFFF)


def gram_hashes(codes: np.ndarray, k: int = K) -> np.ndarray:
    """32-bit hash of every k-gram, by joining the polynomial hashes of shorter runs; the whole text if it is shorter."""
    codes = codes.astype(np.uint64) + np.uint64(1)
    k = min(k, len(codes))
    total, done, power = None, 0, codes
    factor, length = _BASE, 1
    # Binary powers: a run of 2n is two runs of n, and k is put together from the runs of its bits.
    with np.errstate(over="ignore"):
        while True:
            if k & length:
                if total is None:
                    total, done = power, length
                else:
                    n = len(codes) - done - length + 1
                    total = total[:n] * factor + power[done : done + n]
                    done += length
            if done == k:
                break
            n = len(codes) - 2 * length + 1
            power = power[:n] * factor + power[length : length + n]
            factor, length = factor * factor, 2 * length
        total = total[: len(codes) - k + 1]
        total = (total ^ (total >> np.uint64(32))) * _MIX
    return (total ^ (total >> np.uint64(29))) >> np.uint64(32)


def choose(hashes: np.ndarray, w: int = W) -> np.ndarray:
    """Places of the hashes that are least in some window, rightmost of equal ones, in order."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64)
    w = min(w, n)
    # Later places count as less among equal hashes.
    keys = (hashes << np.uint64(32)) | (_LOW - np.arange(n, dtype=np.uint64))
    least, length = keys, 1
    while 2 * length <= w:
        least = np.minimum(least[: n - 2 * length + 1], least[length : n - length + 1])
        length *= 2
    m = n - w + 1
    least = np.minimum(least[:m], least[w - length : w - length + m])
    places = (_LOW - (least & _LOW)).astype(np.int64)
    return places[np.concatenate([[True], places[1:] != places[:-1]])]


def fingerprint(text: str, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes and their places, in code points, of a whole text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    hashes, places = [], []
    last = -1
    for at in range(0, len(codes), PIECE):
        part = codes[at : at + PIECE + k + w - 2]
        if at and len(part) < k + w - 1:
            break
        own = gram_hashes(part, k)
        chosen = choose(own, w)
        chosen = chosen[chosen + at > last]
        if len(chosen):
            last = int(chosen[-1]) + at
            hashes.append(own[chosen].astype(np.uint32))
            places.append(chosen + at)
    return np.concatenate(hashes), np.concatenate(places)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared share of the distinct hashes of both; two empty fingerprints are alike."""
    a, b = np.unique(a), np.unique(b)
    union = len(np.union1d(a, b))
    return (len(a) + len(b) - union) / union if union else 1.0


def edited(text: str, following: str) -> str:
    """The last half replaced by the start of the next text, or by all of it if it is shorter."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def shown(hashes: np.ndarray) -> str:
    """Hashes in the order of the text, eight hexadecimal digits each."""
    return hashes.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Chosen hashes and places of every whole text: doc_id, hashes, places. Null texts have none; no shuffle."""
    schema = schema_of("doc_id bigint, hashes bigints, places bigints")
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t.as_py() or "", k, w) for t in batch.column(1)]
            cols = [batch.column(0).cast(pa.int64()), pa.array([h.astype(np.int64) for h, _ in made], arrow[1].type), pa.array([p for _, p in made], arrow[2].type)]
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return map_in_arrow(docs.select("doc_id", "text"), run, schema)


EDITS = schema_of(
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_DEALT = schema_of("range bigint, tail boolean, missing boolean, doc_id bigint, text string")


def compare_with_next(docs: DataFrame, k: int = K, w: int = W, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprints of every whole text and of its edit, and their likenesses, as one row per row of ``docs``.

    Next is the next row by (doc_id, text), null ids first and null texts as empty ones; after the last comes the first,
    so a single row follows itself. Texts cross the network once, and a task holds two documents at a time.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = keyed.count()
    if not rows:
        return docs.sparkSession.createDataFrame([], EDITS)
    parts = -(-rows // range_rows)
    # Bounds are ids that occur; a range starts at its bound. Null ids come before all.
    points = [i / parts for i in range(1, parts)]
    found = keyed.agg(
        F.min("doc_id").alias("least"),
        F.max(F.col("doc_id").isNull()).alias("missing"),
        F.percentile_approx("doc_id", points or [0.5], 10_000 + 4 * parts).alias("bounds"),
    ).first()
    first = None if found["missing"] else found["least"]
    bounds = sorted({b for b in (found["bounds"] or []) if points and b > found["least"]})
    if found["missing"] and found["least"] is not None:
        bounds = sorted({*bounds, found["least"]})
    starts = {b: i for i, b in enumerate(bounds)}
    last = len(bounds)
    dealt = arrow_schema(_DEALT)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, pick, ranges, tails = batch.column(0).to_pylist(), [], [], []
            for i, doc in enumerate(ids):
                pick.append(i)
                ranges.append(0 if doc is None else bisect_right(bounds, doc))
                tails.append(False)
                if doc in starts:
                    pick.append(i)
                    ranges.append(starts[doc])
                    tails.append(True)
                if doc == first:
                    pick.append(i)
                    ranges.append(last)
                    tails.append(True)
            if pick:
                at = pa.array(pick)
                own = batch.column(0).take(at)
                cols = [pa.array(ranges, pa.int64()), pa.array(tails), own.is_null(), own, batch.column(1).take(at).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(cols, schema=dealt)

    # Tails of the last range are the first document: they follow the tails of no other, since it has no next range.
    sent = map_in_arrow(keyed, deal, _DEALT).repartition(max(1, parts), "range")
    ordered = sent.sortWithinPartitions(
        "range", "tail", F.col("missing").desc(), "doc_id", F.coalesce("text", F.lit(""))
    )
    arrow = arrow_schema(EDITS)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for i in range(batch.num_rows):
                own, tail = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if tail and (held is None or held[0] != own):
                    continue
                text = batch.column(4)[i].as_py() or ""
                made = fingerprint(text, k, w)[0]
                if held is not None:
                    out.append(_compared(held, text, made, k, w))
                    size += len(text)
                # Only the first tail of a range is its next document.
                held = None if tail else (own, batch.column(3)[i].as_py(), text, made)
                if size > 4_000_000:
                    yield _batch(out, arrow)
                    out, size = [], 0
            if out:
                yield _batch(out, arrow)

    return map_in_arrow(ordered, compare, EDITS)


def _compared(held: tuple, following: str, following_hashes: np.ndarray, k: int, w: int) -> tuple:
    _, doc, text, hashes = held
    changed = edited(text, following)
    other = fingerprint(changed, k, w)[0]
    digest = hashlib.sha256(changed.encode("utf-8")).hexdigest()
    return doc, len(text), digest, shown(hashes), shown(other), likeness(hashes, other), likeness(hashes, following_hashes)


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)
