"""N-gram Jaccard join with adaptive multi-match prefixes, and the groups that its links form.

Texts with equal shingle sets are one class. All shingles have one order, rare ones first: those that chance makes of common
words come last, others go by a counting sketch over the whole corpus. A class that links with another at the threshold shares at least ``l`` of the first ``size - need + l``
shingles with it, so each class lengthens its prefix by the ``l`` that its estimated cost asks for, and a pair is
verified only when it shares as many prefix shingles as the smaller ``l`` of both.

Prefix shingles of few classes give candidate pairs; equal lists of classes are paired once, and lists of one least class
meet before their pairs are counted. A shingle of many classes is not counted but taken to be shared; only classes
that could link by such shingles alone are chained to one of them. Bundles of classes chained by candidates are verified together: a bundle's sets travel
once, blocks of them are compared by matrix products, and each pair of blocks is a task of its own. Where many sets
are wanted, bundles are verified in turns, so that a part of the corpus' sets is on disk at a time.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import arrow_schema, map_in_arrow, schema_of
from eventloom.llm.components import components
from eventloom.session import cut_lineage, release

# Counters of the sketch, in chunks that are added up by chunk.
SKETCH_BITS = 22
CHUNK_BITS = 15
# Counters of words, in the chunks behind those of shingles.
WORD_BITS = 16
# A prefix shingle of more classes is not paired row by row.
PAIRED_CLASSES = 64
# Prefix extensions tried, and the cost of a verification in posting reads.
MAX_EXTENSION = 8
VERIFY_COST = 25.0
# Shingles and classes of a block of a bundle.
BLOCK_SHINGLES = 250_000
BLOCK_CLASSES = 800
# Share of the corpus' shingles, by rows, whose sets are moved at a time.
MOVED_SHARE = 0.25
# Bits of the filter that says whose sets are wanted; a full filter only lets more sets through.
FILTER_BITS = 1 << 26

_CASE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; link when ``whole`` * shared >= ``part`` * union."""

    words: int = 5
    part: int = 4
    whole: int = 5

    def need(self, size: int) -> int:
        """Fewest shared shingles of a link of a set of ``size``."""
        return -(-size * self.part // self.whole)


# Words are read in pieces of eight bytes; longer ones than these are hashed one by one.
_PIECE = 8
_LONG_WORD = 8 * _PIECE
_KEPT = np.array([(1 << 8 * n) - 1 for n in range(_PIECE + 1)], np.uint64)
_SPACE = np.isin(np.arange(256), list(b"\t\n\x0b\x0c\r "))


def _long_word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def _word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word, in order; words are runs of anything but ASCII white space."""
    inside = np.zeros(len(text) + 2, bool)
    inside[1:-1] = ~_SPACE[np.frombuffer(text, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, size = edges[::2], edges[1::2] - edges[::2]
    # The eight bytes at every place of the text.
    pieces = np.ndarray(len(text) + 1, "<u8", text + bytes(_PIECE), strides=(1,))
    out = size.astype(np.uint64) * _A
    longest = min(int(size.max(initial=0)), _LONG_WORD)
    for at in range(0, longest, _PIECE):
        these = np.flatnonzero(size > at) if at else slice(None)
        h = out[these] ^ (pieces[start[these] + at] & _KEPT[np.minimum(size[these] - at, _PIECE)])
        h = (h ^ (h >> np.uint64(32))) * _B
        h = (h ^ (h >> np.uint64(29))) * _A
        out[these] = h ^ (h >> np.uint64(32))
    for i in np.flatnonzero(size > _LONG_WORD).tolist():
        out[i] = _long_word_hash(text[start[i] : start[i] + size[i]])
    return out


class Shingler:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, words: int) -> None:
        self.words = words

    def word_hashes(self, text: str | None) -> np.ndarray:
        # Bytes are split at ASCII white space only.
        return _word_hashes(text.encode("utf-8", "surrogatepass").translate(_CASE) if text else b"")

    def __call__(self, text: str | None) -> np.ndarray:
        return self.of_words(self.word_hashes(text))

    def of_words(self, hashes: np.ndarray) -> np.ndarray:
        if not len(hashes):
            return hashes
        out = self._windows(hashes)
        out.sort()
        return out[np.append(True, out[1:] != out[:-1])]

    def weighed(self, text: str | None, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shingles as by a call, and the sum of the ``weights`` of each one's words; equal shingles weigh the same."""
        hashes = self.word_hashes(text)
        if not len(hashes):
            return hashes, np.zeros(0, np.int64)
        out = self._windows(hashes)
        each = weights[(hashes >> np.uint64(64 - WORD_BITS)).view(np.int64)]
        sums = sum(each[i : len(out) + i] for i in range(min(self.words, len(hashes))))
        order = np.argsort(out, kind="stable")
        out = out[order]
        kept = np.append(True, out[1:] != out[:-1])
        return out[kept], sums[order[kept]]

    def _windows(self, hashes: np.ndarray) -> np.ndarray:
        k = min(self.words, len(hashes))
        n = len(hashes) - k + 1
        out = hashes[:n] * _B
        for i in range(1, k):
            out = (out ^ (out >> np.uint64(31))) * _A + hashes[i : n + i]
        if len(hashes) < self.words:
            # A short text is one shingle, unlike any of full length.
            out = out + np.uint64(len(hashes))
        out = (out ^ (out >> np.uint64(29))) * _B
        out ^= out >> np.uint64(32)
        return out


def _digest(shingles: np.ndarray, salt: int) -> tuple[int, int]:
    raw = hashlib.blake2b(shingles.tobytes(), digest_size=16, salt=salt.to_bytes(8, "little")).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


_SCANNED = schema_of("doc_id bigint, n bigint, key bigint, check bigint, chunk int, spread int, counts binary")


def _packed(counts: np.ndarray) -> bytes:
    """Counters as bytes, one byte of each after the other: a task's are small, so most of them are zeros."""
    return zlib.compress(counts.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1).T).view("<u8").ravel().astype(np.int64)


def _scan(docs: DataFrame, rule: Rule, salt: int) -> DataFrame:
    """Set size and class key of every row, and at the end of a task the chunks of its part of the sketch and of the word counts."""
    arrow = arrow_schema(_SCANNED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(rule.words)
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        words = np.zeros(1 << WORD_BITS, np.int64)
        spread = 0
        for batch in batches:
            sizes, keys, checks = [], [], []
            ids = batch.column(0).cast(pa.int64())
            for i in range(batch.num_rows):
                hashes = shingler.word_hashes(batch.column(1)[i].as_py())
                own = shingler.of_words(hashes)
                sizes.append(len(own))
                key, check = _digest(own, salt) if len(own) else (None, None)
                keys.append(key)
                checks.append(check)
                if len(own):
                    np.add.at(sketch, (own >> np.uint64(64 - SKETCH_BITS)).view(np.int64), 1)
                    np.add.at(words, (hashes >> np.uint64(64 - WORD_BITS)).view(np.int64), 1)
                    spread = (spread + (key or 0)) & 31
            none = pa.nulls(batch.num_rows)
            cols = [ids, pa.array(sizes), pa.array(keys, pa.int64()), pa.array(checks, pa.int64()), none, none, none]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)
        size = 1 << CHUNK_BITS
        counts = [_packed(part[at : at + size]) for part in (sketch, words) for at in range(0, len(part), size)]
        none = pa.nulls(len(counts))
        cols = [none, none, none, none, pa.array(range(len(counts))), pa.array([spread] * len(counts)), pa.array(counts)]
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return map_in_arrow(docs.select("doc_id", "text"), run, _SCANNED)


def _sketch(scanned: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sums of all tasks' sketches and word counts, by way of 32 partial sums a chunk; their sizes are fixed."""

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << CHUNK_BITS, np.int64)
        for counts in parts["counts"]:
            total += _unpacked(counts)
        return pd.DataFrame({"chunk": [parts["chunk"].iloc[0]], "counts": [_packed(total)]})

    out = scanned.where("chunk IS NOT NULL").select("chunk", "spread", "counts")
    for keys in (["chunk", "spread"], ["chunk"]):
        out = out.groupBy(*keys).applyInPandas(add, "chunk int, counts binary")
    totals = np.zeros(1 << SKETCH_BITS, np.int32), np.zeros(1 << WORD_BITS, np.int64)
    summed = cut_lineage(out, drop_shuffles=True)
    for row in summed.collect():
        start, counts = row["chunk"] << CHUNK_BITS, _unpacked(row["counts"])
        if start < 1 << SKETCH_BITS:
            totals[0][start : start + len(counts)] = np.minimum(counts, np.iinfo(np.int32).max)
        else:
            totals[1][start - (1 << SKETCH_BITS) :][: len(counts)] = counts
    release(summed)
    return totals


def prefix_order(seen: np.ndarray, weights: np.ndarray, usual: float) -> np.ndarray:
    """Order of a set's shingles, rare ones first, from what is the same for a shingle in every set.

    ``seen`` are counters of the sketch. ``weights`` are sixteenths of the logarithm of how often chance makes a shingle
    of its words, over what is ``usual``: twice to one step up, and none below a quarter.
    """
    steps = np.maximum((weights - round(usual)) // 32 + 2, 0)
    # Shingles lie in their order already, which settles ties.
    return np.argsort((steps << 32) + seen, kind="stable")


def extension(seen: np.ndarray, size: int, need: int) -> int:
    """Prefix extension of least estimated cost; ``seen`` are the others expected at each shingle, in prefix order.

    A longer prefix reads more postings; asking for ``l`` matches leaves at most an l-th of the met classes to verify.
    """
    base = size - need
    most = min(MAX_EXTENSION, need)
    lengths = base + np.arange(1, most + 1)
    met = np.cumsum(seen)[lengths - 1]
    return int(np.argmin(lengths + met + VERIFY_COST * met / np.arange(1, most + 1))) + 1


_POSTINGS = schema_of("token bigint, key bigint, n int, ell int")


def _postings(docs: DataFrame, rule: Rule, salt: int, sketch: np.ndarray, words: np.ndarray) -> DataFrame:
    """Prefix shingles of every class; a task names a class once, as long as it remembers it."""
    arrow = arrow_schema(_POSTINGS)
    noise = int(np.median(sketch))
    # Logarithms in whole sixteenths add up to the same in any order.
    logs = np.round(16 * np.log2(words + 1.0)).astype(np.int64)
    usual = 16 * (rule.words - 1) * float(np.log2(words.sum() + 1.0))
    # Two bytes a counter: those far below the usual count as rare, those far above as common, whatever their number.
    least = max(0, noise - 16 * int(noise**0.5 + 1))
    sent = docs.sparkSession.sparkContext.broadcast(((np.clip(sketch, least, least + 65535) - np.int32(least)).astype(np.uint16), logs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (counts, logs), shingler, done = sent.value, Shingler(rule.words), set()
        for batch in batches:
            held, cols = 0, ([], [], [], [])
            for i in range(batch.num_rows):
                own, weights = shingler.weighed(batch.column(0)[i].as_py(), logs)
                if not len(own):
                    continue
                key = _digest(own, salt)[0]
                if key in done:
                    continue
                if len(done) > 50_000:
                    done.clear()
                done.add(key)
                seen = counts[(own >> np.uint64(64 - SKETCH_BITS)).view(np.int64)].astype(np.int64) + least
                need = rule.need(len(own))
                longest = min(len(own), len(own) - need + min(MAX_EXTENSION, need))
                order = prefix_order(seen, weights, usual)[:longest]
                # What the sketch cannot tell from chance counts as one standard deviation.
                others = np.maximum(seen[order].astype(np.float64) - max(noise, 1), noise**0.5)
                ell = extension(others, len(own), need)
                tokens = own[order[: len(own) - need + ell]].view(np.int64)
                for col, value in zip(cols, (tokens, key, len(own), ell), strict=True):
                    col.append(tokens if col is cols[0] else np.full(len(tokens), value))
                held += len(tokens)
                if held > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)
                    held, cols = 0, ([], [], [], [])
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return map_in_arrow(docs.select("text"), run, _POSTINGS)


_SIDE = {"key": "", "n": "n", "ell": "l"}


def _lists(cold: DataFrame) -> DataFrame:
    """The classes of each prefix shingle of few, in order."""
    return cold.groupBy("token").agg(F.array_sort(F.collect_list(F.struct("key", "n", "ell"))).alias("l")).select("l")


def _candidates(lists: DataFrame, held: DataFrame, rule: Rule) -> DataFrame:
    """Pairs u < v of fitting sizes that share enough prefix shingles; lists are short, so they fit a row.

    Lists are dealt by their least class and equal ones made one, so pairs of a cluster are mostly added up where they
    are made, and what travels grows with the pairs, not with the shingles they share.

    ``held`` has the number of a class' prefix shingles of many classes, which are in no list: a pair may share those of both.

    Of the shingles that a pair shares, those in the prefix that ends first are in both prefixes; the others are in the
    rest of that class. So a link also needs as many matches as its own sizes ask for beyond the longer rest.
    """
    lists = lists.withColumn("least", F.col("l")[0]["key"]).repartition("least").groupBy("least", "l").agg(F.count(F.lit(1)).alias("times"))
    pairs = F.flatten(
        F.transform(
            "l",
            lambda a, i: F.transform(
                F.filter(
                    F.slice("l", i + 2, PAIRED_CLASSES),
                    lambda b: F.least(a["n"], b["n"]) * rule.whole >= F.greatest(a["n"], b["n"]) * rule.part,
                ),
                lambda b: F.struct(
                    *[a[c].alias(f"{name}u") for c, name in _SIDE.items()], *[b[c].alias(f"{name}v") for c, name in _SIDE.items()]
                ),
            ),
        )
    )
    met = lists.select("times", F.explode(pairs).alias("p")).select("times", "p.*")
    counted = met.groupBy("u", "v").agg(
        F.sum("times").alias("shared"), *[F.first(c).alias(c) for c in ("nu", "nv", "lu", "lv")]
    )
    for side in "uv":
        counted = counted.join(held.select(F.col("key").alias(side), F.col("hot").alias(f"h{side}")), side, "left")
    counted = counted.withColumn("shared", F.col("shared") + F.least(*[F.coalesce(h, F.lit(0)) for h in ("hu", "hv")]))
    rest = [F.ceil(F.col(f"n{s}") * rule.part / rule.whole) - F.col(f"l{s}") for s in "uv"]
    least = F.ceil((F.col("nu") + F.col("nv")) * rule.part / (rule.whole + rule.part)) - F.greatest(*rest)
    return counted.where((F.col("shared") >= F.least("lu", "lv")) & (F.col("shared") >= least)).select("u", "v")


def _chains(hot: DataFrame) -> DataFrame:
    """Edges u, v that chain the classes of each shingle of many which may link by such shingles alone.

    A link asks for the lesser ``ell`` of both. A pair with fewer hot shingles on either side shares a cold one as well,
    so one of a pair that does not has as many as its own ``ell``, and the other as many as that.
    """
    asked = F.min(F.when(F.col("hot") >= F.col("ell"), F.col("ell"))).alias("asked")
    alone = hot.join(hot.groupBy("token").agg(asked).where("asked IS NOT NULL"), "token").where("hot >= asked")
    centres = alone.groupBy("token").agg(F.min("key").alias("v"))
    return alone.join(centres, "token").select(F.col("key").alias("u"), "v").where("u <> v").distinct()


def _wanted_bits(keys: DataFrame, column: str = "key") -> tuple[int, dict[int, bytes]]:
    """Bit filter of the class keys, or another ``column``, of bounded size: bits and its pages of 32,768 bits."""
    n = keys.count()
    bits = min(FILTER_BITS, 1 << max(16, (64 * n).bit_length()))
    bit = F.col(column).bitwiseAND(F.lit(bits - 1)) + 1
    pages = keys.groupBy(F.call_function("bitmap_bucket_number", bit).alias("page")).agg(
        F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", bit)).alias("bitmap")
    )
    return bits, {r["page"] - 1: bytes(r["bitmap"]) for r in pages.collect()}


def _has(bits: int, pages: dict[int, bytes], key: int) -> bool:
    page, place = divmod(key & (bits - 1), 32768)
    return page in pages and bool(pages[page][place >> 3] >> (place & 7) & 1)


def _sets(docs: DataFrame, rule: Rule, salt: int, keys: DataFrame) -> DataFrame:
    """Shingle sets of the classes in ``keys``, and some more. Texts are read again; only wanted sets leave their task."""
    bits, pages = _wanted_bits(keys)
    schema = schema_of("key bigint, shingles binary")
    arrow = arrow_schema(schema)
    sent = docs.sparkSession.sparkContext.broadcast(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, done, wanted = Shingler(rule.words), set(), sent.value
        for batch in batches:
            found, own_sets, held = [], [], 0
            for i in range(batch.num_rows):
                own = shingler(batch.column(0)[i].as_py())
                if not len(own):
                    continue
                key = _digest(own, salt)[0]
                if key in done or not _has(bits, wanted, key):
                    continue
                if len(done) > 50_000:
                    done.clear()
                done.add(key)
                found.append(key)
                own_sets.append(own.tobytes())
                held += own.nbytes
                if held > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(own_sets, pa.binary())], schema=arrow)
                    found, own_sets, held = [], [], 0
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(own_sets, pa.binary())], schema=arrow)

    return map_in_arrow(docs.select("text"), run, schema)


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``left`` with every set of ``right``, by products of slices."""
    tokens = np.concatenate([*left, *right])
    _, inverse, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    # Only shingles of two sets can be shared; they get the numbers of the columns.
    column = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)[inverse]
    rows = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    kept = column >= 0
    rows, column = rows[kept], column[kept]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    width = 1024
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [start, start + width])
        part = np.zeros((len(left) + len(right), width), np.float32)
        part[rows[lo:hi], column[lo:hi] - start] = 1
        out += part[: len(left)] @ part[len(left) :].T
    return out


def _compare_blocks(group: pd.DataFrame, rule: Rule) -> pd.DataFrame:
    """Links between two blocks of a bundle (or within one): per class its linked rows, and edges that span the links."""
    first = int(group["i"].iloc[0])
    second = int(group["j"].iloc[0])
    group = group.sort_values("key")
    sides = [group[group["block"] == b] for b in (first, second)]
    sets = [[np.frombuffer(s, np.uint64) for s in side["shingles"]] for side in sides]
    if not len(sides[0]) or not len(sides[1]):
        return pd.DataFrame({"u": [], "v": [], "links": []})
    shared = shared_counts(sets[0], sets[1])
    sizes = [np.array([len(s) for s in own], np.float64) for own in sets]
    linked = rule.whole * shared >= rule.part * (sizes[0][:, None] + sizes[1][None, :] - shared)
    if first == second:
        np.fill_diagonal(linked, False)
    keys = [side["key"].to_numpy() for side in sides]
    rows = [side["rows"].to_numpy() for side in sides]
    out = [(keys[0], linked @ rows[1])]
    if first != second:
        out.append((keys[1], linked.T @ rows[0]))
    u, v = [], []
    # Spanning edges: every class with its least partner of the other side, then the least partners with each other.
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, row in zip(keys[0].tolist(), linked, strict=True):
        for b in keys[1][row].tolist():
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
                u.append(a)
                v.append(b)
    own = np.concatenate([k for k, _ in out])
    links = np.concatenate([n for _, n in out])
    met = links > 0
    return pd.DataFrame(
        {
            "u": np.concatenate([own[met], np.array(u, np.int64)]),
            "v": pd.array([None] * int(met.sum()) + v, "Int64"),
            "links": np.concatenate([links[met].astype(np.int64), np.zeros(len(u), np.int64)]),
        }
    )


GROUPED = schema_of("u bigint, v bigint, links bigint")


def _verify_bundles(members: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Rows (u, null, linked rows) and spanning edges (u, v, 0) of all bundles; members has key, bundle, n and rows."""
    sized = members.groupBy("bundle").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("classes"))
    blocks = F.ceil(F.greatest(F.col("total") / BLOCK_SHINGLES, F.col("classes") / BLOCK_CLASSES)).cast("int")
    placed = members.join(sized.select("bundle", blocks.alias("blocks")), "bundle").withColumn(
        "block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    )
    every = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least(o, F.col("block")).alias("i"), F.greatest(o, F.col("block")).alias("j")),
    )
    dealt = (
        sets.join(placed, "key")
        .dropDuplicates(["key"])
        .select("key", "bundle", "block", "rows", "shingles", F.explode(every).alias("p"))
        .select("key", "bundle", "block", "rows", "shingles", "p.i", "p.j")
    )
    return dealt.groupBy("bundle", "i", "j").applyInPandas(lambda g: _compare_blocks(g, rule), GROUPED)


def _verify(docs: DataFrame, rule: Rule, salt: int, members: DataFrame, total: int) -> list[DataFrame]:
    """``_verify_bundles`` of all bundles, written; bundles take turns when ``MOVED_SHARE`` of ``total`` shingles is not enough."""
    held = members.agg(F.sum(F.col("n") * F.col("rows"))).first()[0] or 0
    turns = max(1, -(-held // max(1, int(MOVED_SHARE * total))))
    found = []
    for turn in range(turns):
        own = members.where(F.pmod(F.xxhash64("bundle"), F.lit(turns)) == turn)
        found.append(cut_lineage(_verify_bundles(own, _sets(docs, rule, salt, own.select("key")), rule), drop_shuffles=True))
    return found


def _classes_and_groups(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame, int]:
    """Rows (doc_id, n, key), classes (key, root, n_links, component_id) and the salt of the keys."""
    salt = 0
    while True:
        scanned = cut_lineage(_scan(docs, rule, salt))
        rows = scanned.where("chunk IS NULL").select("doc_id", "n", "key", "check")
        classes = cut_lineage(
            rows.where("n > 0")
            .groupBy("key", "check", "n")
            .agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")),
            drop_shuffles=True,
        )
        # Keys are 64 of 128 digest bits; should two classes ever share one, all are keyed anew.
        if classes.groupBy("key").count().where("count > 1").isEmpty():
            break
        salt += 1
    total = classes.agg(F.sum(F.col("n") * F.col("rows"))).first()[0] or 0
    postings = cut_lineage(_postings(docs, rule, salt, *_sketch(scanned)).dropDuplicates(["token", "key"]), drop_shuffles=True)
    met = cut_lineage(postings.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), drop_shuffles=True)
    lists = cut_lineage(_lists(postings.join(met.where(F.col("df") <= PAIRED_CLASSES), "token")), drop_shuffles=True)
    hot_tokens = cut_lineage(met.where(F.col("df") > PAIRED_CLASSES))
    hot = cut_lineage(postings.join(hot_tokens, "token"), drop_shuffles=True)
    release(postings, met, hot_tokens)
    held = cut_lineage(hot.groupBy("key").agg(F.count(F.lit(1)).alias("hot")), drop_shuffles=True)
    chained = components(_candidates(lists, held, rule).unionByName(_chains(hot.join(held, "key"))))
    bundles = chained.withColumnsRenamed({"node": "key", "root": "bundle"})
    members = cut_lineage(classes.select("key", "n", "rows").join(bundles, "key"), drop_shuffles=True)
    release(lists, hot, held, chained)
    parts = _verify(docs, rule, salt, members, total)
    found = reduce(DataFrame.unionByName, parts)
    roots = components(found.where("v IS NOT NULL").select("u", "v"))
    links = found.where("v IS NULL").groupBy("u").agg(F.sum("links").alias("links"))
    named = (
        classes.join(roots.select(F.col("node").alias("key"), "root"), "key", "left")
        .join(links.withColumnRenamed("u", "key"), "key", "left")
        .select("key", "least", F.coalesce("root", "key").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"))
    )
    named = cut_lineage(named, drop_shuffles=True)
    release(*parts, members, roots, classes)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = named.join(least, "root").select("key", "root", "n_links", "component_id")
    return rows, known, salt


def jaccard_groups(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): set size, number of other rows it links with, smallest id of its group.

    Words are runs of anything but ASCII white space, A-Z lower-cased; fewer words than a shingle are one shingle. Null
    texts and texts without words have no set, no links and their own id. Rows with equal sets link. Repeated rows
    are rows; a null id is in its group but never its smallest, so a group of null ids only has a null id. Shingles
    are compared by 64-bit hashes of their words.
    """
    rows, known, _ = _classes_and_groups(docs, rule)
    full = rows.where("n > 0").join(known, "key").select("doc_id", "n", "n_links", "component_id")
    empty = rows.where("n = 0").select("doc_id", "n", F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty).withColumnRenamed("n", "n_shingles")


def one_of_each_group(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Rows of ``docs``, with all their columns, that stay when one row of each group does.

    The row of the smallest id stays (of equal ids the smallest class key, of equal rows one); rows without a set are
    in no group and all stay. A group of null ids keeps one row.
    """
    rows, known, salt = _classes_and_groups(docs, rule)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "key"))
    found = cut_lineage(rows.where("n > 0").join(known.select("key", "root"), "key").select("doc_id", "key", "root"), drop_shuffles=True)
    kept = found.groupBy("root").agg(first.alias("f"))
    kept = kept.select(*_place(F.col("f.doc_id")), F.col("f.key").alias("key"), F.lit(True).alias("stays"))
    named = found.groupBy(*_place(F.col("doc_id")), "key").agg(F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    named = named.join(kept, ["id", "missing", "key"], "left").withColumn("kept", F.col("stays").isNotNull())
    named = cut_lineage(named.withColumns({"slot": F.xxhash64("doc_id"), "mark": _mark(F.col("doc_id"), F.col("key"))}), drop_shuffles=True)
    release(found)
    open_ids = _wanted_bits(named.where("NOT kept OR copies > 1"), "slot")
    kept_rows = _wanted_bits(named.where("kept"), "mark")
    # Whose id is not in the first filter stays. Of the others, those outside the second go, and few are left to be joined.
    sent = docs.sparkSession.sparkContext.broadcast((open_ids, kept_rows))
    sure, left = _sure(docs, sent), _left(docs, rule, salt, sent)
    chosen = named.where("kept").select("id", "missing", "key")
    copy = F.row_number().over(Window.partitionBy("id", "missing", "key").orderBy("id"))
    met = left.select("row", *_place(F.col("id")), "key").join(chosen, ["id", "missing", "key"]).withColumn("copy", copy)
    return sure.unionByName(met.where("copy = 1").select("row.*"))


def _mark(doc_id: Column, key: Column) -> Column:
    return key.bitwiseXOR(F.coalesce(doc_id, F.lit(-1)).cast("long"))


def _place(doc_id: Column) -> list[Column]:
    """Id as two columns that are never null, so that a join and a window need the same exchange."""
    return [F.coalesce(doc_id, F.lit(0)).cast("long").alias("id"), doc_id.isNull().alias("missing")]


def _slotted(docs: DataFrame) -> DataFrame:
    """Rows as one column beside their id and its slot in the filter of open ids."""
    ids = docs["doc_id"].cast("long")
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), ids.alias("id"), F.xxhash64(ids).alias("slot"))


def _sure(docs: DataFrame, sent: Broadcast) -> DataFrame:
    """Rows that stay whatever their set: all of ids that are not open, and those without words."""
    place = docs.columns.index("text")
    kept = _slotted(docs).select("row", "slot")
    schema = T.StructType(kept.schema.fields[:1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (bits, pages), _ = sent.value
        shingler = Shingler(1)
        for batch in batches:
            texts = batch.column(0).field(place)
            slots = batch.column(1).to_pylist()
            keep = [not _has(bits, pages, slot) or not len(shingler.word_hashes(texts[i].as_py())) for i, slot in enumerate(slots)]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep, pa.bool_()))], names=["row"])

    return map_in_arrow(kept, run, schema).select("row.*")


def _left(docs: DataFrame, rule: Rule, salt: int, sent: Broadcast) -> DataFrame:
    """Rows of open ids that may stay, as one column beside their id and class key; rows without words are left out."""
    place = docs.columns.index("text")
    kept = _slotted(docs)
    schema = T.StructType([*kept.schema.fields[:2], T.StructField("key", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (bits, pages), (row_bits, row_pages) = sent.value
        shingler = Shingler(rule.words)
        for batch in batches:
            texts, ids, slots = batch.column(0).field(place), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            places, keys = [], []
            for i, slot in enumerate(slots):
                own = shingler(texts[i].as_py()) if _has(bits, pages, slot) else ()
                key = _digest(own, salt)[0] if len(own) else None
                if key is not None and _has(row_bits, row_pages, key ^ (-1 if ids[i] is None else ids[i])):
                    places.append(i)
                    keys.append(key)
            rows = batch.take(pa.array(places, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(keys, pa.int64())], names=["row", "id", "key"])

    return map_in_arrow(kept, run, schema)
