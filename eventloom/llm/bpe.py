"""Byte-pair encoding and decoding with a segment tree over the ranks of adjacent pairs.

The leaves of a word's tree hold the rank of the pair that starts there, with its place behind it, so the root is the
leftmost pair of lowest rank. A merge changes three leaves, each with logarithmic work up to the root, and goes on
until no pair has a rank. Distinct words of a slice are encoded together: their trees are the rows of one array, and
every step merges once in each row that still has a pair.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventloom.llm.common import arrow_schema, map_in_arrow, schema_of, slices

# A worker remembers so many words; then it starts anew. Only speed depends on it.
REMEMBERED = 150_000
NONE = np.int64(1) << 62

# Fixed value: the pattern by which byte-level vocabularies of this family split a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in vocabulary files: printable Latin-1 as itself, the others from U+0100 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@dataclass
class Vocabulary:
    """Merges as sorted pair keys with rank and merged id; bytes of every id; special tokens by text."""

    first_ids: np.ndarray
    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    pair_ids: np.ndarray
    pieces: dict[int, bytes]
    special: dict[str, int]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair; ``NONE`` and -1 where the pair does not merge."""
        keys = left * 1_000_003 + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        ok = (self.pair_keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(ok, self.pair_ranks[at], NONE), np.where(ok, self.pair_ids[at], -1)


def load(path: str) -> Vocabulary:
    """Vocabulary of a byte-level BPE file; other kinds of files are refused."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model, split = data["model"], data["pre_tokenizer"]
    if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or data["normalizer"]:
        raise ValueError(f"{path} is no byte-level BPE file without normaliser and prefix space")
    letters = byte_letters()
    vocab = model["vocab"]
    pieces = {i: bytes(letters[c] for c in token) for token, i in vocab.items()}
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    pieces |= {i: token.encode("utf-8") for token, i in special.items()}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    left = np.array([vocab[a] for a, _ in merges], np.int64)
    right = np.array([vocab[b] for _, b in merges], np.int64)
    ids = np.array([vocab[a + b] for a, b in merges], np.int64)
    keys = left * 1_000_003 + right
    order = np.argsort(keys)
    firsts = np.full(256, -1, np.int64)
    for letter, byte in letters.items():
        firsts[byte] = vocab.get(letter, -1)
    return Vocabulary(firsts, keys[order], np.arange(len(merges))[order], ids[order], pieces, special)


def encode_words(vocabulary: Vocabulary, words: list[bytes]) -> list[list[int]]:
    """Token ids of each word; words are encoded in groups of one tree size."""
    out: list[list[int]] = [[] for _ in words]
    sizes: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        if word:
            sizes.setdefault(max(2, 1 << (len(word) - 1).bit_length()), []).append(i)
    for leaves, rows in sizes.items():
        step = max(1, 65536 // leaves)
        for at in range(0, len(rows), step):
            own = rows[at : at + step]
            for i, ids in zip(own, _encode_group(vocabulary, [words[i] for i in own], leaves), strict=True):
                out[i] = ids
    return out


def _encode_group(vocabulary: Vocabulary, words: list[bytes], leaves: int) -> list[list[int]]:
    n = len(words)
    lengths = np.array([len(w) for w in words])
    codes = np.frombuffer(b"".join(w.ljust(leaves, b"\0") for w in words), np.uint8).reshape(n, leaves)
    places = np.arange(leaves)
    ids = np.where(places < lengths[:, None], vocabulary.first_ids[codes], -1)
    after = np.where(places + 1 < lengths[:, None], places + 1, -1) + np.zeros((n, 1), np.int64)
    before = places - 1 + np.zeros((n, 1), np.int64)
    merged = np.full((n, leaves), -1, np.int64)
    tree = np.full((n, 2 * leaves), NONE, np.int64)
    rank, made = vocabulary.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel())
    rank, made = rank.reshape(n, leaves - 1), made.reshape(n, leaves - 1)
    merged[:, :-1] = made
    tree[:, leaves : 2 * leaves - 1] = np.where(rank < NONE, rank * leaves + places[:-1], NONE)
    for level in range(leaves.bit_length() - 2, -1, -1):
        low = 1 << level
        np.minimum(tree[:, 2 * low : 4 * low : 2], tree[:, 2 * low + 1 : 4 * low : 2], out=tree[:, low : 2 * low])
    live = np.flatnonzero(tree[:, 1] < NONE)
    while len(live):
        at = tree[live, 1] % leaves
        gone = after[live, at]
        ids[live, at] = merged[live, at]
        ids[live, gone] = -1
        follower = after[live, gone]
        after[live, at] = follower
        has = follower >= 0
        before[live[has], follower[has]] = at[has]
        _put(tree, live, gone, np.full(len(live), NONE), leaves)
        _renew(vocabulary, tree, ids, merged, live, at, follower, leaves)
        prior = before[live, at]
        has = prior >= 0
        _renew(vocabulary, tree, ids, merged, live[has], prior[has], at[has], leaves)
        live = live[tree[live, 1] < NONE]
    return [row[row >= 0].tolist() for row in ids]


def _renew(vocabulary, tree, ids, merged, rows, at, follower, leaves) -> None:
    """Pair that starts at ``at`` after one of its sides changed; there is none without a follower."""
    right = np.where(follower >= 0, ids[rows, follower], -1)
    rank, made = vocabulary.ranks(ids[rows, at], right)
    merged[rows, at] = made
    _put(tree, rows, at, np.where(rank < NONE, rank * leaves + at, NONE), leaves)


def _put(tree: np.ndarray, rows: np.ndarray, at: np.ndarray, values: np.ndarray, leaves: int) -> None:
    """Point update of one leaf in each row, up to the root."""
    node = at + leaves
    tree[rows, node] = values
    while leaves > 1:
        node >>= 1
        tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
        leaves >>= 1


class Codec:
    """Encoder and decoder of a worker, with the words it remembers."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        import regex

        self.vocabulary = vocabulary
        self.split = regex.compile(PATTERN)
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.known: dict[str, tuple[int, ...]] = {}
        size = max(vocabulary.pieces, default=0) + 1
        self.pieces = [vocabulary.pieces.get(i, b"") for i in range(size)]
        self.names = [str(i) for i in range(size)]

    def words(self, text: str) -> list[str]:
        """Words of a text; special tokens stand for themselves."""
        if self.specials is None or not self.specials.search(text):
            return self.split.findall(text)
        parts = self.specials.split(text)
        return [w for i, p in enumerate(parts) for w in ([p] if i % 2 else self.split.findall(p))]

    def encode(self, texts: list[str | None]) -> Iterator[list[int]]:
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        if not known:
            known.update({t: (i,) for t, i in self.vocabulary.special.items()})
        split = [self.words(t) if t else [] for t in texts]
        fresh = list(set(chain.from_iterable(split)).difference(known))
        encoded = encode_words(self.vocabulary, [w.encode("utf-8") for w in fresh])
        known.update(zip(fresh, map(tuple, encoded), strict=True))
        for own in split:
            yield list(chain.from_iterable(map(known.__getitem__, own)))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")


def _codec(sent) -> Codec:
    """Codec of a task; what it remembers goes with the task, while the vocabulary stays with the worker."""
    return Codec(Vocabulary(**sent.value))


def _sent(df: DataFrame, path: str):
    return df.sparkSession.sparkContext.broadcast(vars(load(path)))


TOKENS = schema_of("doc_id bigint, ids ints")
DIGESTS = schema_of("doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _coded(docs: DataFrame, path: str, schema, row) -> DataFrame:
    sent = _sent(docs, path)
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent)
        for batch in batches:
            for start, end in slices(batch.column(1), 1_000_000):
                part = batch.slice(start, end - start)
                encoded = codec.encode(part.column(1).to_pylist())
                rows = [row(codec, doc, ids) for doc, ids in zip(part.column(0).to_pylist(), encoded, strict=True)]
                cols = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return map_in_arrow(docs.select("doc_id", "text"), run, schema)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Token ids of every whole text by the vocabulary file ``path``, which every machine has.

    Null and empty texts have no ids; a special token in a text is that token; rows may repeat. No shuffle.
    """
    return _coded(docs, path, TOKENS, lambda _, doc, ids: (doc, ids))


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """Number and digest of the ids of every whole text, and digest of the text decoded from them."""

    def row(codec: Codec, doc: int | None, ids: list[int]) -> tuple:
        listed = ",".join(map(codec.names.__getitem__, ids))
        back = codec.decode(ids)
        return doc, len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

    return _coded(docs, path, DIGESTS, row)


def decode_documents(tokens: DataFrame, path: str) -> DataFrame:
    """Text of every row of ``tokens`` (doc_id, ids); null ids give an empty text, unknown ids nothing."""
    sent = _sent(tokens, path)
    schema = schema_of("doc_id bigint, text string")
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent)
        for batch in batches:
            texts = [codec.decode([i for i in ids or [] if 0 <= i < len(codec.pieces)]) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(texts, pa.string())], schema=arrow)

    return map_in_arrow(tokens.select("doc_id", "ids"), run, schema)
