"""Spelling variants: words one edit apart, found in a trie over letter-group counts, and the forms they vary.

Letters are dealt into groups of about equal frequency. A word's counts by group, one after the other, are its path in
a trie; all words of one path are a leaf. An edit adds at most one to one count (surplus) and takes at most one from
another (deficit), so the search goes down depth first with a budget of one each, carrying along all words that still
have budget at a node. The words of the leaves it reaches are verified letter by letter.

On Spark, the first levels of the trie are the shuffle key. Their number is chosen so that no subtree holds more than
``SUBTREE_WORDS`` words; every word is sent to its own subtree, and as a question to those the budget reaches.
Subtrees that stay larger at full depth are dealt out in parts, and their questions go to every part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import arrow_schema, map_in_arrow, schema_of, slices
from eventloom.session import cut_lineage, release

LEAST_LETTERS = 5
LEAST_COUNT = 3
# One run in so many loses a letter, by the checksum of document and run.
TYPO_SHARE = 97
# Levels of the trie, and words of one subtree at most.
LEVELS = 16
SUBTREE_WORDS = 20_000
# A node of no more words is compared with its questions at once instead of level by level.
NODE_WORDS = 48
# Distinct words that a counting task holds before it hands them on, and their letters.
HELD_WORDS = 200_000
HELD_BYTES = 16_000_000

# Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8, of five letters at least: shorter ones cannot become words.
_RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf]){%d,}" % LEAST_LETTERS)


def without_letter(run: bytes, place: int) -> bytes:
    """``run`` (UTF-8) without the code point at ``place``."""
    text = run.decode("utf-8")
    return (text[:place] + text[place + 1 :]).encode("utf-8")


def runs_of(doc_id: int | None, text: bytes) -> Iterator[tuple[bytes, int]]:
    """Distinct lower-cased runs of a text, after the letter loss, with how often each occurs."""
    text = text.lower()  # Bytes: only A-Z change.
    found = _RUN.findall(text) if len(text) < 4_000_000 else (m.group() for m in _RUN.finditer(text))
    start = zlib.crc32(b"%d:" % doc_id if doc_id is not None else b":")
    for run, n in Counter(found).items():
        h = zlib.crc32(run, start)
        if h % TYPO_SHARE == 0:
            run = without_letter(run, h % (len(run) - run.count(b"\xc3")))
        yield run, n


def count_words(docs: DataFrame) -> DataFrame:
    """Words of at least five letters that occur at least three times: word, n."""
    schema = arrow_schema(schema_of("word string,n bigint"))

    def handed(held: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array(list(held), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        letters = 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())
            for start, end in slices(texts):
                for doc_id, text in zip(ids[start:end], texts.slice(start, end - start).to_pylist(), strict=True):
                    for word, n in runs_of(doc_id, text or b""):
                        if word not in held:
                            letters += len(word)
                        held[word] += n
                if len(held) > HELD_WORDS or letters > HELD_BYTES:
                    yield handed(held)
                    held, letters = Counter(), 0
        if held:
            yield handed(held)

    parts = map_in_arrow(docs.select("doc_id", "text"), run, schema_of("word string,n bigint"))
    whole = parts.groupBy("word").agg(F.sum("n").alias("n"))
    return whole.where((F.col("n") >= LEAST_COUNT) & (F.length("word") >= LEAST_LETTERS))


class Words:
    """Words as one buffer of Latin-1 letters with offsets, and their counts by letter group."""

    def __init__(self, words: pa.Array, groups: np.ndarray):
        letters = [w.encode("latin-1") for w in words.to_pylist()]
        self.lengths = np.fromiter(map(len, letters), np.int64, len(letters))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.buffer = np.frombuffer(b"".join(letters) + bytes(1), np.uint8)
        owner = np.repeat(np.arange(len(letters)), self.lengths)
        at = owner * LEVELS + groups[self.buffer[:-1]]
        self.counts = np.bincount(at, minlength=len(letters) * LEVELS).reshape(-1, LEVELS).astype(np.int32)

    def letters(self, which: np.ndarray, width: int) -> np.ndarray:
        """Letters of the words ``which``, one row each, zeros behind the last."""
        place = np.arange(width)
        inside = place < self.lengths[which][:, None]
        return np.where(inside, self.buffer[np.where(inside, self.starts[which][:, None] + place, -1)], 0)


def one_edit_apart(words: Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of pairs of words, those that differ by exactly one inserted, deleted or replaced letter."""
    swap = words.lengths[a] > words.lengths[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    same = np.zeros(len(a), bool)
    width = words.lengths[b]
    rank = np.ceil(np.log2(np.maximum(width, 8))).astype(np.int64)
    for size in np.unique(rank):
        mine = np.flatnonzero(rank == size)
        span = int(width[mine].max()) + 1
        for part in np.array_split(mine, len(mine) * span // 4_000_000 + 1):
            short, long = words.letters(a[part], span), words.letters(b[part], span)
            unlike = short != long
            swapped = (words.lengths[a[part]] == words.lengths[b[part]]) & (unlike.sum(1) == 1)
            # One letter more: equal up to some place, and from there on equal when shifted by one.
            first = unlike.argmax(1)
            shifted = short[:, :-1] == long[:, 1:]
            rest = shifted | (np.arange(span - 1) < first[:, None])
            longer = (words.lengths[a[part]] + 1 == words.lengths[b[part]]) & rest.all(1)
            same[part] = swapped | longer
    return same


def reached(members: np.ndarray, asking: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (place in ``asking``, place in ``members``) whose counts are within a surplus and a deficit of one.

    ``members`` are rows of counts in ascending order, so that a node of the trie is a run of rows.
    """
    todo = [(0, len(members), 0, np.arange(len(asking)), np.ones(len(asking), np.int8), np.ones(len(asking), np.int8))]
    while todo:
        lo, hi, level, who, surplus, deficit = todo.pop()
        if hi - lo <= NODE_WORDS or level == LEVELS:
            for part in np.array_split(np.arange(len(who)), len(who) * (hi - lo) // 200_000 + 1):
                gap = members[None, lo:hi, level:] - asking[who[part], None, level:]
                more, less = np.maximum(gap, 0).sum(2), np.maximum(-gap, 0).sum(2)
                q, m = np.nonzero((more <= surplus[part, None]) & (less <= deficit[part, None]))
                yield who[part][q], lo + m
            continue
        column = members[lo:hi, level]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(column)) + 1, [hi - lo]])
        asked = asking[who, level]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            gap = column[start] - asked
            alive = (gap <= surplus) & (-gap <= deficit)
            if alive.any():
                over = np.clip(gap[alive], -1, 1).astype(np.int8)
                left = surplus[alive] - np.maximum(over, 0), deficit[alive] - np.maximum(-over, 0)
                todo.append((lo + int(start), lo + int(end), level + 1, who[alive], *left))


def near_in_subtree(table: pa.Table, groups: np.ndarray) -> pa.Table:
    """Near words among the members of a subtree, and between them and the words that ask from other subtrees."""
    words = Words(table.column("word").combine_chunks(), groups)
    n = table.column("n").to_numpy()
    asks = table.column("asks").to_numpy(zero_copy_only=False)
    members = np.flatnonzero(~asks)
    members = members[np.lexsort(words.counts[members].T[::-1])]
    found_a, found_b = [], []
    for q, m in reached(words.counts[members], words.counts):
        a, b = q, members[m]
        # Two members of one subtree meet in both directions; one of them is enough.
        once = asks[a] | (a < b)
        a, b = a[once], b[once]
        good = one_edit_apart(words, a, b)
        found_a.append(a[good])
        found_b.append(b[good])
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (found_a, found_b))
    who, other = np.concatenate([a, b]), np.concatenate([b, a])
    place = np.argsort(np.argsort(np.array(table.column("word").to_pylist(), object))) if len(who) else np.empty(0, np.int64)
    order = np.lexsort((place[other], -n[other], who))
    who, other = who[order], other[order]
    first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]])) if len(who) else np.empty(0, np.int64)
    sizes = np.diff(np.append(first, len(who)))
    spelled = table.column("word")
    return pa.table(
        {
            "word": spelled.take(pa.array(who[first])).combine_chunks(),
            "n_near": pa.array(sizes, pa.int64()),
            "near": spelled.take(pa.array(other[first])).combine_chunks(),
            "near_n": pa.array(n[other[first]], pa.int64()),
        },
        schema=arrow_schema(_FOUND),
    )


_FOUND = schema_of("word string,n_near bigint,near string,near_n bigint")


def letter_groups(words: DataFrame) -> np.ndarray:
    """Group of every Latin-1 letter: the commonest letters apart, the rest where there is least so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(256, np.int64)
        for batch in batches:
            for word in batch.column(0).to_pylist():
                for letter in word.encode("latin-1"):
                    seen[letter] += 1
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(seen[used])], names=["letter", "n"])

    # One row per letter of the alphabet: 90 at most.
    totals = words.select("word").mapInArrow(run, schema_of("letter bigint,n bigint")).groupBy("letter").agg(F.sum("n").alias("n"))
    groups, load = np.arange(256) % LEVELS, np.zeros(LEVELS)
    for letter, n in sorted(totals.collect(), key=lambda r: (-r.n, r.letter)):
        groups[letter] = load.argmin()
        load[groups[letter]] += n
    return groups.astype(np.int64)


def keys_of(counts: np.ndarray) -> pa.Array:
    """Counts as bytes, in the trie's order; a count above 255 is 255, which moves no neighbours apart."""
    raw = np.minimum(counts, 255).astype(np.uint8)
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(raw.shape[1]), len(raw), [None, pa.py_buffer(np.ascontiguousarray(raw))]
    ).cast(pa.binary())


def with_paths(words: DataFrame, groups: np.ndarray) -> DataFrame:
    """Words with their path through the trie: word, n, path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path = keys_of(Words(batch.column(0), groups).counts)
            yield pa.RecordBatch.from_arrays([*batch.columns, path], names=["word", "n", "path"])

    return words.select("word", "n").mapInArrow(run, schema_of("word string,n bigint,path binary"))


def questions(depth: int) -> list[tuple[tuple[int, int], ...]]:
    """Changes of the first ``depth`` counts that lead to another subtree, of every two opposite ones the first."""
    one = [((i, 1),) for i in range(depth)]
    return one + [((i, 1), (j, -1)) for i in range(depth) for j in range(i + 1, depth)]


def route(paths: DataFrame, depth: int) -> DataFrame:
    """Every word in its own subtree (asks false) and as a question in those it reaches: key, word, n, asks."""
    moves = questions(depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            word, n, path = batch.columns
            own = np.frombuffer(b"".join(p[:depth] for p in path.to_pylist()), np.uint8).reshape(-1, depth).astype(np.int16)
            yield _routed(own, np.arange(len(own)), word, n, False)
            for move in moves:
                key = own.copy()
                for level, by in move:
                    key[:, level] += by
                real = np.flatnonzero((key >= 0).all(1) & (key <= 255).all(1))
                if len(real):
                    yield _routed(key[real], real, word, n, True)

    return paths.mapInArrow(run, schema_of("key binary,word string,n bigint,asks boolean"))


def _routed(key: np.ndarray, which: np.ndarray, word: pa.Array, n: pa.Array, asks: bool) -> pa.RecordBatch:
    which = pa.array(which)
    return pa.RecordBatch.from_arrays(
        [keys_of(key), word.take(which), n.take(which), pa.array(np.full(len(which), asks))], names=["key", "word", "n", "asks"]
    )


def near_words(words: DataFrame) -> DataFrame:
    """Words with a near word: word, n_near, near (the commonest, ties by code points), near_n."""
    groups = letter_groups(words)
    paths = cut_lineage(with_paths(words, groups))
    largest, depth = SUBTREE_WORDS + 1, 1
    while largest > SUBTREE_WORDS and depth < LEVELS:
        depth += 1
        subtrees = paths.groupBy(F.substring("path", 1, depth).alias("key")).agg(F.count(F.lit(1)).alias("size"))
        largest = subtrees.agg(F.max("size")).first()[0] or 0
    # A subtree of no word answers nothing; one of too many is cut into parts.
    subtrees = subtrees.select("key", F.ceil(F.col("size") / SUBTREE_WORDS).cast("int").alias("parts"))
    routed = route(paths, depth).join(subtrees, "key")
    if largest > SUBTREE_WORDS:
        own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
        # A member asks in the parts after its own, so that each pair meets once.
        every = F.sequence(F.lit(0), F.col("parts") - 1)
        spread = routed.withColumn("own", own).withColumn("part", F.explode(F.when(F.col("asks"), every).otherwise(F.filter(every, lambda p: p >= own))))
        routed = spread.withColumn("asks", F.col("asks") | (F.col("part") != F.col("own")))
    else:
        routed = routed.withColumn("part", F.lit(0))
    found = routed.groupBy("key", "part").applyInArrow(lambda t: near_in_subtree(t, groups), _FOUND)
    best = F.min(F.struct((-F.col("near_n")).alias("least"), F.col("near").alias("near")))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    done = cut_lineage(merged.select("word", "n_near", "best.near", (-F.col("best.least")).alias("near_n")))
    release(paths)
    return done


def roots(forms: DataFrame) -> DataFrame:
    """Last form of every chain of word, form: word, root. A form is at least twice as common, so 6 rounds are the most."""
    now = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        before, now = now, cut_lineage(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        release(before)
        if not now.where(F.col("next").isNotNull()).limit(1).count():
            return now.drop("next")
        now = now.drop("next")


def group_variants(docs: DataFrame) -> DataFrame:
    """Words of ``docs`` (doc_id, text) with their near words and forms: word, n, n_near, form, form_n, root.

    A null or empty text has no words and a null id counts as an empty one; repeated rows count each. Without words
    the result is empty. Other columns of ``docs`` are not looked at.
    """
    words = cut_lineage(count_words(docs))
    near = near_words(words)
    is_form = F.col("near_n") >= 2 * F.col("n")
    named = cut_lineage(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("near")).alias("form"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        )
    )
    release(words, near)
    last = roots(named.where(F.col("form").isNotNull()))
    return named.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
