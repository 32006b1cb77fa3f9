"""Benchmark decontamination: one Aho-Corasick automaton over the windows of normalised benchmark items.

Words are runs of digits, lower-cased Latin letters and characters beyond ASCII. Everything works on UTF-8
bytes: lower-casing and separating is one byte translation, so a place in the normalised text is a place in
the original, and a byte is one character of the automaton's text.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from eventloom.llm.common import arrow_schema, keep_rows, map_in_arrow, schema_of

WINDOW = 10
# The windows of so many bytes of patterns make one automaton; larger benchmarks are scanned in several passes.
PATTERN_BYTES = 32_000_000

_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or b in _WORD_BYTES else 32 for b in range(256)
)
_RUN = re.compile(rb"[^ ]+")


def words_of(text: str | None) -> list[bytes]:
    return [] if not text else [w for w in text.encode("utf-8").translate(_FOLD).split(b" ") if w]


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """Windows of an item: all runs of ``size`` words, or the whole of a shorter item; none without words."""
    words = words_of(text)
    if not words:
        return []
    return [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def _blocks(items: Iterator[tuple[str, str | None]], size: int, limit: int) -> Iterator[dict[bytes, list[str]]]:
    block: dict[bytes, list[str]] = {}
    held = 0
    for item, text in items:
        for window in windows(text, size):
            held += len(window)
            owners = block.setdefault(window, [])
            if item not in owners:
                owners.append(item)
        if held > limit:
            yield block
            block, held = {}, 0
    if block:
        yield block


def _sent_blocks(benchmark: DataFrame, size: int, limit: int) -> list:
    """Broadcast blocks of windows with the items that hold them; rows are read one partition at a time."""
    rows = benchmark.select("item_id", "text").toLocalIterator()
    items = (("" if row["item_id"] is None else str(row["item_id"]), row["text"]) for row in rows)
    context = benchmark.sparkSession.sparkContext
    return [context.broadcast(block) for block in _blocks(items, size, limit)]


def _automaton(patterns: dict[bytes, list[str]]):
    import ahocorasick

    made = ahocorasick.Automaton()
    for window, owners in patterns.items():
        made.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, tuple(owners)))
    made.make_automaton()
    return made


def find_hits(text: str | None, automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, hit runs of word numbers [start, end) in order and not touching, and items that hit."""
    words = words_of(text)
    if not words:
        return 0, [], set()
    line = b" " + b" ".join(words) + b" "
    ends, items, marks = None, set(), []
    for end, (length, owners) in automaton.iter(line.decode("latin-1")):
        if ends is None:
            ends, at = [], 0
            for word in words:
                at += len(word) + 1
                ends.append(at)
        last = bisect_left(ends, end)
        marks.append((last - length + 1, last + 1))
        items.update(owners)
    runs: list[tuple[int, int]] = []
    for start, stop in sorted(marks):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(stop, runs[-1][1]))
        else:
            runs.append((start, stop))
    return len(words), runs, items


def _merged(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    runs: list[tuple[int, int]] = []
    for start, stop in sorted([*a, *b]):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(stop, runs[-1][1]))
        else:
            runs.append((start, stop))
    return runs


def char_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of word numbers as code-point offsets [start, end) of the original text."""
    if not runs:
        return []
    raw = text.encode("utf-8")
    places = [(m.start(), m.end()) for m in _RUN.finditer(raw.translate(_FOLD))]
    spans = []
    for start, stop in runs:
        first, last = places[start][0], places[stop - 1][1]
        before = len(raw[:first].decode("utf-8"))
        spans.append((before, before + len(raw[first:last].decode("utf-8"))))
    return spans


SCAN = schema_of(
    "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
    "items strings, spans spans"
)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pattern_bytes: int = PATTERN_BYTES
) -> DataFrame:
    """Per document row: words, words inside a benchmark window, items found and their places in the text.

    The benchmark is a stated query set and its windows are sent to every task, in blocks of at most
    ``pattern_bytes``; a task builds one automaton at a time and keeps the hits of a document between blocks.
    Documents are read once and never shuffled. Null text has no words; an item with a null id counts under
    the empty id; repeated items count once; repeated documents give a row each; extra columns are ignored.
    """
    blocks = _sent_blocks(benchmark, window, pattern_bytes)
    schema = arrow_schema(SCAN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task keeps the automaton of a single block; of several it builds one after the other for every batch.
        kept = _automaton(blocks[0].value) if len(blocks) == 1 else None
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            found: list = [None] * len(ids)
            for block in blocks:
                automaton = kept or _automaton(block.value)
                for i in range(len(ids)):
                    n, runs, hit = find_hits(texts[i].as_py(), automaton)
                    found[i] = (n, runs, hit) if found[i] is None else (n, _merged(found[i][1], runs), found[i][2] | hit)
            out: dict[str, list] = {f.name: [] for f in schema}
            for i, doc in enumerate(ids):
                text = texts[i].as_py()
                n, runs, hit = found[i] if blocks else (len(words_of(text)), [], set())
                names = sorted(hit)
                out["doc_id"].append(doc)
                out["n_words"].append(n)
                out["n_hit"].append(sum(b - a for a, b in runs))
                out["n_items"].append(len(names))
                out["items_sha256"].append(hashlib.sha256(",".join(names).encode()).hexdigest())
                out["contaminated"].append(bool(runs))
                out["items"].append(names)
                out["spans"].append([{"start": a, "end": b} for a, b in char_spans(text or "", runs)])
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in schema], schema=schema)

    return map_in_arrow(docs.select("doc_id", "text"), run, SCAN)


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` without any benchmark window, with all their columns.

    The verdict is made beside the row it is about, so repeated or null ids need no join.
    """
    out = docs
    for block in _sent_blocks(benchmark, window, PATTERN_BYTES):
        out = keep_rows(out, lambda block=block: _clean_judge(block))
    return out


def _clean_judge(block):
    automaton = _automaton(block.value)
    return lambda texts: [not find_hits(text, automaton)[1] for text in texts]
