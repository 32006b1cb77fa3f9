"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

A text is read in windows that end at ASCII white space: a window is a run of other bytes, cut after
``WINDOW`` bytes. The network labels every byte of a window from its left and right context, and a document's
probabilities are the mean over its positions. Equal windows have equal labels, so a slice of texts runs each of
its distinct windows once and weighs it by its occurrences; that is exact, and no text is shortened.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import arrow_schema, crc_bucket, map_in_arrow, map_rows, schema_of, slices

WINDOW = 24
HIDDEN = 8
# The fit takes so many documents of each language, and the most frequent windows of their whole texts.
DOCS_PER_LANG = 200
TRAIN_STEPS = 500
TRAIN_BATCH = 512
# Documents of a language that its bar is taken from, and the share of their least score that it is.
BAR_DOCS, BAR_SHARE = 40, 0.5
# More languages are an error: the remembered position sums of a task grow with their number.
MAX_LANGS = 512
UNKNOWN = "und"

_SPLIT = re.compile(rb"[^\t-\r ]+")
_CASE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def windows_of(text: str) -> list[bytes]:
    out = []
    for word in text.encode("utf-8").translate(_CASE).split():
        if len(word) <= WINDOW:
            out.append(word)
        else:
            out.extend(word[i : i + WINDOW] for i in range(0, len(word), WINDOW))
    return out


@dataclass
class Network:
    """Weights: for each direction the input table (256 x 3H), recurrent matrix (H x 3H) and candidate bias, then the output.

    ``bars`` has for each language the score below which a document of it would be unlike all that were learned.
    """

    langs: list[str]
    table: list[np.ndarray]
    inner: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray
    bars: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [*self.table, *self.inner, *self.bias, self.out, self.out_bias]


def new_network(langs: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    return Network(
        langs,
        [draw(256, 3 * hidden) for _ in range(2)],
        [draw(hidden, 3 * hidden) for _ in range(2)],
        [np.zeros(hidden, np.float32) for _ in range(2)],
        draw(2 * hidden, len(langs)),
        np.zeros(len(langs), np.float32),
        np.zeros(len(langs)),
    )


def _steps(net: Network, way: int, codes: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (T x N x H) of one direction; codes is T x N in reading order. ``keep`` gets what training needs."""
    steps, n = codes.shape
    hidden = net.inner[way].shape[0]
    state = np.zeros((n, hidden), np.float32)
    states = np.empty((steps, n, hidden), np.float32)
    for t in range(steps):
        given = net.table[way].take(codes[t], axis=0)
        own = state @ net.inner[way]
        gates = given[:, : 2 * hidden] + own[:, : 2 * hidden]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates += 1.0
        gates *= 0.5
        update, reset = gates[:, :hidden], gates[:, hidden:]
        inner = own[:, 2 * hidden :] + net.bias[way]
        fresh = reset * inner
        fresh += given[:, 2 * hidden :]
        np.tanh(fresh, out=fresh)
        if keep is not None:
            keep.append((state, gates, inner, fresh))
        state = np.subtract(state, fresh, out=states[t])
        state *= update
        state += fresh
    return states


def position_logits(net: Network, codes: np.ndarray, keep: tuple[list, list] | None = None) -> np.ndarray:
    """Logits (T x N x L) for windows of equal length; codes is T x N."""
    ahead = _steps(net, 0, codes, keep[0] if keep else None)
    back = _steps(net, 1, codes[::-1], keep[1] if keep else None)[::-1]
    half = ahead.shape[2]
    return ahead @ net.out[:half] + back @ net.out[half:] + net.out_bias


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    x /= x.sum(axis=-1, keepdims=True)
    return x


def gradients(net: Network, codes: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over positions and its gradient for ``net.parts()``, by backpropagation through time."""
    keep: tuple[list, list] = ([], [])
    steps, n = codes.shape
    probs = _softmax(position_logits(net, codes, keep))
    loss = float(-np.log(np.maximum(probs[:, np.arange(n), target], 1e-9)).mean())
    probs[:, np.arange(n), target] -= 1
    d_logit = probs / (steps * n)
    half = net.inner[0].shape[0]
    d_table, d_inner, d_bias = [], [], []
    d_out = np.zeros_like(net.out)
    for way in range(2):
        read = codes if way == 0 else codes[::-1]
        d_read = d_logit if way == 0 else d_logit[::-1]
        weights = net.out[way * half : (way + 1) * half]
        table, inner_w, bias = np.zeros_like(net.table[way]), np.zeros_like(net.inner[way]), np.zeros_like(net.bias[way])
        later = np.zeros((n, half), np.float32)
        for t in range(steps - 1, -1, -1):
            before, gates, inner, fresh = keep[way][t]
            update, reset = gates[:, :half], gates[:, half:]
            state = fresh + update * (before - fresh)
            d_out[way * half : (way + 1) * half] += state.T @ d_read[t]
            d_state = d_read[t] @ weights.T + later
            d_fresh = d_state * (1 - update) * (1 - fresh * fresh)
            d_update = d_state * (before - fresh) * update * (1 - update)
            d_reset = d_fresh * inner * reset * (1 - reset)
            d_own = np.concatenate([d_update, d_reset, d_fresh * reset], axis=1)
            np.add.at(table, read[t], np.concatenate([d_update, d_reset, d_fresh], axis=1))
            inner_w += before.T @ d_own
            bias += (d_fresh * reset).sum(axis=0)
            later = d_state * update + d_own @ net.inner[way].T
        d_table.append(table)
        d_inner.append(inner_w)
        d_bias.append(bias)
    return loss, [*d_table, *d_inner, *d_bias, d_out, d_logit.sum(axis=(0, 1))]


def train(examples: list[tuple[str, str]], hidden: int = HIDDEN, steps: int = TRAIN_STEPS, seed: int = 7) -> Network:
    """Fit a network to (text, lang) pairs; without any pair there is nothing to learn and every answer is ``und``."""
    langs = sorted({lang for _, lang in examples})
    net = new_network(langs, hidden, seed)
    if not langs:
        return net
    counts: Counter = Counter()
    for text, lang in sorted(examples):
        y = langs.index(lang)
        counts.update((window, y) for window in windows_of(text))
    if not counts:
        return net
    by_length: dict[int, list[tuple[bytes, int, int]]] = {}
    total = Counter()
    for (window, y), n in sorted(counts.items()):
        by_length.setdefault(len(window), []).append((window, y, n))
        total[y] += n
    lengths = sorted(by_length)
    groups = []
    for length in lengths:
        rows = by_length[length]
        codes = np.frombuffer(b"".join(w for w, _, _ in rows), np.uint8).reshape(len(rows), length)
        # Every language counts the same, however many documents it has.
        weight = np.array([n / total[y] for _, y, n in rows])
        groups.append((codes, np.array([y for _, y, _ in rows]), weight / weight.sum(), weight.sum() * length))
    share = np.array([g[3] for g in groups])
    share /= share.sum()
    rng = np.random.default_rng(seed)
    parts = net.parts()
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, steps + 1):
        codes, target, weight, _ = groups[rng.choice(len(groups), p=share)]
        pick = rng.choice(len(target), size=TRAIN_BATCH, p=weight)
        _, grads = gradients(net, codes[pick].T.astype(np.int64), target[pick])
        rate = 0.02 * min(1.0, step / 20) * (1 - 0.9 * step / steps)
        for p, g, m, v in zip(parts, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    net.bars = least_scores(net, examples)
    return net


def least_scores(net: Network, examples: list[tuple[str, str]]) -> np.ndarray:
    """A bar for each language, from the best scores of its own documents: how high those are follows from how many
    languages there are and how alike, so no fixed number would do."""
    own: dict[str, list[str]] = {}
    for text, lang in sorted(examples):
        if has_letter(text) and len(own.setdefault(lang, [])) < BAR_DOCS:
            own[lang].append(text)
    bars = np.zeros(len(net.langs))
    for i, lang in enumerate(net.langs):
        if own.get(lang):
            bars[i] = BAR_SHARE * float(document_probabilities(net, own[lang]).max(axis=1).min())
    return bars


def known_language(net: Network, probs: np.ndarray) -> np.ndarray:
    """Whether the best language of each row of document probabilities reaches its bar."""
    if not net.langs:
        return np.ones(len(probs), bool)
    best = probs.argmax(axis=1)
    return probs[np.arange(len(probs)), best] >= net.bars[best]


def _position_sums(net: Network, codes: np.ndarray) -> np.ndarray:
    """Label probabilities summed over positions; languages are the leading axis, which numpy adds up fastest."""
    steps, n = codes.shape
    half = net.inner[0].shape[0]
    ahead = _steps(net, 0, codes).reshape(steps * n, half)
    back = _steps(net, 1, codes[::-1])[::-1].reshape(steps * n, half)
    x = net.out[:half].T @ ahead.T
    x += net.out[half:].T @ back.T
    x += net.out_bias[:, None]
    x -= x.max(axis=0)
    np.exp(x, out=x)
    x /= x.sum(axis=0)
    return x.reshape(-1, steps, n).sum(axis=1).T


def window_probabilities(net: Network, windows: list[bytes]) -> np.ndarray:
    """Sum over the positions of each window of the label probabilities (windows x languages)."""
    out = np.zeros((len(windows), len(net.langs)), np.float32)
    order = sorted(range(len(windows)), key=lambda i: len(windows[i]))
    lengths = np.array([len(windows[i]) for i in order])
    place = np.array(order)
    for length in np.unique(lengths):
        rows = place[lengths == length]
        # Blocks that keep states in the processor's cache.
        for at in range(0, len(rows), 1024):
            own = rows[at : at + 1024]
            codes = np.frombuffer(b"".join(windows[i] for i in own), np.uint8).reshape(len(own), length)
            out[own] = _position_sums(net, np.ascontiguousarray(codes.T))
    return out


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text[:64]) or any(c.isalpha() for c in text[64:])


# A worker remembers so many windows; then it starts anew. Only speed depends on it.
REMEMBERED = 200_000


class Memory:
    """Position sums of windows seen before, as rows of a growing table."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self.rows: dict[bytes, int] = {}
        self.sums = np.zeros((0, len(net.langs)), np.float32)
        self.sizes = np.zeros(0, np.float32)

    def places(self, texts: list[str | None]) -> list[list[int]]:
        if len(self.rows) > REMEMBERED:
            self.__init__(self.net)
        rows, first = self.rows, len(self.rows)
        places = []
        for text in texts:
            own = windows_of(text) if text else []
            for window in set(own).difference(rows):
                rows[window] = len(rows)
            places.append(list(map(rows.__getitem__, own)))
        if len(rows) > first:
            fresh = list(islice(rows, first, None))
            self.sums = np.concatenate([self.sums, window_probabilities(self.net, fresh)])
            self.sizes = np.concatenate([self.sizes, np.array([len(w) for w in fresh], np.float32)])
        return places


def document_probabilities(net: Network, texts: list[str | None], memory: Memory | None = None) -> np.ndarray:
    """Mean of the position probabilities over each whole text; zeros without any position."""
    memory = memory or Memory(net)
    places = memory.places(texts)
    out = np.zeros((len(texts), len(net.langs)), np.float32)
    for i, own in enumerate(places):
        if own:
            own = np.array(own)
            out[i] = memory.sums[own].sum(axis=0) / memory.sizes[own].sum()
    return out


LABELS = schema_of("doc_id bigint, lang_pred string, score double, n_positions bigint")


def fit(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, steps: int = TRAIN_STEPS) -> Network:
    """Train on at most ``docs_per_lang`` documents of each language, picked by a hash of their id.

    Only rows with a language and a text whose crc32(doc_id) mod 3 is not 1 are used, with their whole texts.
    The hash threshold of a language lets through twice the documents wanted; the lowest hashes stay, and only their
    texts reach the driver. Every language that occurs is learned; more than ``MAX_LANGS`` raise a ValueError.
    """
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").where(crc_bucket("doc_id", 3) != 1)
    counted = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS + 1).collect()
    if not counted:
        return new_network([])
    if len(counted) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages in column lang")
    top = 1 << 32
    limits = F.create_map(
        *[F.lit(x) for r in counted for x in (r["lang"], min(top, 2 * docs_per_lang * top // r["count"]))]
    )
    spread = F.xxhash64(F.lit("lang"), "doc_id").bitwiseAND(F.lit(top - 1))
    found = rows.where(spread <= limits[F.col("lang")]).select("lang", "text", spread.alias("spread"), "doc_id")
    order = Window.partitionBy("lang").orderBy("spread", "doc_id", "text")
    kept = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= docs_per_lang)
    examples = [(r["text"], r["lang"]) for r in kept.select("lang", "text").toLocalIterator()]
    return train(examples, steps=steps)


def identify(docs: DataFrame, net: Network) -> DataFrame:
    """Language and its probability for every whole text.

    Null texts and texts without a letter are ``und`` with score 0; so is everything when nothing was learned.
    Repeated rows give a row each. Documents are not shuffled.
    """

    memories: list[Memory] = []

    def label(cols: dict[str, list]) -> dict[str, list]:
        if not memories:
            memories.append(Memory(net))
        texts = [t if t and has_letter(t) else None for t in cols["text"]]
        probs = document_probabilities(net, texts, memories[0]) if net.langs else None
        named, scores = [], []
        for i, text in enumerate(texts):
            best = int(probs[i].argmax()) if text and probs is not None else -1
            named.append(net.langs[best] if best >= 0 else UNKNOWN)
            scores.append(min(1.0, float(probs[i][best])) if best >= 0 else 0.0)
        positions = [len(t.encode("utf-8")) if t else 0 for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "lang_pred": named, "score": scores, "n_positions": positions}

    return map_rows(docs, ["text", "doc_id"], label, LABELS)


def label_positions(docs: DataFrame, net: Network) -> DataFrame:
    """Runs of equal labels over the bytes of each text: doc_id, start, end (UTF-8 offsets), lang.

    White space belongs to no run; empty and null texts have none.
    """
    schema = schema_of("doc_id bigint, start bigint, end bigint, lang string")
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in slices(batch.column(0)):
                part = batch.slice(start, end - start)
                rows = []
                for doc, text in zip(part.column(1).to_pylist(), part.column(0).to_pylist(), strict=True):
                    rows.extend((doc, *run) for run in text_runs(net, text or ""))
                cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return map_in_arrow(docs.select("text", "doc_id"), run, schema)


def text_runs(net: Network, text: str) -> list[tuple[int, int, str]]:
    runs: list[tuple[int, int, str]] = []
    for found in _SPLIT.finditer(text.encode("utf-8").translate(_CASE)):
        word = found.group()
        for at in range(0, len(word), WINDOW):
            part = word[at : at + WINDOW]
            codes = np.frombuffer(part, np.uint8)[:, None]
            for k, best in enumerate(position_logits(net, codes)[:, 0].argmax(axis=1)):
                place, lang = found.start() + at + k, net.langs[best]
                if runs and runs[-1][2] == lang and runs[-1][1] == place:
                    runs[-1] = (runs[-1][0], place + 1, lang)
                else:
                    runs.append((place, place + 1, lang))
    return runs
