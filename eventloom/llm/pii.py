"""Personal data: plain patterns, and a linear-chain conditional random field that adds what they miss.

The field labels tokens (runs of letters, runs of digits, single marks) as outside, first or inner of an email, ip,
card or phone. It sees word shapes only: shapes of a token and its neighbours, gaps, whether a run of digits has a
valid check digit or small parts. Its chains are the stretches around digits and at signs, two words to either side;
no token elsewhere can be part of a span. It learns from a small labelled table: lines labelled by hand, in which
personal data is written as no plain pattern reads it, and a bounded sample of chains that the patterns label.
Forward and backward sums give the gradient; the best labels are found by Viterbi for all chains of a batch at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import map_in_arrow, map_rows, sampled, schema_of, sha256_hex

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *[f"{part}-{kind}" for kind in KINDS for part in "BI"])

# Documents, and chains of them, that the field learns from at most, and their longest texts.
SAMPLE_DOCS, SAMPLE_LETTERS = 2000, 20_000
SAMPLE_CHAINS, CHAIN_LETTERS = 3000, 400
# How often a line labelled by hand counts.
HAND_WEIGHT = 8.0
STEPS, RATE, SHRINK = 120, 0.15, 2e-4

Span = tuple[int, int, int]

# Lines labelled by hand; <kind> and </> stand around personal data.
LABELLED = [
    "ring <phone>(017) 555-7713</> after six",
    "Tel. <phone>(030) 555 20 11 45</> or come by",
    "phone <phone>017-555-7713</> and ask for Ana",
    "my number is <phone>0049 30 5552011</> since May",
    "Fax: <phone>020 7555 0199</>, room 12",
    "call <phone>(974) 555-3436</>, then press 2",
    "mobile <phone>0171/5550199</> all day",
    "reach us at <phone>001 (487) 555-7209</> or 7209",
    "<phone>555.017.7713</> is the office line",
    "Tel <phone>(+49) 30 5552 0114</> weekdays",
    "text <phone>(212)555-0143</> to order 3 boxes",
    "téléphone <phone>01 55 55 01 43</> le matin",
    "Teléfono <phone>91 555 01 43 20</> de 9 a 14",
    "write to <email>anna.berg [at] mail7.example.com</> please",
    "mail <email>j.lopez(at)example.org</> for the file",
    "contact <email>info @ example.com</> or 12 High Street",
    "<email>max_m [at] web.example.de</> schreibt 3 Briefe",
    "send it to <email>ana@mail [dot] example [dot] com</> today",
    "<email>support(at)shop9.example.net</>: 24 hours",
    "Kontakt: <email>k.wolf (at) example.de</>",
    "mail <email>peter [at] shop.example.com</>, box 14",
    "or <email>eva (at) post.example.org</>; 7 days a week",
    "e-mail: <email>office [at] town.example.net</>",
    "mail <email>marie [at] site4.example.fr</> pour 2 places",
    "see you [at] 10 or (at) 12, gate 4",
    "host <ip>10 . 0 . 17 . 250</> is down",
    "from <ip>192.168.17.4</> port 8080",
    "ping <ip>172 .16 .254 .1</> failed twice",
    "gateway <ip>10,0,0,138</> answers",
    "address <ip>192-0-2-14</> was blocked",
    "card <card>4111.1111.1111.1111</> until 12/29",
    "paid with <card>5500 0000 0000 0004</> on 3 May",
    "visa <card>4012/8888/8888/1881</> accepted",
    "<card>4222  2222  2222  2</> was charged 20",
    "number <card>3782.822463.10005</>, code 1234",
    "Karte <card>4111 - 1111 - 1111 - 1111</> gesperrt",
    "order 4111 of 12 boxes at 3.50 each",
    "invoice 2024-0017-5512 from 2024-05-17",
    "it was 17.05.2024 at 10:45:30 sharp",
    "between 1914 and 1918, or 1939 to 1945",
    "version 3.11.4.2024 of the tool",
    "pages 12-17 and 120 - 134 of volume 3",
    "1,250,000 items for 3.999.000 crowns",
    "ISBN 978-3-16-148410-0, 2nd edition",
    "account 1234567890123456 at the desk",
    "the ratio 16/9, 4/3 or 21/9 and 1.85",
    "serial 0054994038693467 and 7660c51feb63",
    "token = \"48ab8b03847754d9381\" was removed",
    "chapter 1.2.3, section 4.5.6 and table 7",
    "scores 3-2, 1-1 and 0-4 on day 12",
    "room 101, floor 3, seat 12-B",
    "at 10 @ 3.50 each, 24 @ 2.10",
    "meet @ noon, bring 2 chairs",
    "coordinates 52.5200, 13.4050 and 48.8566",
    "1 2 3 4 5 6 7 8 9 10 11 12",
    "2019 2020 2021 2022 2023 2024",
    "temperatures of 12.5 - 14.5 - 17.0 degrees",
    "order no. 555-0143 was shipped on 12-05-24",
    "lot 300.12.400.7 of 12 pieces",
    "telephone bills rose by 12 per cent in 2023",
    "$$ 120 %% 45 ## 300 && 12",
    "§ 14 (2) and § 15 (1) 3 of the act",
    "line 100: 200 300 400, line 101: 210 310 410",
    "the 4 cards and the 2 phones cost 300",
    "IP law since 1990 and 2 emails a day",
]


# ---- Plain patterns -------------------------------------------------------------------------------------------

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match can only begin where a run of digits does: what fails there fails at its later digits too.
_QUAD = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of those before it."""
    odd = digits[-1::-2]
    even = digits[-2::-2]
    return (sum(map(int, odd)) + sum(int(d) * 2 - 9 * (d > "4") for d in even)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        # The local part is the run of its characters that ends here; earlier at signs end it as well.
        begin = at
        while begin > done and _LOCAL.fullmatch(text, max(done, begin - 64), begin):
            begin = max(done, begin - 64)
        while begin > done and _LOCAL.fullmatch(text, begin - 1, begin):
            begin -= 1
        if begin < at:
            domain = _DOMAIN.match(text, at + 1)
            if domain:
                done = domain.end()
                yield begin, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Spans (kind, start, end) of the plain patterns, by kind and place."""
    spans = [(0, a, b) for a, b in _emails(text)]
    for m in _QUAD.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            spans.append((1, m.start(), m.end()))
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NO_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, m.start(), m.end()))
    for m in _PLUS.finditer(text):
        if 9 <= len(_NO_DIGIT.sub("", m.group())) <= 15:
            spans.append((3, m.start(), m.end()))
    return spans


# ---- Chains and word shapes -----------------------------------------------------------------------------------

_MARK = re.compile(r"[0-9@]|[\[(](?:at|dot)[\])]")
_AHEAD = re.compile(r"\S*+(?:\s++\S++){0,2}+")
_WORD = re.compile(r"\S*+")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
_RUN = re.compile(r"[0-9]++(?:[ ().,/-]{1,3}[0-9]++)*+")


def chains(text: str) -> list[tuple[int, int]]:
    """Stretches of words around marked ones, two words to either side; those that touch are one."""
    found: list[tuple[int, int]] = []
    at = 0
    while m := _MARK.search(text, at):
        reach = 128
        while True:
            behind = text[max(0, m.start() - reach) : m.start()][::-1]
            back = _AHEAD.match(behind).end()
            if back < len(behind) or reach >= m.start():
                break
            reach *= 4
        start, end = m.start() - back, _AHEAD.match(text, m.start()).end()
        if found and start <= found[-1][1]:
            start = found.pop()[0]
        found.append((start, end))
        at = max(_WORD.match(text, m.start()).end(), m.end())
    return found


def _shape(token: str) -> str:
    if token[0] in "0123456789":
        return f"d{min(len(token), 20)}"
    if token[0].isalpha():
        case = "x" if token.islower() else "X" if token.isupper() else "Xx" if token[1:].islower() else "xX"
        word = token.lower()
        return f"{case}:{word}" if word in ("at", "dot") else f"{case}{min(len(token), 4)}"
    return token if token.isascii() else "~"


def _run_class(run: str) -> str:
    digits = _NO_DIGIT.sub("", run)
    n = len(digits)
    if 13 <= n <= 19:
        return "card" if luhn(digits) else "long"
    parts = re.findall("[0-9]+", run)
    if len(parts) == 4 and max(map(len, parts)) <= 3 and max(map(int, parts)) <= 255:
        return "quad"
    return "phone" if 9 <= n <= 12 else "few" if n < 9 else "long"


def token_features(chain: str) -> tuple[list[tuple[int, int]], list[list[str]]]:
    """Tokens of a chain as places, and the names of their features."""
    places = [m.span() for m in _TOKEN.finditer(chain)]
    shapes = [_shape(chain[a:b]) for a, b in places]
    runs: dict[int, str] = {}
    kinds = []
    for m in _RUN.finditer(chain):
        runs[m.start()] = _run_class(m.group()) + ("+" if chain[max(0, m.start() - 2) : m.start()].strip(" (") == "+" else "")
        kinds.append((m.start(), m.end(), runs[m.start()]))
    glued = [False, *[a[1] == b[0] for a, b in zip(places, places[1:])], False]
    edge = ["<", "<", *shapes, ">", ">"]
    names, k = [], 0
    for i, (a, _) in enumerate(places):
        while k < len(kinds) and kinds[k][1] <= a:
            k += 1
        inside = kinds[k][2] if k < len(kinds) and kinds[k][0] <= a else ""
        first = "first" if k < len(kinds) and kinds[k][0] == a else ""
        s = edge[i : i + 5]
        gaps = f"{glued[i]:d}{glued[i + 1]:d}"
        names.append(
            [
                "bias", f"0{s[2]}", f"-1{s[1]}", f"+1{s[3]}", f"-2{s[0]}", f"+2{s[4]}", f"g{gaps}", f"g{gaps}{s[2]}",
                f"-{s[1]}{s[2]}{glued[i]:d}", f"+{s[2]}{s[3]}{glued[i + 1]:d}", f"r{inside}", f"r{inside}{first}{s[2][0]}",
                f"r{inside}{first}{s[1]}", f"-2{s[0]}{s[1]}", f"+2{s[3]}{s[4]}",
            ]
        )
    return places, names


# ---- The field ------------------------------------------------------------------------------------------------

# An inner label follows a first or inner one of its kind, and nothing else.
_MAY = np.array([[not b.startswith("I") or (a[1:] == b[1:]) for b in LABELS] for a in LABELS])
_BARRED = np.where(_MAY, 0.0, -1e9)
_START = np.array([-1e9 if label.startswith("I") else 0.0 for label in LABELS])


@dataclass
class Field:
    """Weights by feature and label (the first row is that of unknown features, always zero), and by label pair."""

    names: dict[str, int]
    weights: np.ndarray
    steps: np.ndarray

    def numbered(self, features: list[list[str]]) -> np.ndarray:
        get = self.names.get
        return np.array([[get(f, 0) for f in token] for token in features], np.int32).reshape(len(features), -1)


def _padded(rows: Sequence[np.ndarray], fill: int) -> np.ndarray:
    out = np.full((len(rows), max(map(len, rows)), *rows[0].shape[1:]), fill, rows[0].dtype)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def likelihood(field: Field, tokens: Sequence[np.ndarray], labels: Sequence[np.ndarray], weight: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted log likelihood of the labels and its gradients, by forward and backward sums over all chains at once."""
    score = np.zeros(field.weights.shape)
    moves = np.zeros(field.steps.shape)
    total = 0.0
    lengths = np.array(list(map(len, tokens)))
    order = np.argsort(lengths, kind="stable")
    step = field.steps + _BARRED
    for part in np.array_split(order, max(1, len(order) // 256)):
        length = lengths[part]
        x, y = _padded([tokens[i] for i in part], 0), _padded([labels[i] for i in part], 0)
        emit = field.weights[x].sum(2)
        rows, width = y.shape
        inside = np.arange(width) < length[:, None]
        ahead, behind = np.zeros(emit.shape), np.zeros(emit.shape)
        ahead[:, 0] = emit[:, 0] + _START
        for t in range(1, width):
            ahead[:, t] = np.where(inside[:, t, None], _log_sum(ahead[:, t - 1, :, None] + step, 1) + emit[:, t], ahead[:, t - 1])
        for t in range(width - 2, -1, -1):
            after = _log_sum(step[None] + (emit[:, t + 1] + behind[:, t + 1])[:, None], 2)
            behind[:, t] = np.where(inside[:, t + 1, None], after, 0.0)
        whole = _log_sum(ahead[:, -1], 1)
        w = weight[part]
        chance = np.exp(ahead + behind - whole[:, None, None]) * (inside * w[:, None])[..., None]
        truth = np.zeros(emit.shape)
        np.put_along_axis(truth, y[..., None], (inside * w[:, None])[..., None], 2)
        gap = (truth - chance).reshape(-1, len(LABELS))
        flat = x.reshape(-1, x.shape[2])
        for label in range(len(LABELS)):
            score[:, label] += np.bincount(flat.ravel(), np.repeat(gap[:, label], flat.shape[1]), len(score))
        both = (inside[:, 1:] * w[:, None])[..., None, None]
        pair = np.exp(ahead[:, :-1, :, None] + step + (emit + behind)[:, 1:, None] - whole[:, None, None, None])
        moves -= (pair * both).sum((0, 1))
        np.add.at(moves, (y[:, :-1], y[:, 1:]), both[..., 0, 0])
        picked = np.take_along_axis(emit, y[..., None], 2)[..., 0] * inside
        passed = step[y[:, :-1], y[:, 1:]] * inside[:, 1:]
        total += float((w * (picked.sum(1) + passed.sum(1) + _START[y[:, 0]] - whole)).sum())
    score[0] = 0.0
    return total, score, np.where(_MAY, moves, 0.0)


def learn(examples: Sequence[tuple[str, list[Span], float]], steps: int = STEPS) -> Field:
    """Field that makes the examples likely: (chain, spans, weight), fitted by Adam on all of them at once."""
    cut = [(*token_features(text), spans, weight) for text, spans, weight in examples]
    cut = [c for c in cut if c[0]]
    seen = sorted({f for _, names, _, _ in cut for token in names for f in token})
    field = Field({f: i for i, f in enumerate(seen, 1)}, np.zeros((len(seen) + 1, len(LABELS))), np.zeros((len(LABELS),) * 2))
    if not cut:
        return field
    tokens = [field.numbered(names) for _, names, _, _ in cut]
    labels = [label_tokens(places, spans) for places, _, spans, _ in cut]
    weight = np.array([w for *_, w in cut])
    parts = [field.weights, field.steps]
    mean, square = [np.zeros(p.shape) for p in parts], [np.zeros(p.shape) for p in parts]
    for t in range(1, steps + 1):
        _, *grads = likelihood(field, tokens, labels, weight / weight.sum())
        for part, grad, m, v in zip(parts, grads, mean, square, strict=True):
            grad = grad - SHRINK * part
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            part += RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8) * (1 - t / (steps + 1))
    return field


def label_tokens(places: list[tuple[int, int]], spans: list[Span]) -> np.ndarray:
    """Label numbers of the tokens; where spans of several kinds overlap, the first kind holds."""
    out = np.zeros(len(places), np.int64)
    for kind, start, end in sorted(spans, reverse=True):
        held = [i for i, (a, b) in enumerate(places) if start <= a and b <= end]
        if held:
            out[held[0]], out[held[1:]] = 1 + 2 * kind, 2 + 2 * kind
    # A span cut short by another one begins anew after it.
    for i, label in enumerate(out):
        if label and label % 2 == 0 and (i == 0 or out[i - 1] not in (label, label - 1)):
            out[i] = label - 1
    return out


def viterbi(emit: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> list[np.ndarray]:
    """Best labels of every chain; ``emit`` is chains x tokens x labels, padded behind ``lengths``. Ties: the first label."""
    rows, width, _ = emit.shape
    step = steps + _BARRED
    best = emit[:, 0] + _START
    came = np.zeros(emit.shape, np.int8)
    for t in range(1, width):
        paths = best[:, :, None] + step
        came[:, t] = paths.argmax(1)
        new = paths.max(1) + emit[:, t]
        best = np.where((t < lengths)[:, None], new, best)
    at = best.argmax(1)
    out = np.zeros((rows, width), np.int8)
    for t in range(width - 1, -1, -1):
        out[:, t] = at
        at = np.where((t < lengths) & (t > 0), came[np.arange(rows), t, at], at)
    return [out[i, :n] for i, n in enumerate(lengths)]


def decode(field: Field, texts: Sequence[str]) -> list[list[Span]]:
    """Spans that the field finds in every chain."""
    cut = [token_features(text) for text in texts]
    found: list[list[Span]] = [[] for _ in texts]
    order = sorted((i for i, (places, _) in enumerate(cut) if places), key=lambda i: len(cut[i][0]))
    lot: list[int] = []
    for k, i in enumerate(order):
        lot.append(i)
        width = len(cut[order[k + 1]][0]) if k + 1 < len(order) else 0
        if width and width * (len(lot) + 1) <= 20_000 and width <= 2 * len(cut[lot[0]][0]) + 8:
            continue
        tokens = [field.numbered(cut[j][1]) for j in lot]
        lengths = np.array(list(map(len, tokens)))
        emit = np.zeros((len(lot), lengths.max(), len(LABELS)))
        sums = field.weights[np.concatenate(tokens)].sum(1)
        emit[np.arange(lengths.max()) < lengths[:, None]] = sums
        for j, labels in zip(lot, viterbi(emit, lengths, field.steps), strict=True):
            found[j] = spans_of(cut[j][0], labels)
        lot = []
    return found


def spans_of(places: list[tuple[int, int]], labels: np.ndarray) -> list[Span]:
    out: list[Span] = []
    for i in np.flatnonzero(labels).tolist():
        kind, inner = divmod(int(labels[i]) - 1, 2)
        if inner:
            out[-1] = (kind, out[-1][1], places[i][1])
        else:
            out.append((kind, *places[i]))
    return out


def plausible(kind: int, text: str) -> bool:
    """Whether a span that the field found can be what it is said to be."""
    digits = _NO_DIGIT.sub("", text)
    if kind == 0:
        return bool(re.search(r"[A-Za-z0-9]\s*(@|[\[(]at[\])])", text) and re.search(r"\.|[\[(]dot[\])]", text) and re.search("[A-Za-z]", text))
    if kind == 1:
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and max(map(len, parts)) <= 3 and max(map(int, parts)) <= 255
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def added_spans(text: str, base: list[Span], found: Sequence[tuple[int, list[Span]]]) -> list[Span]:
    """Spans of the field, by chain and its start, that are plausible and touch no plain one."""
    taken = sorted((a, b) for _, a, b in base)
    out, k = [], 0
    for offset, spans in found:
        for kind, a, b in spans:
            a, b = a + offset, b + offset
            while k < len(taken) and taken[k][1] <= a:
                k += 1
            clear = all(y <= a or x >= b for x, y in taken[max(0, k - 4) : k + 1])
            if clear and plausible(kind, text[a:b]):
                out.append((kind, a, b))
    return out


# ---- Spark ----------------------------------------------------------------------------------------------------


def labelled_lines(spark: SparkSession) -> DataFrame:
    """The lines labelled by hand: text, spans (kind:start:end, comma-joined), weight."""
    rows = []
    for line in LABELLED:
        text, spans = "", []
        for piece in re.split(r"(<[a-z]+>.*?</>)", line):
            m = re.fullmatch(r"<([a-z]+)>(.*?)</>", piece)
            if m:
                spans.append((KINDS.index(m[1]), len(text), len(text) + len(m[2])))
            text += m[2] if m else piece
        rows.append((text, listed(spans), HAND_WEIGHT))
    return spark.createDataFrame(rows, "text string, spans string, weight double")


def sample_chains(docs: DataFrame) -> DataFrame:
    """A bounded sample of chains, labelled by the plain patterns: text, spans, weight."""
    # A threshold on the hash lets about twice as many through, so that tasks do not hand on a whole sample each.
    share = min(1.0, 2 * SAMPLE_DOCS / max(docs.count(), 1))
    lot = F.xxhash64(F.lit("chains of"), "doc_id").bitwiseAND(F.lit((1 << 32) - 1)) <= int(share * (1 << 32))
    fitting = docs.select("doc_id", "text").where(lot & (F.length("text") <= SAMPLE_LETTERS))
    some = sampled(fitting, SAMPLE_DOCS, "field", "doc_id", "text")

    def run(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"text": [], "spans": []}
        for text in cols["text"]:
            texts, spans = [], []
            if text:
                base = base_spans(text)
                for a, b in chains(text):
                    if b - a <= CHAIN_LETTERS:
                        texts.append(text[a:b])
                        spans.append(listed([(k, x - a, y - a) for k, x, y in base if a <= x and y <= b]))
            out["text"].append(texts)
            out["spans"].append(spans)
        return out

    cut = map_rows(some, ["text"], run, schema_of("text strings,spans strings"))
    each = cut.select(F.explode(F.arrays_zip("text", "spans")).alias("c")).select("c.text", "c.spans")
    return sampled(each, SAMPLE_CHAINS, "chains", "text", "spans").withColumn("weight", F.lit(1.0))


def fit(labelled: DataFrame, sample: DataFrame | None = None, steps: int = STEPS) -> Field:
    """Field learned from small tables of text, spans (kind:start:end, comma-joined) and weight.

    The spans of ``sample`` are those of the plain patterns, so they lack what the field is for: chains in which a field
    of the labelled table alone finds more are in doubt and not learned from.
    """
    known = _examples(labelled)
    if sample is None:
        return learn(known, steps)
    first, rest = learn(known, steps), _examples(sample)
    found = decode(first, [text for text, _, _ in rest])
    sure = [row for row, spans in zip(rest, found, strict=True) if not added_spans(row[0], row[1], [(0, spans)])]
    return learn(known + sure, steps)


def _examples(labelled: DataFrame) -> list[tuple[str, list[Span], float]]:
    rows = labelled.select("text", "spans", "weight").collect()
    return [(text, read_spans(spans), weight) for text, spans, weight in sorted((r.text, r.spans or "", r.weight) for r in rows if r.text)]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def read_spans(text: str) -> list[Span]:
    parts = [p.split(":") for p in text.split(",") if p]
    return [(KINDS.index(k), int(a), int(b)) for k, a, b in parts]


def find(docs: DataFrame, field: Field) -> DataFrame:
    """Personal data of every whole text: doc_id, n_email, n_ip, n_card, n_phone, base, spans.

    The counts and ``base`` are those of the plain patterns; ``spans`` has them and what the field adds, all as
    kind:start:end in code points, by kind and start, comma-joined. A null or empty text has none. Repeated rows and
    null ids are kept as they are; other columns are not looked at. One pass, no shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field)
    counts = [f"n_{kind}" for kind in KINDS]

    def run(cols: dict[str, list]) -> dict[str, list]:
        own = sent.value
        out: dict[str, list] = {name: [] for name in ("doc_id", *counts, "base", "spans")}
        around = [[(a, b) for a, b in chains(t)] if t else [] for t in cols["text"]]
        found = iter(decode(own, [t[a:b] for t, cut in zip(cols["text"], around, strict=True) for a, b in cut]))
        for doc_id, text, cut in zip(cols["doc_id"], cols["text"], around, strict=True):
            base = base_spans(text) if text else []
            more = added_spans(text, base, [(a, next(found)) for a, _ in cut])
            out["doc_id"].append(doc_id)
            for kind, name in enumerate(counts):
                out[name].append(sum(k == kind for k, _, _ in base))
            out["base"].append(listed(base))
            out["spans"].append(listed(base + more))
        return out

    # The text comes first, so that slices go by its length; the id keeps its own type.
    plain = schema_of(",".join(f"{name} bigint" for name in counts) + ",base string,spans string")
    schema = type(plain)([docs.schema["doc_id"], *plain])
    return map_rows(docs, ["text", "doc_id"], run, schema)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``find`` with a field learned from the lines labelled by hand and a sample of ``docs``, with digests of ``base``."""
    field = fit(labelled_lines(docs.sparkSession), sample_chains(docs))
    return find(docs, field).withColumn("base_sha256", sha256_hex(F.col("base")))
