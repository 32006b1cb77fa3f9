from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from eventloom.llm import pii, spelling, whitening

# ---- Spelling ---------------------------------------------------------------------------------------------------


def plain_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    found = {}
    for w in words:
        near = [v for v in words if one_edit(w, v)]
        best = min(near, key=lambda v: (-words[v], v.encode()), default=None)
        found[w] = (len(near), best if best and words[best] >= 2 * words[w] else None)
    out = set()
    for w, (k, form) in found.items():
        root = w
        while found[root][1]:
            root = found[root][1]
        out.add((w, words[w], k, form, words.get(form), root))
    return out


def garbled(seed, n):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeéàß") for _ in range(rng.randint(4, 9))) for _ in range(25)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(30):
            w = list(rng.choice(stems))
            if rng.random() < 0.4:
                at = rng.randrange(len(w))
                w[at : at + rng.randint(0, 1)] = [rng.choice(["", "a", "bé", "é", "È", "Z"])]
            words.append("".join(w))
        rows.append((i, rng.choice([" ", "-", "1", "×ø "]).join(words)))
    return rows


EDGES = [(20, "lantern " * 40 + "lanterns " * 12 + "lanternss " * 4), (None, "Straße Straße Strasse strasse STRASSE"), (5, None), (6, ""), (7, "x" * 5000 + " " + "x" * 5001), (7, "x" * 5000 + " " + "x" * 5001), (7, "x" * 5000 + " " + "x" * 5001)]


@pytest.mark.parametrize(("subtree", "node"), [(20_000, 48), (5, 1), (1, 0)])
def test_variants_equal_brute_force(docs, monkeypatch, subtree, node):
    monkeypatch.setattr(spelling, "SUBTREE_WORDS", subtree)
    monkeypatch.setattr(spelling, "NODE_WORDS", node)
    rows = garbled(4, 60 if subtree > 1 else 25) + EDGES
    got = spelling.group_variants(docs(rows)).collect()
    want = plain_variants(plain_words(rows))
    assert len(got) == len(want) > 40
    assert {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == want
    assert any(w[5] != w[3] and w[3] for w in want)


def test_variants_of_nothing(docs):
    made = spelling.group_variants(docs([(1, None), (2, "one two")]))
    assert made.collect() == [] and spelling.group_variants(docs([])).collect() == []


def test_anagrams_fill_a_leaf(docs, monkeypatch):
    monkeypatch.setattr(spelling, "SUBTREE_WORDS", 7)
    rows = [(i, " ".join("".join(p) for p in itertools.permutations("abcde"))) for i in range(3)] + [(9, "abcdef abcdef abcdef")]
    got = {r.word: r.n_near for r in spelling.group_variants(docs(rows)).collect()}
    words = plain_words(rows)
    assert got == {w: sum(one_edit(w, v) for v in words) for w in words}


# ---- Personal data ----------------------------------------------------------------------------------------------


def plain_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if max(map(int, m.group().split("."))) <= 255:
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def test_plain_patterns():
    rng = random.Random(3)
    for _ in range(8000):
        text = "".join(rng.choice("ab1.2@-+ 3(9)%é") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("a" * 300 + "@b.c x@y@z.de 0001.2.3.255 1.2.3.256 " + "9" * 5000 + ".1.1.1") == [(0, 0, 304), (0, 307, 313), (1, 314, 326)]


def tiny(seed=1):
    examples = [("ab 12 cd", [(3, 3, 5)], 2.0), ("x@y.z 7", [(0, 0, 5)], 1.0), ("no 3", [], 1.0)]
    field = pii.learn(examples, steps=1)
    rng = np.random.default_rng(seed)
    field.weights[1:] = rng.normal(size=field.weights[1:].shape)
    field.steps[:] = rng.normal(size=field.steps.shape)
    return field, examples


def chain_score(field, tokens, labels):
    emit = field.weights[tokens].sum(1)
    start = pii._START[labels[0]] + emit[0, labels[0]]
    step = field.steps + pii._BARRED
    return start + sum(step[a, b] + emit[i, b] for i, (a, b) in enumerate(zip(labels, labels[1:]), 1))


def test_likelihood_and_viterbi_equal_enumeration():
    field, examples = tiny()
    places, names = pii.token_features("ab 12 c")
    tokens = field.numbered(names)
    every = list(itertools.product(range(len(pii.LABELS)), repeat=len(places)))
    scores = np.array([chain_score(field, tokens, labels) for labels in every])
    real = scores > -1e8
    best = every[int(scores.argmax())]
    emit = np.zeros((2, 5, len(pii.LABELS)))
    emit[0, :3], emit[1] = field.weights[tokens].sum(1), 1.0
    assert tuple(pii.viterbi(emit, np.array([3, 5]), field.steps)[0]) == best
    labels = np.array([0, 7, 8])
    whole = np.log(np.exp(scores[real]).sum())
    got = pii.likelihood(field, [tokens], [labels], np.ones(1))[0]
    assert abs(got - (chain_score(field, tokens, labels) - whole)) < 1e-9


def test_gradients_of_the_field():
    field, examples = tiny(2)
    cut = [(pii.token_features(t), s, w) for t, s, w in examples]
    data = [field.numbered(f[1]) for f, _, _ in cut], [pii.label_tokens(f[0], s) for f, s, _ in cut], np.array([w for *_, w in cut])
    _, score, moves = pii.likelihood(field, *data)
    for part, grad in ((field.weights, score), (field.steps, moves)):
        for at in np.argsort(-np.abs(grad).ravel())[:6]:
            old = part.flat[at]
            part.flat[at] = old + 1e-5
            up = pii.likelihood(field, *data)[0]
            part.flat[at] = old - 1e-5
            down = pii.likelihood(field, *data)[0]
            part.flat[at] = old
            assert abs((up - down) / 2e-5 - grad.flat[at]) < 1e-5 * max(1, abs(grad.flat[at]))


def test_personal_data_of_documents(docs, spark, prose):
    shown = "ring (030) 555-7713 or +1 (017) 555-7713, mail ana [at] web.example.com; 54 items of 2024-05-17"
    rows = [(1, None), (2, ""), (3, shown), (3, shown), (None, "4111 1111 1111 1111"), (4, "x" * 50_000 + " 1" * 3000)]
    rows += [(10 + i, f"{prose(i, 12)} +1 (555) 010-{1000 + i} {prose(i + 1, 5)} u{i}@mail{i}.example.org 9807915762804491") for i in range(40)]
    got = {(r.doc_id): r for r in pii.find_personal_data(docs(rows)).collect()}
    assert len(pii.find_personal_data(docs(rows)).collect()) == len(rows)
    assert got[1].spans == "" and got[2].n_phone == 0 and got[None].n_card == 1
    spans = {(k, shown[a:b]) for k, a, b in pii.read_spans(got[3].spans)}
    assert {(3, "+1 (017) 555-7713"), (3, "(030) 555-7713"), (0, "ana [at] web.example.com")} <= spans and len(spans) == 3
    assert got[3].n_phone == 1 and got[3].base == "phone:23:40"
    for i, text in rows:
        if i and i >= 10:
            assert got[i].spans == got[i].base == pii.listed(plain_spans(text))
    assert pii.find_personal_data(docs([])).collect() == []


def test_chains_hold_all_marked_words():
    rng = random.Random(5)
    for _ in range(500):
        text = "".join(rng.choice("ab \n1@") if rng.random() < 0.3 else rng.choice("ab ") for _ in range(rng.randint(0, 120)))
        cut = pii.chains(text)
        assert all(b <= c for (_, b), (c, _) in zip(cut, cut[1:]))
        for m in re.finditer(r"\S*[0-9@]\S*", text):
            assert any(a <= m.start() and m.end() <= b for a, b in cut)
        words = [m.span() for m in re.finditer(r"\S+", text)]
        marked = [i for i, (a, b) in enumerate(words) if re.search("[0-9@]", text[a:b])]
        kept = sorted({j for i in marked for j in range(i - 2, i + 3) if 0 <= j < len(words)})
        assert kept == [i for i, (a, b) in enumerate(words) if any(x <= a and b <= y for x, y in cut)]


# ---- Whitening --------------------------------------------------------------------------------------------------


def check_whitening(got, vectors, components=4):
    """Against the eigenvectors of the exact covariance."""
    x = np.floor(256 * np.array([v for _, v in vectors], float))
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    e, q = np.linalg.eigh((u - s / n).T @ (u - s / n) / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, int((e > 1e-18 * e[0]).sum()), n - 1, len(e))
    rows = sorted(got, key=lambda r: (r.vec_id, r.component))
    assert len(rows) == k * len(vectors) and {r.component for r in rows} == set(range(1, k + 1))
    assert all(r.n == n and r.identity_error < 1e-9 for r in rows)
    place = {i: p for p, (i, _) in enumerate(vectors)}
    for c in range(k):
        z = (x - s / n) @ q[:, c] / np.sqrt(e[c])
        w = np.array([r.whitened for r in rows[c::k]])
        z = z[[place[r.vec_id] for r in rows[c::k]]]
        assert min(np.abs(w - z).max(), np.abs(w + z).max()) < 1e-8
        assert abs(rows[c].explained - e[c] / e.sum()) < 1e-12
    for r in rows:
        row = [int(v) for v in x[place[r.vec_id]]]
        assert r.deviation == sum((n * v - int(t)) ** 2 for v, t in zip(row, s))


@pytest.mark.parametrize(("rows", "size"), [(200, 24), (9, 30), (60, 3), (3, 5)])
def test_whitening_equals_eigenvectors(table, rows, size):
    rng = np.random.default_rng(rows)
    scale = np.linspace(1, 3, size)
    vectors = [(i, (rng.normal(size=size) * scale).astype(np.float32).tolist()) for i in range(rows)]
    vectors += [(rows + i, vectors[0][1]) for i in range(40)]  # Copies weigh nothing in the fit.
    made = table("vec_id bigint, embedding array<float>, x int, key string", [{"vec_id": i, "embedding": v, "x": 1} for i, v in vectors])
    check_whitening(whitening.whiten(made).collect(), vectors)


def test_early_stop_and_equal_variances(table):
    rng = np.random.default_rng(2)
    wide = rng.normal(size=(300, 80)) * np.concatenate([[40, 30, 20, 10], np.ones(76)])
    made = table("vec_id bigint, embedding array<double>", [{"vec_id": i, "embedding": v.tolist()} for i, v in enumerate(wide)])
    fitted = whitening.fit(whitening.whole_numbers(made))
    assert fitted.steps < 80
    check_whitening(whitening.whiten(made).collect(), list(enumerate(wide.tolist())))
    # Two directions of equal variance: the span closes early and is opened again.
    cross = [(1.0, 0.0, 0.0), (-1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, -1.0, 0.0)]
    made = table("vec_id bigint, embedding array<double>", [{"vec_id": i, "embedding": list(v)} for i, v in enumerate(cross)])
    got = whitening.whiten(made).collect()
    assert {r.component for r in got} == {1, 2} and all(abs(r.explained - 0.5) < 1e-12 and r.identity_error < 1e-9 for r in got)


def test_vectors_that_cannot_be_used(table):
    schema = "vec_id bigint, embedding array<float>"
    bad = [None, [], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, 2.0, 3.0]]
    good = [[0.0, -0.001], [1.0, 0.5], [1.0, 0.5], [2.0, 0.25]]
    rows = [{"vec_id": i, "embedding": v} for i, v in enumerate(bad)] + [{"vec_id": None, "embedding": v} for v in good]
    got = whitening.whiten(table(schema, rows)).collect()
    assert len(got) == 8 and {r.vec_id for r in got} == {None} and {r.n for r in got} == {3}
    assert whitening.whiten(table(schema, [])).collect() == []
    assert whitening.whiten(table(schema, rows[:2] + [rows[7]] * 3)).collect() == []
    huge = [{"vec_id": i, "embedding": [3e38 * i, float(i)]} for i in range(3)]
    assert {r.deviation for r in whitening.whiten(table(schema, huge)).collect()} == {None}
