from __future__ import annotations

import hashlib
import re

import pytest

from eventloom.llm import bpe, decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text, items):
    words = WORD.findall(lowered(text))
    hit, found = set(), set()
    for item, body in items:
        own = WORD.findall(lowered(body))
        size = min(10, len(own))
        wanted = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if own and tuple(words[i : i + size]) in wanted:
                hit.update(range(i, i + size))
                found.add("" if item is None else str(item))
    names = sorted(found)
    return len(words), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)


def test_decontamination_against_brute_force(spark, docs, prose):
    long_item = prose(1, 25)
    words = long_item.split()
    items = [(1, long_item), (2, "Tiny ITEM"), (3, None), (4, ""), (5, "!!"), (10, "tiny item"), (2, "Tiny ITEM"), (None, "größe zählt"), (6, prose(1, 25) + " x")]
    rows = [
        (1, None), (2, ""), (3, "nothing here"), (4, " ".join(words[3:13])), (5, " ".join(words[3:12])),
        (6, "A tiny--item, twice: TINY Item " + ", ".join(words[:20]).upper()), (6, "tiny item"), (None, "Größe zählt größe zählt"),
        (7, prose(2, 3000) + " " + long_item + " " + prose(3, 3000)), (8, "tinyitem tiny item"), (9, "tiny item tiny item tiny item"),
    ]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for size in (decontam.PATTERN_BYTES, 100):
        got = decontam.decontaminate(docs(rows), bench, pattern_bytes=size).collect()
        assert sorted(((r.doc_id or -1), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == sorted(
            ((i or -1), *brute(t, items)) for i, t in rows
        )
        for r in got:
            text = next(t for i, t in rows if i == r.doc_id and (t or "") and brute(t, items)[1] == r.n_hit) if r.n_hit else ""
            assert sum(len(WORD.findall(lowered(text[s.start : s.end]))) for s in r.spans) == r.n_hit
    kept = decontam.clean_documents(docs(rows), bench)
    assert kept.columns == docs(rows).columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted((i or -1) for i, t in rows if not brute(t, items)[4])


def test_decontamination_of_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.decontaminate(docs([]), none).count() == 0
    got = decontam.decontaminate(docs([(1, "a b")]), none).first()
    assert (got.n_words, got.n_hit, got.contaminated) == (2, 0, False)


TEXTS = [
    None, "", " ", "a", "Hello  world\n\n it's we'LL 'twas", "日本語 テスト 🙂🙂", "x<|endoftext|> y <|endoftext|>", "<|endoftext", "ab" * 3000,
    "\x00\x01 ﻿", "  tail  \t\n", "½ ١٢٣ x²", "é é",
]


def test_bpe_equals_the_library(docs, prose):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = [(i, t) for i, t in enumerate([*TEXTS, prose(5, 5000)])] + [(None, "twice"), (1, "twice")]
    coded = {(r.doc_id, tuple(r.ids)) for r in bpe.encode_documents(docs(rows), path).collect()}
    assert coded == {(i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows}
    digests = bpe.encode_and_decode(docs(rows), path).collect()
    assert len(digests) == len(rows)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert (i, len(ids), sha(",".join(map(str, ids))), sha(back)) in {tuple(r) for r in digests}
    back = bpe.decode_documents(bpe.encode_documents(docs(rows), path), path).collect()
    assert sorted(((r.doc_id or -1), r.text) for r in back) == sorted(((i or -1), t or "") for i, t in rows)
    assert bpe.encode_documents(docs([]), path).count() == 0


def test_segment_tree_merges_leftmost_lowest():
    letters = bpe.byte_letters()
    assert sorted(letters.values()) == list(range(256))
    P = pytest.importorskip("public_tokenizers")
    vocabulary = bpe.load(P.path("byte_bpe_50k.json"))
    pairs = {k: (r, m) for k, r, m in zip(vocabulary.pair_keys.tolist(), vocabulary.pair_ranks.tolist(), vocabulary.pair_ids.tolist(), strict=True)}

    def plain(word):
        ids = [int(vocabulary.first_ids[b]) for b in word]
        while True:
            ranked = [(*pairs[a * 1_000_003 + b], i) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if a * 1_000_003 + b in pairs]
            if not ranked:
                return ids
            _, made, at = min(ranked, key=lambda x: (x[0], x[2]))
            ids[at : at + 2] = [made]

    words = [b"aaaaaaa", b" the", b"abababab" * 9, b"\xff\xfe", b"z", b"1234567890" * 13, b"hellohello"]
    assert bpe.encode_words(vocabulary, words) == [plain(w) for w in words]
