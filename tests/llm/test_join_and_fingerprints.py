from __future__ import annotations

import hashlib
import random
import time
from pathlib import Path

import numpy as np
import pytest

from eventloom.llm import jaccard, sharding, winnowing
from eventloom.llm.components import components
from eventloom.session import cut_lineage


def shingles(text, n):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x1c", "\x1c")
    found = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not found:
        return set()
    return {tuple(found[i : i + n]) for i in range(max(1, len(found) - n + 1))}


def brute(rows, rule):
    sets = [shingles(t, rule.words) for _, t in rows]
    near = [[j for j in range(len(rows)) if i != j and sets[i] and sets[j] and rule.whole * len(sets[i] & sets[j]) >= rule.part * len(sets[i] | sets[j])] for i in range(len(rows))]
    group = list(range(len(rows)))
    for _ in rows:
        for i, own in enumerate(near):
            group[i] = min([group[i], *(group[j] for j in own)])
    least = {}
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        least[i] = min(ids) if ids else None
    return [(rows[i][0], len(sets[i]), len(near[i]), least[i] if sets[i] else rows[i][0]) for i in range(len(rows))]


def edits(text, seed, count):
    rng, words = random.Random(seed), text.split()
    for _ in range(count):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(prose):
    rows = [(i, prose(i, 20 + i)) for i in range(30)]
    rows += [(100 + i, edits(prose(900, 120), i, i % 5)) for i in range(90)]
    rows += [(300 + i, prose(i, 60) + " " + prose(901, 30)) for i in range(80)]
    rows += [(400, None), (401, ""), (402, " \t"), (403, "one"), (404, "ONE"), (405, "one two"), (406, "one two"), (406, "one two"), (None, prose(0, 20)), (None, "alone here in the null row")]
    rows += [(500, prose(7, 6000)), (501, edits(prose(7, 6000), 1, 40)), (502, "a b c d e f"), (503, "a b c d e f"), (504, "x\x1cy z")]
    return rows


@pytest.mark.parametrize("rule", [jaccard.Rule(3, 90, 100), jaccard.Rule(5, 4, 5)])
@pytest.mark.parametrize("bound", [jaccard.PAIRED_CLASSES, 8])
def test_groups_equal_brute_force(docs, prose, rule, bound, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRED_CLASSES", bound)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 3000)
    rows = corpus(prose)
    got = [(r.doc_id, r.n_shingles, r.n_links, r.component_id) for r in jaccard.jaccard_groups(docs(rows), rule).collect()]
    order = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(got, key=order) == sorted(brute(rows, rule), key=order)


def test_one_of_each_group_stays(docs, prose):
    rule = jaccard.Rule(5, 4, 5)
    rows = corpus(prose)
    kept = jaccard.one_of_each_group(docs(rows), rule)
    assert kept.columns == docs(rows).columns
    want = sorted({c for i, n, _, c in brute(rows, rule) if n and c is not None} | {400, 401, 402})
    got = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in got if i is not None) == want and got.count(None) == 1


def test_join_of_empty_tables(docs):
    assert jaccard.jaccard_groups(docs([])).count() == 0
    assert jaccard.one_of_each_group(docs([(1, None), (None, "")])).count() == 2


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {(i, 0) for i in range(41)} | {(i, 100) for i in range(100, 140)} | {(200, 200), (201, 200)}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_winnowing_chooses_rightmost_minima():
    rng = np.random.default_rng(2)
    for n in [*range(1, 30), 200]:
        hashes = rng.integers(0, 5, n).astype(np.uint64)
        w = min(6, n)
        want = []
        for i in range(n - w + 1):
            least = min(hashes[i : i + w])
            at = max(j for j in range(i, i + w) if hashes[j] == least)
            if not want or want[-1] != at:
                want.append(at)
        assert winnowing.choose(hashes, 6).tolist() == want


def test_winnowing_guarantee_and_pieces(prose, monkeypatch):
    a, b = prose(1, 300), prose(2, 300)
    shared = prose(3, 40)[: winnowing.K + winnowing.W - 1]
    assert set(winnowing.fingerprint(a + shared)[0].tolist()) & set(winnowing.fingerprint(shared + b)[0].tolist())
    whole = winnowing.fingerprint(a + "é🙂" + b)
    monkeypatch.setattr(winnowing, "PIECE", 100)
    parts = winnowing.fingerprint(a + "é🙂" + b)
    assert all((x == y).all() for x, y in zip(whole, parts, strict=True))


def plain_compare(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc, text) in enumerate(order):
        own, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(own) // 2
        changed = own[: len(own) - half] + after[:half]
        prints = [winnowing.fingerprint(t)[0] for t in (own, changed, after)]
        out.append((doc, len(own), hashlib.sha256(changed.encode()).hexdigest(), *map(winnowing.shown, prints[:2]), winnowing.likeness(prints[0], prints[1]), winnowing.likeness(prints[0], prints[2])))
    return out


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_comparison_with_the_next_document(docs, prose, size):
    rows = [(i * 3 % 101, prose(i, i * 3)) for i in range(40)] + [(500, None), (None, "null id"), (None, "another"), (7, "repeat"), (7, "repeat"), (7, None), (600, "é🙂" * 50)]
    got = [tuple(r) for r in winnowing.compare_with_next(docs(rows), range_rows=size).collect()]
    assert sorted(got, key=str) == sorted(plain_compare(rows), key=str)
    one = [(4, "only one here, followed by itself")]
    assert [tuple(r) for r in winnowing.compare_with_next(docs(one), range_rows=size).collect()] == plain_compare(one)
    assert winnowing.compare_with_next(docs([]), range_rows=size).count() == 0
    nulls = [(None, "a text"), (None, "b text")]
    assert sorted(map(tuple, winnowing.compare_with_next(docs(nulls), range_rows=size).collect()), key=str) == sorted(plain_compare(nulls), key=str)


def test_fingerprints_keep_places(docs):
    row = winnowing.fingerprints(docs([(1, "the quick brown fox jumps over it"), (2, None)])).orderBy("doc_id").collect()
    hashes, places = winnowing.fingerprint("the quick brown fox jumps over it")
    assert row[0].places == places.tolist() and row[0].hashes == hashes.tolist() and row[1].hashes == []


def test_shards_follow_the_mixture(spark):
    import zlib

    rows = [(i, f"text {i}" if i % 50 else None, ["a", "b", None][0 if i % 3 == 0 or i % 7 == 0 else 1 + i % 2]) for i in range(1000)] + [(5, "text 5", "a")] * 3 + [(None, "é", "z")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for shards, bucket_rows in ((24, 200_000), (7, 9)):
        got = sharding.assign_shards(table, shards=shards, bucket_rows=bucket_rows).collect()
        assert len(got) == len(rows)
        sizes = [[r for r in got if r.shard == s] for s in range(shards)]
        assert max(map(len, sizes)) - min(map(len, sizes)) <= 1
        for own in sizes:
            assert sorted(r.slot for r in own) == list(range(len(own)))
        for source in ("a", "b", None):
            n = sum(r.source == source for r in got)
            assert all(abs(sum(r.source == source for r in own) - n / shards) <= 2 for own in sizes)
    want = sorted((i or -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == want
    assert sharding.assign_shards(table.limit(0)).count() == 0


def test_buckets_are_even_however_rows_repeat(spark):
    """Many sources of two rows, and one id and text for all rows of another."""
    small = spark.range(6000).selectExpr("id AS doc_id", "'t' AS text", "concat('s', id DIV 2) AS source")
    same = spark.range(3000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'same' AS text", "'one' AS source")
    seen = []
    plain = sharding.ranged

    def watched(df, order, bucket_rows):
        out = plain(df, order, bucket_rows)
        seen.append(out.groupBy("__bucket").count().agg({"count": "max"}).first()[0])
        return out

    sharding.ranged = watched
    try:
        got = sharding.assign_shards(small.unionByName(same), shards=8, bucket_rows=500).collect()
    finally:
        sharding.ranged = plain
    assert len(got) == 9000 and len(seen) == 2 and max(seen) <= 1000
    for s in range(8):
        own = [r for r in got if r.shard == s]
        assert len(own) == 1125 and sorted(r.slot for r in own) == list(range(1125)) and abs(sum(r.source == "one" for r in own) - 375) <= 60


def test_words_are_hashed_together(monkeypatch):
    words = [w.encode() for w in ("a", "b", "é", "abcdefg", "abcdefgh", "abcdefghi", "x" * 63, "x" * 64, "x" * 65, "x" * 66, "\0", "\0\0", "\0a", "a\0")]
    alone = [jaccard._word_hashes(w).tolist() for w in words]
    assert len({h for (h,) in alone}) == len(words)
    text = b" \t" + b" \n".join([*words, *reversed(words)]) + b"\x0b\x0c\r"
    assert jaccard._word_hashes(text).tolist() == [h for (h,) in [*alone, *reversed(alone)]]
    assert jaccard._word_hashes(b"").tolist() == jaccard._word_hashes(b" \t ").tolist() == []
    # No Python call a word: that took most of the time of the join.
    calls = []
    monkeypatch.setattr(jaccard.hashlib, "blake2b", lambda *a, **k: calls.append(a))
    assert len(jaccard.Shingler(3)(" ".join(f"word{i}" for i in range(1000)))) == 998 and not calls


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for folder in folders for f in Path(folder).rglob("shuffle_*.data")}


def test_a_written_table_can_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    shuffled = spark.range(10000).selectExpr("id % 100 AS k").groupBy("k").count().repartition("count", "k")
    written = cut_lineage(shuffled, drop_shuffles=True)
    for _ in range(100):  # they go in the background
        if left := shuffle_files(spark) - before:
            time.sleep(0.1)
    assert not left and written.count() == 100
    cut_lineage(shuffled)
    assert shuffle_files(spark) - before


def spied(monkeypatch, name):
    """Calls of a function of the module: lists of arguments and result."""
    calls, plain = [], getattr(jaccard, name)

    def spy(*args):
        calls.append([*args, plain(*args)])
        return calls[-1][-1]

    monkeypatch.setattr(jaccard, name, spy)
    return calls


def test_a_phrase_of_many_texts_bundles_none(docs, prose, monkeypatch):
    """Where the order does not keep a phrase of many texts out of prefixes, it chains none: a link asks for more."""
    rule = jaccard.Rule(3, 4, 5)
    monkeypatch.setattr(jaccard, "PAIRED_CLASSES", 8)
    monkeypatch.setattr(jaccard, "extension", lambda seen, size, need: jaccard.MAX_EXTENSION)
    monkeypatch.setattr(jaccard, "prefix_order", lambda seen, weights, usual: np.arange(len(seen)))
    bundled, plain = [], jaccard._verify_bundles
    monkeypatch.setattr(jaccard, "_verify_bundles", lambda members, *args: [bundled.append(members.count()), plain(members, *args)][1])
    rows = [(i, f"zeta eta theta iota kappa lambda {prose(i, 50)}") for i in range(60)] + [(100 + i, edits(prose(900, 200), i, 1)) for i in range(12)]
    got = [(r.doc_id, r.n_shingles, r.n_links, r.component_id) for r in jaccard.jaccard_groups(docs(rows), rule).collect()]
    assert sorted(got) == sorted(brute(rows, rule)) and sum(bundled) == 12


def test_edges_of_shingles_of_many_classes(spark):
    rows = [("few", k, 100, 8, 3) for k in range(20)] + [("own", k, 100, 4, 4) for k in range(20, 30)] + [("own", 30, 100, 8, 5), ("own", 31, 100, 8, 3)]
    hot = spark.createDataFrame([(hash(t), k, n, ell, h) for t, k, n, ell, h in rows], "token bigint, key bigint, n int, ell int, hot bigint")
    assert {(r.u, r.v) for r in jaccard._chains(hot).collect()} == {(k, 20) for k in range(21, 31)}


def test_bundles_take_turns(docs, prose, monkeypatch):
    monkeypatch.setattr(jaccard, "MOVED_SHARE", 0.2)
    calls = spied(monkeypatch, "_verify_bundles")
    rows = corpus(prose)
    got = [(r.doc_id, r.n_shingles, r.n_links, r.component_id) for r in jaccard.jaccard_groups(docs(rows)).collect()]
    order = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(got, key=order) == sorted(brute(rows, jaccard.Rule()), key=order) and len(calls) > 1


def test_equal_lists_are_paired_once(spark, monkeypatch):
    """Pairs of a cluster add up before they are dealt, whatever the number of shingles they share."""
    keys = [(k, 100, 2) for k in range(1, 13)]
    lists = spark.createDataFrame([(keys,)] * 50 + [(keys[1:],)], "l array<struct<key bigint, n int, ell int>>")
    held = spark.createDataFrame([], "key bigint, hot bigint")
    found = jaccard._candidates(lists, held, jaccard.Rule(5, 4, 5))
    assert {(r.u, r.v) for r in found.collect()} == {(u, v) for u in range(1, 13) for v in range(u + 1, 13)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Aggregate [least") < plan.index("RepartitionByExpression [least")


def test_shingles_of_common_words_come_last():
    logs = np.array([16 * 20, 16 * 20, 16 * 3, 16 * 3])
    assert jaccard.prefix_order(np.array([7, 5, 9, 8]), logs, usual=16 * 10).tolist() == [3, 2, 1, 0]


def test_few_texts_are_dealt_to_choose_rows(docs, prose, monkeypatch):
    """Rows of groups of their own and rows that go are told apart where they are."""
    calls = spied(monkeypatch, "_left")
    rows = [(i, prose(i, 60)) for i in range(200)] + [(1000 + i, prose(i, 60)) for i in range(20)] + [(5, prose(5, 60)), (None, "a null"), (None, "a null"), (7, " ")]
    got = [r.doc_id for r in jaccard.one_of_each_group(docs(rows)).collect()]
    assert sorted(i for i in got if i is not None) == sorted([*range(200), 7]) and got.count(None) == 1
    # The two rows 5, one of the null ids' and some that the filters mistake.
    assert 3 <= calls[0][-1].count() <= 12
