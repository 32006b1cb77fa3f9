from __future__ import annotations

import datetime as dt
import random

import pytest

from eventloom.operators import overlap as ov
from eventloom.operators import pairs as pr

SCHEMA = "row_idx long, case_tag string, underlying string, ex_date string, pay_date string, amount double, div_ccy string, economic_event_id string, vendor_event_id string, isin string, div_type string, status string, source string, note string, source_event_key string"


def make_rows(n: int, seed: int, hot: float = 0.5):
    rnd = random.Random(seed)
    day = lambda lo, hi: (dt.date(2025, 1, 1) + dt.timedelta(days=rnd.randint(lo, hi))).isoformat()
    return [
        {
            "row_idx": i,
            "case_tag": "O3A",
            "underlying": "HOT" if rnd.random() < hot else f"U{rnd.randint(0, 8)}",
            "ex_date": rnd.choice(["", day(0, 60), day(0, 60), day(0, 60)]),
            "pay_date": rnd.choice(["", day(70, 74), day(70, 74), day(70, 74)]),
            "amount": rnd.choice([None, 0.5, 0.51, 0.53, 1.0, 1.01]),
            "div_ccy": rnd.choice(["USD", "usd ", "BRL"]),
            "economic_event_id": f"e{i}",
            "vendor_event_id": f"v{rnd.randint(0, n)}",
            "isin": "US1",
            "div_type": rnd.choice(["", "a", "b"]),
        }
        for i in range(n)
    ]


def days(a: str, b: str) -> int:
    return (dt.date.fromisoformat(b) - dt.date.fromisoformat(a)).days


def brute_pairs(rows, window):
    out = []
    for name in sorted({r["underlying"] for r in rows}):
        group = [r for r in rows if r["underlying"] == name and r["ex_date"]]
        group.sort(
            key=lambda r: (r["ex_date"], r["pay_date"] == "", r["pay_date"], r["amount"] is None, r["amount"] or 0, r["row_idx"])
        )
        for i, a in enumerate(group):
            out += [(a, b) for b in group[i + 1 :] if days(a["ex_date"], b["ex_date"]) <= window]
    return out


@pytest.mark.parametrize("ex_ge", [0, 1])
def test_pair_queue_equals_all_pairs_filtered(table, ex_ge):
    rows = make_rows(150, 1)
    policy = pr.PairPolicy(ex_shift_days_ge=ex_ge, pay_shift_days_le=1, amount_abs_diff_le=0.02, max_ex_shift_window_days=20)
    got = {(r.row_idx_a, r.row_idx_b) for r in pr.pair_queue(table(SCHEMA, rows), policy).collect()}
    want = {
        (a["row_idx"], b["row_idx"])
        for a, b in brute_pairs(rows, 20)
        if days(a["ex_date"], b["ex_date"]) >= ex_ge
        and a["pay_date"]
        and b["pay_date"]
        and abs(days(a["pay_date"], b["pay_date"])) <= 1
        and a["amount"] is not None
        and b["amount"] is not None
        and abs(a["amount"] - b["amount"]) <= 0.02
    }
    assert got == want and want


@pytest.mark.parametrize("cap, window", [(1, 30), (37, 3), (500, 10), (10**6, 2)])
def test_first_pairs_equals_prefix_of_all_pairs(table, cap, window):
    rows = make_rows(90, 2)
    got = [(r.row_idx_a, r.row_idx_b) for r in pr.first_pairs(table(SCHEMA, rows), min(cap, 4000), window).collect()]
    want = [(a["row_idx"], b["row_idx"]) for a, b in brute_pairs(rows, window)][: min(cap, 4000)]
    assert sorted(got) == sorted(want)


def brute_flags(rows, group="underlying"):
    flags = {r["row_idx"]: set() for r in rows}
    full = [r for r in rows if r["ex_date"] and r["pay_date"] and r["amount"] is not None]
    for name in {r[group] for r in rows}:
        base = [r for r in rows if r[group] == name and r["ex_date"]]
        for r in base:
            same = [x for x in base if x["ex_date"] == r["ex_date"] and x["pay_date"]]
            if r["pay_date"] and len({x["pay_date"] for x in same}) > 1:
                flags[r["row_idx"]].add("O1")
            same = [x for x in same if x["pay_date"] == r["pay_date"] and x["amount"] is not None]
            if r["pay_date"] and r["amount"] is not None and len({x["amount"] for x in same}) > 1:
                flags[r["row_idx"]].add("O2")
            if len({x["div_ccy"].strip().upper() for x in base}) > 1:
                flags[r["row_idx"]].add("O5")
        near = sorted((r for r in full if r[group] == name), key=lambda r: (r["ex_date"], r["row_idx"]))
        for i, a in enumerate(near):
            for b in near[i + 1 :]:
                ex, pay = days(a["ex_date"], b["ex_date"]), abs(days(a["pay_date"], b["pay_date"]))
                if ex == 0 or ex > 7:
                    continue
                close = abs(a["amount"] - b["amount"]) <= 0.02 * max(a["amount"], b["amount"])
                hit = set()
                if ex <= 2 and pay == 0:
                    hit.add("O3a" if close else "O3c")
                if ex <= 2 and pay == 1 and close:
                    hit.add("O3b")
                if ex >= 3 and pay == 0 and close:
                    hit.add("O3d")
                if a["div_type"] and b["div_type"] and a["div_type"] != b["div_type"]:
                    hit.add("O6")
                flags[a["row_idx"]] |= hit
                flags[b["row_idx"]] |= hit
    vendor: dict = {}
    for r in rows:
        vendor.setdefault(r["vendor_event_id"], []).append(r["row_idx"])
    for members in vendor.values():
        if len(members) > 1:
            for i in members:
                flags[i].add("O4")
    return flags


@pytest.mark.parametrize("rows", [600, 2500])
def test_overlap_flags_equal_brute_force(table, rows):
    made = make_rows(rows, 5)
    got = ov.add_overlap_flags(ov.normalise(table(SCHEMA, made))).collect()
    found = {r.row_idx: {p for p in ov.PATTERNS if r[f"flag_{p}"]} for r in got}
    assert found == brute_flags(made)


def test_sample_prefers_single_pattern_rows(table):
    flagged = ov.add_overlap_flags(ov.normalise(table(SCHEMA, make_rows(200, 9))))
    out = ov.stratified_sample(flagged, seed=3, k=4).collect()
    assert out and max(r.sample_no for r in out) <= 4
    pure = ov.stratified_sample(flagged, seed=3, k=4, pure_only=True).collect()
    assert all(sum(r[f"flag_{p}"] for p in ov.PATTERNS) == 1 for r in pure)


@pytest.mark.parametrize("ex_ge", [0, 1])
def test_cells_and_members_hold_every_row_pair_once(table, ex_ge):
    rows = [r | {"economic_event_id": f"e{r['row_idx'] % 2}" if r["row_idx"] % 5 else None} for r in make_rows(120, 7)]
    rows += [r | {"row_idx": 1000 + r["row_idx"]} for r in rows[:60]]
    policy = pr.PairPolicy(ex_shift_days_ge=ex_ge, pay_shift_days_le=1, amount_abs_diff_le=0.02, max_ex_shift_window_days=20)
    data = table(SCHEMA, rows)
    cells = pr.pair_cells(data, policy)
    members = pr.pair_members(data, cells)
    got = [(r.row_idx_a, r.row_idx_b) for r in pr.row_pairs(cells, members).collect()]
    want = {
        (a["row_idx"], b["row_idx"])
        for a, b in brute_pairs(rows, 20)
        if days(a["ex_date"], b["ex_date"]) >= ex_ge
        and a["pay_date"]
        and b["pay_date"]
        and abs(days(a["pay_date"], b["pay_date"])) <= 1
        and a["amount"] is not None
        and b["amount"] is not None
        and abs(a["amount"] - b["amount"]) <= 0.02
    }
    assert len(got) == len(want) and set(got) == want
    listed = cells.collect()
    assert sum(r.n_pairs for r in listed) == len(want) > len(listed)
    sizes = {}
    for r in members.collect():
        sizes[r.cell] = sizes.get(r.cell, 0) + 1
    assert sizes == {c: n for r in listed for c, n in ((r.cell_a, r.rows_a), (r.cell_b, r.rows_b))}


def test_copies_do_not_multiply_in_stage_two(table):
    from eventloom.plans import stage2 as s2

    one = {"case_tag": "O3A", "underlying": "U", "pay_date": "2025-03-01", "amount": 1.0, "div_ccy": "USD", "isin": "US0000000001", "source": "s", "status": ""}
    rows = [one | {"row_idx": i, "ex_date": f"2025-02-0{1 + i % 2}", "economic_event_id": f"e{i % 2}", "vendor_event_id": f"v{i}"} for i in range(400)]
    made = s2.stage2(table(SCHEMA, rows), options=s2.Stage2Options(respect_existing=True, pairs_enabled=True))
    queue = made.pair_queue.collect()
    assert len(queue) == 1 and queue[0].n_pairs == 200 * 200
    assert made.pair_members.count() == 400 and made.pair_events.count() == 2


def test_a_hot_day_is_ranked_in_parts(table):
    rows = [r | {"underlying": "HOT", "ex_date": "2025-01-05" if r["row_idx"] % 4 else "2025-01-07"} for r in make_rows(700, 5)]
    made = pr.first_pairs(table(SCHEMA, rows), 40, 10)
    got = [(r.row_idx_a, r.row_idx_b) for r in made.collect()]
    assert sorted(got) == sorted((a["row_idx"], b["row_idx"]) for a, b in brute_pairs(rows, 10)[:40])


def test_stage_two_writes_every_row_pair(spark, table, tmp_path):
    from eventloom.plans import stage2 as s2

    rows = [("U", "U", "O3", f"2024-01-{d:02}", "2024-02-01", "1.0", "USD", f"e{d}", "", i) for i, d in enumerate([1] * 3 + [3] * 4)]
    rows = [dict(zip(["underlying", "isin", "case_tag", "ex_date", "pay_date", "amount", "div_ccy", "economic_event_id", "vendor_event_id"], r, strict=False)) | {"row_idx": r[-1]} for r in rows]
    data = spark.createDataFrame(rows, "underlying string, isin string, case_tag string, ex_date string, pay_date string, amount string, div_ccy string, economic_event_id string, vendor_event_id string, row_idx bigint")
    s2.run(spark, str(tmp_path), data, options=s2.Stage2Options(respect_existing=True, pairs_enabled=True))
    read = lambda name: spark.read.parquet(f"{tmp_path}/stage2/{name}")
    assert {(r.row_idx_a, r.row_idx_b) for r in read("pair_queue").collect()} == {(a, b) for a in range(3) for b in range(3, 7)}
    assert read("pair_cells").count() == 1 and read("pair_members").count() == 7


def test_a_cell_asks_few_boxes(spark):
    cells = spark.sql(
        """SELECT 'U' AS g, date_add(DATE'2024-01-01', cast(id % 50 AS int)) AS ex_date, date_add(DATE'2024-02-01', cast(id % 31 AS int)) AS pay_date,
        (id * 37 % 1000) / 7.0D - 30 AS amount FROM range(2000)"""
    ).distinct()
    probes, placed = ov._boxed(cells)
    # 18 with boxes of a day and a band.
    assert probes.count() < 4 * placed.count()
