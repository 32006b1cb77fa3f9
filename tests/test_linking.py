from __future__ import annotations

import datetime as dt
import random

import pytest

from eventloom.operators.linking import LinkGuardError, LinkPolicy, assign_event_ids

SCHEMA = (
    "row_idx long, source string, source_event_key string, vendor_event_id string, underlying string, isin string, "
    "action_type string, share_class string, div_ccy string, amount double, ex_date string, record_date string, "
    "pay_date string, economic_event_id string"
)
BASE = {
    "source": "a", "source_event_key": "", "vendor_event_id": "", "underlying": "AAA", "isin": "US0000000001",
    "action_type": "cash_dividend", "share_class": "ordinary", "div_ccy": "USD", "amount": 1.0, "record_date": "",
    "pay_date": "", "economic_event_id": "",
}


def rows_of(table, *changes):
    return table(SCHEMA, [BASE | {"row_idx": i} | c for i, c in enumerate(changes)])


def linked(df, *args, **kwargs):
    out = assign_event_ids(df, *args, **kwargs).orderBy("row_idx").collect()
    return [r.economic_event_id for r in out], [r.event_link_reason for r in out], out


@pytest.mark.parametrize(
    "second, policy, same",
    [
        ({"ex_date": "2025-01-11", "amount": None}, LinkPolicy(), True),
        ({"ex_date": "2025-01-12", "amount": None}, LinkPolicy(), False),
        ({"ex_date": "2025-01-11", "amount": 0.0}, LinkPolicy(), False),
        ({"ex_date": "2025-01-11", "amount": 0.0}, LinkPolicy(allow_zero_amount_link=True), True),
        ({"ex_date": "2025-01-15", "amount": 1.2}, LinkPolicy(), True),
        ({"ex_date": "2025-01-16", "amount": 1.0}, LinkPolicy(), False),
        ({"ex_date": "2025-01-12", "amount": 1.3}, LinkPolicy(), False),
        ({"ex_date": "2025-01-12", "amount": 1.3}, LinkPolicy(max_amount_rel_move=0.5), True),
    ],
)
def test_link_rule(table, second, policy, same):
    ids, reasons, _ = linked(rows_of(table, {"ex_date": "2025-01-10"}, second), policy)
    assert (ids[0] == ids[1]) is same
    assert reasons == (["seed", "linked"] if same else ["seed", "seed"])


def test_rows_that_cannot_be_linked_say_why(table):
    ids, reasons, _ = linked(
        rows_of(
            table,
            {"ex_date": ""},
            {"ex_date": "2025-01-10", "div_ccy": "US"},
            {"ex_date": "x", "isin": " ", "underlying": "nan", "div_ccy": None},
            {"ex_date": "", "pay_date": "2025-02-01"},
        )
    )
    assert ids[:3] == ["", "", ""] and ids[3].startswith("eco_")
    assert reasons[:3] == [
        "skip:missing_anchor_date",
        "skip:missing_div_ccy",
        "skip:missing_ident,missing_div_ccy,missing_anchor_date",
    ]


def test_noise_does_not_change_ids(table):
    clean, _, _ = linked(rows_of(table, {"ex_date": "2025-01-10", "source_event_key": "k"}))
    noisy = {"isin": " us0000000001 ", "div_ccy": " usd", "action_type": "CASH_DIVIDEND ", "ex_date": " 2025-01-10"}
    other, _, _ = linked(rows_of(table, noisy | {"source_event_key": " k "}))
    assert clean == other


def test_vendor_id_makes_rows_canonical_by_source_priority(table):
    pair = (
        {"source": "vendor_a", "vendor_event_id": "V1", "ex_date": "2025-01-10", "share_class": ""},
        {"source": "vendor_b", "vendor_event_id": "V1", "ex_date": "2025-01-11", "amount": 1.05},
    )
    df = rows_of(table, *pair)
    first = linked(df, LinkPolicy(source_priority={"VENDOR_A": 1, "VENDOR_B": 2}))[2]
    second = linked(df, LinkPolicy(source_priority={"vendor_a": 2, "vendor_b": 1}))[2]
    assert [str(r.anchor_date) for r in first] == ["2025-01-10"] * 2
    assert [str(r.anchor_date) for r in second] == ["2025-01-11"] * 2
    assert first[0].economic_event_id == first[1].economic_event_id != second[0].economic_event_id


def test_vendor_id_on_two_identities_is_an_error(table):
    df = rows_of(
        table,
        {"vendor_event_id": "V1", "ex_date": "2025-01-10"},
        {"vendor_event_id": "V1", "ex_date": "2025-01-10", "isin": "US0000000002"},
    )
    with pytest.raises(LinkGuardError, match="V1"):
        assign_event_ids(df)


def test_presets_are_kept_and_shared_within_a_vendor_id(table):
    df = rows_of(
        table,
        {"vendor_event_id": "V1", "ex_date": "2025-01-10", "economic_event_id": "eco_p"},
        {"vendor_event_id": "V1", "ex_date": "2025-01-10"},
        {"ex_date": "2025-06-10"},
    )
    ids, reasons, _ = linked(df, respect_existing=True)
    assert ids[:2] == ["eco_p", "eco_p"] and reasons == ["preset", "preset", "seed"]
    assert linked(df)[1][:2] == ["seed", "linked"]


def test_conflicting_presets_are_an_error(table):
    df = rows_of(
        table,
        {"vendor_event_id": "V1", "ex_date": "2025-01-10", "economic_event_id": "a"},
        {"vendor_event_id": "V1", "ex_date": "2025-01-10", "economic_event_id": "b"},
    )
    with pytest.raises(LinkGuardError, match="conflicting"):
        assign_event_ids(df, respect_existing=True)


@pytest.mark.parametrize(
    "bad",
    [{"max_day_shift": -1}, {"max_amount_rel_move": 1.5}, {"source_priority": {" ": 1}}, {"source_priority": {"a": "1"}}],
)
def test_policy_is_validated(bad):
    with pytest.raises(ValueError):
        LinkPolicy(**bad)


def model(rows, policy):
    """Row-by-row statement of the rule."""
    groups: dict = {}
    for r in rows:
        groups.setdefault((r["isin"], r["share_class"]), []).append(r)
    keys = {}
    for members in groups.values():
        members.sort(key=lambda r: (r["ex_date"], r["source_event_key"], r["row_idx"]))
        amount = last = seed = None
        for r in members:
            day, value = dt.date.fromisoformat(r["ex_date"]), r["amount"]
            days = None if last is None else (day - last).days
            if days is None or days > policy.max_day_shift:
                join = False
            elif amount is None or value is None:
                join = days <= policy.max_day_shift_when_amount_missing
            elif amount == 0 or value == 0:
                join = policy.allow_zero_amount_link and days <= policy.max_day_shift_when_amount_missing
            else:
                gap = abs(amount - value)
                join = gap <= policy.min_absolute_diff_ignore or gap / max(abs(amount), abs(value)) <= policy.max_amount_rel_move
            last = day
            if not join:
                seed = f"{r['ex_date']}|{r['source_event_key']}"
                amount = value
            elif value:
                amount = value
            keys[r["row_idx"]] = seed
    return keys


@pytest.mark.parametrize("zero_links", [False, True])
@pytest.mark.parametrize("hot_rows", ["2000000", "120"])
def test_walk_equals_row_by_row_model(spark, table, zero_links, hot_rows):
    """The second limit makes one identity hot, so its rows are walked in chunks."""
    rnd = random.Random(7)
    rows = []
    for i in range(1500):
        hot = rnd.random() < 0.5
        rows.append(
            BASE
            | {
                "row_idx": i,
                "isin": "US0000000009" if hot else f"US00000000{rnd.randint(10, 30)}",
                "share_class": "x" if hot else rnd.choice("ab"),
                "ex_date": (dt.date(2025, 1, 1) + dt.timedelta(days=rnd.randint(0, 150))).isoformat(),
                "source_event_key": f"k{rnd.randint(0, 20):02d}",
                "amount": rnd.choice([None, 0.0, 1.0, 1.1, 1.5, 2.0, 1.0005]),
            }
        )
    policy = LinkPolicy(allow_zero_amount_link=zero_links)
    spark.conf.set("eventloom.hotRows", hot_rows)
    try:
        got = assign_event_ids(table(SCHEMA, rows).repartition(3), policy).collect()
    finally:
        spark.conf.unset("eventloom.hotRows")
    want = model(rows, policy)
    assert {r.row_idx: "|".join(r.economic_event_key.split("|")[4:]) for r in got} == want
    events = {r.economic_event_id for r in got}
    assert sum(r.event_link_reason == "seed" for r in got) == len(events)


def test_row_order_of_the_input_does_not_matter(table):
    rnd = random.Random(3)
    rows = [
        BASE | {"row_idx": i, "ex_date": f"2025-01-{rnd.randint(1, 28):02d}", "amount": rnd.choice([1.0, 1.4, 2.0]), "source_event_key": f"k{i}"}
        for i in range(60)
    ]
    shuffled = rows[:]
    rnd.shuffle(shuffled)
    a = {r.row_idx: r.economic_event_id for r in assign_event_ids(table(SCHEMA, rows)).collect()}
    b = {r.row_idx: r.economic_event_id for r in assign_event_ids(table(SCHEMA, shuffled).repartition(4)).collect()}
    assert a == b


@pytest.mark.parametrize("limits", [{}, {"max_day_shift": 3, "max_day_shift_when_amount_missing": 6}, {"allow_zero_amount_link": True}])
def test_chunks_of_a_few_rows_carry_every_state(spark, table, limits):
    """Days, ties and amounts repeat, and most rows leave the state open, so that it is carried over many chunks."""
    rnd = random.Random(11)
    rows = [
        BASE
        | {
            "row_idx": i,
            "isin": f"US00000000{10 + i % 3}",
            "ex_date": (dt.date(2025, 1, 1) + dt.timedelta(days=rnd.randint(0, 40) * rnd.randint(1, 3))).isoformat(),
            "source_event_key": f"k{rnd.randint(0, 2)}",
            "source": f"s{rnd.randint(0, 3)}",
            "amount": rnd.choice([None, None, None, 0.0, 0.0, 1.0, 1.5]),
        }
        for i in range(400)
    ]
    policy = LinkPolicy(**limits)
    shown = ("row_idx", "economic_event_key", "event_link_reason")
    plain = {tuple(r) for r in assign_event_ids(table(SCHEMA, rows), policy).select(*shown).collect()}
    for hot_rows in ("3", "17"):
        spark.conf.set("eventloom.hotRows", hot_rows)
        try:
            got = assign_event_ids(table(SCHEMA, rows).repartition(3), policy)
        finally:
            spark.conf.unset("eventloom.hotRows")
        assert {tuple(r) for r in got.select(*shown).collect()} == plain
    assert len({r[1] for r in plain}) > 20


def test_small_chunks_make_few_ranges(spark):
    from eventloom.operators.skew import into_chunks

    rows = spark.range(1000).selectExpr("cast(id % 3 AS string) AS key", "id AS row_idx")
    out = into_chunks(rows, ["key"], ["row_idx"], 1000, 4)
    # One range, file and task per chunk before: 250.
    assert len(out.inputFiles()) <= 2
    placed = sorted((r.key, r.row_idx, r["__chunk"]) for r in out.collect())
    chunks = [c for _, _, c in placed]
    assert len(placed) == 1000 and chunks == sorted(chunks) and max(map(chunks.count, set(chunks))) <= 4
