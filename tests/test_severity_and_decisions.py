from __future__ import annotations

import pytest

from eventloom.operators import decisions as dc
from eventloom.operators import gates
from eventloom.operators import severity as sv
from eventloom.plans import stage2 as s2
from eventloom.sinks.tables import ensure_template
from eventloom.sources import decisions as sd
from eventloom.sources.tables import read_table

ROWS = "row_idx long, case_tag string, vendor_event_id string, underlying string, isin string, ex_date string, pay_date string, amount double, div_ccy string, economic_event_id string"


def case_rows(table):
    cells = [
        ("O1", "v1", "ABC", "2025-06-10", "2025-06-20", 0.1, "USD", "e1"),
        ("O1", "v2", "ABC", "2025-06-10", "2025-06-21", 0.2, "USD", "e1"),
        ("O2", "v3", "DEF", "2025-08-01", "2025-08-10", 0.1, "USD", "e2"),
        ("O2", "v4", "DEF", "2025-08-01", "2025-08-10", 0.12, "USD", "e2"),
        ("O3A", "v5", "GHI", "2025-09-01", "2025-09-15", 0.5, "USD", "e3"),
        ("O3A", "v6", "GHI", "2025-09-05", "2025-09-15", 0.5, "USD", "e4"),
        ("O5", "v7", "JKL", "2025-11-01", "2025-11-20", 1.0, "USD", "e5"),
        ("O5", "v8", "JKL", "2025-11-01", "2025-11-20", 1.0, "BRL", "e5"),
        ("OK", "v9", "XYZ.SA", "2025-07-01", "2025-07-10", 0.5, "USD", "e6"),
        ("OK", "w1", "XYZ.SA", "2025-07-01", "2025-07-10", 0.6, "USD", "e6"),
        (None, "w2", "MIS", "2025-07-01", "", None, "USD", "e7"),
    ]
    names = ["case_tag", "vendor_event_id", "underlying", "ex_date", "pay_date", "amount", "div_ccy", "economic_event_id"]
    return table(ROWS, [dict(zip(names, c)) | {"row_idx": i, "isin": ""} for i, c in enumerate(cells)])


def test_tiers_of_the_case_table(table):
    tables = s2.stage2(case_rows(table), options=s2.Stage2Options(respect_existing=True, pairs_enabled=True))
    got = {r.economic_event_id: (r.severity_tier, r.severity_reasons) for r in tables.events.collect()}
    assert got == {
        "e1": (2, "amount_nunique=2>=tier1|relax_split_paydate"),
        "e2": (1, "amount_nunique=2>=tier1"),
        "e3": (2, "clean"),
        "e4": (2, "clean"),
        "e5": (0, "ccy_nunique=2>1"),
        "e6": (2, "br_relaxed_tier1"),
        "e7": (1, "missing_amount_any"),
    }
    assert [r.economic_event_id for r in tables.review_events.collect()] == ["e5", "e2", "e7"]
    assert {r.economic_event_id for r in tables.review_rows.collect()} == {"e5", "e2", "e7"}
    assert [(r.econ_id_a, r.econ_id_b, r.ex_date_abs_shift_days) for r in tables.pair_queue.collect()] == [("e3", "e4", 4)]
    assert {r.economic_event_id for r in tables.pair_events.collect()} == {"e3", "e4"}
    assert tables.regions["brazil"].count() == 3 and tables.regions["non_brazil"].count() == 8
    told = {r.economic_event_id: r.not_flagged_summary for r in tables.events.collect()}
    assert told["e2"] == "" and told["e1"] == "Not flagged: relaxed by split rule; underlying triggers were amount_nunique."
    assert told["e3"] == "Not flagged: below tier-1 on amount_nunique, anchor_spread_days, row_count, currency_mixture."


def test_merge_and_keep_decisions(table):
    schema = "enabled string, underlying string, econ_id_a string, econ_id_b string, decision string, canonical_econ_id string"
    merge = table(schema, [{"enabled": "true", "econ_id_a": "e3", "econ_id_b": "e4", "decision": "merge", "canonical_econ_id": ""}])
    options = s2.Stage2Options(respect_existing=True, pairs_enabled=True, suppress_reviewed=True)
    tables = s2.stage2(case_rows(table), pair_decisions=sd.clean_pair_decisions(merge), options=options)
    ids = {r.economic_event_id: r.severity_reasons for r in tables.events.collect()}
    assert "e4" not in ids and ids["e3"] == "anchor_spread_days=4>=tier1"
    assert tables.pair_queue.count() == 1
    keep = merge.replace("merge", "KEEP", "decision")
    tables = s2.stage2(case_rows(table), pair_decisions=sd.clean_pair_decisions(keep), options=options)
    assert tables.pair_queue.count() == 0 and tables.events.count() == 7


def test_tier0_gate_stops_before_anything_is_written(spark, table, tmp_path):
    options = s2.Stage2Options(respect_existing=True, max_tier0_ratio=0.1)
    with pytest.raises(gates.GateError, match="tier-0"):
        s2.run(spark, str(tmp_path / "run"), case_rows(table), options=options)
    assert not (tmp_path / "run").exists()
    with pytest.raises(ValueError):
        gates.tier0_gate(case_rows(table), 1.5)


DECISIONS = "vendor_event_id string, underlying string, ex_date string, action string, amount double, div_ccy string, economic_event_id string, anchor_date string"


def decide(table, *rows):
    return table(DECISIONS, [{"amount": None, "div_ccy": "", "economic_event_id": "", "anchor_date": ""} | r for r in rows])


def test_decisions_exact_beats_wildcard(table):
    key = {"vendor_event_id": "v1", "underlying": "ABC", "ex_date": "2025-06-10"}
    other = {"vendor_event_id": "v3", "underlying": "DEF", "ex_date": "2025-08-01"}
    got = dc.apply_qa_decisions(
        case_rows(table),
        decide(
            table,
            key | {"action": "SET_ECON_ID", "economic_event_id": "wild"},
            key | {"action": "SET_ECON_ID", "economic_event_id": "exact", "amount": 0.1, "div_ccy": "USD"},
            other | {"action": "DROP", "amount": 0.1, "div_ccy": "USD"},
        ),
    ).collect()
    ids = {r.vendor_event_id: r.economic_event_id for r in got}
    assert ids["v1"] == "exact" and "v3" not in ids and ids["v2"] == "e1" and len(got) == 10


def test_half_wild_decision_is_exact(table):
    key = {"vendor_event_id": "v1", "underlying": "ABC", "ex_date": "2025-06-10"}
    got = dc.apply_qa_decisions(case_rows(table), decide(table, key | {"action": "DROP", "amount": 0.1})).count()
    assert got == 11


def test_repeated_decision_keys_are_an_error(table):
    row = {"vendor_event_id": "v1", "underlying": "ABC", "ex_date": "2025-06-10", "action": "DROP"}
    with pytest.raises(ValueError, match="more than once"):
        dc.apply_qa_decisions(case_rows(table), decide(table, row, row))


def test_decision_files_are_checked(table):
    row = {"vendor_event_id": "v1", "underlying": "ABC", "ex_date": "2025-06-10"}
    with pytest.raises(ValueError, match="unknown_actions"):
        sd.clean_qa_decisions(decide(table, row | {"action": "move"}))
    with pytest.raises(ValueError, match="missing_event_ids"):
        sd.clean_qa_decisions(decide(table, row | {"action": "set_econ_id"}))
    with pytest.raises(ValueError, match="missing columns"):
        sd.clean_qa_decisions(decide(table, row).drop("action"))


def pairs_of(table, *steps):
    return table("event_id string, canonical_id string", [{"event_id": b, "canonical_id": a} for a, b in steps])


def test_merge_chains_are_followed_to_their_end(table):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(40)]
    got = {r.event_id: r.canonical_id for r in dc.close_map(pairs_of(table, *chain)).collect()}
    assert got == {f"n{i + 1}": "n0" for i in range(40)}


@pytest.mark.parametrize("length", [2, 3, 4, 5])
def test_merge_cycles_are_an_error(table, length):
    steps = [(f"n{i}", f"n{(i + 1) % length}") for i in range(length)]
    with pytest.raises(ValueError, match="cycle"):
        dc.close_map(pairs_of(table, *steps))


def test_templates_are_written_once(spark, tmp_path):
    path = str(tmp_path / "qa.csv")
    assert ensure_template(spark, path, "qa") and not ensure_template(spark, path, "qa")
    back = read_table(spark, path)
    assert back.columns == sd.QA_REQUIRED + sd.QA_OPTIONAL
    assert sd.clean_qa_decisions(back).count() == 3
    assert "005930" in {r.underlying for r in back.collect()}


def test_events_without_rows(table):
    assert sv.event_severity(case_rows(table).where("false")).count() == 0
    assert sv.tier0_ratio(sv.event_severity(case_rows(table).where("false"))).first().tier0_ratio == 0.0


MERGES = "enabled string, underlying string, econ_id_a string, econ_id_b string, decision string, canonical_econ_id string"


@pytest.mark.parametrize(
    "pairs",
    [
        [("e3", "e4", "")],
        [("e1", "e2", ""), ("e2", "e3", "")],  # a chain
        [("e1", "e5", "new")],  # the event moves to an id nobody has
        [("e6", "none", "")],  # nothing to move
        [("e1", "e2", ""), ("e4", "e5", ""), ("e6", "e7", "e3")],
    ],
)
def test_a_merge_regrades_as_a_full_run_would(table, pairs):
    merges = table(
        MERGES,
        [{"enabled": "true", "econ_id_a": a, "econ_id_b": b, "decision": "MERGE", "canonical_econ_id": c} for a, b, c in pairs],
    )
    blank = {"row_idx": 99, "underlying": "ABC", "economic_event_id": "", "case_tag": "O1", "isin": ""}
    rows = case_rows(table).unionByName(table(ROWS, [blank, {"row_idx": 100, "underlying": "ABC"}]))
    options = s2.Stage2Options(respect_existing=True)
    before = s2.outputs(rows, options)
    mapping = dc.merge_map(sd.clean_pair_decisions(merges))
    graded, events = dc.regraded(before.rows, before.events, mapping, options.severity)
    full = s2.outputs(dc.apply_merges(rows, mapping), options)
    listed = lambda df: sorted(map(repr, df.select(*sorted(df.columns)).collect()))
    assert listed(graded) == listed(full.rows) and listed(events) == listed(full.events)


def test_a_merge_grades_only_the_rows_it_names(table, monkeypatch):
    seen = []
    grade = sv.event_severity
    monkeypatch.setattr(sv, "event_severity", lambda rows, policy=None: seen.append(rows.count()) or grade(rows, policy))
    merge = table(MERGES, [{"enabled": "true", "econ_id_a": "e3", "econ_id_b": "e4", "decision": "MERGE", "canonical_econ_id": ""}])
    options = s2.Stage2Options(respect_existing=True, pairs_enabled=True)
    s2.stage2(case_rows(table), pair_decisions=sd.clean_pair_decisions(merge), options=options)
    assert seen == [11, 2]


def test_required_columns_are_told_per_input(spark, table):
    rows = case_rows(table)
    made = gates.columns_gate({"whole": (rows, ["underlying", "amount"]), "cut": (rows.drop("amount").limit(0), ["underlying", "amount"])})
    assert sorted(map(tuple, made.collect())) == [
        ("cut", "amount", 0, True),
        ("cut", "underlying", 0, False),
        ("whole", "amount", 11, False),
        ("whole", "underlying", 11, False),
    ]
    with pytest.raises(gates.GateError, match="amount"):
        gates.require(made, "columns")


def test_events_are_measured_in_one_exchange(table, monkeypatch):
    rows = case_rows(table)
    plan = sv.event_metrics(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    more = [{"row_idx": 90 + i, "economic_event_id": "e8", "amount": a, "pay_date": f"2025-06-{10 + i % 3}", "underlying": u, "div_ccy": c}
            for i, (a, u, c) in enumerate([(0.0, None, "USD"), (-0.0, " ", "USD"), (1.5, "LATE", ""), (1.5, "LATER", None), (None, "X", "BRL"), (float("nan"), "X", "BRL")])]
    rows = rows.unionByName(table(ROWS, more)).unionByName(table(ROWS, more[:2]))
    want = sorted(map(tuple, sv.event_metrics(rows).collect()))
    (e8,) = [dict(zip(sv.event_metrics(rows).columns, r)) for r in want if r[0] == "e8"]
    assert (e8["row_count"], e8["amount_nunique"], e8["pay_date_nunique"], e8["ccy_nunique"], e8["underlying"]) == (8, 2, 3, 2, "LATE")
    # Events of more rows than a task should hold are measured by aggregates, with the same result.
    for limit in (1, 3, 5):
        monkeypatch.setattr(sv, "EVENT_ROWS", limit)
        assert sorted(map(tuple, sv.event_metrics(rows).collect())) == want


def test_rows_and_events_are_written_in_their_place(spark, table, tmp_path):
    options = s2.Stage2Options(respect_existing=True, pairs_enabled=True)
    tables = s2.run(spark, str(tmp_path / "run"), case_rows(table), options=options)
    for df, name, n in ((tables.rows, "rows", 11), (tables.events, "events", 7)):
        assert df.count() == n and all(f"{tmp_path}/run/stage2/{name}/" in f for f in df.inputFiles())


def test_pairs_are_made_once(table):
    options = s2.Stage2Options(respect_existing=True, pairs_enabled=True)
    tables = s2.stage2(case_rows(table), options=options)
    assert tables.pairs._written_path and tables.pairs.count() == tables.pair_queue.count() == 1
