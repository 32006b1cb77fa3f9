from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.functions import text as tx
from eventloom.functions import values as vl
from eventloom.operators import fx, gates
from eventloom.operators import ingest as ig
from eventloom.operators import resolution_records as rr
from eventloom.operators import resolve as rs
from eventloom.operators import review as rv
from eventloom.operators import summary as sm
from eventloom.operators import ticker_qa as tq
from eventloom.operators import universe as un
from eventloom.plans import stage0, stage1
from eventloom.sources import holdings as hd
from eventloom.sources import tables as st
from eventloom.sources import vendor as vd


def test_snapshot_cells_and_leading_zeros(spark, tmp_path):
    rows = [
        ["005930", "A", "Tech", "Equity", {"display": "$1", "raw": 1.5}, {"display": "60", "raw": 60.0}, "1", "2", "c 1", "kr 1", "s", {"display": "7.5"}, "Korea", "KRX", "KRW", "1", "x"],
        ["CASH", "Cash", "-", "Cash", 1, 2],
        ["BBB", "B", "s", "EQUITY", None, "40"],
        ["BBB", "B again", "s", "equity", None, "40"],
    ]
    (tmp_path / "20250101_EEM.json").write_text(json.dumps({"aaData": []}))
    (tmp_path / "20250203_EEM.json").write_text("﻿" + json.dumps({"asOfDate": "Feb 3, 2025", "aaData": rows}))
    out = stage0.run(spark, str(tmp_path / "*.json"), str(tmp_path / "out"), "EEM")
    got = {r.underlying: r for r in out.collect()}
    assert set(got) == {"005930", "BBB"} and got["005930"].isin == "KR1" and got["005930"].asof_date == "20250203"
    assert got["005930"].weight == pytest.approx(0.6) and got["005930"].market_value == 1.5 and got["005930"].price == 7.5
    assert got["BBB"].underlying_ccy == "USD" and got["BBB"].name == "B" and got["BBB"].market_value is None
    assert out.columns == hd.HOLDING_COLUMNS


def test_bare_array_and_bad_payloads(table):
    payloads = table(
        "fund string, file_name string, content string",
        [
            {"fund": "A", "file_name": "20250101_A.json", "content": json.dumps([["X", "n", "s", "Equity", 1, 5]])},
            {"fund": "B", "file_name": "b.json", "content": " "},
            {"fund": "C", "file_name": "c.json", "content": "oops"},
            {"fund": "D", "file_name": "d.json", "content": "{"},
            {"fund": "E", "file_name": "e.json", "content": "[1]"},
            {"fund": "F", "file_name": "f.json", "content": '{"aaData": 3}'},
        ],
    )
    assert {r.fund: r.problem for r in hd.validate_payloads(payloads)[1].collect()} == {
        "A": "root_not_object", "B": "empty", "C": "not_json", "D": "broken_json", "E": "root_not_object", "F": "no_rows",
    }
    assert [(r.underlying, r.asof_date) for r in hd.normalise_snapshots(payloads.where("fund = 'A'")).collect()] == [("X", "20250101")]


def test_holdings_out_of_bounds_are_an_error(table):
    df = table("etf_symbol string, weight double, weight_pct double, isin string", [{"etf_symbol": "EEM", "weight": 0.5, "weight_pct": 50.0, "isin": ""}])
    with pytest.raises(ValueError, match="EEM"):
        hd.require_good_holdings(df)
    with pytest.raises(ValueError, match="unknown fund"):
        hd.fund_spec("nope")


def test_links_are_found_in_order_of_preference(table):
    html = 'a <a href="/us/products/1/x-y/2.ajax?tab=all&amp;fileType=json">j</a> as of Feb 3, 2025 "asOfDate": "2024-01-01"'
    found, rejected = hd.discover_links(table("page_id long, html string", [{"page_id": 1, "html": html}, {"page_id": 2, "html": "as of Feb 3, 2025"}]))
    row = found.first()
    assert row.link.endswith("/us/products/1/x-y/2.ajax?tab=all&fileType=json") and row.asof == "20250203"
    assert rejected.first().problem == "no_link"


def test_csv_keeps_codes_as_text(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text("﻿Ticker,CCY,ISIN,weight\n005930,krw,KR7005930003,1\nUSD,USD,,1\nbad sym,USD,,1\nX,usd,bad,0\n", encoding="utf-8")
    assert [(r.underlying, r.underlying_ccy, r.isin) for r in hd.read_holdings(spark, str(path)).collect()] == [("005930", "KRW", "KR7005930003")]
    assert hd.read_holdings(spark, str(path), include_zero_weight=True).count() == 2
    empty = st.read_or_empty(spark, str(tmp_path / "none.csv"), schemas.ERRORS)
    assert empty.columns == schemas.ERRORS and empty.count() == 0
    with pytest.raises(FileNotFoundError):
        st.read_observations(spark, str(tmp_path))


def test_text_and_value_functions(table):
    df = table("s string", [{"s": s} for s in (" usd ", "NaN", "us", None, "\tEUR\n")])
    assert [r[0] for r in df.select(vl.currency(F.col("s"))).collect()] == ["USD", None, None, None, "EUR"]
    amounts = table("s string", [{"s": s} for s in ("$1,000.5", "USD 3e1", "1.2.3", "", ".5")])
    assert [r[0] for r in amounts.select(vl.parse_amount(F.col("s"))).collect()] == [1000.5, 30.0, None, None, 0.5]
    with pytest.raises(Exception, match="invalid values in f"):
        table("s string", [{"s": "perhaps"}]).select(tx.strict_flag(F.col("s"), "f")).collect()
    with pytest.raises(ValueError, match="stands for both"):
        schemas.known_headers({"a": ["X y"], "b": ["x_Y"]}, [])


RES = "underlying string, underlying_ccy string, isin string, chosen_ticker string, resolution_status string, exists_ticker string, candidates_json string, candidate_count string, guess_source string, prefix_exchange_consistent string"


def resolution(**change):
    base = {"underlying": "AAA", "underlying_ccy": "USD", "isin": "", "chosen_ticker": "AAA", "exists_ticker": "AAA", "candidates_json": "[]", "candidate_count": "0"}
    return base | change


@pytest.mark.parametrize(
    "change, failed",
    [
        ({"resolution_status": "div_found"}, False),
        ({"resolution_status": "div_found", "exists_ticker": ""}, True),
        ({"resolution_status": "verified_exists_but_no_dividends"}, False),
        ({"resolution_status": "verified_exists_but_no_dividends", "exists_ticker": ""}, True),
        ({"resolution_status": "candidate_unverified"}, True),
        ({"resolution_status": "not_found"}, True),
        ({"resolution_status": "div_found", "chosen_ticker": "nan"}, True),
        ({"resolution_status": "something", "exists_ticker": "AAA"}, False),
    ],
)
def test_failure_rule(table, change, failed):
    assert tq.ticker_report(table(RES, [resolution(**change)])).first().is_failed is failed


def test_mapping_issue_classes(table):
    cases = {
        "isin_sg_alias_pollution": ["US0000000009.SG", "AAA"],
        "india_ns_bo_dual": ["A.NS", "A.BO"],
        "plain_plus_local_alt": ["A", "A.L"],
        "same_venue_alias": ["A.L", "B.L"],
        "single_candidate_no_div": ["A.L"],
        "other": [],
    }
    rows = [
        resolution(underlying=k, candidates_json=json.dumps(v), candidate_count=str(len(v)), resolution_status="verified_exists_but_no_dividends")
        for k, v in cases.items()
    ]
    for r in tq.ticker_report(table(RES, rows)).collect():
        assert r.mapping_issue_class.upper() == r.underlying
    assert tq.ticker_report(table(RES, rows)).select("candidate_suffixes").where("underlying = 'PLAIN_PLUS_LOCAL_ALT'").first()[0] == "US/PLAIN,L"


UNIVERSE = "underlying string, underlying_ccy string, isin string, weight double"


def test_weights_gates_and_review(table):
    rows = [
        resolution(underlying="A", isin="I1", resolution_status="ticker_not_found", exists_ticker=""),
        resolution(underlying="B", isin="I9", resolution_status="candidate_unverified", guess_source="ccy_fallback"),
        resolution(underlying="C", resolution_status="error", exists_ticker=""),
        resolution(underlying="D", isin="I4", resolution_status="div_found", guess_source="ccy_fallback", prefix_exchange_consistent="false"),
        resolution(underlying="A", isin="I1", resolution_status="ticker_not_found", exists_ticker=""),
    ]
    universe = table(UNIVERSE, [{"underlying": u, "underlying_ccy": "USD", "isin": i, "weight": w} for u, i, w in (("a", "i1", 0.3), ("A", "I1", 0.2), ("B", "I2", 0.1), ("D", "I4", 0.4))])
    report = tq.ticker_report(table(RES, rows), universe)
    got = {r.underlying: (round(r.weight, 6), r.weight_match_method) for r in report.collect()}
    assert got == {"A": (0.5, tq.EXACT), "B": (0.1, tq.FALLBACK), "C": (0.0, tq.UNMATCHED), "D": (0.4, tq.EXACT)}
    with pytest.raises(gates.GateError, match=r"top_failed=\[A:AAA:TICKER_NOT_FOUND:0.5; A:AAA:TICKER_NOT_FOUND:0.5; B:AAA:CANDIDATE_UNVERIFIED:0.1\]"):
        gates.require_materiality(report, single=0.4)
    gates.require_materiality(report, single=0.5)
    assert tq.top_failed_text(report.where("false")) == "none"
    queue = rv.queue_order(rv.review_queue(table(RES, rows), universe)).collect()
    assert [(r.underlying, r.review_tags_text) for r in queue] == [
        ("A", "hard_failure"),
        ("C", "hard_failure|failed_weight_unmatched"),
        ("B", "candidate_unverified|anomaly_review|ccy_fallback"),
        ("D", "anomaly_review|ccy_fallback|prefix_exchange_inconsistent"),
    ]
    assert len(rv.review_queue(table(RES, rows), universe, include_anomalies=False).collect()) == 3
    with pytest.raises(ValueError, match="missing columns"):
        tq.ticker_report(table(RES, rows).drop("chosen_ticker"))


def test_cache_keeps_first_seen_and_overrides_win(table):
    schema = "row_no long, underlying string, underlying_ccy string, chosen_ticker string, reason string, first_seen_asof string, exists_ns string"
    old = rr.cache(table(schema, [
        {"row_no": 0, "underlying": "a", "underlying_ccy": "usd", "chosen_ticker": "x.ns", "first_seen_asof": "20240101", "exists_ns": "true"},
        {"row_no": 1, "underlying": "A", "underlying_ccy": "USD", "chosen_ticker": "y", "first_seen_asof": "bad", "exists_ns": ""},
        {"row_no": 2, "underlying": "B", "underlying_ccy": "USD", "chosen_ticker": "b", "first_seen_asof": "20240202", "exists_ns": ""},
        {"row_no": 3, "underlying": "C", "underlying_ccy": "USD", "chosen_ticker": "-", "first_seen_asof": "", "exists_ns": ""},
    ]))
    assert {r.underlying: (r.chosen_ticker, r.first_seen_asof) for r in old.collect()} == {"A": ("Y", ""), "B": ("B", "20240202")}
    found = table(RES, [resolution(underlying="B", resolution_status="div_found", chosen_ticker="bb"), resolution(underlying="E", resolution_status="error")])
    new = rr.upsert_cache(old, rr.cache_updates(found, "20250101", "run1"))
    assert {r.underlying: (r.chosen_ticker, r.first_seen_asof, r.last_seen_asof) for r in new.collect()} == {"A": ("Y", "", ""), "B": ("BB", "20240202", "20250101")}
    over = rr.overrides(table(schema, [
        {"row_no": 0, "underlying": "b", "underlying_ccy": "USD", "chosen_ticker": "first", "reason": "why"},
        {"row_no": 1, "underlying": "B", "underlying_ccy": "USD", "chosen_ticker": "second"},
    ]))
    assert {r.underlying: (r.chosen_ticker, r.reason) for r in rr.effective_map(over, new).collect()} == {"A": ("Y", "cache"), "B": ("FIRST", "why")}


def test_fx_layouts_and_diagnostics(table):
    rates = fx.usd_rates(table("CCY string, USD_PER_CCY string", [{"CCY": " hkd", "USD_PER_CCY": "0.128"}, {"CCY": "XX", "USD_PER_CCY": "1"}]))
    df = table("amount double, ccy string", [{"amount": 10.0, "ccy": "HKD"}, {"amount": 2.0, "ccy": "usd"}, {"amount": 3.0, "ccy": "EUR"}, {"amount": 1.0, "ccy": None}])
    out = fx.add_usd_value(df, "amount", "ccy", "usd", rates)
    assert sorted((r.usd for r in out.collect()), key=lambda v: (v is None, v or 0)) == [pytest.approx(1.28), 2.0, None, None]
    assert fx.fx_diagnostics(out, "ccy", "usd", rates).first().asDict() == {
        "total_rows": 4, "non_usd_rows": 2, "missing_ccy_rows": 1, "missing_fx_rows": 1, "converted_rows": 2,
    }


SEC = "security_id string, underlying string, underlying_ccy string, isin string, country string, exchange string, chosen_ticker string, holdings_tag string, holdings_file string, weight double"


def securities(table):
    rows = [
        ("1", "5", "HKD", "HK0000000013", "Hong Kong", "Hong Kong Exchanges and Clearing Ltd", ""),
        ("2", "TCS", "INR", "", "India", "", ""),
        ("3", "ABC", "USD", "", "", "Nowhere", ""),
        ("4", "GAZ", "RUB", "RU0000000019", "Russian Federation", "", ""),
        ("5", "OVR", "USD", "", "", "", "UNSUPPORTED_YF"),
        ("6", "7203.T", "JPY", "", "", "", ""),
        ("7", "-", "JPY", "", "", "", ""),
        ("8", "MX1", "MXN", "", "Mexico", "Bolsa Mexicana de Valores", ""),
    ]
    names = ["security_id", "underlying", "underlying_ccy", "isin", "country", "exchange", "chosen_ticker"]
    return table(SEC, [dict(zip(names, r)) | {"holdings_tag": "EEM", "holdings_file": "h.csv", "weight": 0.125} for r in rows])


def vendor_tables(table):
    day = dt.date(2025, 1, 15)
    return ig.Landing(
        search=vd.search_candidates(table("isin string, content string", [])),
        existing=table("ticker string, exists boolean", [{"ticker": "TCS.BO", "exists": True}, {"ticker": "TCS.NS", "exists": False}]),
        actions=table(
            "ticker string, ex_date date, amount double",
            [{"ticker": "0005.HK", "ex_date": day, "amount": 0.5}, {"ticker": "7203.T", "ex_date": dt.date(2020, 1, 1), "amount": 1.0}, {"ticker": "7203.T", "ex_date": day, "amount": 0.0}],
        ),
    )


def test_guesses(spark, table):
    got = rs.guess_tickers(securities(table).where("security_id <> 7"), rs.exchange_rules(rs.default_rules(spark))).collect()
    found = {r.security_id: [] for r in got}
    for r in sorted(got, key=lambda r: (r.security_id, r.ordinal)):
        found[r.security_id].append((r.ticker, r.guess_source))
    assert found == {
        "1": [("0005.HK", "exchange_rule")],
        "2": [("TCS.NS", "country_fallback"), ("TCS.BO", "country_fallback")],
        "6": [("7203.T", "asis")],
        # The Mexican suffix is not one the exchange rules may use, so the country decides.
        "8": [("MX1.MX", "country_fallback")],
    }


def test_default_rules_match_names(spark, table):
    rules = rs.exchange_rules(rs.default_rules(spark))
    df = table("id long, exchange string", [{"id": i, "exchange": e} for i, e in enumerate(("nyse", "Tokyo Stock Exchange - 2", "bse ltd", "", None, "x", "XETRA"))])
    pick = lambda out: {r.id: (r.rule_exchange, r.rule_suffixes) for r in out.collect()}
    inline = pick(rs.match_exchange(df, rules))
    assert inline[0] == ("US_NYSE", [""]) and inline[1] == ("TOKYO_STOCK_EXCHANGE", ["T"]) and inline[5] == ("", None)


def test_rule_files_are_checked(table):
    columns = ", ".join(f"{c} string" for c in rs.RULE_COLUMNS)
    good = {"match_type": "exact", "match_value": "X", "canonical_exchange": "X", "suffixes": "L", "priority": "1", "is_active": "", "note": ""}
    assert rs.exchange_rules(table(columns, [good])).count() == 1
    for change in ({"match_type": "like"}, {"priority": "-1"}, {"is_active": "x"}, {"match_value": "nan"}):
        with pytest.raises(ValueError, match="not usable"):
            rs.exchange_rules(table(columns, [good | change]))
    with pytest.raises(ValueError, match="duplicate"):
        rs.exchange_rules(table(columns, [good, good]))


def test_stage1_run(spark, table, tmp_path):
    none = table("underlying string, underlying_ccy string, chosen_ticker string", [])
    rules = rs.exchange_rules(rs.default_rules(spark))
    catalog = str(tmp_path / "catalog")
    holdings = securities(table).drop("security_id")
    options = stage1.Stage1Options(window=ig.Window("20250101", "20251231"), tag_total_fail_weight=1.0)
    summary = stage1.run(spark, str(tmp_path / "run"), "run1", holdings, vendor_tables(table), rules, none, none, catalog, options)
    total = summary.where("holdings_tag IS NULL").first()
    assert (total.observations_rows, total.resolutions_rows, total.rejections_rows, total.status) == (1, 7, 1, "complete_with_review")
    tables = stage1.read(spark, str(tmp_path / "run"))
    status = {r.underlying: (r.resolution_status, r.chosen_ticker) for r in tables.resolutions.collect()}
    assert status == {
        "5": ("div_found", "0005.HK"),
        "TCS": ("verified_exists_but_no_dividends", "TCS.BO"),
        "ABC": ("ticker_not_found", ""),
        "GAZ": ("ticker_not_found", ""),
        "OVR": ("unsupported_vendor", "UNSUPPORTED_YF"),
        "7203.T": ("candidate_unverified", "7203.T"),
        "MX1": ("candidate_unverified", "MX1.MX"),
    }
    row = tables.observations.first()
    assert (row.source_event_key, row.amount, row.confidence, row.asof_date) == ("0005.HK|HKD|2025-01-15", 0.5, 35, "2025-12-31")
    assert json.loads(row.evidence_json)["resolution"]["guess_source"] == "exchange_rule"
    assert {r.error for r in tables.errors.collect()} == {"ticker_not_found"}
    assert tables.rejections.first().reason == "placeholder_underlying"
    assert sm.resolve_run(spark.read.parquet(catalog)) == str(tmp_path / "run")
    cache = spark.read.parquet(str(tmp_path / "run/stage1/resolution_cache"))
    assert [(r.underlying, r.chosen_ticker) for r in cache.collect()] == [("5", "0005.HK")]
    strict = stage1.Stage1Options(window=options.window, tag_single_fail_weight=0.1)
    with pytest.raises(gates.GateError):
        stage1.run(spark, str(tmp_path / "strict"), "run2", holdings, vendor_tables(table), rules, none, none, None, strict)


def test_bad_numbers_and_buckets(table):
    good, bad = ig.split_bad_numbers(table("underlying string, amount string, weight string", [{"underlying": "A", "amount": "1", "weight": "2"}, {"underlying": "B", "amount": "x", "weight": None}]))
    assert [r.underlying for r in good.collect()] == ["A"]
    row = bad.first()
    assert row.bad_numeric_columns == "amount,weight" and json.loads(row.bad_numeric_values_json) == {"amount": "x", "weight": None}
    frames = un.no_event_buckets(table("underlying string, exists_ticker string, candidate_count long", [
        {"underlying": "A", "exists_ticker": "UNSUPPORTED_YF", "candidate_count": 1},
        {"underlying": "B", "exists_ticker": "B.KS", "candidate_count": 1},
        {"underlying": "C", "exists_ticker": "C.L", "candidate_count": 1},
        {"underlying": "D", "exists_ticker": "D", "candidate_count": 1},
    ]))
    assert {k: v.count() for k, v in frames.items()} == {"unsupported": 1, "kr": 1, "rest": 2, "rest_suspect": 1}


def test_worker_errors_and_failed_run_catalog(spark, table):
    df = table("underlying string, underlying_ccy string, exception_type string, exception string", [{"underlying": "A", "underlying_ccy": "usd", "exception_type": "E", "exception": "boom"}])
    assert ig.worker_error_rows(df, "v", ig.Window("20250101", "")).first().error == "worker_exception"
    now = dt.datetime(2025, 1, 1)
    runs = sm.catalog_entry(spark, "a", "/a", now, 0).unionByName(sm.catalog_entry(spark, "b", "/b", now + dt.timedelta(1), 2))
    assert sm.resolve_run(runs) == "/a" and sm.resolve_run(runs, "/x") == "/x"
    assert sm.resolve_run(runs.where("run_id = 'b'")) == "/b"


@pytest.mark.parametrize("hot_rows", ["2000000", "100"])
def test_versions_count_changes_of_content(spark, table, hot_rows):
    import random

    rnd = random.Random(4)
    rows = [{"fund": "HOT" if rnd.random() < 0.6 else f"F{rnd.randint(0, 5)}", "asof": "20250101", "seq": i, "content": rnd.choice("aab")} for i in range(500)]
    want, last, count = set(), {}, {}
    for r in rows:
        if last.get(r["fund"]) != r["content"]:
            count[r["fund"]] = count.get(r["fund"], 0) + 1
            want.add((r["seq"], count[r["fund"]]))
        last[r["fund"]] = r["content"]
    spark.conf.set("eventloom.hotRows", hot_rows)
    try:
        got = {(r.seq, r.version) for r in hd.version_log(table("fund string, asof string, seq long, content string", rows)).collect()}
    finally:
        spark.conf.unset("eventloom.hotRows")
    assert got == want


def test_file_order_holds_however_splits_are_packed(spark, tmp_path):
    from eventloom.operators.fx import usd_rates

    folder = tmp_path / "rates.csv"
    folder.mkdir()
    for part in range(7):
        lines = [f"{'EUR' if i % 2 else 'GBP'},{part * 1000 + i}" for i in range(40 * (part % 3) + 1)]
        (folder / f"part-{part:03d}.csv").write_text("\n".join(["ccy,usd_per_ccy", *lines, "EUR,%d" % (part * 1000 + 999)]) + "\n")
    found = set()
    for size in ("64", "500", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = usd_rates(st.read_table(spark, str(folder), "csv")).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        found.add(tuple(sorted((r.ccy, r.usd_per_ccy) for r in rows)))
    assert found == {(("EUR", 6999.0), ("GBP", 6000.0))}


def test_a_query_result_has_no_file_order(spark):
    made = spark.range(10).withColumn("ccy", F.lit("EUR")).groupBy("ccy").agg(F.max("id").alias("usd_per_ccy"))
    with pytest.raises(ValueError, match="row_no"):
        st.with_row_no(made)


def test_only_a_missing_path_is_an_absent_table(spark, tmp_path):
    from pyspark.errors import AnalysisException

    (tmp_path / "empty").mkdir()
    assert st.read_or_empty(spark, str(tmp_path / "nothing"), schemas.ERRORS).count() == 0
    with pytest.raises(AnalysisException):
        st.read_or_empty(spark, str(tmp_path / "empty"), schemas.ERRORS)
    with pytest.raises(AnalysisException):
        st.read_first(spark, [str(tmp_path / "empty"), str(tmp_path / "nothing")])


def test_versions_are_numbered_within_a_batch(spark, tmp_path):
    from eventloom.sinks.tables import append_if_changed

    path = str(tmp_path / "log")
    rows = lambda *texts: spark.createDataFrame([("F", "d", i, t) for i, t in texts], "fund string, asof string, seq bigint, content string")
    append_if_changed(rows((1, "a"), (2, "a"), (3, "b")), path)
    append_if_changed(rows((4, "b"), (5, "a"), (6, "c")), path)
    log = spark.read.parquet(path).orderBy("version").collect()
    assert [(r.version, r.seq, r.content) for r in log] == [(1, 1, "a"), (2, 3, "b"), (3, 5, "a"), (4, 6, "c")]


def test_of_doubled_exact_rules_the_first_by_priority_counts(spark):
    from eventloom.operators.resolve import match_exchange

    rules = spark.createDataFrame(
        [("EXACT", "NYSE", 5, "Late", ["L"]), ("EXACT", "NYSE", 1, "Early", ["E"]), ("CONTAINS", "YS", 1, "Part", ["P"]), ("CONTAINS", "XET", 9, "Xetra", ["DE"])],
        "match_type string, match_value string, priority int, canonical_exchange string, suffixes array<string>",
    )
    rows = spark.createDataFrame([("NYSE",), ("NYSE ARCA",), ("XETRA",), ("none",), (None,)], "exchange string")
    got = {r.exchange: r.rule_exchange for r in match_exchange(rows, rules).collect()}
    assert got == {"NYSE": "Early", "NYSE ARCA": "Part", "XETRA": "Xetra", "none": "", None: ""}


def test_a_ticker_probed_twice_is_one_candidate(spark):
    fields = [f for f in rs.CANDIDATE_FIELDS if f != "ticker"]
    row = {"security_id": 1, "ticker": "A.X", "stage": 0, "ordinal": 0} | {f: "x" for f in fields}
    candidates = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in row.items()))
    existing = spark.createDataFrame([("A.X", True), ("A.X", False), ("A.X", True)], "ticker string, exists boolean")
    got = rs.candidate_lists(candidates, existing).first().candidates
    assert len(got) == 1 and got[0].exists


def test_contains_rules_are_looked_up_by_pieces(table):
    from eventloom.operators.resolve import RULE_COLUMNS, exchange_rules, match_exchange

    # The numbers have one length each, so that no rule's text holds another's.
    parts = [f"STOCK EXCHANGE OF TOWN {i:06d}" for i in range(100_000)] + ["AB", "Z", "QUAY"]
    rules = [
        {"match_type": "CONTAINS", "match_value": p, "canonical_exchange": f"X{i}", "suffixes": "", "priority": str(i % 7), "is_active": "1"}
        for i, p in enumerate(parts)
    ]
    rules.append({"match_type": "EXACT", "match_value": "QUAY ROAD", "canonical_exchange": "EXACT", "suffixes": "", "priority": "9", "is_active": "1"})
    names = [(f"THE STOCK EXCHANGE OF TOWN {i:06d} HALL", f"X{i}") for i in range(0, 100_000, 1999)]
    names += [("QUAY ROAD", "EXACT"), ("OLD QUAY", "X100002"), ("CAB", "X100000"), ("AB Z", "X100001" if 100_001 % 7 < 100_000 % 7 else "X100000")]
    names += [("TOWN 123", ""), ("", ""), (None, ""), ("ST", "")]
    made = match_exchange(
        table("exchange string", [{"exchange": n} for n, _ in names]),
        exchange_rules(table(", ".join(f"{c} string" for c in RULE_COLUMNS), rules), check=False),
    )
    assert sorted((r.exchange or "", r.rule_exchange) for r in made.collect()) == sorted((n or "", x) for n, x in names)
    assert "NestedLoop" not in made._jdf.queryExecution().toString()


@pytest.mark.parametrize("kind", ["holdings", "overrides", "cache", "rules", "fx"])
def test_line_breaks_inside_quoted_cells(spark, tmp_path, kind):
    from eventloom.operators import fx, resolution_records as rr, resolve as rs
    from eventloom.sources import holdings as hd

    key = "underlying,underlying_ccy,chosen_ticker,reason"
    texts = {
        "holdings": 'underlying,underlying_ccy,isin,name,weight\nAAA,USD,US0000000017,"one\ntwo ""x""\n",1.5\nBBB,USD,,plain,2\n',
        "overrides": f'{key}\nAAA,USD,A.L,"one\ntwo"\nBBB,USD,B.L,plain\n',
        "cache": f'{key}\nAAA,USD,A.L,"one\ntwo"\nBBB,USD,B.L,plain\n',
        "rules": 'match_type,match_value,canonical_exchange,suffixes,priority,is_active,note\nEXACT,NYSE,NYSE,US,1,1,"one\ntwo"\nEXACT,XETRA,XETRA,DE,2,1,\n',
        "fx": 'ccy,usd_per_ccy,note\nEUR,1.1,"one\ntwo, 3"\nGBP,1.3,\n',
    }
    path = tmp_path / f"{kind}.csv"
    path.write_text(texts[kind])
    df = st.read_table(spark, str(path))
    made = {
        "holdings": lambda: [(r.underlying, r.weight) for r in hd.clean_holdings(df).collect()],
        "overrides": lambda: [(r.underlying, r.chosen_ticker) for r in rr.overrides(df).collect()],
        "cache": lambda: [(r.underlying, r.chosen_ticker) for r in rr.cache(df).collect()],
        "rules": lambda: [(r.match_value, r.priority) for r in rs.exchange_rules(df).collect()],
        "fx": lambda: [(r.ccy, r.usd_per_ccy) for r in fx.usd_rates(df).collect()],
    }[kind]()
    expected = {
        "holdings": [("AAA", 1.5), ("BBB", 2.0)],
        "overrides": [("AAA", "A.L"), ("BBB", "B.L")],
        "cache": [("AAA", "A.L"), ("BBB", "B.L")],
        "rules": [("NYSE", 1), ("XETRA", 2)],
        "fx": [("EUR", 1.1), ("GBP", 1.3)],
    }[kind]
    assert sorted(tuple(map(str, r)) for r in made) == sorted(tuple(map(str, r)) for r in expected)


def test_files_without_broken_cells_are_still_split(spark, tmp_path):
    path = tmp_path / "plain.csv"
    path.write_text("a,b\n" + "".join(f'{i},"say ""{i}"""\n' for i in range(500)))
    assert not st.has_broken_cells(spark, str(path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        df = st.read_table(spark, str(path))
        assert df.rdd.getNumPartitions() > 1 and df.where("b = concat('say \"', a, '\"')").count() == 500
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    lone = tmp_path / "lone.csv"
    lone.write_text('a,b\n1,5" pipe\n2,x\n')
    assert [(r.a, r.b) for r in st.read_table(spark, str(lone)).orderBy("a").collect()] == [("1", '5" pipe'), ("2", "x")]


def test_an_append_reads_only_the_days_of_its_batch(spark, tmp_path):
    from eventloom.sinks import tables as sinks

    path = str(tmp_path / "log")
    make = lambda rows: spark.createDataFrame(rows, "fund string, asof string, seq bigint, content string")
    days = [f"2024-01-{d:02d}" for d in range(1, 21)]
    first = [(f"F{f}", day, i * 10 + f, f"{f}{day}") for i, day in enumerate(days) for f in range(3)]
    assert sinks.append_if_changed(make([*first, ("F0", None, 900, "x")]), path).count() == 61
    folders = {p.name for p in (tmp_path / "log").iterdir() if p.name.startswith("bucket=")}
    assert len(folders) > 5
    batch = make([("F0", days[3], 1000, "new"), ("F1", days[3], 1001, f"1{days[3]}"), ("F9", days[3], 1002, "other"), ("F0", None, 1003, "x")])
    plan = sinks.newest_logged(batch, path)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in text
    read = spark.read.parquet(path).join(batch.select(sinks.log_bucket().alias("bucket")).distinct(), "bucket").select("asof").distinct()
    assert {r.asof for r in plan.select("asof").distinct().collect()} == {r.asof for r in read.collect()} != set(days) | {None}
    added = sinks.append_if_changed(batch, path)
    assert sorted((r.fund, r.version) for r in added.collect()) == [("F0", 2), ("F9", 1)]


def test_a_log_without_buckets_is_refused(spark, tmp_path):
    from eventloom.sinks.tables import append_if_changed

    path = str(tmp_path / "log")
    rows = spark.createDataFrame([("F", "d", 1, "a", "h", 1)], "fund string, asof string, seq bigint, content string, content_hash string, version int")
    rows.write.parquet(path)
    with pytest.raises(ValueError, match="buckets"):
        append_if_changed(rows.select("fund", "asof", "seq", "content"), path)


def test_payloads_of_one_small_file_are_dealt_over_tasks(spark):
    content = '{"aaData": [["A", "n", "s", "Equity", 1, {"raw": null, "display": "2"}, {"display": null}, {"x": {"raw": 3}}], 5]}'
    payloads = spark.createDataFrame([(f"F{i}", f"20250101_F{i}.json", content) for i in range(64)], "fund string, file_name string, content string")
    usable = hd.validate_payloads(payloads.coalesce(1))[0]
    rows = hd.snapshot_rows(usable)
    assert rows.select(F.spark_partition_id()).distinct().count() > 1
    got = rows.drop("fund", "asof").distinct().collect()
    # A null ``raw`` is null, a missing one reads as ``display``, an element that is no row is left out.
    assert [(r.row_no, r.underlying, r.market_value, r.weight_pct, r.notional_value, r.quantity, r.isin) for r in got] == [(0, "A", "1", None, "", None, None)]
