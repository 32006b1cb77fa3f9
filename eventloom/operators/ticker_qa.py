"""Report on resolved tickers: failures, anomalies, weights behind them and mapping issues."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.functions import tickers as tk
from eventloom.functions import values as vl
from eventloom.operators.linking import column_or
from eventloom.operators.severity import require_columns
from eventloom.session import cut_lineage

REQUIRED = ["underlying", "underlying_ccy", "chosen_ticker", "resolution_status"]

# Statuses and sources the report reacts to.
FAILURE_STATUSES = [
    "TICKER_NOT_FOUND",
    "UNSUPPORTED_VENDOR",
    "AMBIGUOUS",
    "ERROR",
    "CANDIDATE_UNVERIFIED",
]
REPORT_FAILURES = [*FAILURE_STATUSES, "NOT_FOUND"]
NO_EVENT_STATUSES = ["NO_DIVIDENDS_IN_WINDOW", "VERIFIED_EXISTS_BUT_NO_DIVIDENDS"]
SUCCESS_STATUSES = ["SUCCESS", "DIV_FOUND", "MANUAL_OVERRIDE"]
ANOMALY_SOURCES = ["CCY_FALLBACK"]
EXACT, FALLBACK, UNMATCHED = "exact_underlying_ccy_isin", "fallback_underlying_ccy", "unmatched"

REPORT_COLUMNS = [
    "underlying", "underlying_ccy", "isin", "chosen_ticker", "candidate_market", "candidate_origin",
    "resolution_status", "resolution_reason", "resolution_method", "resolution_source", "candidate_count",
    "candidates_json", "exists_ticker", "exists_ns", "exists_bo", "is_failed", "mapping_issue_class",
    "candidate_list_pretty", "candidate_suffixes", "holdings_tag", "holdings_file", "source", "start", "end",
    "guess_source", "canonical_exchange", "isin_prefix", "prefix_exchange_consistent", "weight", "weight_matched",
    "weight_match_method", "is_anomaly",
]


def prepare_report(resolutions: DataFrame) -> DataFrame:
    """All report inputs, clean and typed; columns the input lacks get their defaults."""
    require_columns(resolutions, REQUIRED, "ticker report")
    col = lambda name: column_or(resolutions, name)
    upper = ["underlying", "underlying_ccy", "isin", "candidate_market", "resolution_status", "guess_source",
             "canonical_exchange", "isin_prefix"]
    plain = ["chosen_ticker", "candidate_origin", "resolution_source", "candidates_json", "exists_ticker",
             "holdings_tag", "holdings_file", "source", "start", "end"]
    cols = {c: tx.report_text(col(c), upper=True) for c in upper} | {c: tx.report_text(col(c)) for c in plain}
    for name, legacy in (("resolution_reason", "reason"), ("resolution_method", "method")):
        cols[name] = F.coalesce(F.nullif(tx.report_text(col(name)), F.lit("")), tx.report_text(col(legacy)))
    ns, bo = tx.strict_flag(col("exists_ns"), "exists_ns"), tx.strict_flag(col("exists_bo"), "exists_bo")
    any_exists = tx.strict_flag(col("preverified_exists_any"), "preverified_exists_any") | ns | bo
    fallback = F.coalesce(F.nullif(cols["exists_ticker"], F.lit("")), cols["chosen_ticker"])
    verified = tx.report_text(col("preverified_exists_ticker"), upper=True)
    verified = F.when((verified == "") & any_exists, F.upper(fallback)).otherwise(verified)
    cols |= {
        "candidate_count": tx.truncated_number(col("candidate_count")),
        "preverified_exists_any": any_exists,
        "preverified_exists_ticker": verified,
        "exists_ns": ns if "exists_ns" in resolutions.columns else verified.endswith(".NS"),
        "exists_bo": bo if "exists_bo" in resolutions.columns else verified.endswith(".BO"),
        "prefix_exchange_consistent": tx.nullable_flag(col("prefix_exchange_consistent")),
    }
    return resolutions.withColumns(cols)


def is_failed() -> Column:
    status, exists = F.col("resolution_status"), F.col("exists_ticker") != ""
    fine_without_events = status.isin(NO_EVENT_STATUSES) & exists
    nothing = ~(status.isin(SUCCESS_STATUSES) & exists) & ~exists
    return ((F.col("chosen_ticker") == "") | status.isin(REPORT_FAILURES) | nothing) & ~fine_without_events


def is_anomaly() -> Column:
    bad_prefix = F.coalesce(~F.col("prefix_exchange_consistent"), F.lit(False))
    return bad_prefix | F.upper(tx.report_text(F.col("guess_source"))).isin(ANOMALY_SOURCES)


# --- weights ---------------------------------------------------------------------------------


def clean_universe(universe: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return universe.select(
        *[tx.report_text(column_or(universe, c), upper=True).alias(c) for c in ("underlying", "underlying_ccy", "isin")],
        F.coalesce(vl.number_in(universe, "weight"), F.lit(0.0)).alias("weight"),
        *(keep or []),
    )


def weight_maps(universe: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Weight per exact key next to the weight of its fallback key; ``by`` adds leading keys.

    The fallback sums are sums of the exact ones over the shorter key, so rows are aggregated once and joined with nothing.
    """
    by = by or []
    exact = (
        clean_universe(universe, by)
        .groupBy(*by, "underlying", "underlying_ccy", "isin")
        .agg(F.sum("weight").alias("weight_exact"))
    )
    shorter = Window.partitionBy(*by, "underlying", "underlying_ccy")
    return exact.withColumn("weight_fallback", F.sum("weight_exact").over(shorter))


def attach_weights(report: DataFrame, maps: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``weight`` by exact key, else by fallback key, else 0, with the method used."""
    by = by or []
    keys = [*by, "underlying", "underlying_ccy"]
    # Written once: both lookups read it, and it is as small as the distinct securities.
    maps = cut_lineage(maps)
    exact = maps.where(F.col("weight_exact").isNotNull()).select(*keys, "isin", "weight_exact")
    fallback = maps.select(*keys, "weight_fallback").distinct()
    df = report.join(exact, [*keys, "isin"], "left").join(fallback, keys, "left")
    method = (
        F.when(F.col("weight_exact").isNotNull(), EXACT)
        .when(F.col("weight_fallback").isNotNull(), FALLBACK)
        .otherwise(UNMATCHED)
    )
    return df.withColumns(
        {
            "weight": F.coalesce("weight_exact", "weight_fallback", F.lit(0.0)),
            "weight_match_method": method,
            "weight_matched": method != UNMATCHED,
        }
    ).drop("weight_exact", "weight_fallback")


# --- mapping issues --------------------------------------------------------------------------

Classifier = tuple[str, Callable[[Column], Column]]

# Label and test over the upper-case candidate list; the first that holds wins.
LIST_CLASSIFIERS: list[Classifier] = [
    (
        "isin_sg_alias_pollution",
        lambda c: F.exists(c, lambda x: x.rlike(tk.ISIN_ALIAS_PATTERN)) & F.exists(c, lambda x: ~x.endswith(".SG")),
    ),
    ("india_ns_bo_dual", lambda c: F.exists(c, lambda x: x.endswith(".NS")) & F.exists(c, lambda x: x.endswith(".BO"))),
    (
        "plain_plus_local_alt",
        lambda c: F.exists(c, lambda x: ~x.contains(".") & x.rlike(tk.PLAIN_PATTERN))
        & F.exists(c, lambda x: x.contains(".")),
    ),
    (
        "same_venue_alias",
        lambda c: F.size(F.array_distinct(F.filter(F.transform(c, lambda x: tk.suffix(x)), lambda s: s != ""))) == 1,
    ),
]


def mapping_issue(candidates: Column, count: Column, status: Column) -> Column:
    out = F.when(count <= 0, "other")
    for label, test in LIST_CLASSIFIERS:
        out = out.when((count >= 2) & test(candidates), label)
    return out.when(
        (count == 1) & (F.upper(tx.strip(status)) == "VERIFIED_EXISTS_BUT_NO_DIVIDENDS"), "single_candidate_no_div"
    ).otherwise("other")


def with_mapping_issue(df: DataFrame) -> DataFrame:
    listed = F.transform(tk.parse_candidates(F.col("candidates_json")), lambda x: F.upper(x))
    df = df.withColumn("__listed", listed)
    c = F.col("__listed")
    return df.withColumns(
        {
            "mapping_issue_class": mapping_issue(c, F.col("candidate_count"), F.col("resolution_status")),
            "candidate_list_pretty": F.array_join(c, " | "),
            "candidate_suffixes": F.array_join(F.transform(c, lambda x: tk.suffix_label(x)), ","),
        }
    ).drop("__listed")


def ticker_report(
    resolutions: DataFrame,
    universe: DataFrame | None = None,
    maps: DataFrame | None = None,
    by: list[str] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """The full report. ``by`` (for example ``holdings_tag``) keeps weights of several runs apart."""
    df = prepare_report(resolutions).withColumn("is_failed", is_failed())
    if maps is None and universe is not None:
        maps = weight_maps(universe, by)
    if maps is None:
        df = df.withColumns(
            {"weight": F.lit(0.0), "weight_match_method": F.lit(UNMATCHED), "weight_matched": F.lit(False)}
        )
    else:
        df = attach_weights(df, maps, by)
    df = with_mapping_issue(df.withColumn("is_anomaly", is_anomaly()))
    return df.select(*REPORT_COLUMNS, *(keep or []))


def failed(report: DataFrame) -> DataFrame:
    return report.where("is_failed")


def anomalies(report: DataFrame) -> DataFrame:
    return report.where("is_anomaly")


# --- summaries -------------------------------------------------------------------------------


def materiality(report: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Failed and anomalous rows with their weights; one row, or one per ``by``."""
    w = F.coalesce(vl.number_in(report, "weight"), F.lit(0.0))
    lost = F.col("is_failed")
    unmatched = lost & (tx.report_text(F.col("weight_match_method")) == UNMATCHED)
    total = lambda cond: F.coalesce(F.sum(F.when(cond, w)), F.lit(0.0))
    count = lambda cond: F.count(F.when(cond, 1))
    return report.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("report_rows"),
        count(lost).alias("failed_rows"),
        count(F.col("is_anomaly")).alias("anomaly_rows"),
        total(lost).alias("failed_weight_sum"),
        total(F.col("is_anomaly")).alias("anomaly_weight_sum"),
        F.coalesce(F.max(F.when(lost, w)), F.lit(0.0)).alias("max_failed_weight"),
        count(unmatched).alias("unmatched_failed_count"),
        total(unmatched).alias("unmatched_failed_weight_sum"),
    )


def weight_diagnostics(report: DataFrame) -> DataFrame:
    """Rows and weights by match method, and fallback sums attached to more than one row."""
    method = tx.report_text(F.col("weight_match_method"))
    w = F.coalesce(vl.number_in(report, "weight"), F.lit(0.0))
    cols = [F.count(F.lit(1)).alias("report_rows")]
    for name, value in (("exact", EXACT), ("fallback", FALLBACK), ("unmatched", UNMATCHED)):
        rows = f"{name}_match_rows" if name != "unmatched" else "unmatched_rows"
        cols.append(F.count(F.when(method == value, 1)).alias(rows))
        cols.append(F.coalesce(F.sum(F.when(method == value, w)), F.lit(0.0)).alias(f"{name}_weight_sum"))
    key = F.when(method == FALLBACK, F.struct("underlying", "underlying_ccy"))
    df = report.agg(*cols, F.countDistinct(key).alias("fallback_distinct_keys"))
    extra = F.greatest(F.col("fallback_match_rows") - F.col("fallback_distinct_keys"), F.lit(0))
    warning = F.when(extra > 0, "fallback weight may be attached to multiple report rows").otherwise("")
    return df.withColumns(
        {
            "fallback_duplicate_rows": extra,
            "has_fallback_duplication_risk": extra > 0,
            "weight_match_warning": warning,
        }
    )


def top_failed(report: DataFrame, n: int = 3) -> DataFrame:
    """The heaviest failed rows."""
    w = F.coalesce(vl.number_in(report, "weight"), F.lit(0.0))
    return (
        report.where("is_failed")
        .select("underlying", "chosen_ticker", "resolution_status", w.alias("weight"))
        .orderBy(F.desc("weight"), "underlying", "chosen_ticker", "resolution_status")
        .limit(n)
    )


def top_failed_text(report: DataFrame, n: int = 3) -> str:
    rows = top_failed(report, n).collect()
    shown = [f"{r.underlying}:{r.chosen_ticker}:{r.resolution_status}:{r.weight:.6g}" for r in rows]
    return "; ".join(shown) or "none"
