"""Policy bucket and reason for securities without events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.functions import tickers as tk
from eventloom.functions import values as vl
from eventloom.operators.severity import require_columns

# Statuses, suffixes and words the rules look at.
NO_EVENT_LIKE = ["VERIFIED_EXISTS_BUT_NO_DIVIDENDS", "CANDIDATE_UNVERIFIED", "TICKER_NOT_FOUND"]
RU_LOCAL = [".ME", ".MOEX", ".RM"]
RU_ABROAD = [".L", ".US", ".N", ".O", ".K", ".SW", ".DE", ".F"]
UAE = [".AD", ".AB", ".DU"]
PS = [".PS"]
RU_COUNTRIES = ["RUSSIA", "RUSSIAN FEDERATION"]
RU_EXCHANGES = ["MOEX", "MOSCOW", "STANDARD-CLASSICA-FORTS", "FORTS"]
UAE_COUNTRIES = ["UNITED ARAB EMIRATES", "UAE"]
UAE_EXCHANGES = ["ABU DHABI", "ADX", "DUBAI", "DFM"]
PS_COUNTRIES = ["PHILIPPINES"]
PS_EXCHANGES = ["PHILIPP", "PSE"]

# Either spelling of each of these must be present.
SOURCES = {
    "ticker": ("chosen_ticker", "exists_ticker"),
    "candidates": ("candidates_json", "candidates"),
    "country": ("country", "candidate_country"),
    "exchange": ("exchange", "candidate_exchange"),
}


def _present(df: DataFrame, names: tuple[str, ...]) -> Column:
    for name in names:
        if name in df.columns:
            return F.upper(tx.text_or_blank(F.col(name)))
    return F.lit("")


def _candidates(df: DataFrame) -> Column:
    name = next(c for c in SOURCES["candidates"] if c in df.columns)
    if df.schema[name].dataType.typeName() == "array":
        return F.transform(tk.non_blank(F.col(name)), lambda x: F.upper(x))
    return tk.split_candidates(F.col(name))


def annotate_policy(df: DataFrame) -> DataFrame:
    """Add ``policy_bucket`` and ``policy_reason``; the most specific later rule wins."""
    require_columns(df, ["status", "isin"], "venue policy")
    absent = [what for what, names in SOURCES.items() if not any(n in df.columns for n in names)]
    if absent:
        raise ValueError(f"venue policy: no column for {absent}")

    base = df.withColumns(
        {
            "__status": _present(df, ("status",)),
            "__country": _present(df, SOURCES["country"]),
            "__exchange": _present(df, SOURCES["exchange"]),
            "__isin": _present(df, ("isin",)),
            "__ticker": _present(df, SOURCES["ticker"]),
            "__exists": _present(df, ("exists_ticker",)),
            "__count": F.coalesce(vl.number(F.col("candidate_count")), F.lit(0.0))
            if "candidate_count" in df.columns
            else F.lit(0.0),
            "__list": _candidates(df),
        }
    )
    chosen = lambda suffixes: tx.ends_with_any(F.col("__ticker"), suffixes)
    listed = lambda suffixes: F.exists("__list", lambda x: tx.ends_with_any(x, suffixes))
    either = lambda suffixes: chosen(suffixes) | listed(suffixes)
    place = lambda countries, exchanges: tx.contains_any(F.col("__country"), countries) | tx.contains_any(
        F.col("__exchange"), exchanges
    )
    several = F.col("__count") > 1

    russia = place(RU_COUNTRIES, RU_EXCHANGES) | F.col("__isin").startswith("RU")
    russia_local = russia & (either(RU_LOCAL) | ~either(RU_ABROAD))
    india_dual = several & (
        (chosen([".NS"]) & listed([".BO"])) | (chosen([".BO"]) & listed([".NS"])) | (listed([".NS"]) & listed([".BO"]))
    )
    unresolved = (
        (F.col("__ticker") == "")
        | (several & ~india_dual)
        | ((F.col("__status") == "VERIFIED_EXISTS_BUT_NO_DIVIDENDS") & (F.col("__exists") == ""))
    )
    # Highest precedence first.
    rules = [
        ("venue_precedence_review", "ns_bo_dual_listing", india_dual),
        ("coverage_limited_review", "ps_coverage_limited", place(PS_COUNTRIES, PS_EXCHANGES) & either(PS)),
        ("venue_policy_review", "uae_symbol_policy_gap", place(UAE_COUNTRIES, UAE_EXCHANGES) & either(UAE)),
        ("unsupported", "ru_local_unsupported", russia_local),
        ("generic_review", "unclassified_no_div", unresolved),
    ]
    bucket = reason = None
    no_event = F.col("__status").isin(NO_EVENT_LIKE)
    for name, why, test in rules:
        hit = no_event & test
        bucket = F.when(hit, name) if bucket is None else bucket.when(hit, name)
        reason = F.when(hit, why) if reason is None else reason.when(hit, why)
    out = base.withColumns({"policy_bucket": bucket.otherwise("clean"), "policy_reason": reason.otherwise("none")})
    return out.select(*df.columns, "policy_bucket", "policy_reason")
