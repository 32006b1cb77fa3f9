"""Stage 1 for a whole universe: resolve, take dividends, and shape the four output tables."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.functions import text as tx
from eventloom.functions import tickers as tk
from eventloom.functions import values as vl
from eventloom.operators import resolve as rs
from eventloom.session import cut_lineage
from eventloom.sources.vendor import window_actions

# Resolution statuses in report order.
STATUSES = [
    "div_found",
    "verified_exists_but_no_dividends",
    "candidate_unverified",
    "ticker_not_found",
    "unsupported_vendor",
    "worker_exception",
    "unknown_status",
]
CONFIDENCE = 35
DATE_SEMANTICS = "yfinance_history_actions_dividends"


@dataclass(frozen=True)
class Window:
    """Requested dividend window, ``YYYYMMDD`` texts; blank means open."""

    start: str = ""
    end: str = ""

    def start_day(self) -> Column | None:
        return vl.compact_day(F.lit(self.start)) if self.start else None

    def end_day(self) -> Column | None:
        return vl.compact_day(F.lit(self.end)) if self.end else None


@dataclass(frozen=True)
class Landing:
    """Landed vendor tables: search candidates, (ticker, exists) and (ticker, ex_date, amount)."""

    search: DataFrame
    existing: DataFrame
    actions: DataFrame


@dataclass(frozen=True)
class Ingested:
    observations: DataFrame
    errors: DataFrame
    no_events: DataFrame
    resolutions: DataFrame


class Adaptor(Protocol):
    """A vendor: takes a universe and landed tables, gives the four stage-1 tables."""

    def fetch(self, universe: DataFrame, landing: Landing, window: Window) -> Ingested: ...


def status_when_unpaid(candidates: Column, exists: Column) -> Column:
    return (
        F.when(exists, "verified_exists_but_no_dividends")
        .when(tk.candidate_count(candidates) > 0, "candidate_unverified")
        .otherwise("ticker_not_found")
    )


def tickers_of(candidates: Column) -> Column:
    return F.transform(candidates, lambda c: c["ticker"])


def by_ticker(candidates: Column, ticker: Column) -> Column:
    return F.try_element_at(F.filter(candidates, lambda c: c["ticker"] == ticker), F.lit(1))


def choose(resolved: DataFrame) -> DataFrame:
    """Final choice per security: the paying candidate, else what is reported when nothing paid.

    That is the override, else the existing ticker, else the first candidate, else blank.
    """
    c = F.col("candidates")
    existing = F.when(F.col("preverified_any"), F.col("preverified_ticker")).otherwise(rs.first_existing(c))
    df = resolved.withColumns({"paid": F.col("chosen").isNotNull(), "__existing": existing})
    df = df.withColumn("exists_any", ~F.col("paid") & F.col("__existing").isNotNull())
    fallback = (
        F.when(F.col("override").isNotNull(), by_ticker(c, tk.ticker_key(F.col("override.ticker"))))
        .when(F.col("exists_any"), by_ticker(c, F.col("__existing")))
        .otherwise(F.try_element_at(c, F.lit(1)))
    )
    df = df.withColumn("pick", F.coalesce(F.col("chosen"), fallback))
    ticker = F.coalesce(
        F.col("pick.ticker"),
        F.when(F.col("override").isNotNull(), tk.ticker_key(F.col("override.ticker"))),
        F.when(F.col("exists_any"), F.col("__existing")),
        F.lit(""),
    )
    return df.withColumns(
        {
            "chosen_ticker": ticker,
            "exists_ticker": F.when(F.col("paid"), F.col("pick.ticker")).otherwise(F.coalesce("__existing", F.lit(""))),
            "resolution_status": F.when(F.col("paid"), "div_found").otherwise(
                status_when_unpaid(c, F.col("exists_any"))
            ),
        }
    ).drop("__existing")


def with_metadata(df: DataFrame) -> DataFrame:
    """Market, origin, source, guess source, exchange, prefix and consistency of the choice."""
    pick, override = F.col("pick"), F.col("override")
    has_pick, has_override = pick.isNotNull(), override.isNotNull()
    from_pick = lambda f: F.when(has_pick, F.coalesce(pick[f], F.lit("")))
    market = F.nullif(tk.listing_market(F.coalesce(pick["ticker"], F.col("chosen_ticker"))), F.lit(""))
    source = F.when(has_override, F.coalesce(override["source"], F.lit("")))
    prefix = F.coalesce(F.nullif(pick["isin_prefix"], F.lit("")), tk.soft_prefix(F.col("row_isin")))
    df = df.withColumns(
        {
            "candidate_market": F.coalesce(F.when(has_pick | has_override, market), from_pick("market"), F.lit("")),
            "candidate_origin": F.coalesce(from_pick("origin"), source, F.lit("")),
            "resolution_source": F.coalesce(from_pick("origin"), source, F.lit("")),
            "guess_source": F.coalesce(from_pick("guess_source"), F.when(has_override, "override"), F.lit("")),
            "canonical_exchange": F.coalesce(from_pick("canonical_exchange"), F.lit("")),
            "isin_prefix": prefix,
        }
    )
    df = rs.prefix_matches_tokens(df, F.col("row_isin"), "canonical_exchange", "__by_tokens")
    known = F.when(has_pick, pick["prefix_exchange_consistent"])
    return df.withColumn("prefix_exchange_consistent", F.coalesce(known, F.col("__by_tokens"))).drop("__by_tokens")


def _shaped(df: DataFrame, source: str, window: Window) -> DataFrame:
    listed = tickers_of(F.col("candidates"))
    return df.withColumns(
        {
            "source": F.lit(source),
            "isin": F.col("row_isin"),
            "candidate_count": tk.candidate_count(listed),
            "candidates_json": tk.candidates_json(listed),
            "start": F.lit(window.start),
            "end": F.lit(window.end),
        }
    ).withColumn("candidates", listed)


def resolution_rows(chosen: DataFrame, source: str, window: Window) -> DataFrame:
    found = F.col("paid")
    otherwise_override = F.when(F.col("override").isNotNull(), "override").when(found, "div_found").otherwise("")
    any_verified = F.col("preverified_any") | F.col("exists_any")
    verified = tk.ticker_key(
        F.coalesce(F.nullif(F.col("preverified_ticker"), F.lit("")), F.when(~found, F.col("exists_ticker")), F.lit(""))
    )
    df = _shaped(chosen, source, window).withColumns(
        {
            "resolution_reason": F.coalesce(F.nullif(F.col("reason"), F.lit("")), otherwise_override),
            "resolution_method": F.coalesce(
                F.nullif(F.col("pick.method"), F.lit("")),
                F.when(F.col("override").isNotNull(), F.coalesce(F.col("override.method"), F.lit("override"))),
                F.lit(""),
            ),
            "preverified_exists_any": any_verified,
            "preverified_exists_ticker": verified,
            "exists_ns": verified.endswith(".NS"),
            "exists_bo": verified.endswith(".BO"),
        }
    )
    return df.select(*schemas.RESOLUTIONS, *schemas.RESOLUTIONS_LEGACY, *_stamps(chosen))


def _stamps(df: DataFrame) -> list[str]:
    return [c for c in ("holdings_tag", "holdings_file") if c in df.columns]


def no_event_rows(chosen: DataFrame, source: str, window: Window) -> DataFrame:
    unpaid = chosen.where(~F.col("paid") & (F.col("resolution_status") != "ticker_not_found"))
    shaped = _shaped(unpaid, source, window).withColumn("status", F.col("resolution_status"))
    return shaped.select(*schemas.NO_EVENTS, *_stamps(chosen))


def error_rows(chosen: DataFrame, source: str, window: Window) -> DataFrame:
    lost = chosen.where(F.col("resolution_status") == "ticker_not_found")
    shaped = _shaped(lost, source, window).withColumn("error", F.col("resolution_status"))
    return shaped.select(*schemas.ERRORS, *_stamps(chosen))


def unsupported_rows(securities: DataFrame, source: str, window: Window) -> tuple[DataFrame, DataFrame]:
    """(resolutions, no events) of overrides that say the vendor does not serve the security."""
    ticker = F.upper(tx.strip(F.col("override.ticker")))
    entry = rs.override_candidate(F.col("row_isin"), F.col("override"))
    df = securities.withColumns(
        {
            "candidates": F.array(F.struct(ticker.alias("ticker"))),
            "chosen_ticker": ticker,
            "exists_ticker": ticker,
            "candidate_market": F.lit(""),
            "candidate_origin": F.col("override.source"),
            "resolution_status": F.lit("unsupported_vendor"),
            "resolution_reason": F.coalesce(F.col("override.reason"), F.lit("unsupported_vendor:yfinance")),
            "resolution_method": F.coalesce(F.col("override.method"), F.lit("override")),
            "resolution_source": F.col("override.source"),
            "preverified_exists_any": F.lit(False),
            "preverified_exists_ticker": F.lit(""),
            "guess_source": F.lit("override"),
            "canonical_exchange": F.lit(""),
            "isin_prefix": entry["isin_prefix"],
            "prefix_exchange_consistent": F.lit(None).cast("boolean"),
            "status": F.lit("unsupported_vendor"),
            "exists_ns": F.lit(False),
            "exists_bo": F.lit(False),
        }
    )
    df = _shaped(df, source, window)
    stamps = _stamps(securities)
    return (
        df.select(*schemas.RESOLUTIONS, *schemas.RESOLUTIONS_LEGACY, *stamps),
        df.select(*schemas.NO_EVENTS, *stamps),
    )


def evidence() -> Column:
    """Nested evidence of one observation as JSON text."""
    pick, listed = F.col("pick"), tickers_of(F.col("candidates"))
    return F.to_json(
        F.struct(
            F.lit(DATE_SEMANTICS).alias("date_semantics"),
            F.col("raw_amount").alias("raw_amount"),
            F.col("weight").alias("weight"),
            F.col("name").alias("input_name"),
            F.col("exchange").alias("input_exchange"),
            F.col("row_isin").alias("input_isin"),
            F.struct(
                pick["method"].alias("method"),
                pick["origin"].alias("source"),
                F.col("market").alias("market"),
                pick["guess_source"].alias("guess_source"),
                pick["canonical_exchange"].alias("canonical_exchange"),
                pick["isin_prefix"].alias("isin_prefix"),
                pick["prefix_exchange_consistent"].alias("prefix_exchange_consistent"),
            ).alias("resolution"),
            F.struct(listed.alias("values"), tk.candidate_count(listed).alias("count")).alias("candidates"),
        ),
        {"ignoreNullFields": "false"},
    )


def observation_rows(
    chosen: DataFrame, actions: DataFrame, source: str, window: Window, asof: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(observations, errors): one row per dividend of the chosen ticker; unreadable amounts are errors."""
    paid = chosen.where("paid").withColumn("ticker", tk.ticker_key(F.col("pick.ticker")))
    dated = actions.select("ticker", "ex_date", F.col("amount").cast("string").alias("raw_amount"))
    df = paid.join(dated, "ticker")
    market = F.coalesce(
        F.nullif(tk.listing_market(F.col("ticker")), F.lit("")), F.upper(tx.text_or_blank(F.col("pick.market")))
    )
    ex_day = F.col("ex_date").cast("string")
    df = df.withColumns({"amount": vl.parse_amount(F.col("raw_amount")), "market": market, "ex_date": ex_day})

    stamps = _stamps(chosen)
    bad = _shaped(df.where(F.col("amount").isNull()), source, window).withColumns(
        {"error": F.lit("bad_amount"), "yfinance_ticker": F.col("ticker")}
    )
    bad = bad.select(*schemas.ERRORS, *stamps, "yfinance_ticker", "ex_date", "raw_amount")

    good = df.where(F.col("amount").isNotNull()).withColumn("evidence_json", evidence())
    blank = {c: F.lit("") for c in ("economic_event_id", "vendor_event_id", "declared_date", "record_date", "pay_date")}
    good = good.withColumns(
        blank
        | {
            "source": F.lit(source),
            "source_event_key": F.concat_ws("|", "ticker", "underlying_ccy", "ex_date"),
            "isin": F.col("row_isin"),
            "currency": F.col("underlying_ccy"),
            "yfinance_ticker": F.col("ticker"),
            "action_type": F.lit("cash_dividend"),
            "period_type": F.lit("unknown"),
            "share_class": F.lit("unknown"),
            "status": F.lit("historical"),
            "amount_type": F.lit("per_share"),
            "amount_ccy": F.col("underlying_ccy"),
            "confidence": F.lit(CONFIDENCE),
            "asof_date": vl.effective_asof(
                F.lit(asof), window.end_day() if window.end else F.lit(None).cast("date")
            ),
            "ingest_ts": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
        }
    )
    return schemas.enforce_canonical(good, keep=stamps), bad


def ingest(
    universe: DataFrame,
    landing: Landing,
    rules: DataFrame,
    chosen_map: DataFrame,
    window: Window = Window(),
    source: str = "yfinance",
    asof: str | None = None,
) -> Ingested:
    """All securities at once; a security that cannot be served becomes a row in errors or no-events.

    Securities, resolved and chosen ones (one row each) are written to the shared folder: the first
    feed three searches, the second are read twice to find the paying ticker, the last give four tables.
    """
    securities = cut_lineage(rs.with_row_isin(rs.attach_override(rs.security_context(universe), chosen_map)))
    unsupported = rs.is_unsupported(F.col("override"))
    actions = window_actions(landing.actions, window.start_day(), window.end_day())

    open_rows = securities.where(~unsupported)
    resolved = cut_lineage(rs.resolve_candidates(open_rows, landing.search, rules, landing.existing))
    chosen = cut_lineage(with_metadata(choose(rs.choose_paying(resolved, actions))))

    blocked_resolutions, blocked_no_events = unsupported_rows(securities.where(unsupported), source, window)
    observations, bad_amounts = observation_rows(chosen, actions, source, window, asof)
    return Ingested(
        observations=observations,
        errors=error_rows(chosen, source, window).unionByName(bad_amounts, allowMissingColumns=True),
        no_events=no_event_rows(chosen, source, window).unionByName(blocked_no_events),
        resolutions=resolution_rows(chosen, source, window).unionByName(blocked_resolutions),
    )


# --- numeric contract ------------------------------------------------------------------------

CRITICAL_NUMBERS = ["amount", "weight"]


def split_bad_numbers(df: DataFrame, context: str = "") -> tuple[DataFrame, DataFrame]:
    """(good, errors): rows whose critical numbers cannot be read become error rows that quote them."""
    cols = [c for c in CRITICAL_NUMBERS if c in df.columns]
    typed = {f"__{c}": vl.number(F.col(c)) for c in cols}
    judged = df.withColumns(typed)
    bad_list = F.array_compact(F.array(*[F.when(F.col(f"__{c}").isNull(), F.lit(c)) for c in cols]))
    judged = judged.withColumn("__bad", bad_list)
    good = judged.where(F.size("__bad") == 0)
    good = good.withColumns({c: F.col(f"__{c}") for c in cols}).select(*df.columns)

    pick = lambda *names: next((F.col(n) for n in names if n in df.columns), F.lit(""))
    quoted = F.map_from_entries(
        F.transform(
            F.col("__bad"),
            lambda name: F.struct(
                name.alias("key"),
                F.coalesce(*[F.when(name == c, F.col(c).cast("string")) for c in cols], F.lit(None)).alias("value"),
            ),
        )
    )
    errors = judged.where(F.size("__bad") > 0).select(
        pick("source").alias("source"),
        pick("underlying").alias("underlying"),
        pick("underlying_ccy", "currency", "amount_ccy").alias("underlying_ccy"),
        pick("isin").alias("isin"),
        F.lit("critical_numeric_contract_violation").alias("error"),
        F.array().cast("array<string>").alias("candidates"),
        F.lit("[]").alias("candidates_json"),
        F.lit(0).alias("candidate_count"),
        F.lit("").alias("start"),
        F.lit("").alias("end"),
        pick("source_event_key").alias("source_event_key"),
        pick("vendor_event_id").alias("vendor_event_id"),
        pick("yfinance_ticker").alias("yfinance_ticker"),
        *_stamps(df),
        F.array_join("__bad", ",").alias("bad_numeric_columns"),
        F.to_json(quoted, {"ignoreNullFields": "false"}).alias("bad_numeric_values_json"),
        F.lit(context).alias("context"),
    )
    return good, errors


def status_counts(resolutions: DataFrame) -> DataFrame:
    """Rows per status with the report position; statuses not listed come last by name."""
    status = F.lower(tx.vendor_text(F.col("resolution_status")))
    status = F.when(status == "", F.lit("unknown_status")).otherwise(status)
    place = F.array_position(F.array(*[F.lit(s) for s in STATUSES]), F.col("status"))
    counts = resolutions.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("place", F.when(place > 0, place).otherwise(len(STATUSES) + 1))


def worker_error_rows(failed: DataFrame, source: str, window: Window) -> DataFrame:
    """Error rows for securities whose vendor landing is marked as failed (``exception_type``, ``exception``)."""
    df = rs.security_context(failed)
    return df.select(
        F.lit(source).alias("source"),
        "underlying",
        "underlying_ccy",
        "isin",
        F.lit("worker_exception").alias("error"),
        F.array().cast("array<string>").alias("candidates"),
        F.lit("[]").alias("candidates_json"),
        F.lit(0).alias("candidate_count"),
        F.lit(window.start).alias("start"),
        F.lit(window.end).alias("end"),
        "exception_type",
        "exception",
    )
