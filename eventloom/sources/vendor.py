"""Landed vendor payloads: dividend actions, chart events, ISIN search results and quote info."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.functions import values as vl
from eventloom.functions.tickers import looks_like_isin, soft_prefix, ticker_key

# Fields whose presence shows that a quote exists, and how many are enough.
FAST_FIELDS = ["currency", "exchange", "quoteType", "timezone", "lastPrice", "previousClose"]
INFO_FIELDS = ["symbol", "exchange", "quoteType", "currency", "market", "regularMarketPrice"]
ENOUGH_FIELDS = 2
QUOTE_TYPES = ["EQUITY", "ETF"]

CHART_SCHEMA = (
    "chart struct<result: array<struct<events: struct<dividends: map<string, struct<date: string, amount: string>>>>>>"
)
SEARCH_SCHEMA = "quotes array<struct<symbol: string, quoteType: string, exchDisp: string, exchange: string>>"


def window_actions(actions: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Non-zero dividends inside the window, both ends included."""
    out = actions.where((F.col("amount") != 0) & F.col("amount").isNotNull())
    if start is not None:
        out = out.where(F.col("ex_date") >= start)
    return out if end is None else out.where(F.col("ex_date") <= end)


def chart_events(payloads: DataFrame) -> DataFrame:
    """(ticker, ex_date, amount) from chart payloads (ticker, content).

    Only the first result counts, items without date or amount are passed over, and one unreadable
    item voids its payload.
    """
    parsed = F.from_json("content", CHART_SCHEMA)
    first = F.try_element_at(parsed["chart"]["result"], F.lit(1))
    items = F.filter(
        F.map_values(first["events"]["dividends"]),
        lambda i: (F.coalesce(i["date"], F.lit("")) != "") & (F.coalesce(i["amount"], F.lit("")) != ""),
    )
    df = payloads.select(ticker_key(F.col("ticker")).alias("ticker"), items.alias("items"))
    unreadable = F.exists(
        "items", lambda i: i["date"].try_cast("bigint").isNull() | vl.parse_amount(i["amount"]).isNull()
    )
    # An unreadable payload gives a null list and so no rows; a filter would parse every payload again.
    readable = F.when(~unreadable, F.col("items"))
    df = df.where(F.col("ticker") != "").select("ticker", F.explode(readable).alias("i"))
    return df.select(
        "ticker",
        F.to_date(F.timestamp_seconds(F.col("i.date").try_cast("bigint"))).alias("ex_date"),
        vl.parse_amount(F.col("i.amount")).alias("amount"),
    )


def search_candidates(payloads: DataFrame) -> DataFrame:
    """Candidate tickers from ISIN search payloads (isin, content), in result order."""
    isin = tx.compact_id(tx.text_or_blank(F.col("isin")))
    df = payloads.select(isin.alias("isin"), F.from_json("content", SEARCH_SCHEMA)["quotes"].alias("quotes"))
    df = df.where(looks_like_isin(F.col("isin"))).select("isin", F.posexplode("quotes").alias("ordinal", "q"))
    kind = F.upper(F.coalesce(F.col("q.quoteType"), F.lit("")))
    ticker = ticker_key(F.col("q.symbol"))
    named = lambda c: F.nullif(F.coalesce(F.col(c), F.lit("")), F.lit(""))
    return df.where((ticker != "") & ((kind == "") | kind.isin(QUOTE_TYPES))).select(
        "isin",
        "ordinal",
        ticker.alias("ticker"),
        tx.strip(F.coalesce(named("q.exchDisp"), named("q.exchange"), F.lit("UNK"))).alias("market"),
        F.lit("isin_search").alias("method"),
        F.lit("auto_search").alias("origin"),
        F.lit("").alias("canonical_exchange"),
        F.lit("isin_search").alias("guess_source"),
        soft_prefix(F.col("isin")).alias("isin_prefix"),
        F.lit(None).cast("boolean").alias("prefix_exchange_consistent"),
    )


def present(c: Column) -> Column:
    """A quote field that says something: not null, blank, empty or zero."""
    s = tx.text_or_blank(c)
    return (s != "") & ~s.isin("[]", "{}") & (F.coalesce(s.try_cast("double"), F.lit(1.0)) != 0)


def exists_signal(landing: DataFrame) -> DataFrame:
    """(ticker, exists) from landed quote info: price rows, or enough fields in either block.

    Expects ``price_rows`` and the structs ``fast_info`` and ``info``.
    """
    count = lambda block, names: sum((present(F.col(f"{block}.{n}")).cast("int") for n in names), F.lit(0))
    found = (
        (F.coalesce(F.col("price_rows"), F.lit(0)) > 0)
        | (count("fast_info", FAST_FIELDS) >= ENOUGH_FIELDS)
        | (count("info", INFO_FIELDS) >= ENOUGH_FIELDS)
    )
    df = landing.select(ticker_key(F.col("ticker")).alias("ticker"), found.alias("exists"))
    return df.where(F.col("ticker") != "").groupBy("ticker").agg(F.bool_or("exists").alias("exists"))
