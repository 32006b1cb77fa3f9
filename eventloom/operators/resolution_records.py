"""Resolution records: canonical form, cache, overrides and the chosen map built from them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.functions import text as tx
from eventloom.functions import values as vl
from eventloom.operators.linking import column_or
from eventloom.operators.ticker_qa import FAILURE_STATUSES
from eventloom.sources.holdings import first_per_key
from eventloom.sources.tables import with_row_no

KEY = ["underlying", "underlying_ccy"]
UNSUPPORTED_TICKER = "UNSUPPORTED_YF"

# Canonical record fields, their other names and whether they are upper-cased.
FIELDS: list[tuple[str, tuple[str, ...], str]] = [
    ("underlying", (), "text"),
    ("underlying_ccy", ("ccy",), "upper"),
    ("isin", (), "isin"),
    ("chosen_ticker", (), "text"),
    ("candidate_market", (), "upper"),
    ("candidate_origin", (), "text"),
    ("resolution_status", ("status",), "upper"),
    ("resolution_reason", ("reason",), "text"),
    ("resolution_method", ("method",), "text"),
    ("resolution_source", (), "text"),
    ("candidate_count", (), "int"),
    ("candidates_json", (), "text"),
    ("exists_ticker", (), "upper"),
    ("preverified_exists_any", ("exists_any",), "flag"),
    ("preverified_exists_ticker", ("preverified_ticker",), "derived"),
    ("exists_probe_symbol", (), "derived"),
    ("exists_probe_result", (), "derived"),
    ("review_reason", (), "text"),
    ("holdings_tag", (), "text"),
    ("holdings_file", (), "text"),
    ("source", (), "text"),
    ("start", (), "text"),
    ("end", (), "text"),
]
CANONICAL_FIELDS = [name for name, _, _ in FIELDS]


def _rename(df: DataFrame) -> DataFrame:
    """Known aliases to canonical names; of several spellings the first column wins."""
    target = {alias: name for name, aliases, _ in FIELDS for alias in (name, *aliases)}
    seen: set[str] = set()
    cols = []
    for c in df.columns:
        name = target.get(c, c)
        if name not in seen:
            seen.add(name)
            cols.append(F.col(c).alias(name))
    return df.select(*cols)


def verified_ticker(df: DataFrame) -> Column:
    """Preverified ticker, else (when a legacy flag is set) the existing, else the chosen one."""
    legacy = _legacy_any(df)
    named = lambda c: F.nullif(tx.resolution_text(column_or(df, c), upper=True), F.lit(""))
    derived = F.when(legacy, F.coalesce(named("exists_ticker"), named("chosen_ticker")))
    return F.coalesce(named("preverified_exists_ticker"), derived, F.lit(""))


def _legacy_any(df: DataFrame) -> Column:
    return tx.strict_flag(column_or(df, "exists_ns"), "exists_ns") | tx.strict_flag(
        column_or(df, "exists_bo"), "exists_bo"
    )


def normalise_resolutions(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The 23 canonical fields of resolution records."""
    df = _rename(raw)
    cleaners = {
        "text": lambda c: tx.resolution_text(c),
        "upper": lambda c: tx.resolution_text(c, upper=True),
        "isin": tx.clean_isin,
        "int": tx.whole_number,
        "flag": lambda c: tx.strict_flag(c, "preverified_exists_any"),
    }
    cols = {name: cleaners[kind](column_or(df, name)) for name, _, kind in FIELDS if kind in cleaners}
    if "preverified_exists_any" not in df.columns:
        cols["preverified_exists_any"] = _legacy_any(df)
    cols["preverified_exists_ticker"] = verified_ticker(df)
    out = df.withColumns(cols)
    exists, chosen, status = F.col("exists_ticker"), F.col("chosen_ticker"), F.col("resolution_status")
    verified = F.col("preverified_exists_ticker")
    symbol = F.upper(
        F.when(verified != "", verified).when((exists != "") & (exists != UNSUPPORTED_TICKER), exists).otherwise(chosen)
    )
    result = (
        F.when(F.col("preverified_exists_any"), True)
        .when(exists == UNSUPPORTED_TICKER, False)
        .when(exists != "", True)
        .when((status == "VERIFIED_EXISTS_BUT_NO_DIVIDENDS") & (chosen != ""), True)
        .when(status.isin(FAILURE_STATUSES), False)
    )
    out = out.withColumns({"exists_probe_symbol": symbol, "exists_probe_result": result})
    return out.select(*CANONICAL_FIELDS, *(keep or []))


def _legacy_flags(df: DataFrame) -> dict[str, Column]:
    """NS/BO flags: stated ones, else from the verified ticker's suffix."""
    if "exists_ns" in df.columns or "exists_bo" in df.columns:
        return {c: tx.strict_flag(column_or(df, c), c) for c in ("exists_ns", "exists_bo")}
    ticker = verified_ticker(df)
    return {"exists_ns": ticker.endswith(".NS"), "exists_bo": ticker.endswith(".BO")}


def _clean_records(raw: DataFrame, columns: list[str]) -> DataFrame:
    """Clean override or cache records; records without key or ticker are left out."""
    df = with_row_no(raw)
    flags = _legacy_flags(df)
    cols = {}
    for c in columns:
        if c in flags:
            cols[c] = flags[c]
        elif c == "isin":
            cols[c] = tx.clean_isin(column_or(df, c))
        elif c.endswith("_asof"):
            cols[c] = vl.compact_day_or_blank(tx.resolution_text(column_or(df, c)))
        else:
            upper = c in (*KEY, "chosen_ticker", "resolution_status", "candidate_market")
            cols[c] = tx.resolution_text(column_or(df, c), upper=upper)
    out = df.select(*[v.alias(k) for k, v in cols.items()], "row_no")
    return out.where((F.col("underlying") != "") & (F.col("underlying_ccy") != "") & (F.col("chosen_ticker") != ""))


def last_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("__row"))
    return packed.select(*keys, "__row.*").select(*df.columns)


def overrides(raw: DataFrame) -> DataFrame:
    """Override table: the first record of a key wins."""
    clean = _clean_records(raw, schemas.OVERRIDE_COLUMNS)
    return first_per_key(clean, KEY, ["row_no"]).select(*schemas.OVERRIDE_COLUMNS)


def cache(raw: DataFrame) -> DataFrame:
    """Resolution cache: the last record of a key wins."""
    return last_per_key(_clean_records(raw, schemas.CACHE_COLUMNS), KEY, "row_no").select(*schemas.CACHE_COLUMNS)


def effective_map(override_rows: DataFrame, cache_rows: DataFrame) -> DataFrame:
    """Cache overlaid by overrides."""
    or_cache = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("cache"))
    lower = cache_rows.select(*schemas.OVERRIDE_COLUMNS).withColumns(
        {"reason": or_cache("reason"), "method": or_cache("method"), "__place": F.lit(1)}
    )
    upper = override_rows.select(*schemas.OVERRIDE_COLUMNS).withColumn("__place", F.lit(0))
    return first_per_key(upper.unionByName(lower), KEY, ["__place"]).select(*schemas.OVERRIDE_COLUMNS)


def map_order(df: DataFrame) -> DataFrame:
    return df.orderBy(*KEY)


def cache_updates(
    resolutions: DataFrame,
    asof: str,
    run_id: str,
    accepted: Iterable[str] = ("div_found", "verified_exists_but_no_dividends"),
) -> DataFrame:
    """Cache records of a run's accepted resolutions; of several for a key the last by ``row_no`` wins.

    A written resolutions table has the order of the tasks that wrote it, so without ``row_no`` the content decides: the
    record with the largest values, column by column.
    """
    wanted = [s.strip().upper() for s in accepted if s.strip()]
    if "row_no" not in resolutions.columns:
        told = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(resolutions.columns) if resolutions.schema[c].dataType.typeName() != "array"]
        resolutions = resolutions.withColumn("row_no", F.struct(*[t.alias(f"c{i}") for i, t in enumerate(told)]))
    df = normalise_resolutions(resolutions, keep=["row_no"])
    df = df.where(F.col("resolution_status").isin(wanted))
    ticker = F.col("preverified_exists_ticker")
    df = df.withColumns(
        {
            "reason": F.col("resolution_reason"),
            "method": F.col("resolution_method"),
            "exists_ns": ticker.endswith(".NS"),
            "exists_bo": ticker.endswith(".BO"),
            "first_seen_asof": F.lit(asof),
            "last_seen_asof": F.lit(asof),
            "last_validated_run_id": F.lit(run_id),
        }
    )
    return last_per_key(_clean_records(df, schemas.CACHE_COLUMNS), KEY, "row_no").select(*schemas.CACHE_COLUMNS)


def upsert_cache(existing: DataFrame, updates: DataFrame) -> DataFrame:
    """New records replace old ones but keep the day the key was first seen."""
    fields = [c for c in schemas.CACHE_COLUMNS if c not in KEY]
    old = existing.select(*KEY, F.struct(*fields).alias("old"))
    new = updates.select(*KEY, F.struct(*fields).alias("new"))
    both = old.join(new, KEY, "full_outer")
    first_seen = F.coalesce(
        F.nullif(F.col("old.first_seen_asof"), F.lit("")), F.nullif(F.col("new.first_seen_asof"), F.lit("")), F.lit("")
    )
    picked = F.coalesce(F.col("new"), F.col("old"))
    cols = {c: picked[c] for c in fields} | {"first_seen_asof": first_seen}
    return both.select(*KEY, *[cols[c].alias(c) for c in fields]).select(*schemas.CACHE_COLUMNS)


def chosen_map(raw: DataFrame) -> DataFrame:
    """(underlying, ccy) -> ticker with reason, method, source and ISIN; the last record wins.

    The currency column is ``underlying_ccy`` when any record fills it, else ``ccy``.
    """
    df = with_row_no(raw)
    ccy = "ccy"
    if "underlying_ccy" in df.columns and not df.where(tx.text_or_blank(F.col("underlying_ccy")) != "").isEmpty():
        ccy = "underlying_ccy"
    told = lambda a, b: F.coalesce(
        F.nullif(tx.vendor_text(column_or(df, a)), F.lit("")),
        F.nullif(tx.vendor_text(column_or(df, b)), F.lit("")),
        F.lit("override"),
    )
    out = df.select(
        tx.vendor_text(column_or(df, "underlying")).alias("underlying"),
        vl.currency_or_blank(column_or(df, ccy)).alias("underlying_ccy"),
        tx.vendor_text(column_or(df, "chosen_ticker")).alias("ticker"),
        told("resolution_reason", "reason").alias("reason"),
        told("resolution_method", "method").alias("method"),
        F.lit("chosen_map").alias("source"),
        F.upper(tx.vendor_text(column_or(df, "isin"))).alias("isin"),
        "row_no",
    ).where((F.col("underlying") != "") & (F.col("underlying_ccy") != "") & (F.col("ticker") != ""))
    return last_per_key(out, KEY, "row_no").drop("row_no")


def apply_suggestions(chosen: DataFrame, suggestions: DataFrame) -> DataFrame:
    """Fill blank tickers by ISIN from the first suggestion for it."""
    sug = with_row_no(suggestions).select(
        F.upper(tx.text_or_blank(column_or(suggestions, "isin"))).alias("isin"),
        tx.text_or_blank(F.col("suggested_ticker")).alias("__ticker"),
        tx.text_or_blank(column_or(suggestions, "method")).alias("__method"),
        "row_no",
    )
    sug = first_per_key(sug.where(F.col("__ticker") != ""), ["isin"], ["row_no"]).drop("row_no")
    fields = ["isin", "chosen_ticker", "reason", "method"]
    df = chosen.withColumns({c: tx.text_or_blank(column_or(chosen, c)) for c in fields})
    df = df.withColumn("isin", F.upper("isin")).join(sug, "isin", "left")
    hit = (F.col("chosen_ticker") == "") & F.col("__ticker").isNotNull()
    method = F.coalesce(F.nullif(F.col("__method"), F.lit("")), F.lit("suggest_overrides_yahoo"))
    return df.withColumns(
        {
            "chosen_ticker": F.when(hit, F.col("__ticker")).otherwise(F.col("chosen_ticker")),
            "reason": F.when(hit, F.lit("override_suggested")).otherwise(F.col("reason")),
            "method": F.when(hit, method).otherwise(F.col("method")),
        }
    ).drop("__ticker", "__method")


def mark_unsupported(
    chosen: DataFrame,
    failures: DataFrame,
    tag: str = UNSUPPORTED_TICKER,
    reason: str = "unsupported",
    method: str = "manual",
) -> DataFrame:
    """Tag every entry whose ISIN is in the failure list."""
    isin = lambda df: F.upper(tx.text_or_blank(F.col("isin")))
    listed = failures.select(isin(failures).alias("__isin")).distinct().withColumn("__hit", F.lit(True))
    df = chosen.withColumn("__isin", isin(chosen)).join(listed, "__isin", "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    values = {"chosen_ticker": tag, "reason": reason, "method": method}
    return df.withColumns(
        {c: F.when(hit, F.lit(v)).otherwise(column_or(df, c)) for c, v in values.items()}
    ).drop("__isin", "__hit")
