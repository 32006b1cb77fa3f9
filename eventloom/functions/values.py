"""Currency, amount, date and hash expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, NumericType, TimestampNTZType, TimestampType

from eventloom.functions.text import strip, text_or_blank, vendor_text

# Codes that look like a currency but mean "missing".
NOT_A_CURRENCY = ["NAN", "NON"]
# Fixed value: a plain signed decimal, exponent allowed.
AMOUNT_PATTERN = r"^[-+]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][-+]?\d+)?$"


def currency(c: Column) -> Column:
    """Three-letter upper-case code, otherwise null."""
    s = F.upper(strip(c))
    return F.when((F.length(s) == 3) & ~s.isin(NOT_A_CURRENCY), s)


def currency_or_blank(c: Column) -> Column:
    return F.coalesce(currency(c), F.lit(""))


def number(c: Column) -> Column:
    """Double or null; NaN counts as missing."""
    d = strip(c).try_cast("double")
    return F.when(~F.isnan(d), d)


def number_in(df: DataFrame, name: str) -> Column:
    """``number`` of a column that may be missing; numeric columns skip the way through text."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    kind = df.schema[name].dataType
    if isinstance(kind, NumericType):
        d = F.col(name).cast("double")
        return F.when(~F.isnan(d), d) if isinstance(kind, (DoubleType, FloatType)) else d
    return number(F.col(name))


def day_in(df: DataFrame, name: str) -> Column:
    """``to_day`` of a column that may be missing; dates and timestamps skip the way through text."""
    if name not in df.columns:
        return F.lit(None).cast("date")
    kind = df.schema[name].dataType
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.col(name).cast("date")
    return to_day(F.col(name))


def optional_number(c: Column) -> Column:
    return number(F.nullif(vendor_text(c), F.lit("")))


def parse_amount(c: Column) -> Column:
    """Amount text with thousands commas, ``$`` or ``USD``; null if it is no number."""
    s = strip(c)
    for noise in (",", "$", "USD"):
        s = F.replace(s, F.lit(noise), F.lit(""))
    s = strip(s)
    return F.when(s.rlike(AMOUNT_PATTERN), s.try_cast("double"))


def holding_number(c: Column) -> Column:
    s = strip(c)
    for noise in (",", "$"):
        s = F.replace(s, F.lit(noise), F.lit(""))
    return s.try_cast("double")


def scale_amount(amount: Column, unit: Column) -> Column:
    u = F.lower(text_or_blank(unit))
    v = number(amount)
    return F.when(u == "pct", v / 100.0).when(u == "bps", v / 10000.0).otherwise(v)


def to_day(c: Column) -> Column:
    """Lenient date parse: ISO first, then compact and written-out forms."""
    s = strip(c)
    return F.coalesce(
        s.try_cast("date"),
        F.when(s.rlike(r"^\d{8}$"), F.try_to_date(s, "yyyyMMdd")),
        F.when(s.rlike(r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$"), F.try_to_date(s, "MMM d, yyyy")),
    )


def compact_day(c: Column) -> Column:
    """``yyyyMMdd`` text to date, null when malformed."""
    s = F.nullif(strip(c), F.lit(""))
    return F.when(s.rlike(r"^\d{8}$"), F.try_to_date(s, "yyyyMMdd"))


def compact_day_or_blank(c: Column) -> Column:
    return F.coalesce(F.date_format(compact_day(c), "yyyyMMdd"), F.lit(""))


def written_day(c: Column) -> Column:
    """``Jan 2, 2025`` or ISO date text to date."""
    s = F.nullif(strip(c), F.lit(""))
    return F.coalesce(
        F.when(s.rlike(r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$"), F.try_to_date(s, "MMM d, yyyy")),
        F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(s, "yyyy-MM-dd")),
    )


def window_start_seconds(day: Column) -> Column:
    """Unix second at which a day starts (UTC); no day means 0."""
    return F.coalesce(F.unix_seconds(day.cast("timestamp")), F.lit(0).cast("bigint"))


def window_end_seconds(day: Column) -> Column:
    """Unix second just after a day ends (UTC); no day means now."""
    return F.coalesce(
        F.unix_seconds(F.date_add(day, 1).cast("timestamp")),
        F.unix_seconds(F.current_timestamp()),
    )


def effective_asof(asof: Column, window_end: Column) -> Column:
    return F.coalesce(
        F.nullif(strip(asof), F.lit("")),
        window_end.cast("date").cast("string"),
        F.current_date().cast("string"),
    )


def digest(c: Column, digits: int) -> Column:
    return F.substring(F.sha2(c.cast("binary"), 256), 1, digits)


def event_id(key: Column) -> Column:
    return F.concat(F.lit("eco_"), digest(text_or_blank(key), 32))


def observation_id(provider: Column, provider_event_id: Column, fallback: Column, asof: Column) -> Column:
    parts = F.concat_ws(
        "|",
        F.upper(text_or_blank(provider)),
        text_or_blank(provider_event_id),
        text_or_blank(fallback),
        text_or_blank(asof),
    )
    return F.concat(F.lit("obs_"), digest(parts, 32))


def fixed_decimals(c: Column, decimals: int) -> Column:
    return F.when(c.isNotNull(), F.format_string(f"%.{decimals}f", c)).otherwise(F.lit(""))


def relative_spread(lo: Column, hi: Column, floor: float = 1e-9) -> Column:
    """Spread of absolute amounts relative to the largest; 0 for nothing or near-zero."""
    return F.when(hi > floor, (hi - lo) / hi).otherwise(F.lit(0.0))


def amount_close(a: Column, b: Column, rel: float = 0.02) -> Column:
    bound = F.lit(rel) * F.greatest(F.abs(a), F.abs(b), F.lit(1e-9))
    return F.coalesce(F.abs(a - b) <= bound, F.lit(False))
