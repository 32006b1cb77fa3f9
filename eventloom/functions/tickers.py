"""Vendor tickers, ISIN prefixes and candidate lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions import text as tx

ISIN_PATTERN = r"^[A-Z]{2}[A-Z0-9]{9}[0-9]$"
ISIN_ALIAS_PATTERN = r"^[A-Z]{2}[A-Z0-9]{9}[0-9]\.SG$"
PLAIN_PATTERN = r"^[A-Z0-9][A-Z0-9._-]*$"
UNSUPPORTED_PREFIX = "UNSUPPORTED_"


def clean_symbol(c: Column) -> Column:
    """Symbol without white space, ``$`` and ``*``."""
    return F.regexp_replace(tx.text_or_blank(c), r"[\s$*]", "")


def ticker_key(c: Column) -> Column:
    return F.upper(clean_symbol(c))


def suffix(ticker: Column) -> Column:
    """Part after the last dot, blank when there is none."""
    return F.when(ticker.contains("."), F.substring_index(ticker, ".", -1)).otherwise(F.lit(""))


def base(ticker: Column) -> Column:
    """Part before the last dot, or the whole ticker."""
    return F.regexp_replace(ticker, r"\.[^.]*$", "")


def suffix_label(ticker: Column) -> Column:
    t = F.upper(tx.text_or_blank(ticker))
    return F.when(t == "", F.lit("")).when(~t.contains("."), F.lit("US/PLAIN")).otherwise(suffix(t))


def listing_market(ticker: Column) -> Column:
    t = F.upper(tx.text_or_blank(ticker))
    return F.when(t.startswith(UNSUPPORTED_PREFIX), F.lit("")).otherwise(suffix(t))


def is_plain(ticker: Column) -> Column:
    return (ticker != "") & ~ticker.contains(".")


def is_local(ticker: Column) -> Column:
    return ticker.contains(".")


def looks_like_isin(c: Column) -> Column:
    return tx.compact_id(tx.text_or_blank(c)).rlike(ISIN_PATTERN)


def soft_prefix(isin: Column) -> Column:
    """Two leading letters, whether or not the rest is a proper ISIN."""
    s = tx.compact_id(tx.vendor_text(isin))
    return F.when(s.rlike(r"^\p{L}{2}"), F.substring(s, 1, 2)).otherwise(F.lit(""))


def strict_prefix(isin: Column) -> Column:
    s = tx.clean_isin(isin)
    return F.when(s.rlike(ISIN_PATTERN), F.substring(s, 1, 2)).otherwise(F.lit(""))


def zero_fill(c: Column, width: int) -> Column:
    """Left-pad a purely numeric text; ``lpad`` alone would cut longer ones."""
    s = tx.strip(c)
    return F.when(s.rlike(r"^\d+$") & (F.length(s) < width), F.lpad(s, width, "0")).otherwise(s)


def non_blank(items: Column) -> Column:
    return F.filter(F.transform(items, lambda x: tx.text_or_blank(x)), lambda x: x != "")


def parse_candidates(c: Column) -> Column:
    """Candidate list from its JSON text; anything else is an empty list."""
    return F.coalesce(non_blank(F.from_json(tx.text_or_blank(c), "array<string>")), F.array().cast("array<string>"))


def candidates_json(items: Column) -> Column:
    """JSON list text with a space after each comma, as the export format has it."""
    quoted = F.transform(items, lambda x: F.to_json(F.array(x)))
    inner = F.transform(quoted, lambda x: F.substr(x, F.lit(2), F.length(x) - 2))
    return F.concat(F.lit("["), F.array_join(inner, ", "), F.lit("]"))


def candidate_count(items: Column) -> Column:
    return F.size(non_blank(items))


def split_candidates(c: Column) -> Column:
    """Lenient list: JSON, or a comma list with or without brackets and quotes; upper case."""
    s = tx.text_or_blank(c)
    as_json = F.when(s.rlike(r"^\[[\s\S]*\]$"), F.from_json(s, "array<string>"))
    as_json = F.when(F.try_parse_json(s).isNotNull(), as_json)
    bare = F.btrim(s, F.lit("[](){}"))
    parts = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"\s*,\s*"))
    unquoted = F.transform(
        parts, lambda x: F.btrim(F.btrim(F.btrim(tx.strip(x), F.lit("'")), F.lit('"')), F.lit("() "))
    )
    return F.transform(non_blank(F.coalesce(as_json, unquoted)), lambda x: F.upper(x))


def exchange_tokens(c: Column) -> Column:
    """Distinct letter/digit runs of an exchange text."""
    return F.array_distinct(F.regexp_extract_all(F.upper(tx.vendor_text(c)), F.lit("([A-Z0-9]+)"), 1))
