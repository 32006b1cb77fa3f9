"""Text cleaning as Column expressions.

Each data source has its own idea of "missing", so every cleaner names its sentinel set.
All functions return JVM-side expressions; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\x0b\x0c"

# Sentinel texts that mean "missing", per data source.
LINK_SENTINELS = ["NONE", "NAN", "<NA>", "None", "nan"]
REPORT_SENTINELS = ["<NA>", "None", "none", "nan", "NaN", "NONE", "NAN"]
REVIEW_SENTINELS = ["<NA>", "None", "NONE", "nan", "NaN", "NAN"]
NULL_LIKE = ["", "NA", "NAN", "NONE", "<NA>", "-"]
VENDOR_EMPTY = ["", "nan", "none", "<na>"]
HOLDING_EMPTY = ["", "nan", "none", "<na>", "-"]
OVERLAP_SENTINELS = ["nan", "NaN", "NAN", "None", "<NA>"]
TRUE_LIKE = ["TRUE", "T", "YES", "Y", "1"]
FALSE_LIKE = ["FALSE", "F", "NO", "N", "0"]


def strip(c: Column) -> Column:
    """Trim every kind of white space; null stays null."""
    return F.btrim(c.cast("string"), F.lit(WHITESPACE))


def text_or_blank(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def _drop_sentinels(s: Column, sentinels: list[str], upper: bool) -> Column:
    out = F.when(s.isin(sentinels), F.lit("")).otherwise(s)
    return F.upper(out) if upper else out


def link_text(c: Column, upper: bool = True, stripped: bool = False) -> Column:
    """Cleaning used before linking: blank and sentinel texts become null.

    ``stripped`` says that white space is gone already, which saves doing it once per use.
    """
    s = c if stripped else strip(c)
    out = F.when(~s.isin("", *LINK_SENTINELS), s)
    return F.upper(out) if upper else out


def report_text(c: Column, upper: bool = False) -> Column:
    return _drop_sentinels(text_or_blank(c), REPORT_SENTINELS, upper)


def review_text(c: Column, upper: bool = False) -> Column:
    return _drop_sentinels(text_or_blank(c), REVIEW_SENTINELS, upper)


def resolution_text(c: Column, upper: bool = False) -> Column:
    s = text_or_blank(c)
    out = F.when(F.upper(s).isin(NULL_LIKE), F.lit("")).otherwise(s)
    return F.upper(out) if upper else out


def vendor_text(c: Column) -> Column:
    s = text_or_blank(c)
    return F.when(F.lower(s).isin(VENDOR_EMPTY), F.lit("")).otherwise(s)


def holding_text(c: Column) -> Column:
    s = text_or_blank(c)
    return F.when(F.lower(s).isin(HOLDING_EMPTY), F.lit("")).otherwise(s)


def overlap_text(c: Column) -> Column:
    s = c.cast("string")
    return F.when(~s.isin(OVERLAP_SENTINELS), s)


def compact_id(c: Column) -> Column:
    """Identifier without inner spaces, upper case."""
    return F.upper(F.replace(c, F.lit(" "), F.lit("")))


def clean_isin(c: Column) -> Column:
    return compact_id(resolution_text(c))


def collapse_spaces_upper(c: Column) -> Column:
    return F.regexp_replace(F.upper(text_or_blank(c)), r"\s+", " ")


def contains_any(c: Column, tokens: list[str]) -> Column:
    out = F.lit(False)
    for token in tokens:
        out = out | c.contains(token)
    return out


def ends_with_any(c: Column, suffixes: list[str]) -> Column:
    out = F.lit(False)
    for suffix in suffixes:
        out = out | c.endswith(suffix)
    return out


def flag(c: Column) -> Column:
    """Bool-like text to boolean; blank and sentinels are false, unknown texts are null."""
    s = F.upper(text_or_blank(c))
    return F.when(s.isin(TRUE_LIKE), True).when(s.isin(FALSE_LIKE + NULL_LIKE), False)


def strict_flag(c: Column, name: str) -> Column:
    """Like ``flag`` but a value that is neither true- nor false-like stops the job."""
    bad = F.concat(F.lit(f"invalid values in {name}: "), c.cast("string"))
    return F.coalesce(flag(c), F.raise_error(bad).cast("boolean"))


def nullable_flag(c: Column) -> Column:
    s = F.upper(text_or_blank(c))
    return F.when(s.isin(TRUE_LIKE), True).when(s.isin(FALSE_LIKE), False)


def whole_number(c: Column) -> Column:
    """Integer value of a number or numeric text; fractions and junk give 0."""
    d = strip(c).try_cast("double")
    return F.coalesce(F.when(d == F.floor(d), d.try_cast("bigint")), F.lit(0).cast("bigint"))


def truncated_number(c: Column) -> Column:
    """Integer part of a number or numeric text; junk gives 0."""
    return F.coalesce(strip(c).try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))
