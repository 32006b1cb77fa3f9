"""Input validation, no-event buckets, dataset tags and regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.functions import text as tx
from eventloom.functions import values as vl
from eventloom.operators.linking import column_or

# Texts that stand for a missing symbol, and what a symbol may contain.
PLACEHOLDERS = ["", "-", "--", "N/A", "NA", "NONE", "NULL", "NAN", "<NA>"]
SYMBOL_PATTERN = r"^[A-Z0-9.\-_/]+$"


def rejection_reason(underlying: Column) -> Column:
    """Why a symbol is not usable, null when it is."""
    s = tx.collapse_spaces_upper(underlying)
    return (
        F.when(s == "", "blank_underlying")
        .when(s.isin(PLACEHOLDERS), "placeholder_underlying")
        .when(~s.rlike(r"[\p{L}\p{N}]"), "non_symbol_underlying")
        .when(~s.rlike(SYMBOL_PATTERN), "invalid_underlying_format")
    )


def split_universe(universe: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid with the normalised symbol, rejected with the reason)."""
    judged = universe.withColumns(
        {
            "__raw": F.coalesce(F.col("underlying").cast("string"), F.lit("")),
            "__clean": tx.collapse_spaces_upper(F.col("underlying")),
            "__reason": rejection_reason(F.col("underlying")),
        }
    )
    valid = judged.where(F.col("__reason").isNull()).withColumn("underlying", F.col("__clean")).select(*universe.columns)
    rejected = judged.where(F.col("__reason").isNotNull()).select(
        F.lit("input_validation").alias("source"),
        F.col("__raw").alias("underlying_raw"),
        F.col("__clean").alias("underlying_normalised"),
        *[
            (F.col("__reason") if c == "reason" else column_or(judged, c)).alias(c)
            for c in schemas.REJECTIONS[3:]
        ],
    )
    return valid, rejected


BUCKETS = ["unsupported", "kr", "rest", "rest_suspect"]


def no_event_bucket(df: DataFrame) -> Column:
    exists = F.coalesce(column_or(df, "exists_ticker").cast("string"), F.lit(""))
    underlying = F.coalesce(column_or(df, "underlying").cast("string"), F.lit(""))
    count = F.coalesce(vl.number(column_or(df, "candidate_count")), F.lit(0.0))
    only_ticker_dotted = exists.contains(".") & ~underlying.contains(".")
    return (
        F.when(exists == "UNSUPPORTED_YF", "unsupported")
        .when(exists.rlike(r"\.(?:KS|KQ)\b"), "kr")
        .when((count >= 2) | only_ticker_dotted, "rest_suspect")
        .otherwise("rest")
    )


def classify_no_events(df: DataFrame) -> DataFrame:
    out = df.withColumn("bucket", no_event_bucket(df))
    return out.withColumn("suspect_mapping", F.col("bucket") == "rest_suspect")


def no_event_buckets(df: DataFrame) -> dict[str, DataFrame]:
    """The bucket tables; ``rest`` includes the suspect rows."""
    classified = classify_no_events(df)
    out = {b: classified.where(F.col("bucket") == b) for b in BUCKETS}
    out["rest"] = classified.where(F.col("bucket").isin("rest", "rest_suspect"))
    return out


def bucket_counts(df: DataFrame) -> DataFrame:
    """Rows per bucket table; suspect rows count in two of them."""
    classified = classify_no_events(df)
    tables = F.when(F.col("suspect_mapping"), F.array(F.lit("rest"), F.lit("rest_suspect"))).otherwise(F.array("bucket"))
    return classified.select(F.explode(tables).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))


# --- tags and regions ------------------------------------------------------------------------

# Words of a file name that say nothing about the dataset.
NOISE_WORDS = ["HOLDINGS", "FULL", "MIN", "CSV", "DATA", "OUTPUT", "INPUT"]
REGIONS = ["EM", "DM"]


def dataset_tag(file_name: Column, known: list[str]) -> Column:
    """Tag from a file name: the one known fund in it, else the first telling word; null when unclear."""
    stem = F.regexp_replace(F.substring_index(file_name, "/", -1), r"\.[^.]*$", "")
    words = F.filter(F.split(F.upper(stem), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    hits = F.filter(words, lambda w: w.isin(known)) if known else F.array().cast("array<string>")
    telling = F.filter(words, lambda w: ~w.isin(NOISE_WORDS) & ~w.rlike(r"^\d{8}$"))
    return F.when(F.size(hits) == 1, F.try_element_at(hits, F.lit(1))).when(
        F.size(hits) == 0, F.try_element_at(telling, F.lit(1))
    )


def require_tags(df: DataFrame, tag: str = "holdings_tag") -> DataFrame:
    """Rows with a tag; an unclear one stops the job."""
    return df.withColumn(
        tag, F.coalesce(F.col(tag), F.raise_error(F.lit("no clear dataset tag in a file name")).cast("string"))
    )


def with_region(df: DataFrame, registry: DataFrame, tag: str = "holdings_tag", region: str | None = None) -> DataFrame:
    """``universe_region``: a valid stated one, else the fund's coverage, else null."""
    coverage = registry.select(F.col("symbol").alias("__symbol"), F.upper(tx.strip(F.col("default_coverage"))).alias("__cov"))
    # The registry is a fixed handful of funds.
    joined = df.withColumn("__symbol", F.upper(tx.strip(F.col(tag)))).join(coverage, "__symbol", "left")
    valid = lambda c: F.when(c.isin(REGIONS), c)
    stated = valid(F.upper(tx.strip(F.col(region)))) if region else F.lit(None).cast("string")
    return joined.withColumn("universe_region", F.coalesce(stated, valid(F.col("__cov")))).drop("__symbol", "__cov")
