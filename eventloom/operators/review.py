"""Review queue of resolutions that need a person."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.operators import ticker_qa as tq
from eventloom.operators.linking import column_or
from eventloom.sources.holdings import first_per_key

REVIEW_COLUMNS = [
    "underlying", "underlying_ccy", "isin", "chosen_ticker", "candidate_market", "candidate_origin",
    "resolution_status", "review_reason", "review_tags_json", "review_tags_text", "resolution_reason",
    "resolution_method", "resolution_source", "candidate_count", "candidates_json", "guess_source",
    "canonical_exchange", "isin_prefix", "prefix_exchange_consistent", "exists_probe_symbol", "exists_probe_result",
    "weight", "weight_matched", "weight_match_method", "is_failed", "is_anomaly", "holdings_tag", "holdings_file",
    "source", "start", "end",
]
DEDUPE_KEY = ["underlying", "underlying_ccy", "isin", "chosen_ticker", "resolution_status", "review_tags_json"]

# Review reasons, most urgent first, and guess sources worth a look.
REASONS = ["hard_failure", "failed_weight_unmatched", "candidate_unverified", "anomaly_review"]
GUESS_ANOMALIES = ["country_fallback", "ccy_fallback"]
UNVERIFIED = "CANDIDATE_UNVERIFIED"


def review_tags(report: DataFrame, suspect: list[str], anomalies: bool = True) -> Column:
    """Ordered array of review tags."""
    status = tx.review_text(column_or(report, "resolution_status"), upper=True)
    guess = F.lower(tx.review_text(column_or(report, "guess_source")))
    unverified = status.isin(suspect)
    hard = status.isin([s for s in tq.FAILURE_STATUSES if s not in suspect])
    bad_prefix = F.coalesce(~F.col("prefix_exchange_consistent"), F.lit(False))
    odd_guess = guess.isin(GUESS_ANOMALIES)
    anomaly = F.col("is_anomaly") & (odd_guess | bad_prefix) if anomalies else F.lit(False)
    return F.array_distinct(
        F.array_compact(
            F.array(
                F.when(hard, F.lit("hard_failure")).when(unverified, F.lit("candidate_unverified")),
                F.when(F.col("is_failed") & ~F.col("weight_matched") & ~unverified, F.lit("failed_weight_unmatched")),
                F.when(anomaly, F.lit("anomaly_review")),
                F.when(anomaly & odd_guess, guess),
                F.when(anomaly & bad_prefix, F.lit("prefix_exchange_inconsistent")),
            )
        )
    )


def tags_json(tags: Column) -> Column:
    quoted = F.transform(tags, lambda t: F.concat(F.lit('"'), t, F.lit('"')))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def primary_reason(tags: Column) -> Column:
    return F.coalesce(*[F.when(F.array_contains(tags, r), F.lit(r)) for r in REASONS], F.lit(""))


def reason_rank(reason: Column) -> Column:
    out = F.lit(99)
    for rank, name in enumerate(REASONS):
        out = F.when(reason == name, F.lit(rank)).otherwise(out)
    return out


def review_queue(
    resolutions: DataFrame,
    universe: DataFrame | None = None,
    maps: DataFrame | None = None,
    suspect_statuses: tuple[str, ...] = ("candidate_unverified",),
    include_statuses: tuple[str, ...] = ("ticker_not_found", "candidate_unverified"),
    include_anomalies: bool = True,
    by: list[str] | None = None,
) -> DataFrame:
    """Rows to review, first of each duplicate. ``row_idx`` (or the content) decides which is first."""
    extras = [c for c in resolutions.columns if c not in REVIEW_COLUMNS and c not in tq.REPORT_COLUMNS]
    keep = [*extras, *[c for c in ("exists_probe_symbol", "exists_probe_result") if c in resolutions.columns]]
    report = tq.ticker_report(resolutions, universe, maps, by, keep=keep)
    suspect = [s.strip().upper() for s in suspect_statuses if s.strip()] + [UNVERIFIED]
    include = [s.strip().upper() for s in include_statuses if s.strip()]

    df = report.withColumn("__tags", review_tags(report, suspect, include_anomalies))
    status = tx.review_text(F.col("resolution_status"), upper=True)
    df = df.where((F.size("__tags") > 0) | status.isin(include))
    df = df.withColumns(
        {
            "review_tags_json": tags_json(F.col("__tags")),
            "review_tags_text": F.array_join("__tags", "|"),
            "review_reason": primary_reason(F.col("__tags")),
            "exists_probe_symbol": column_or(df, "exists_probe_symbol", None),
            "exists_probe_result": column_or(df, "exists_probe_result", None),
        }
    ).drop("__tags")
    extras = [c for c in extras if c not in ("exists_probe_symbol", "exists_probe_result")]
    df = df.select(*REVIEW_COLUMNS, *extras)
    order = ["row_idx"] if "row_idx" in df.columns else [c for c in df.columns if c not in DEDUPE_KEY]
    return first_per_key(df, DEDUPE_KEY, order)


def queue_order(queue: DataFrame) -> DataFrame:
    return queue.orderBy(reason_rank(F.col("review_reason")), F.desc("weight"), "underlying", "chosen_ticker")
