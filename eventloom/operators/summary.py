"""Run summaries, link diagnostics and the run catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.operators import ticker_qa as tq

TABLES = ["observations", "errors", "no_events", "resolutions", "rejections"]


def rows_per_tag(tables: dict[str, DataFrame], tag: str = "holdings_tag") -> DataFrame:
    """(tag, kind, rows) over all output tables, in one job."""
    out = None
    for kind, df in tables.items():
        counted = df.groupBy(F.col(tag)).agg(F.count(F.lit(1)).alias("rows")).withColumn("kind", F.lit(kind))
        out = counted if out is None else out.unionByName(counted)
    return out.select(tag, "kind", "rows")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-blank value, by value."""
    value = tx.text_or_blank(F.col(column))
    counted = df.select(value.alias(column)).where(F.col(column) != "").groupBy(column)
    return counted.agg(F.count(F.lit(1)).alias("rows")).orderBy(column)


def stage1_summary(tag_counts: DataFrame, tag_runs: DataFrame, tag: str = "holdings_tag") -> DataFrame:
    """Counts, failures and timing per tag, and a total row with a null tag.

    ``tag_runs`` is (tag, failed, elapsed_seconds); a tag may have no rows at all.
    """
    wide = tag_counts.groupBy(tag).agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("rows"))), F.lit(0)).alias(f"{k}_rows") for k in TABLES]
    )
    counts = [f"{k}_rows" for k in TABLES]
    df = tag_runs.join(wide, tag, "left").fillna(0, counts)
    return df.rollup(tag).agg(
        *[F.sum(c).alias(c) for c in counts],
        F.count(F.lit(1)).alias("tag_count"),
        F.count(F.when(F.col("failed"), 1)).alias("failed_tag_count"),
        F.round(F.sum("elapsed_seconds"), 6).alias("total_elapsed_seconds"),
        F.round(F.max("elapsed_seconds"), 6).alias("max_elapsed_seconds"),
        F.round(F.avg("elapsed_seconds"), 6).alias("mean_elapsed_seconds"),
    )


def run_status(failed_tags: Column, error_rows: Column) -> Column:
    return F.when(failed_tags > 0, "partial_failure").when(error_rows > 0, "complete_with_review").otherwise("complete")


def tag_qa_summary(report: DataFrame, queue: DataFrame, tag: str = "holdings_tag") -> DataFrame:
    """Report, failed, anomaly and review rows per tag with rounded weights."""
    weights = ["failed_weight_sum", "anomaly_weight_sum", "max_failed_weight", "unmatched_failed_weight_sum"]
    measures = tq.materiality(report, [tag]).withColumns({c: F.round(c, 12) for c in weights})
    waiting = queue.groupBy(tag).agg(F.count(F.lit(1)).alias("review_queue_rows"))
    return measures.join(waiting, tag, "left").fillna(0, ["review_queue_rows"])


# --- link diagnostics ------------------------------------------------------------------------


def conflicting_vendor_ids(rows: DataFrame) -> DataFrame:
    """Vendor ids whose rows ended in more than one event."""
    return (
        rows.where(F.col("vendor_event_id").isNotNull())
        .groupBy("vendor_event_id")
        .agg(F.countDistinct("economic_event_id").alias("event_count"))
        .where(F.col("event_count") > 1)
    )


def conflict_sample(rows: DataFrame, ids: int = 10, limit: int = 50) -> DataFrame:
    shown = ["vendor_event_id", "underlying", "div_ccy", "ex_date", "amount", "economic_event_id"]
    first = conflicting_vendor_ids(rows).orderBy("vendor_event_id").limit(ids)
    out = rows.join(first, "vendor_event_id", "left_semi")
    return out.orderBy("row_idx").select(*[c for c in shown if c in rows.columns], "row_idx").limit(limit)


def set_difference(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of the distinct sets that only one side has, with the side."""
    pick = lambda df: df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns]).distinct()
    left, right = pick(a).withColumn("__a", F.lit(True)), pick(b).withColumn("__b", F.lit(True))
    both = left.join(right, columns, "full_outer")
    side = F.when(F.col("__b").isNull(), "first").when(F.col("__a").isNull(), "second")
    return both.withColumn("side", side).where(F.col("side").isNotNull()).select(*columns, "side")


def top_events(rows: DataFrame, by: str, n: int = 20) -> DataFrame:
    """Events with the most distinct amounts (``amounts``) or rows (``rows``)."""
    measure = F.countDistinct("amount") if by == "amounts" else F.count(F.lit(1))
    events = rows.where(tx.text_or_blank(F.col("economic_event_id")) != "").groupBy("economic_event_id")
    return events.agg(measure.alias(by)).orderBy(F.desc(by), "economic_event_id").limit(n)


# --- run catalog -----------------------------------------------------------------------------

CATALOG_SCHEMA = "run_id string, run_root string, finished_at timestamp, failed_tags int, published boolean"


def catalog_entry(
    spark: SparkSession, run_id: str, run_root: str, finished_at, failed_tags: int, publish_partial: bool = False
) -> DataFrame:
    """Catalog row of a run; it is published when no tag failed, or when partial runs may be."""
    published = failed_tags == 0 or publish_partial
    return spark.createDataFrame([(run_id, run_root, finished_at, failed_tags, published)], CATALOG_SCHEMA)


def latest_run(catalog: DataFrame) -> DataFrame:
    """The newest published run, else the newest run."""
    return catalog.agg(
        F.coalesce(
            F.max_by("run_root", F.when(F.col("published"), F.struct("finished_at", "run_id"))),
            F.max_by("run_root", F.struct("finished_at", "run_id")),
        ).alias("run_root")
    )


def resolve_run(catalog: DataFrame, run_root: str = "") -> str:
    found = run_root or latest_run(catalog).first()[0]
    if not found:
        raise FileNotFoundError("the run catalog is empty")
    return found
