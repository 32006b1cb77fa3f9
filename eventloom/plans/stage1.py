"""Stage 1: securities to observations, with ticker QA, gates and the resolution cache."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators import gates
from eventloom.operators import ingest as ig
from eventloom.operators import resolution_records as rr
from eventloom.operators import review as rv
from eventloom.operators import summary as sm
from eventloom.operators import ticker_qa as tq
from eventloom.operators import universe as un
from eventloom.sinks import tables as sinks


@dataclass(frozen=True)
class Stage1Options:
    window: ig.Window = ig.Window()
    asof: str | None = None
    source: str = "yfinance"
    tag_fail_on_unmatched: bool = False
    tag_single_fail_weight: float | None = None
    tag_total_fail_weight: float | None = None
    publish_partial: bool = False


@dataclass(frozen=True)
class Stage1Tables:
    observations: DataFrame
    errors: DataFrame
    no_events: DataFrame
    resolutions: DataFrame
    rejections: DataFrame
    universe: DataFrame

    def outputs(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in sm.TABLES}


def stage1(
    holdings: DataFrame, landing: ig.Landing, rules: DataFrame, chosen: DataFrame, options: Stage1Options = Stage1Options()
) -> Stage1Tables:
    """All dataset tags in one plan; ``holdings`` carry ``holdings_tag`` and ``holdings_file``."""
    optional = ["isin", "weight", "exchange", "country", "location", "coverage", "name", "chosen_ticker"]
    stamps = [c for c in ("holdings_tag", "holdings_file") if c in holdings.columns]
    universe = holdings.select(
        "underlying", "underlying_ccy", *[c for c in optional if c in holdings.columns], *stamps
    ).distinct()
    valid, rejected = un.split_universe(universe)
    got = ig.ingest(valid, landing, rules, chosen, options.window, options.source, options.asof)
    good, bad_numbers = ig.split_bad_numbers(got.observations)
    return Stage1Tables(
        observations=good,
        errors=got.errors.unionByName(bad_numbers, allowMissingColumns=True),
        no_events=got.no_events,
        resolutions=got.resolutions,
        rejections=rejected,
        universe=valid,
    )


def write(tables: Stage1Tables, root: str) -> None:
    for name, df in tables.outputs().items():
        sinks.write_by_tag(df, f"{root}/stage1/{name}", sinks.CONTRACTS[name])
    sinks.write_by_tag(tables.universe, f"{root}/stage1/universe")


def read(spark: SparkSession, root: str) -> Stage1Tables:
    load = lambda name: spark.read.parquet(f"{root}/stage1/{name}")
    return Stage1Tables(**{name: load(name) for name in sm.TABLES}, universe=load("universe"))


def run(
    spark: SparkSession,
    root: str,
    run_id: str,
    holdings: DataFrame,
    landing: ig.Landing,
    rules: DataFrame,
    overrides: DataFrame,
    cache: DataFrame,
    catalog_path: str | None = None,
    options: Stage1Options = Stage1Options(),
) -> DataFrame:
    """Write all tables, check the tag gates, and return the run's summary.

    Outputs are written once and every later step reads them back, so nothing is resolved twice.
    """
    started = dt.datetime.now(dt.timezone.utc)
    # The effective map has one record per key, so their order decides nothing.
    effective = rr.effective_map(rr.overrides(overrides), rr.cache(cache)).withColumn("row_no", F.lit(0))
    chosen = rr.chosen_map(effective)
    write(stage1(holdings, landing, rules, chosen, options), root)
    tables = read(spark, root)

    by = ["holdings_tag"]
    maps = tq.weight_maps(tables.universe, by)
    sinks.write_table(tq.ticker_report(tables.resolutions, maps=maps, by=by), f"{root}/stage1/ticker_report")
    report = spark.read.parquet(f"{root}/stage1/ticker_report")
    queue = rv.review_queue(tables.resolutions, maps=maps, by=by)
    sinks.write_table(queue, f"{root}/stage1/review_queue")
    sinks.write_table(tq.failed(report), f"{root}/stage1/ticker_failed_queue")
    sinks.write_table(tq.anomalies(report), f"{root}/stage1/ticker_anomaly_queue")
    sinks.write_json(
        sm.tag_qa_summary(report, spark.read.parquet(f"{root}/stage1/review_queue")), f"{root}/stage1/tag_qa_summary"
    )

    limits = (options.tag_fail_on_unmatched, options.tag_single_fail_weight, options.tag_total_fail_weight)
    if limits != (False, None, None):
        gates.require(gates.tag_gate(report, *limits), "ticker QA per tag")

    sinks.write_buckets(tables.no_events, f"{root}/stage1/no_event_buckets")
    asof = options.asof or options.window.end or started.strftime("%Y%m%d")
    updates = rr.cache_updates(tables.resolutions, asof.replace("-", ""), run_id, ("div_found",))
    sinks.write_table(rr.upsert_cache(rr.cache(cache), updates), f"{root}/stage1/resolution_cache")

    elapsed = (dt.datetime.now(dt.timezone.utc) - started).total_seconds()
    runs = tables.universe.select("holdings_tag").distinct().withColumns(
        {"failed": F.lit(False), "elapsed_seconds": F.lit(elapsed)}
    )
    summary = sm.stage1_summary(sm.rows_per_tag(tables.outputs()), runs)
    status = sm.run_status(F.col("failed_tag_count"), F.col("errors_rows"))
    sinks.write_json(summary.withColumn("status", status), f"{root}/_meta/stage1_summary")
    if catalog_path:
        entry = sm.catalog_entry(spark, run_id, root, dt.datetime.now(dt.timezone.utc), 0, options.publish_partial)
        sinks.append_row(entry, catalog_path)
    return spark.read.json(f"{root}/_meta/stage1_summary")


__all__ = ["Stage1Options", "Stage1Tables", "read", "run", "stage1", "write"]
