"""Stage 0: landed holdings snapshots to normalised holdings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventloom.sinks.tables import export_csv, write_table
from eventloom.sources import holdings as hd


def normalise(payloads: DataFrame, check: bool = True) -> tuple[DataFrame, DataFrame]:
    """(holdings, rejected payloads) of all landed funds in one job."""
    usable, rejected = hd.validate_payloads(payloads)
    out = hd.normalise_snapshots(usable)
    return (hd.require_good_holdings(out) if check else out), rejected


def run(spark: SparkSession, landing: str, out: str, fund: str | None = None, check: bool = True) -> DataFrame:
    """Read the newest snapshot of every fund (or one), check it and write the holdings table."""
    if fund:
        hd.fund_spec(fund)
    df = hd.read_snapshots(spark, landing, fund)
    write_table(df, out)
    written = spark.read.parquet(out)
    if check:
        hd.require_good_holdings(written)
    return written


def export(df: DataFrame, path: str) -> None:
    export_csv(df, path)
