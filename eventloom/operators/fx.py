"""Currency conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions import values as vl
from eventloom.sources.tables import with_row_no


def usd_rates(rates: DataFrame) -> DataFrame:
    """(ccy, usd_per_ccy) from either layout: ccy / usd_per_ccy, or from_ccy / to_ccy / rate.

    Bad codes and rates are dropped, and of several rates for one currency the last wins.
    """
    names = {c.lower(): c for c in rates.columns}
    if "row_no" not in names:
        rates = with_row_no(rates)
    order = F.col(names.get("row_no", "row_no"))
    if {"ccy", "usd_per_ccy"} <= names.keys():
        df = rates.select(
            vl.currency(F.col(names["ccy"])).alias("ccy"), vl.number(F.col(names["usd_per_ccy"])).alias("rate"), order
        )
    elif {"from_ccy", "to_ccy", "rate"} <= names.keys():
        df = rates.where(vl.currency(F.col(names["to_ccy"])) == "USD").select(
            vl.currency(F.col(names["from_ccy"])).alias("ccy"), vl.number(F.col(names["rate"])).alias("rate"), order
        )
    else:
        df = rates.select(F.lit(None).cast("string").alias("ccy"), F.lit(None).cast("double").alias("rate"), order)
    df = df.where(F.col("ccy").isNotNull() & F.col("rate").isNotNull())
    return df.groupBy("ccy").agg(F.max_by("rate", order).alias("usd_per_ccy"))


def add_usd_value(df: DataFrame, value: str, ccy: str, out: str, rates: DataFrame) -> DataFrame:
    """``out`` = value in USD: own value for USD rows, null when currency or rate is missing.

    ``__fx_ccy`` is dropped again; codes have three characters, so the rate table stays small.
    """
    code = vl.currency(F.col(ccy)) if ccy in df.columns else F.lit(None).cast("string")
    amount = vl.number_in(df, value)
    keyed = df.withColumns({"__fx_ccy": code, "__fx_value": amount})
    lookup = rates.select(F.col("ccy").alias("__fx_ccy"), F.col("usd_per_ccy").alias("__fx_rate"))
    joined = keyed.join(lookup, "__fx_ccy", "left")
    rate = F.when(F.col("__fx_ccy") == "USD", F.lit(1.0)).otherwise(F.col("__fx_rate"))
    return joined.withColumn(out, F.col("__fx_value") * rate).select(*df.columns, out)


def fx_diagnostics(converted: DataFrame, ccy: str, out: str, rates: DataFrame) -> DataFrame:
    """One row: totals of non-USD, unknown currency, unknown rate and converted rows."""
    code = vl.currency(F.col(ccy)) if ccy in converted.columns else F.lit(None).cast("string")
    lookup = rates.select(F.col("ccy").alias("__fx_ccy"), F.lit(True).alias("__known"))
    df = converted.withColumn("__fx_ccy", code).join(lookup, "__fx_ccy", "left")
    foreign = F.col("__fx_ccy").isNotNull() & (F.col("__fx_ccy") != "USD")
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count(F.when(foreign, 1)).alias("non_usd_rows"),
        F.count(F.when(F.col("__fx_ccy").isNull(), 1)).alias("missing_ccy_rows"),
        F.count(F.when(foreign & F.col("__known").isNull(), 1)).alias("missing_fx_rows"),
        F.count(F.col(out)).alias("converted_rows"),
    )
