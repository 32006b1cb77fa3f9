"""Region splits and country buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.operators.linking import column_or

# Country prefixes that are buckets of their own.
COUNTRY_BUCKETS = [
    "JP", "AU", "US", "KR", "BR", "IN", "TW", "HK", "GB", "FR",
    "DE", "CH", "SE", "CA", "NL", "IT", "ES", "BE", "SG",
]


def _upper(df: DataFrame, name: str) -> Column:
    return F.upper(tx.text_or_blank(column_or(df, name)))


def is_brazil(df: DataFrame) -> Column:
    return (
        _upper(df, "isin").startswith("BR")
        | (_upper(df, "div_ccy") == "BRL")
        | _upper(df, "underlying").endswith(".SA")
        | _upper(df, "yfinance_ticker").endswith(".SA")
    )


def is_korea(df: DataFrame) -> Column:
    suffixes = [".KS", ".KQ"]
    return (
        _upper(df, "isin").startswith("KR")
        | tx.ends_with_any(_upper(df, "yfinance_ticker"), suffixes)
        | tx.ends_with_any(_upper(df, "underlying"), suffixes)
    )


def region_split(df: DataFrame) -> dict[str, DataFrame]:
    """Brazil, everything else, and Korea (which overlaps the second)."""
    brazil = is_brazil(df)
    return {"brazil": df.where(brazil), "non_brazil": df.where(~brazil), "korea": df.where(is_korea(df))}


def country_bucket(isin: Column, ccy: Column) -> tuple[Column, Column]:
    """Bucket and the reason for it, from ISIN prefix and currency."""
    i = F.upper(tx.text_or_blank(isin))
    cc = F.when(F.length(i) >= 2, F.substring(i, 1, 2)).otherwise(F.lit(""))
    money = F.upper(tx.text_or_blank(ccy))
    own = cc.isin(COUNTRY_BUCKETS)
    china = cc == "CN"
    usd_pay = (cc != "") & (money == "USD")
    bucket = (
        F.when(own, cc)
        .when(china & (money == "HKD"), F.lit("HK_PROXY"))
        .when(china, F.lit("CN"))
        .when(usd_pay, F.concat(cc, F.lit("_USD_PAY")))
        .otherwise(F.lit("OTHER"))
    )
    reason = (
        F.when(own, F.concat(F.lit("ISIN="), cc))
        .when(china & (money == "HKD"), F.lit("ISIN=CN + CCY=HKD"))
        .when(china & money.isin("CNY", "CNH"), F.lit("ISIN=CN + CCY=CNY/CNH"))
        .when(china, F.lit("ISIN=CN"))
        .when(usd_pay, F.lit("non-US ISIN + USD div_ccy"))
        .otherwise(F.concat(F.lit("ISIN="), F.when(cc == "", F.lit("NA")).otherwise(cc)))
    )
    return bucket, reason
