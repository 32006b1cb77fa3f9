"""Fund holdings: CSV files, landed JSON snapshots and the pages they are linked from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.functions import values as vl
from eventloom.operators.skew import CHUNK, split_by_heat
from eventloom.session import spread
from eventloom.sources.tables import read_table

# Symbols that are really currency rows.
CURRENCY_SYMBOLS = [
    "HKD", "KRW", "TWD", "INR", "JPY", "CNY", "CNH", "USD", "EUR", "BRL", "THB", "COP", "HUF",
    "MYR", "EGP", "ZAR", "SAR", "QAR", "KWD", "PLN", "TRY", "PHP", "CLP", "CZK", "MXN",
]
SYMBOL_PATTERN = r"^[0-9A-Za-z.\-_=]+$"
ISIN_PATTERN = r"^[A-Z]{2}[A-Z0-9]{9}[0-9]$"
MAX_SYMBOL_LENGTH = 32

# Header spellings of holdings files (lower case).
HEADERS = {
    "isin": ["isin", "isin_code", "isincode", "isin code"],
    "underlying": ["ticker", "symbol"],
    "underlying_ccy": ["ccy", "currency"],
    "country": ["country", "country_code", "country code"],
    "exchange": ["exchange", "exchange_code", "exchange code"],
    "location": ["location"],
    "coverage": ["coverage"],
}

# Funds known by symbol.
FUNDS = [
    ("EEM", "239637/ishares-msci-emerging-markets-etf", "EM", "Emerging Markets"),
    ("EFA", "239623/ishares-msci-eafe-etf", "DM", "Developed Markets"),
]
FUND_BASE_URL = "https://www.ishares.com/us/products"
SITE_URL = "https://www.ishares.com"

# Where a product page states its holdings link and date, in order of preference.
LINK_PATTERNS = [
    r"""(?i)(/us/products/\d+/[^"']+/\d+\.ajax\?tab=all(?:&amp;|&)fileType=json)""",
    r"""(?i)(/us/products/\d+/[^"']+/\d+\.ajax\?fileType=json(?:&amp;|&)tab=all)""",
]
DATE_PATTERNS = [
    r"\bas of\s+([A-Z][a-z]{2} \d{1,2}, \d{4})\b",
    r"\bAs of\s+([A-Z][a-z]{2} \d{1,2}, \d{4})\b",
    r'"asOfDate"\s*:\s*"([A-Z][a-z]{2} \d{1,2}, \d{4})"',
    r'"asOfDate"\s*:\s*"(\d{4}-\d{2}-\d{2})"',
]

# Cells of a snapshot row by position, and whether a cell is a number.
CELLS = [
    ("underlying", "Ticker", False),
    ("name", "Name", False),
    ("sector", "Sector", False),
    ("asset_class", "Asset Class", False),
    ("market_value", "Market Value", True),
    ("weight_pct", "Weight (%)", True),
    ("notional_value", "Notional Value", True),
    ("quantity", "Quantity", True),
    ("cusip", "CUSIP", False),
    ("isin", "ISIN", False),
    ("sedol", "SEDOL", False),
    ("price", "Price", True),
    ("country", "Location", False),
    ("exchange", "Exchange", False),
    ("currency", "Currency", False),
    ("fx_rate", "FX Rate", True),
    ("accrual_date", "Accrual Date", False),
]
HOLDING_COLUMNS = [
    "asof_date", "etf_symbol", "underlying", "name", "sector", "asset_class", "exchange", "country", "currency",
    "underlying_ccy", "isin", "sedol", "cusip", "weight_pct", "weight", "market_value", "notional_value", "quantity",
    "price", "fx_rate", "accrual_date",
]


# --- tabular holdings ------------------------------------------------------------------------


def rename_headers(df: DataFrame) -> DataFrame:
    df = df.withColumnsRenamed({c: c.strip() for c in df.columns})
    renames: dict[str, str] = {}
    for name in df.columns:
        for target, spellings in HEADERS.items():
            if name.lower() in spellings and target not in df.columns and target not in renames.values():
                renames[name] = target
    return df.withColumnsRenamed(renames)


def is_bad_symbol(c: Column) -> Column:
    return (
        (F.length(c) > MAX_SYMBOL_LENGTH)
        | ~c.rlike(SYMBOL_PATTERN)
        | (c == "")
        | (F.lower(c) == "nan")
        | F.upper(c).isin(CURRENCY_SYMBOLS)
    )


def clean_holdings(raw: DataFrame, include_zero_weight: bool = False) -> DataFrame:
    """Usable holdings: known headers, clean keys, no bad symbols, positive weight unless asked."""
    df = rename_headers(raw)
    missing = [c for c in ("underlying", "underlying_ccy") if c not in df.columns]
    if missing:
        raise ValueError(f"holdings need the columns {missing}")
    cols = {
        "underlying": tx.text_or_blank(F.col("underlying")),
        "underlying_ccy": F.upper(tx.text_or_blank(F.col("underlying_ccy"))),
        "weight": F.coalesce(vl.number(F.col("weight")), F.lit(0.0)) if "weight" in df.columns else F.lit(1.0),
    }
    if "isin" in df.columns:
        isin = tx.compact_id(tx.text_or_blank(F.col("isin")))
        cols["isin"] = F.when(isin.rlike(ISIN_PATTERN), isin).otherwise(F.lit(""))
    for name in ("country", "exchange", "location", "coverage"):
        if name in df.columns:
            cols[name] = tx.text_or_blank(F.col(name))
    out = df.withColumns(cols).where(~is_bad_symbol(F.col("underlying")))
    return out if include_zero_weight else out.where(F.col("weight") > 0)


def read_holdings(spark: SparkSession, path: str, include_zero_weight: bool = False) -> DataFrame:
    return clean_holdings(read_table(spark, path), include_zero_weight)


def project_universe(holdings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Distinct securities with the optional columns that are there."""
    optional = ["isin", "weight", "exchange", "country", "location", "coverage", *keep]
    return holdings.select("underlying", "underlying_ccy", *[c for c in optional if c in holdings.columns]).distinct()


# --- JSON snapshots --------------------------------------------------------------------------


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file: name, time and text."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
        F.regexp_extract("_metadata.file_name", r"_([^_.]+)\.[^.]+$", 1).alias("fund"),
        F.col("value").alias("content"),
    )


def latest_snapshots(files: DataFrame) -> DataFrame:
    """Newest file per fund: by the ``YYYYMMDD_`` prefix of its name, else by modification time."""
    named = vl.compact_day(F.regexp_extract("file_name", r"^(\d{8})_", 1)).cast("timestamp")
    when = F.coalesce(named, F.col("modified_at").cast("timestamp"))
    return files.groupBy("fund").agg(
        F.max_by("file_name", F.struct(when, F.col("file_name"))).alias("file_name"), F.max(when).alias("snapshot_at")
    )


def payload_problem(content: Column) -> Column:
    """Why a payload cannot be used, null when it can."""
    body = F.ltrim(F.regexp_replace(content, "^﻿", ""))
    tree = F.try_parse_json(body)
    rows = F.try_variant_get(tree, "$.aaData", "array<variant>")
    # Usable payloads come first and are parsed once; only the others are asked why.
    return (
        F.when(body.startswith("{") & rows.isNotNull(), F.lit(None).cast("string"))
        .when(F.coalesce(tx.strip(body), F.lit("")) == "", F.lit("empty"))
        .when(~F.substring(body, 1, 1).isin("{", "["), F.lit("not_json"))
        .when(tree.isNull(), F.lit("broken_json"))
        .when(body.startswith("["), F.lit("root_not_object"))
        .otherwise(F.lit("no_rows"))
    )


def validate_payloads(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected with ``problem``). Parsing is the work, so the texts are dealt over all cores first."""
    judged = spread(payloads).withColumn("problem", payload_problem(F.col("content")))
    return judged.where(F.col("problem").isNull()).drop("problem"), judged.where(F.col("problem").isNotNull())


def cell_text(cell: Column) -> Column:
    """Text of a cell: ``raw`` of an object, else its ``display``, else the scalar itself."""
    kind = F.schema_of_variant(cell)
    text = F.try_variant_get(cell, "$", "string")
    other = F.when(kind.rlike("[<, ]`?raw`?: "), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.try_variant_get(cell, "$.display", "string"), F.lit(""))
    )
    # The schema of a cell is costly, so only cells that print like an object without ``raw`` are asked for it.
    return (
        F.when(F.try_variant_get(cell, "$.raw", "variant").isNotNull(), F.try_variant_get(cell, "$.raw", "string"))
        .when(text.startswith("{") & kind.startswith("OBJECT"), other)
        .otherwise(text)
    )


def cell_number(text: Column) -> Column:
    return vl.holding_number(F.nullif(tx.holding_text(text), F.lit("")))


def asof_day(stated: Column, file_name: Column) -> Column:
    """Snapshot date: stated in the payload, else the file name's prefix."""
    return F.coalesce(vl.written_day(stated), vl.compact_day(F.regexp_extract(file_name, r"^(\d{8})_", 1)))


def snapshot_rows(payloads: DataFrame) -> DataFrame:
    """One row per snapshot row with its cells as text; short rows read as blanks.

    The root may be an object with ``aaData`` or the bare array.
    """
    tree = F.try_parse_json(F.regexp_replace("content", "^﻿", ""))
    df = payloads.select("fund", "file_name", tree.alias("tree"))
    rows = F.coalesce(
        F.try_variant_get("tree", "$.aaData", "array<variant>"), F.try_variant_get("tree", "$", "array<variant>")
    )
    stated = F.try_variant_get("tree", "$.asOfDate", "string")
    # Rows become texts before they are exploded: one small loop, and what filters the rows reads texts. The outer form
    # keeps Spark from testing the texts (and so making them) once more before the payloads are dealt.
    cells = lambda row: F.transform(F.slice(F.try_variant_get(row, "$", "array<variant>"), 1, len(CELLS)), cell_text)
    df = df.select("fund", asof_day(stated, F.col("file_name")).alias("asof"), F.transform(rows, cells).alias("rows"))
    df = df.select("fund", "asof", F.posexplode_outer("rows").alias("row_no", "row")).where(F.col("row").isNotNull())
    return df.select("fund", "asof", "row_no", *[F.get("row", F.lit(i)).alias(name) for i, (name, _, _) in enumerate(CELLS)])


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of every key. As an aggregate over whole rows, so a hot key is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return packed.select(*keys, "__row.*").select(*df.columns)


def normalise_snapshots(payloads: DataFrame) -> DataFrame:
    """Equity holdings in the holdings contract, first of each (fund, symbol, ISIN, weight)."""
    cells = snapshot_rows(payloads)
    numbers = {name: cell_number(F.col(name)) for name, _, is_number in CELLS if is_number}
    texts = {name: tx.holding_text(F.col(name)) for name, _, is_number in CELLS if not is_number}
    texts |= {c: tx.compact_id(texts[c]) for c in ("isin", "sedol", "cusip")}
    df = cells.withColumns(texts | numbers)
    df = df.where((F.lower("asset_class") == "equity") & (F.col("underlying") != ""))
    df = df.withColumns(
        {
            "asof_date": F.date_format("asof", "yyyyMMdd"),
            "etf_symbol": F.upper("fund"),
            "underlying_ccy": F.when(F.col("currency") == "", F.lit("USD")).otherwise(F.col("currency")),
            "weight": F.coalesce(F.col("weight_pct") / 100.0, F.lit(0.0)),
        }
    )
    df = first_per_key(df, ["etf_symbol", "asof_date", "underlying", "isin", "weight_pct"], ["row_no"])
    return df.select(*HOLDING_COLUMNS)


def read_snapshots(spark: SparkSession, path: str, fund: str | None = None, latest_only: bool = True) -> DataFrame:
    """Normalised holdings of landed JSON files, by default the newest file of every fund."""
    payloads = read_payloads(spark, path)
    if fund:
        payloads = payloads.where(F.col("fund") == fund)
    if latest_only:
        newest = latest_snapshots(payloads.drop("content")).select("fund", "file_name")
        payloads = payloads.join(newest, ["fund", "file_name"], "left_semi")
    return normalise_snapshots(payloads)


def flat_export(payloads: DataFrame) -> DataFrame:
    """All snapshot rows, whatever their asset class, under their printed column names."""
    number = lambda c: F.coalesce(vl.holding_number(F.nullif(tx.strip(c), F.lit(""))).cast("string"), F.lit(""))
    return snapshot_rows(payloads).select(
        "fund",
        "row_no",
        *[
            (number(F.col(name)) if is_number else tx.text_or_blank(F.col(name))).alias(title)
            for name, title, is_number in CELLS
        ],
    )


# Limits of the holdings check.
WEIGHT_SUM_TOLERANCE = 0.02
MAX_UNPARSED_RATIO = 0.02
MAX_NON_POSITIVE_RATIO = 0.20


def holdings_check(holdings: DataFrame, by: str = "etf_symbol") -> DataFrame:
    """Per fund: weight sum, unreadable and non-positive ratios, and whether each is out of bounds."""
    pct = F.col("weight_pct")
    df = holdings.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("weight").alias("weight_sum"),
        F.avg(pct.isNull().cast("double")).alias("unparsed_ratio"),
        F.avg((F.coalesce(pct, F.lit(0.0)) <= 0).cast("double")).alias("non_positive_ratio"),
        F.avg((tx.text_or_blank(F.col("isin")) == "").cast("double")).alias("blank_isin_ratio"),
    )
    return df.withColumns(
        {
            "bad_weight_sum": F.abs(F.col("weight_sum") - 1.0) > WEIGHT_SUM_TOLERANCE,
            "bad_unparsed": F.col("unparsed_ratio") > MAX_UNPARSED_RATIO,
            "bad_non_positive": F.col("non_positive_ratio") > MAX_NON_POSITIVE_RATIO,
        }
    )


def require_good_holdings(holdings: DataFrame, by: str = "etf_symbol") -> DataFrame:
    """The holdings, or an error that names the funds out of bounds."""
    bad = holdings_check(holdings, by).where("bad_weight_sum OR bad_unparsed OR bad_non_positive")
    listed = bad.orderBy(by).limit(20).collect()
    if listed:
        raise ValueError(f"holdings out of bounds: {[r.asDict() for r in listed]}")
    return holdings


# --- pages, versions, funds ------------------------------------------------------------------


def first_match(text: Column, patterns: list[str]) -> Column:
    """First group of the first pattern that matches, null if none does."""
    return F.coalesce(*[F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in patterns])


def discover_links(
    pages: DataFrame,
    link_patterns: list[str] = LINK_PATTERNS,
    date_patterns: list[str] = DATE_PATTERNS,
    site: str = SITE_URL,
) -> tuple[DataFrame, DataFrame]:
    """(found, rejected): the holdings link and date text of every fetched page."""
    link = F.replace(first_match(F.col("html"), link_patterns), F.lit("&amp;"), F.lit("&"))
    stated = first_match(F.col("html"), date_patterns)
    df = pages.withColumns({"link": F.concat(F.lit(site), link), "asof_text": stated}).drop("html")
    df = df.withColumns(
        {
            "asof": F.date_format(vl.written_day(F.col("asof_text")), "yyyyMMdd"),
            "problem": F.when(F.col("link").isNull(), "no_link").when(F.col("asof_text").isNull(), "no_date"),
        }
    )
    return df.where(F.col("problem").isNull()).drop("problem"), df.where(F.col("problem").isNotNull())


def version_log(landings: DataFrame, order: str = "seq") -> DataFrame:
    """Landings whose content differs from the one before, numbered per (fund, as-of).

    ``order`` is a unique column. Only hashes travel, and a much-landed fund is numbered in chunks.
    """
    hashed = landings.withColumn("content_hash", F.sha2(F.col("content").cast("binary"), 256)).drop("content")
    out = None
    for part, scan in split_by_heat(hashed, ["fund", "asof"], [order], size_of=landings):
        seen = scan.last_seen(part, {"__before": F.col("content_hash")})
        changed = ~F.col("content_hash").eqNullSafe(F.col("__before"))
        numbered = scan.running_sum(seen.withColumn("__changed", changed), "version", F.col("__changed").cast("int"))
        kept = numbered.where("__changed").drop("__changed", "__before", CHUNK)
        out = kept if out is None else out.unionByName(kept)
    return out


def fund_registry(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(FUNDS, "symbol string, product_path string, default_coverage string, region_tag string")
    return df.withColumn("product_url", F.concat(F.lit(FUND_BASE_URL + "/"), F.col("product_path")))


def fund_spec(symbol: str) -> dict[str, str]:
    """Registry entry of one fund; an unknown symbol is an error."""
    for entry in FUNDS:
        if entry[0] == str(symbol).strip().upper():
            return dict(zip(("symbol", "product_path", "default_coverage", "region_tag"), entry))
    raise ValueError(f"unknown fund {symbol!r}, known: {sorted(f[0] for f in FUNDS)}")


def with_fund_spec(df: DataFrame, registry: DataFrame, symbol: str = "fund") -> DataFrame:
    """Registry columns on rows; an unknown fund stops the job. How to join is left to the planner, which knows the sizes."""
    key = F.upper(tx.strip(F.col(symbol)))
    known = registry.withColumnRenamed("symbol", "__symbol").withColumn("__known", F.lit(True))
    joined = df.withColumn("__symbol", key).join(known, "__symbol", "left")
    checked = F.when(F.col("__known"), F.col("default_coverage")).otherwise(
        F.raise_error(F.concat(F.lit("unknown fund "), F.col("__symbol"))).cast("string")
    )
    return joined.withColumn("default_coverage", checked).drop("__symbol", "__known")
