"""Queries on holdings, snapshots, pages and universes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.checks.registry import Tables, query
from eventloom.functions import text as tx
from eventloom.functions import tickers as tk
from eventloom.functions import values as vl
from eventloom.operators import universe as un
from eventloom.session import checkpoint_folder
from eventloom.sinks import tables as sinks
from eventloom.sources import holdings as hd
from eventloom.sources import tables as st


def scratch(t: Tables, name: str) -> str:
    """A new folder below the shared one, for queries that read back what they wrote."""
    return f"{checkpoint_folder(t.spark)}/eventloom-{name}-{uuid.uuid4().hex}"


# --- tabular holdings ------------------------------------------------------------------------

CLEAN_HOLDINGS = """h0 AS (SELECT row_no, etf, trim(ticker) AS underlying, upper(trim(ccy)) AS underlying_ccy,
    upper(replace(trim(isin_code), ' ', '')) AS i0, coalesce(try_cast(weight AS DOUBLE), 0) AS weight, trim(country) AS country
  FROM v_holdings_raw),
h AS (SELECT *, CASE WHEN regexp_full_match(i0, '[A-Z]{2}[A-Z0-9]{9}[0-9]') THEN i0 ELSE '' END AS isin FROM h0
  WHERE NOT (length(underlying) > 32 OR NOT regexp_full_match(underlying, '[0-9A-Za-z.\\-_=]+') OR underlying = ''
    OR lower(underlying) = 'nan' OR upper(underlying) IN ('USD', 'KRW', 'BRL', 'HKD')))"""


def raw_holdings(t: Tables) -> DataFrame:
    return t.view("v_holdings_raw").withColumnsRenamed(
        {"ticker": "Ticker", "ccy": " CCY ", "isin_code": "ISIN Code", "country": "Country Code"}
    )


@query("src1_holdings", f"WITH {CLEAN_HOLDINGS} SELECT row_no, underlying, underlying_ccy, isin, weight, country FROM h WHERE weight > 0")
def _(t: Tables) -> DataFrame:
    return hd.clean_holdings(raw_holdings(t)).select("row_no", "underlying", "underlying_ccy", "isin", "weight", "country")


@query("src1_holdings_with_zero_weight", f"WITH {CLEAN_HOLDINGS} SELECT row_no, underlying, weight FROM h")
def _(t: Tables) -> DataFrame:
    return hd.clean_holdings(raw_holdings(t), include_zero_weight=True).select("row_no", "underlying", "weight")


@query(
    "src1_holdings_csv_round_trip",
    f"WITH {CLEAN_HOLDINGS} SELECT row_no, underlying, isin FROM h WHERE weight > 0",
)
def _(t: Tables) -> DataFrame:
    path = scratch(t, "holdings") + ".csv"
    sinks.export_csv(raw_holdings(t), path)
    return hd.read_holdings(t.spark, path).select(F.col("row_no").cast("bigint").alias("row_no"), "underlying", "isin")


@query(
    "prj6_bad_symbols",
    """SELECT row_no, length(s) > 32 OR NOT regexp_full_match(s, '[0-9A-Za-z.\\-_=]+') OR s = '' OR lower(s) = 'nan'
      OR upper(s) IN ('USD', 'KRW', 'BRL', 'HKD') AS is_bad FROM (SELECT row_no, trim(ticker) AS s FROM v_holdings_raw) h""",
)
def _(t: Tables) -> DataFrame:
    return t.view("v_holdings_raw").select("row_no", hd.is_bad_symbol(tx.text_or_blank(F.col("ticker"))).alias("is_bad"))


UNIVERSE = "SELECT DISTINCT underlying, underlying_ccy, isin, weight, country FROM h WHERE weight > 0"


@query("prj4_universe", f"WITH {CLEAN_HOLDINGS} {UNIVERSE}")
def _(t: Tables) -> DataFrame:
    return hd.project_universe(hd.clean_holdings(raw_holdings(t)))


@query("set3_distinct_universe", f"WITH {CLEAN_HOLDINGS} SELECT count(*) AS securities FROM ({UNIVERSE}) u")
def _(t: Tables) -> DataFrame:
    return hd.project_universe(hd.clean_holdings(raw_holdings(t))).agg(F.count("*").alias("securities"))


REASON = """CASE WHEN s = '' THEN 'blank_underlying' WHEN s IN ('-', '--', 'N/A', 'NA', 'NONE', 'NULL', 'NAN', '<NA>') THEN 'placeholder_underlying'
  WHEN NOT regexp_matches(s, '[A-Z0-9]') THEN 'non_symbol_underlying' WHEN NOT regexp_full_match(s, '[A-Z0-9.\\-_/]+') THEN 'invalid_underlying_format' END"""
NOISY = """(SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN ' ' WHEN 1 THEN 'n/a ' WHEN 2 THEN '...' WHEN 3 THEN 'a  b' WHEN 4 THEN 'br k/b'
  ELSE ' x' || cast(p_partkey AS string) || '.l ' END AS underlying, 'USD' AS underlying_ccy, 'EEM' AS holdings_tag FROM {part}) n"""


def noisy(t: Tables) -> DataFrame:
    return t.sql(f"SELECT * FROM {NOISY}", part=t.raw("part"))


NOISY_SQL = NOISY.replace("{part}", "part")


@query(
    "prj5_valid_universe",
    f"""WITH s AS (SELECT *, regexp_replace(upper(trim(underlying)), '\\s+', ' ', 'g') AS s FROM {NOISY_SQL})
    SELECT p_partkey, s AS underlying, underlying_ccy, holdings_tag FROM s WHERE {REASON} IS NULL""",
)
def _(t: Tables) -> DataFrame:
    return un.split_universe(noisy(t))[0]


@query(
    "prj5_rejected_universe",
    f"""WITH s AS (SELECT *, regexp_replace(upper(trim(underlying)), '\\s+', ' ', 'g') AS s FROM {NOISY_SQL})
    SELECT 'input_validation' AS source, underlying AS underlying_raw, s AS underlying_normalised, underlying_ccy, '' AS isin,
      {REASON} AS reason, holdings_tag, '' AS holdings_file FROM s WHERE {REASON} IS NOT NULL""",
)
def _(t: Tables) -> DataFrame:
    return un.split_universe(noisy(t))[1]


@query(
    "sc11_normalised_symbols",
    f"SELECT p_partkey, regexp_replace(upper(trim(underlying)), '\\s+', ' ', 'g') AS symbol FROM {NOISY_SQL}",
)
def _(t: Tables) -> DataFrame:
    return noisy(t).select("p_partkey", tx.collapse_spaces_upper(F.col("underlying")).alias("symbol"))


# --- snapshots -------------------------------------------------------------------------------

# The snapshot text has three rows per part: an equity with mixed cells, a cash row, a short equity row.
USABLE = "p_partkey % 97 <> 0 AND p_partkey % 89 <> 0 AND p_partkey % 83 <> 0 AND p_partkey % 79 <> 0"
SNAPSHOT = f"""v AS (SELECT * FROM v_snapshots WHERE {USABLE}),
cells AS (SELECT fund, p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '20250203' ELSE substr(file_name, 1, 8) END AS asof_date,
    i AS row_no, json_extract(content, '$.aaData[' || i || ']') AS r FROM v, range(3) g(i)),
vals AS (SELECT *, json_extract_string(r, '$[0]') AS underlying, lower(json_extract_string(r, '$[3]')) AS ac,
    coalesce(try_cast(json_extract_string(r, '$[5].raw') AS DOUBLE), try_cast(json_extract_string(r, '$[5]') AS DOUBLE)) AS weight_pct,
    coalesce(try_cast(json_extract_string(r, '$[4].raw') AS DOUBLE),
      try_cast(replace(replace(json_extract_string(r, '$[4]'), '$', ''), ',', '') AS DOUBLE)) AS market_value,
    try_cast(replace(json_extract_string(r, '$[6]'), ',', '') AS DOUBLE) AS notional_value,
    try_cast(coalesce(json_extract_string(r, '$[11].display'), json_extract_string(r, '$[11]')) AS DOUBLE) AS price,
    upper(replace(coalesce(json_extract_string(r, '$[9]'), ''), ' ', '')) AS isin,
    coalesce(json_extract_string(r, '$[12]'), '') AS country,
    coalesce(nullif(json_extract_string(r, '$[14]'), ''), 'USD') AS underlying_ccy FROM cells)"""


@query(
    "src2_snapshot_holdings",
    f"""WITH {SNAPSHOT} SELECT DISTINCT asof_date, fund AS etf_symbol, underlying, isin, weight_pct, coalesce(weight_pct / 100, 0) AS weight,
      market_value, notional_value, price, country, underlying_ccy FROM vals WHERE ac = 'equity'""",
)
def _(t: Tables) -> DataFrame:
    return hd.normalise_snapshots(hd.validate_payloads(t.view("v_snapshots"))[0]).select(
        "asof_date", "etf_symbol", "underlying", "isin", "weight_pct", "weight", "market_value", "notional_value", "price",
        "country", "underlying_ccy",
    )


@query(
    "src3_latest_snapshot",
    """SELECT fund, max_by(file_name, (k, file_name)) AS file_name, cast(max(k) AS VARCHAR) AS snapshot_day FROM (
      SELECT 'F' || cast(o_custkey % 40 AS VARCHAR) AS fund, cast(o_orderdate AS DATE) AS k,
        CASE WHEN o_orderkey % 5 = 0 THEN 'latest' ELSE strftime(o_orderdate, '%Y%m%d') END || '_F' || cast(o_custkey % 40 AS VARCHAR) || '.json' AS file_name
      FROM orders) f GROUP BY fund""",
)
def _(t: Tables) -> DataFrame:
    fund = F.concat(F.lit("F"), (F.col("o_custkey") % 40).cast("string"))
    prefix = F.when(F.col("o_orderkey") % 5 == 0, "latest").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    files = t.raw("orders").select(
        fund.alias("fund"),
        F.concat(prefix, F.lit("_"), fund, F.lit(".json")).alias("file_name"),
        F.col("o_orderdate").alias("modified_at"),
    )
    out = hd.latest_snapshots(files)
    return out.select("fund", "file_name", F.col("snapshot_at").cast("date").cast("string").alias("snapshot_day"))


@query(
    "src4_asof_day",
    """SELECT o_orderkey, cast(CASE o_orderkey % 4 WHEN 2 THEN DATE '2024-05-06' WHEN 3 THEN NULL ELSE cast(o_orderdate AS DATE) END AS VARCHAR)
      AS asof FROM orders""",
)
def _(t: Tables) -> DataFrame:
    k = F.col("o_orderkey") % 4
    stated = F.when(k == 0, F.date_format("o_orderdate", "MMM d, yyyy")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
    name = F.when(k == 2, "20240506_EEM.json").otherwise("EEM.json")
    return t.raw("orders").select("o_orderkey", hd.asof_day(stated, name).cast("string").alias("asof"))


@query(
    "src5_validate_payloads",
    """SELECT p_partkey, CASE WHEN p_partkey % 97 = 0 THEN 'empty' WHEN p_partkey % 89 = 0 THEN 'not_json' WHEN p_partkey % 83 = 0 THEN 'broken_json'
      ELSE 'no_rows' END AS problem FROM part WHERE p_partkey % 97 = 0 OR p_partkey % 89 = 0 OR p_partkey % 83 = 0 OR p_partkey % 79 = 0""",
)
def _(t: Tables) -> DataFrame:
    return hd.validate_payloads(t.view("v_snapshots"))[1].select("p_partkey", "problem")


@query(
    "sc24_cell_values",
    f"""WITH {SNAPSHOT}, x AS (SELECT p_partkey, row_no, j AS cell_no, json_extract(r, '$[' || j || ']') AS c
      FROM (SELECT * FROM cells WHERE json_type(r) = 'ARRAY') a, unnest(range(CAST(json_array_length(r) AS BIGINT))) t(j))
    SELECT p_partkey, CAST(row_no AS INT) AS row_no, CAST(cell_no AS INT) AS cell_no,
      CASE WHEN json_type(c) = 'OBJECT' AND list_contains(json_keys(c), 'raw') THEN json_extract_string(c, '$.raw')
        WHEN json_type(c) = 'OBJECT' THEN coalesce(json_extract_string(c, '$.display'), '') ELSE json_extract_string(c, '$') END AS cell FROM x""",
)
def _(t: Tables) -> DataFrame:
    df = hd.validate_payloads(t.view("v_snapshots"))[0]
    rows = F.try_variant_get(F.try_parse_json("content"), "$.aaData", "array<variant>")
    rows = df.select("p_partkey", F.posexplode(rows).alias("row_no", "row"))
    cells = rows.select("p_partkey", "row_no", F.posexplode(F.try_variant_get("row", "$", "array<variant>")).alias("cell_no", "c"))
    return cells.select("p_partkey", "row_no", "cell_no", hd.cell_text(F.col("c")).alias("cell"))


CHECK = """SELECT etf AS etf_symbol, count(*) AS "rows", round(sum(coalesce(w, 0)), 6) AS weight_sum, round(avg(cast(w IS NULL AS INT)), 6) AS unparsed_ratio,
    round(avg(cast(coalesce(w, 0) <= 0 AS INT)), 6) AS non_positive_ratio, round(avg(cast(isin_code = 'not an isin' AS INT)), 6) AS blank_isin_ratio
  FROM (SELECT *, try_cast(weight AS DOUBLE) AS w FROM v_holdings_raw) h GROUP BY etf"""


def checked(t: Tables) -> DataFrame:
    w = F.col("weight").try_cast("double")
    isin = F.when(F.col("isin_code") == "not an isin", "").otherwise(F.col("isin_code"))
    df = t.view("v_holdings_raw").withColumns({"weight_pct": w, "isin": isin, "weight": F.coalesce(w, F.lit(0.0))})
    out = hd.holdings_check(df.withColumnRenamed("etf", "etf_symbol"))
    rounded = ["weight_sum", "unparsed_ratio", "non_positive_ratio", "blank_isin_ratio"]
    return out.withColumns({c: F.round(c, 6) for c in rounded})


@query(
    "agg10_holdings_check",
    f"""SELECT etf_symbol, "rows", weight_sum, unparsed_ratio, non_positive_ratio, abs(weight_sum - 1) > 0.02 AS bad_weight_sum,
      unparsed_ratio > 0.02 AS bad_unparsed, non_positive_ratio > 0.20 AS bad_non_positive FROM ({CHECK}) c""",
)
def _(t: Tables) -> DataFrame:
    return checked(t).drop("blank_isin_ratio")


@query("agg16_blank_isin_ratio", f"SELECT etf_symbol, blank_isin_ratio FROM ({CHECK}) c")
def _(t: Tables) -> DataFrame:
    return checked(t).select("etf_symbol", "blank_isin_ratio")


@query(
    "win6_first_per_key",
    """SELECT l_partkey, l_suppkey, arg_min(l_orderkey, l_orderkey * 10 + l_linenumber) AS l_orderkey,
      arg_min(l_quantity, l_orderkey * 10 + l_linenumber) AS l_quantity FROM lineitem GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    df = t.raw("lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")
    # Order key and line number are unique together but for generated repeats, so quantity decides last.
    df = df.groupBy("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("l_quantity"))
    out = hd.first_per_key(df, ["l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber"])
    return out.select("l_partkey", "l_suppkey", "l_orderkey", "l_quantity")


# --- pages, versions, funds ------------------------------------------------------------------


@query(
    "src6_discover_links",
    """SELECT page_id, 'https://site' || replace(coalesce(nullif(regexp_extract(html, 'href="(/[A-Z][a-z]+\\?[^"]*)"', 1), ''),
      nullif(regexp_extract(html, 'href="(/[^"]+)"', 1), '')), '&amp;', '&') AS link,
      coalesce(nullif(regexp_extract(html, '<time>([^<]+)</time>', 1), ''), nullif(regexp_extract(html, 'lang="([a-z]+)"', 1), '')) AS asof_text
    FROM pages WHERE regexp_matches(html, 'href="(/[^"]+)"') AND regexp_matches(html, '(<time>[^<]+</time>)|(lang="[a-z]+")')""",
)
def _(t: Tables) -> DataFrame:
    found, _ = hd.discover_links(
        t.raw("pages"),
        [r'href="(/[A-Z][a-z]+\?[^"]*)"', r'href="(/[^"]+)"'],
        [r"<time>([^<]+)</time>", r'lang="([a-z]+)"'],
        site="https://site",
    )
    return found.select("page_id", "link", "asof_text")


@query(
    "src6_rejected_pages",
    """SELECT problem, count(*) AS pages FROM (SELECT CASE WHEN NOT regexp_matches(html, '/us/products/\\d+/[^"'']+/\\d+\\.ajax') THEN 'no_link'
      ELSE 'no_date' END AS problem FROM pages) p GROUP BY problem""",
)
def _(t: Tables) -> DataFrame:
    _, rejected = hd.discover_links(t.raw("pages"))
    return rejected.groupBy("problem").agg(F.count("*").alias("pages"))


VERSIONS = """SELECT fund, "asof", o_orderkey AS seq, row_number() OVER (PARTITION BY fund, "asof" ORDER BY o_orderkey) AS version FROM (
    SELECT *, lag(content) OVER (PARTITION BY fund, "asof" ORDER BY o_orderkey) AS before FROM (
      SELECT 'F' || cast(o_custkey % 50 AS VARCHAR) AS fund, o_orderpriority AS "asof", o_orderkey, o_orderstatus AS content FROM orders) l) x
  WHERE before IS DISTINCT FROM content"""


def landings(t: Tables) -> DataFrame:
    return t.raw("orders").select(
        F.concat(F.lit("F"), (F.col("o_custkey") % 50).cast("string")).alias("fund"),
        F.col("o_orderpriority").alias("asof"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderstatus").alias("content"),
    )


@query("snk8_version_log", VERSIONS)
def _(t: Tables) -> DataFrame:
    return hd.version_log(landings(t)).select("fund", "asof", "seq", "version")


@query("snk8_append_if_changed", VERSIONS)
def _(t: Tables) -> DataFrame:
    path = scratch(t, "landing")
    rows = landings(t)
    last = rows.agg(F.max("seq")).first()[0] or 0
    # All landings in three batches; a batch holds several payloads of most funds.
    for batch in range(3):
        sinks.append_if_changed(rows.where(F.floor(F.col("seq") * 3 / (last + 1)) == batch), path)
    return t.spark.read.parquet(path).select("fund", "asof", "seq", "version")


@query(
    "src19_fund_registry",
    """SELECT o_orderkey, CASE o_orderkey % 2 WHEN 0 THEN 'EM' ELSE 'DM' END AS default_coverage,
      'https://www.ishares.com/us/products/' || CASE o_orderkey % 2 WHEN 0 THEN '239637/ishares-msci-emerging-markets-etf'
        ELSE '239623/ishares-msci-eafe-etf' END AS product_url FROM orders""",
)
def _(t: Tables) -> DataFrame:
    fund = F.when(F.col("o_orderkey") % 2 == 0, " eem").otherwise("EFA")
    df = t.raw("orders").select("o_orderkey", fund.alias("fund"))
    return hd.with_fund_spec(df, hd.fund_registry(t.spark)).select("o_orderkey", "default_coverage", "product_url")


@query(
    "snk10_flat_export",
    f"""WITH {SNAPSHOT} SELECT p_partkey, row_no, underlying AS "Ticker", json_extract_string(r, '$[3]') AS "Asset Class",
      coalesce(json_extract_string(r, '$[9]'), '') AS "ISIN", coalesce(json_extract_string(r, '$[14]'), '') AS "Currency" FROM vals""",
)
def _(t: Tables) -> DataFrame:
    # The part number stands in for the fund, so that every row can be told apart.
    payloads = hd.validate_payloads(t.view("v_snapshots"))[0].withColumn("fund", F.col("p_partkey"))
    path = scratch(t, "flat")
    sinks.export_csv(hd.flat_export(payloads), path)
    out = st.read_table(t.spark, path, "csv")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return out.select(
        F.col("fund").cast("bigint").alias("p_partkey"), F.col("row_no").cast("int").alias("row_no"), "Ticker", "Asset Class", blank("ISIN"), blank("Currency")
    )


# --- schema operators ------------------------------------------------------------------------


@query(
    "prj1_enforce_canonical",
    """SELECT trim(underlying) AS underlying, replace(upper(trim(isin)), ' ', '') AS isin, trim(source_event_key) AS source_event_key,
      CASE WHEN lower(trim(action_type)) IN ('cash_dividend', 'unknown', '') THEN lower(trim(action_type)) ELSE 'unknown' END AS action_type,
      CASE WHEN lower(trim(share_class)) IN ('common', 'preferred', '') THEN lower(trim(share_class)) ELSE 'unknown' END AS share_class,
      ex_date, amount, '' AS market, k AS confidence FROM v_obs""",
)
def _(t: Tables) -> DataFrame:
    out = schemas.enforce_canonical(t.view("v_obs").withColumn("confidence", F.col("k").cast("string")))
    return out.select(
        "underlying", "isin", "source_event_key", "action_type", "share_class", "ex_date", "amount", "market", "confidence"
    )




@query(
    "prj2_validate_literals",
    """SELECT row_idx, CASE WHEN s IN ('', 'common', 'preferred', 'class_a', 'class_b', 'unknown') THEN s ELSE 'unknown' END AS share_class,
      'unknown' AS action_type FROM (SELECT *, CASE WHEN k % 5 = 0 THEN 'class_a' WHEN k % 5 = 1 THEN 'golden' ELSE lower(trim(share_class)) END AS s
      FROM v_obs) o""",
)
def _(t: Tables) -> DataFrame:
    k = F.col("k") % 5
    s = F.when(k == 0, " Class_A").when(k == 1, "golden").otherwise(F.col("share_class"))
    out = schemas.validate_literals(t.view("v_obs").withColumn("share_class", s))
    return out.select("row_idx", "share_class", "action_type")


@query(
    "prj2_literal_violations",
    "SELECT count(*) AS action_type, count(*) FILTER (k % 5 = 1) AS share_class FROM v_obs",
)
def _(t: Tables) -> DataFrame:
    s = F.when(F.col("k") % 5 == 1, "golden").otherwise(F.col("share_class"))
    return schemas.literal_violations(t.view("v_obs").withColumn("share_class", s))


@query(
    "prj3_apply_aliases",
    "SELECT row_idx, underlying, isin, ex_date, pay_date, amount, div_ccy FROM v_obs",
)
def _(t: Tables) -> DataFrame:
    names = {"underlying": "Ticker", "isin": "I S I N", "ex_date": "ex", "pay_date": "Pay-Date", "amount": "Dividend Amount", "div_ccy": "DIV_CCY"}
    out = schemas.apply_aliases(t.view("v_obs").withColumnsRenamed(names))
    return out.select("row_idx", *names)


@query(
    "prj10_no_event_bucket",
    """SELECT row_idx, CASE WHEN exists_ticker = 'UNSUPPORTED_YF' THEN 'unsupported' WHEN regexp_matches(exists_ticker, '\\.(KS|KQ)\\b') THEN 'kr'
      WHEN coalesce(try_cast(candidate_count AS DOUBLE), 0) >= 2 OR (contains(exists_ticker, '.') AND NOT contains(underlying, '.')) THEN 'rest_suspect'
      ELSE 'rest' END AS bucket FROM v_no_events""",
)
def _(t: Tables) -> DataFrame:
    return un.classify_no_events(t.view("v_no_events")).select("row_idx", "bucket")


BUCKET_ROWS = """b AS (SELECT CASE WHEN exists_ticker = 'UNSUPPORTED_YF' THEN 'unsupported' WHEN regexp_matches(exists_ticker, '\\.(KS|KQ)\\b') THEN 'kr'
      WHEN coalesce(try_cast(candidate_count AS DOUBLE), 0) >= 2 OR (contains(exists_ticker, '.') AND NOT contains(underlying, '.')) THEN 'rest_suspect'
      ELSE 'rest' END AS bucket FROM v_no_events),
t AS (SELECT bucket FROM b UNION ALL SELECT 'rest' FROM b WHERE bucket = 'rest_suspect')"""


@query("agg14_bucket_counts", f'WITH {BUCKET_ROWS} SELECT bucket, count(*) AS "rows" FROM t GROUP BY bucket')
def _(t: Tables) -> DataFrame:
    return un.bucket_counts(t.view("v_no_events"))


@query("snk4_bucket_tables", f'WITH {BUCKET_ROWS} SELECT bucket AS bucket_table, count(*) AS "rows" FROM t GROUP BY bucket')
def _(t: Tables) -> DataFrame:
    path = scratch(t, "buckets")
    sinks.write_buckets(t.view("v_no_events"), path)
    return t.spark.read.parquet(path).groupBy("bucket_table").agg(F.count("*").alias("rows"))


@query(
    "prj28_dataset_tag",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'EEM' WHEN 1 THEN 'EFA' WHEN 2 THEN 'C' || cast(o_custkey AS VARCHAR) WHEN 3 THEN NULL ELSE 'X1' END AS tag
    FROM orders""",
)
def _(t: Tables) -> DataFrame:
    k, cust = F.col("o_orderkey") % 5, F.col("o_custkey").cast("string")
    name = (
        F.when(k == 0, F.concat(F.lit("/data/holdings_eem_"), cust, F.lit(".csv")))
        .when(k == 1, "20240101_EFA.full.csv")
        .when(k == 2, F.concat(F.lit("holdings-20240101-c"), cust, F.lit(".csv")))
        .when(k == 3, "EEM_EFA.csv")
        .otherwise("data_full_x1.csv")
    )
    return t.raw("orders").select("o_orderkey", un.dataset_tag(name, ["EEM", "EFA"]).alias("tag"))


@query(
    "prj29_region_for_tag",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'DM' WHEN o_orderkey % 3 = 0 THEN 'EM' WHEN o_orderkey % 3 = 1 THEN 'DM' END AS universe_region FROM orders""",
)
def _(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    tag = F.when(k % 3 == 0, "eem ").when(k % 3 == 1, "EFA").otherwise("XYZ")
    stated = F.when(k % 4 == 0, "dm").otherwise("??")
    df = t.raw("orders").select("o_orderkey", tag.alias("holdings_tag"), stated.alias("stated"))
    return un.with_region(df, hd.fund_registry(t.spark), region="stated").select("o_orderkey", "universe_region")


# --- generic readers and writers -------------------------------------------------------------

ORDER_OUT = "SELECT o_orderkey, o_orderstatus FROM orders"


@query("snk1_write_table", "SELECT '' AS note, o_orderkey, o_orderstatus, '' AS missing FROM orders")
def _(t: Tables) -> DataFrame:
    path = scratch(t, "table")
    sinks.write_table(t.raw("orders").select("o_orderstatus", "o_orderkey"), path, ["note", "o_orderkey", "missing"])
    return t.spark.read.parquet(path)


@query("snk1_export_csv", """SELECT o_orderkey, '["' || o_orderstatus || '", "' || o_orderpriority || '"]' AS listed FROM orders""")
def _(t: Tables) -> DataFrame:
    path = scratch(t, "csv")
    df = t.raw("orders").select("o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("listed"))
    sinks.export_csv(df, path)
    return st.read_table(t.spark, path, "csv").withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query(
    "snk2_tables_by_tag",
    """SELECT holdings_tag, count(*) AS "rows", count(DISTINCT holdings_file) AS files FROM v_securities GROUP BY holdings_tag""",
)
def _(t: Tables) -> DataFrame:
    path = scratch(t, "tags")
    sinks.write_by_tag(t.view("v_securities"), path)
    back = t.spark.read.parquet(path)
    return back.groupBy("holdings_tag").agg(F.count("*").alias("rows"), F.countDistinct("holdings_file").alias("files"))


@query(
    "snk3_aggregate_table",
    """SELECT source, underlying, amount, extra FROM (SELECT 'a' AS source, underlying, try_cast(amount AS DOUBLE) AS amount, NULL AS extra FROM v_obs
      UNION ALL SELECT 'b', underlying, NULL, isin FROM v_resolutions) u""",
)
def _(t: Tables) -> DataFrame:
    a = t.view("v_obs").select(F.lit("a").alias("source"), "underlying", F.col("amount").cast("string").alias("amount"))
    b = t.view("v_resolutions").select("underlying", F.lit("b").alias("source"), F.col("isin").alias("extra"))
    return sinks.union_tables([a, b], ["source", "underlying"])


@query(
    "set1_union_tags",
    "SELECT 'x' AS holdings_tag, o_orderkey, o_totalprice AS amount FROM orders UNION ALL SELECT 'y', l_orderkey, NULL FROM lineitem",
)
def _(t: Tables) -> DataFrame:
    x = t.raw("orders").select(F.lit("x").alias("holdings_tag"), "o_orderkey", F.col("o_totalprice").cast("string").alias("amount"))
    y = t.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.lit("y").alias("holdings_tag"), F.lit("bad").alias("amount"))
    return sinks.union_tables([x, y], ["holdings_tag", "o_orderkey"])


@query("src10_observations", "SELECT row_idx, underlying, amount FROM v_obs")
def _(t: Tables) -> DataFrame:
    root = scratch(t, "run")
    sinks.write_table(t.view("v_obs"), f"{root}/stage1/observations")
    return st.read_observations(t.spark, root).select("row_idx", "underlying", "amount")


@query("src11_read_or_empty", "SELECT count(*) AS found, 0 AS missing, 11 AS contract_columns FROM orders")
def _(t: Tables) -> DataFrame:
    empty = st.read_or_empty(t.spark, scratch(t, "absent"), schemas.NO_EVENTS)
    there = st.read_or_empty(t.spark, f"{t.folder}/orders.parquet", schemas.NO_EVENTS)
    counted = there.agg(F.count("*").alias("found")).crossJoin(empty.agg(F.count("*").alias("missing")))
    return counted.withColumn("contract_columns", F.lit(len(empty.columns)))


# --- scalar functions ------------------------------------------------------------------------

TEXTS = """(SELECT o_orderkey, CASE o_orderkey % 12 WHEN 0 THEN '' WHEN 1 THEN ' NaN ' WHEN 2 THEN 'none' WHEN 3 THEN 'NONE' WHEN 4 THEN '<NA>'
  WHEN 5 THEN '-' WHEN 6 THEN ' na' WHEN 7 THEN 'None' WHEN 8 THEN ' us 0' || cast(o_custkey AS string) || ' ' WHEN 9 THEN ' usd'
  WHEN 10 THEN 'Us0378331005' ELSE 'x y ' || o_orderpriority END AS s FROM {orders}) s"""
TEXTS_SQL = TEXTS.replace("{orders}", "orders")


def texts(t: Tables) -> DataFrame:
    return t.sql(f"SELECT * FROM {TEXTS}", orders=t.raw("orders"))


@query(
    "sc1_sc2_clean_text",
    f"""SELECT o_orderkey, CASE WHEN trim(s) NOT IN ('', 'NONE', 'NAN', '<NA>', 'None', 'nan') THEN upper(trim(s)) END AS link,
      CASE WHEN trim(s) IN ('<NA>', 'None', 'none', 'nan', 'NaN', 'NONE', 'NAN') THEN '' ELSE trim(s) END AS report,
      CASE WHEN upper(trim(s)) IN ('', 'NA', 'NAN', 'NONE', '<NA>', '-') THEN '' ELSE trim(s) END AS resolution,
      CASE WHEN lower(trim(s)) IN ('', 'nan', 'none', '<na>') THEN '' ELSE trim(s) END AS vendor,
      CASE WHEN lower(trim(s)) IN ('', 'nan', 'none', '<na>', '-') THEN '' ELSE trim(s) END AS holding FROM {TEXTS_SQL}""",
)
def _(t: Tables) -> DataFrame:
    s = F.col("s")
    return texts(t).select(
        "o_orderkey",
        tx.link_text(s).alias("link"),
        tx.report_text(s).alias("report"),
        tx.resolution_text(s).alias("resolution"),
        tx.vendor_text(s).alias("vendor"),
        tx.holding_text(s).alias("holding"),
    )


@query(
    "sc3_sc4_isin_and_currency",
    f"""SELECT o_orderkey, CASE WHEN upper(trim(s)) IN ('', 'NA', 'NAN', 'NONE', '<NA>', '-') THEN '' ELSE upper(replace(trim(s), ' ', '')) END AS isin,
      CASE WHEN length(trim(s)) = 3 AND upper(trim(s)) NOT IN ('NAN', 'NON') THEN upper(trim(s)) END AS ccy FROM {TEXTS_SQL}""",
)
def _(t: Tables) -> DataFrame:
    return texts(t).select("o_orderkey", tx.clean_isin(F.col("s")).alias("isin"), vl.currency(F.col("s")).alias("ccy"))


@query(
    "sc5_isin_shape",
    f"""SELECT o_orderkey, regexp_full_match(c, '[A-Z]{{2}}[A-Z0-9]{{9}}[0-9]') AS looks, CASE WHEN v AND regexp_matches(c, '^[A-Z]{{2}}') THEN substr(c, 1, 2) ELSE '' END AS soft,
      CASE WHEN regexp_full_match(c, '[A-Z]{{2}}[A-Z0-9]{{9}}[0-9]') THEN substr(c, 1, 2) ELSE '' END AS strict
    FROM (SELECT *, upper(replace(trim(s), ' ', '')) AS c, lower(trim(s)) NOT IN ('', 'nan', 'none', '<na>') AS v FROM {TEXTS_SQL}) q""",
)
def _(t: Tables) -> DataFrame:
    s = F.col("s")
    return texts(t).select(
        "o_orderkey", tk.looks_like_isin(s).alias("looks"), tk.soft_prefix(s).alias("soft"), tk.strict_prefix(s).alias("strict")
    )


SYMBOLS = """(SELECT p_partkey, p_name, CASE p_partkey % 7 WHEN 0 THEN cast(p_partkey AS string) || '.hk' WHEN 1 THEN 'a.b.' || cast(p_partkey AS string)
  WHEN 2 THEN '$ab *c' WHEN 3 THEN '' WHEN 4 THEN 'UNSUPPORTED_YF.X' WHEN 5 THEN cast(p_partkey AS string) ELSE 'ABCDE12.ZZ' END AS s FROM {part}) s"""
SYMBOLS_SQL = SYMBOLS.replace("{part}", "part")


def symbols(t: Tables) -> DataFrame:
    return t.sql(f"SELECT * FROM {SYMBOLS}", part=t.raw("part"))


@query(
    "sc6_sc7_ticker_parts",
    f"""SELECT p_partkey, upper(regexp_replace(s, '[\\s$*]', '', 'g')) AS key, CASE WHEN contains(s, '.') THEN regexp_extract(s, '[^.]*$') ELSE '' END AS suffix,
      regexp_replace(s, '\\.[^.]*$', '') AS base, CASE WHEN s LIKE 'UNSUPPORTED%' OR NOT contains(s, '.') THEN '' ELSE upper(regexp_extract(s, '[^.]*$')) END AS market,
      s <> '' AND NOT contains(s, '.') AS plain FROM {SYMBOLS_SQL}""",
)
def _(t: Tables) -> DataFrame:
    s = F.col("s")
    return symbols(t).select(
        "p_partkey",
        tk.ticker_key(s).alias("key"),
        tk.suffix(s).alias("suffix"),
        tk.base(s).alias("base"),
        tk.listing_market(s).alias("market"),
        tk.is_plain(s).alias("plain"),
    )


@query(
    "sc9_zero_fill",
    "SELECT p_partkey, CASE WHEN length(cast(p_partkey AS VARCHAR)) < 4 THEN lpad(cast(p_partkey AS VARCHAR), 4, '0') ELSE cast(p_partkey AS VARCHAR) END AS four, p_name AS word FROM part",
)
def _(t: Tables) -> DataFrame:
    return t.raw("part").select(
        "p_partkey", tk.zero_fill(F.col("p_partkey"), 4).alias("four"), tk.zero_fill(F.col("p_name"), 30).alias("word")
    )


@query(
    "sc12_tokens_and_suffixes",
    """SELECT o_orderkey, contains(o_orderpriority, 'URG') OR contains(o_orderpriority, 'LOW') AS has_token,
      o_orderpriority LIKE '%IUM' OR o_orderpriority LIKE '%HIGH' AS has_suffix FROM orders""",
)
def _(t: Tables) -> DataFrame:
    s = F.col("o_orderpriority")
    return t.raw("orders").select(
        "o_orderkey", tx.contains_any(s, ["URG", "LOW"]).alias("has_token"), tx.ends_with_any(s, ["IUM", "HIGH"]).alias("has_suffix")
    )


@query(
    "sc16_scale_amount",
    """SELECT l_orderkey, l_linenumber, round(l_quantity / CASE l_linenumber % 3 WHEN 0 THEN 100.0 WHEN 1 THEN 10000.0 ELSE 1.0 END, 8) AS scaled FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    n = F.col("l_linenumber") % 3
    unit = F.when(n == 0, "PCT ").when(n == 1, "bps")
    return t.raw("lineitem").select("l_orderkey", "l_linenumber", F.round(vl.scale_amount(F.col("l_quantity"), unit), 8).alias("scaled"))


@query(
    "sc17_parse_amount",
    """SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN 1000 + l_quantity WHEN 1 THEN l_quantity WHEN 2 THEN l_quantity * 10 END AS amount,
      CASE WHEN l_linenumber % 4 IN (0, 1) THEN 1000 * (1 - l_linenumber % 4) + l_quantity END AS holding FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    n, q = F.col("l_linenumber") % 4, F.col("l_quantity").cast("int").cast("string")
    two = F.lpad(q, 3, "0")
    s = (
        F.when(n == 0, F.concat(F.lit(" $1,"), two))
        .when(n == 1, F.concat(F.lit(""), q))
        .when(n == 2, F.concat(q, F.lit("e1 USD")))
        .otherwise("1.2.3")
    )
    holding = F.when(n < 2, vl.holding_number(s))
    return t.raw("lineitem").select("l_orderkey", "l_linenumber", vl.parse_amount(s).alias("amount"), holding.alias("holding"))


@query(
    "sc18_sc19_dates",
    """SELECT o_orderkey, cast(CASE WHEN o_orderkey % 3 = 0 THEN cast(o_orderdate AS DATE) END AS VARCHAR) AS parsed,
      CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y%m%d') ELSE '' END AS clean,
      cast(epoch(cast(o_orderdate AS DATE)) AS BIGINT) AS floor_s, cast(epoch(cast(o_orderdate AS DATE)) AS BIGINT) + 86400 AS ceil_s FROM orders""",
)
def _(t: Tables) -> DataFrame:
    k, d = F.col("o_orderkey") % 3, F.col("o_orderdate").cast("date")
    s = F.when(k == 0, F.date_format(d, "yyyyMMdd")).when(k == 1, F.date_format(d, "yyyy-MM-dd")).otherwise("20241399")
    return t.raw("orders").select(
        "o_orderkey",
        vl.compact_day(s).cast("string").alias("parsed"),
        vl.compact_day_or_blank(s).alias("clean"),
        vl.window_start_seconds(d).alias("floor_s"),
        vl.window_end_seconds(d).alias("ceil_s"),
    )


@query(
    "sc20_sc21_flags",
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN FALSE WHEN 3 THEN FALSE WHEN 4 THEN NULL ELSE TRUE END AS flag,
      CASE o_orderkey % 6 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 5 THEN TRUE END AS nullable FROM orders""",
)
def _(t: Tables) -> DataFrame:
    s = F.element_at(F.array(*[F.lit(x) for x in ("Yes ", "f", "", "<na>", "maybe", "1")]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return t.raw("orders").select("o_orderkey", tx.flag(s).alias("flag"), tx.nullable_flag(s).alias("nullable"))


@query(
    "sc27_sc28_numbers",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 12.0 WHEN 1 THEN 3.5 WHEN 4 THEN -2.0 END AS optional, CASE o_orderkey % 5 WHEN 0 THEN 12 WHEN 4 THEN -2 ELSE 0 END AS whole,
      CASE o_orderkey % 5 WHEN 0 THEN 12 WHEN 1 THEN 3 WHEN 4 THEN -2 ELSE 0 END AS cut FROM orders""",
)
def _(t: Tables) -> DataFrame:
    s = F.element_at(F.array(*[F.lit(x) for x in ("12", " 3.5", "nan", "x", "-2.0")]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return t.raw("orders").select(
        "o_orderkey", vl.optional_number(s).alias("optional"), tx.whole_number(s).alias("whole"), tx.truncated_number(s).alias("cut")
    )


@query(
    "sc29_effective_asof",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '2024-03-04' ELSE cast(cast(o_orderdate AS DATE) AS VARCHAR) END AS asof FROM orders",
)
def _(t: Tables) -> DataFrame:
    given = F.when(F.col("o_orderkey") % 2 == 0, " 2024-03-04")
    return t.raw("orders").select("o_orderkey", vl.effective_asof(given, F.col("o_orderdate")).alias("asof"))
