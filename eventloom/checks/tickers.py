"""Queries on candidate resolution, ticker QA, review, cache and policy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.checks.linking import _numbered, sev_sql
from eventloom.checks.registry import Tables, query
from eventloom.checks.views import map_values, rules_values
from eventloom.functions import tickers as tk
from eventloom.operators import fx
from eventloom.operators import gates
from eventloom.operators import ingest as ig
from eventloom.operators import pairs as pr
from eventloom.operators import resolution_records as rr
from eventloom.operators import resolve as rs
from eventloom.operators import review as rv
from eventloom.operators import severity as sv
from eventloom.operators import summary as sm
from eventloom.operators import ticker_qa as tq
from eventloom.operators import venues as vn
from eventloom.operators.venue_policy import annotate_policy
from eventloom.session import cut_lineage
from eventloom.sources import decisions as sd
from eventloom.sources import vendor as vd

SUFFIXES = ", ".join(f"'{s}'" for s in vn.VENDOR_SUFFIXES)
NAME = (
    "replace(replace(replace(replace(regexp_replace(upper(trim({})), '\\s+', ' ', 'g'), '&', 'AND'), 'CO.', 'COMPANY'), 'LTD', 'LTD.'), '  ', ' ')"
)

# --- rules and guesses -----------------------------------------------------------------------

RULES = f"""rules AS (SELECT match_type, {NAME.format("match_value")} AS match_value, canonical_exchange, suffix, priority,
    suffix IN ({SUFFIXES}) AS known FROM {rules_values()})"""

# Securities under the names the guessing block expects; the ISIN is only used for its prefix.
GUESS = f"""{RULES},
sec AS (SELECT security_id, trim(underlying) AS sym, {NAME.format("exchange")} AS ex, regexp_replace(upper(trim(country)), '\\s+', ' ', 'g') AS country,
    upper(trim(underlying_ccy)) AS ccy, CASE WHEN regexp_matches(isin, '^[A-Z]{{2}}') THEN substr(isin, 1, 2) ELSE '' END AS prefix
  FROM {{source}}),
usable AS (SELECT *, regexp_full_match(sym, '[^.]+\\.[^.]*') AND upper(regexp_extract(sym, '[^.]*$')) IN ({SUFFIXES}) AS as_is FROM sec
  WHERE sym <> '' AND length(sym) <= 64 AND regexp_full_match(sym, '[0-9A-Za-z.\\-_=*]+')),
best AS (SELECT n.ex, coalesce(x.canonical_exchange, f.canonical_exchange) AS venue,
    CASE WHEN x.match_value IS NOT NULL THEN x.suffix ELSE f.suffix END AS suffix,
    CASE WHEN x.match_value IS NOT NULL THEN x.known ELSE coalesce(f.known, FALSE) END AS known
  FROM (SELECT DISTINCT ex FROM usable WHERE ex <> '') n
  LEFT JOIN (SELECT * FROM rules WHERE match_type = 'EXACT') x ON n.ex = x.match_value
  LEFT JOIN (SELECT n.ex AS fex, first(r.canonical_exchange ORDER BY priority, match_value) AS canonical_exchange,
      first(r.suffix ORDER BY priority, match_value) AS suffix, first(r.known ORDER BY priority, match_value) AS known
    FROM (SELECT DISTINCT ex FROM usable WHERE ex <> '') n JOIN rules r ON r.match_type = 'CONTAINS' AND contains(n.ex, r.match_value)
    GROUP BY 1) f ON n.ex = f.fex),
cs AS (SELECT * FROM {map_values(vn.COUNTRY_SUFFIXES, "c_country", "c_suffix")}),
ms AS (SELECT * FROM {map_values(vn.CURRENCY_SUFFIXES, "c_ccy", "m_suffix")}),
src AS (SELECT u.*, b.venue, b.suffix AS rule_suffix, CASE WHEN as_is THEN 'asis'
      WHEN country = 'RUSSIAN FEDERATION' OR u.ex IN ('STANDARD-CLASSICA-FORTS', 'STANDARD CLASSICA-FORTS') OR prefix = 'RU' THEN NULL
      WHEN b.known THEN 'exchange_rule' WHEN country IN (SELECT c_country FROM cs) THEN 'country_fallback'
      WHEN ccy IN (SELECT c_ccy FROM ms) THEN 'ccy_fallback' END AS guess_source
  FROM usable u LEFT JOIN best b ON u.ex = b.ex),
sfx AS (SELECT *, 0 AS ordinal, CASE WHEN guess_source = 'asis' THEN '' ELSE rule_suffix END AS sfx FROM src WHERE guess_source IN ('asis', 'exchange_rule')
  UNION ALL SELECT src.*, pos, c_suffix FROM src JOIN cs ON country = c_country WHERE guess_source = 'country_fallback'
  UNION ALL SELECT src.*, pos, m_suffix FROM src JOIN ms ON ccy = c_ccy WHERE guess_source = 'ccy_fallback'),
bare AS (SELECT *, CASE WHEN NOT as_is AND regexp_full_match(sym, '[0-9A-Za-z*]+\\.[A-Za-z]{{1,4}}') THEN split_part(sym, '.', 1) ELSE sym END AS b FROM sfx),
padded AS (SELECT *, CASE WHEN regexp_full_match(b, '[0-9]+') AND sfx IN ('HK', 'TW', 'TWO', 'T', 'SR') AND length(b) < 4 THEN lpad(b, 4, '0')
    WHEN regexp_full_match(b, '[0-9]+') AND sfx IN ('KS', 'KQ', 'SS', 'SZ') AND length(b) < 6 THEN lpad(b, 6, '0') ELSE b END AS p FROM bare),
pv AS (SELECT * FROM {map_values(vn.PREFIX_VENUES, "v_prefix", "v_venue")}),
guesses AS (SELECT security_id, ordinal, upper(regexp_replace(CASE WHEN as_is THEN sym WHEN sfx = '' THEN p ELSE p || '.' || sfx END, '[\\s$*]', '', 'g')) AS ticker,
    CASE WHEN as_is THEN 'ASIS' WHEN sfx = '' AND NOT contains(p, '.') THEN 'US' WHEN sfx = '' THEN regexp_extract(p, '[^.]*$') ELSE sfx END AS market, guess_source, prefix AS isin_prefix,
    CASE WHEN guess_source = 'exchange_rule' THEN venue ELSE '' END AS canonical_exchange,
    guess_source <> 'exchange_rule' OR prefix NOT IN (SELECT v_prefix FROM pv) OR EXISTS (SELECT 1 FROM pv WHERE v_prefix = prefix AND v_venue = venue)
      AS prefix_exchange_consistent
  FROM padded)"""


def guess_sql(source: str) -> str:
    return GUESS.replace("{source}", source)


def rules(t: Tables) -> DataFrame:
    return rs.exchange_rules(rs.default_rules(t.spark), check=False)


# Rule rows made from suppliers: every kind of defect, and names that repeat.
SUPPLIER_RULES = """(SELECT s_suppkey, CASE WHEN s_suppkey % 11 = 0 THEN 'starts' WHEN s_suppkey % 2 = 0 THEN 'exact' ELSE 'Contains ' END AS match_type,
  CASE WHEN s_suppkey % 13 = 0 THEN 'NA' WHEN s_suppkey % 17 = 0 THEN 'twice' ELSE s_name || ' & co. ltd' END AS match_value,
  CASE WHEN s_suppkey % 19 = 0 THEN '' ELSE 'x_' || cast(s_suppkey AS string) END AS canonical_exchange,
  CASE s_suppkey % 3 WHEN 0 THEN 'hk|zz|KS' WHEN 1 THEN '' ELSE 'MX' END AS suffixes,
  CASE WHEN s_suppkey % 23 = 0 THEN 'high' ELSE cast(s_suppkey % 5 AS string) END AS priority,
  CASE WHEN s_suppkey % 29 = 0 THEN 'maybe' WHEN s_suppkey % 7 = 0 THEN 'no' ELSE '1' END AS is_active, '' AS note FROM {supplier}) s"""
SUPPLIER_RULES_SQL = SUPPLIER_RULES.replace("{supplier}", "supplier")
TYPED_RULES = f"""tr AS (SELECT s_suppkey, upper(trim(match_type)) AS match_type, CASE WHEN match_value = 'NA' THEN '' ELSE {NAME.format("match_value")} END AS match_value,
    upper(canonical_exchange) AS canonical_exchange, CASE s_suppkey % 3 WHEN 0 THEN 'HK|KS' ELSE '' END AS suffixes,
    s_suppkey % 3 = 1 AS blank_suffix, try_cast(priority AS INT) AS priority,
    CASE is_active WHEN 'no' THEN FALSE WHEN '1' THEN TRUE END AS is_active FROM {SUPPLIER_RULES_SQL})"""


def supplier_rules(t: Tables) -> DataFrame:
    return t.sql(f"SELECT * FROM {SUPPLIER_RULES}", supplier=t.raw("supplier"))


@query(
    "src17_exchange_rules",
    f"""WITH {TYPED_RULES} SELECT match_type, match_value, canonical_exchange, suffixes, CASE WHEN s_suppkey % 3 = 0 THEN 2 WHEN blank_suffix THEN 1 ELSE 0 END AS n,
      priority FROM tr WHERE is_active""",
)
def _(t: Tables) -> DataFrame:
    out = rs.exchange_rules(supplier_rules(t), check=False)
    return out.select(
        "match_type", "match_value", "canonical_exchange", F.array_join("suffixes", "|").alias("suffixes"), F.size("suffixes").alias("n"), "priority"
    )


@query(
    "src17_rule_problems",
    f"""WITH {TYPED_RULES} SELECT match_value, CASE WHEN match_type NOT IN ('EXACT', 'CONTAINS') THEN 'match_type' WHEN match_value = '' THEN 'match_value'
      WHEN canonical_exchange = '' THEN 'canonical_exchange' WHEN priority IS NULL THEN 'priority' ELSE 'is_active' END AS problem FROM tr
      WHERE match_type NOT IN ('EXACT', 'CONTAINS') OR match_value = '' OR canonical_exchange = '' OR priority IS NULL OR is_active IS NULL
    UNION ALL SELECT match_value, 'duplicate' FROM tr WHERE match_type = 'EXACT' AND is_active GROUP BY match_value HAVING count(*) > 1""",
)
def _(t: Tables) -> DataFrame:
    return rs.rule_problems(supplier_rules(t))


@query(
    "jn10_exchange_rule_match",
    f"WITH {guess_sql('v_securities')}, n AS (SELECT security_id, {NAME.format('exchange')} AS ex FROM v_securities) "
    "SELECT n.security_id, coalesce(venue, '') AS rule_exchange, CASE WHEN known THEN suffix ELSE '' END AS rule_suffix FROM n LEFT JOIN best ON n.ex = best.ex",
)
def _(t: Tables) -> DataFrame:
    out = rs.match_exchange(t.view("v_securities"), rules(t))
    return out.select(
        "security_id", "rule_exchange", F.coalesce(F.array_join("rule_suffixes", "|"), F.lit("")).alias("rule_suffix")
    )


@query("sc8_names", f"SELECT security_id, {NAME.format('exchange')} AS exchange, regexp_replace(upper(trim(country)), '\\s+', ' ', 'g') AS country FROM v_securities")
def _(t: Tables) -> DataFrame:
    return t.view("v_securities").select(
        "security_id", rs.exchange_name(F.col("exchange")).alias("exchange"), rs.country_name(F.col("country")).alias("country")
    )


@query(
    "sc10_strip_local_suffix",
    f"""SELECT security_id, a AS is_ticker, CASE WHEN NOT a AND regexp_full_match(s, '[0-9A-Za-z*]+\\.[A-Za-z]{{1,4}}') THEN split_part(s, '.', 1) ELSE s END AS stripped
    FROM (SELECT security_id, trim(underlying) AS s, regexp_full_match(trim(underlying), '[^.]+\\.[^.]*') AND
      upper(regexp_extract(trim(underlying), '[^.]*$')) IN ({SUFFIXES}) AS a FROM v_securities) q""",
)
def _(t: Tables) -> DataFrame:
    s = F.col("underlying")
    return t.view("v_securities").select(
        "security_id", rs.looks_like_ticker(s).alias("is_ticker"), rs.strip_local_suffix(s).alias("stripped")
    )


@query(
    "prj36_unsupported_jurisdiction",
    """SELECT security_id, regexp_replace(upper(trim(country)), '\\s+', ' ', 'g') = 'RUSSIAN FEDERATION' OR isin LIKE 'RU%' AS unsupported FROM v_securities""",
)
def _(t: Tables) -> DataFrame:
    df = t.view("v_securities")
    return df.select("security_id", rs.unsupported_jurisdiction(df).alias("unsupported"))


@query("rep6_guess_tickers", f"WITH {guess_sql('v_securities')} SELECT * FROM guesses")
def _(t: Tables) -> DataFrame:
    out = rs.guess_tickers(t.solid("v_securities"), rules(t))
    return out.select(
        "security_id", "ordinal", "ticker", "market", "guess_source", "isin_prefix", "canonical_exchange", "prefix_exchange_consistent"
    )


@query(
    "jn11_suffix_fallback",
    f"WITH {guess_sql('v_securities')} SELECT guess_source, count(DISTINCT security_id) AS securities, count(*) AS candidates FROM guesses GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    out = rs.guess_tickers(t.solid("v_securities"), rules(t))
    return out.groupBy("guess_source").agg(F.countDistinct("security_id").alias("securities"), F.count("*").alias("candidates"))


@query(
    "jn12_prefix_tokens",
    f"""WITH pt AS (SELECT * FROM {map_values(vn.PREFIX_TOKENS, "p", "token")}),
    s AS (SELECT security_id, CASE WHEN regexp_matches(isin, '^[A-Z]{{2}}') THEN substr(isin, 1, 2) END AS pre,
      CASE p_size % 4 WHEN 0 THEN 'ns-bo' WHEN 1 THEN 'US NYSE' WHEN 2 THEN '' ELSE 'T.L' END AS ex
      FROM v_securities JOIN part ON security_id = cast(p_partkey AS VARCHAR))
    SELECT security_id, CASE WHEN pre IN (SELECT p FROM pt) AND ex <> '' THEN EXISTS (SELECT 1 FROM pt WHERE p = pre
      AND list_contains(regexp_extract_all(upper(ex), '[A-Z0-9]+'), token)) END AS consistent FROM s""",
)
def _(t: Tables) -> DataFrame:
    k = F.col("p_size") % 4
    ex = F.when(k == 0, "ns-bo").when(k == 1, "US NYSE").when(k == 2, "").otherwise("T.L")
    sizes = t.raw("part").select(F.col("p_partkey").cast("string").alias("security_id"), ex.alias("ex"))
    df = t.view("v_securities").join(sizes, "security_id")
    return rs.prefix_matches_tokens(df, F.col("isin"), "ex", "consistent").select("security_id", "consistent")


@query(
    "sc25_exchange_tokens",
    "SELECT o_orderkey, array_to_string(list_sort(list_distinct(regexp_extract_all(upper(o_orderpriority || '-x'), '[A-Z0-9]+'))), ',') AS tokens FROM orders",
)
def _(t: Tables) -> DataFrame:
    s = F.concat("o_orderpriority", F.lit("-x"))
    return t.raw("orders").select("o_orderkey", F.array_join(F.array_sort(tk.exchange_tokens(s)), ",").alias("tokens"))


# --- landed vendor payloads ------------------------------------------------------------------


@query(
    "src7_vendor_actions",
    "SELECT ticker, cast(ex_date AS VARCHAR) AS ex_date, amount FROM v_actions WHERE amount <> 0 AND ex_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'",
)
def _(t: Tables) -> DataFrame:
    lo, hi = F.lit("1996-01-01").cast("date"), F.lit("1998-12-31").cast("date")
    return vd.window_actions(t.view("v_actions"), lo, hi).withColumn("ex_date", F.col("ex_date").cast("string"))


@query(
    "src8_chart_events",
    """SELECT 'T' || cast(o_custkey AS VARCHAR) AS ticker, cast(cast(make_timestamp((1700000000 + o_orderkey * 86400) * 1000000) AS DATE) AS VARCHAR) AS ex_date,
      o_orderkey % 40 + 0.25 AS amount FROM orders WHERE o_orderkey % 13 <> 0
    UNION ALL SELECT 'T' || cast(o_custkey AS VARCHAR), cast(cast(make_timestamp((1600000000 + o_orderkey * 3600) * 1000000) AS DATE) AS VARCHAR),
      1000 + (o_orderkey % 10) * 10 + 0.5 FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 7 <> 0""",
)
def _(t: Tables) -> DataFrame:
    return vd.chart_events(t.view("v_chart")).withColumn("ex_date", F.col("ex_date").cast("string"))


SEARCH = """search AS (SELECT isin, 0 AS ordinal, split_part(content, '"', 6) AS raw, 'Bombay' AS market FROM v_search WHERE contains(content, '.bo"')
  UNION ALL SELECT isin, 1, regexp_extract(content, '\\{"symbol":"([0-9]+)\\$"', 1) || '$', 'NMS' FROM v_search WHERE contains(content, '"etf"')
  UNION ALL SELECT isin, 3, regexp_extract(content, '"(ZZ[0-9]+\\.SG)"', 1), 'UNK' FROM v_search),
found AS (SELECT isin, ordinal, upper(replace(raw, '$', '')) AS ticker, market, substr(isin, 1, 2) AS isin_prefix FROM search)"""


@query("src9_search_quotes", f"WITH {SEARCH} SELECT isin, ordinal, ticker, market, isin_prefix FROM found")
def _(t: Tables) -> DataFrame:
    return vd.search_candidates(t.view("v_search")).select("isin", "ordinal", "ticker", "market", "isin_prefix")


@query(
    "prj38_exists_signal",
    """SELECT 'Q' || cast(c_custkey AS VARCHAR) AS ticker, c_custkey % 5 = 0 OR (cast(c_custkey % 2 = 0 AS INT) + cast(c_custkey % 3 = 0 AS INT)
      + cast(c_custkey % 7 <> 0 AS INT)) >= 2 OR (cast(c_custkey % 4 = 0 AS INT) + cast(c_custkey % 11 = 0 AS INT)) >= 2 AS "exists" FROM customer""",
)
def _(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    text = lambda cond, v: F.when(cond, v).otherwise("")
    none = F.lit(None).cast("string")
    fast = F.struct(
        text(k % 2 == 0, "USD").alias("currency"),
        text(k % 3 == 0, "NMS").alias("exchange"),
        none.alias("quoteType"),
        F.lit("[]").alias("timezone"),
        F.when(k % 7 == 0, "0").otherwise("12.5").alias("lastPrice"),
        none.alias("previousClose"),
    )
    info = F.struct(
        text(k % 4 == 0, "X").alias("symbol"),
        text(k % 11 == 0, "Y").alias("exchange"),
        *[none.alias(n) for n in ("quoteType", "currency", "market")],
        F.lit("0.0").alias("regularMarketPrice"),
    )
    df = t.raw("customer").select(
        F.concat(F.lit("q$"), k.cast("string")).alias("ticker"),
        F.when(k % 5 == 0, 3).otherwise(0).alias("price_rows"),
        fast.alias("fast_info"),
        info.alias("info"),
    )
    return vd.exists_signal(df)


# --- SQL of records and maps ------------------------------------------------------------------

NULLISH = "('', 'NA', 'NAN', 'NONE', '<NA>', '-')"
RECORDS = """SELECT row_no, CASE WHEN upper(trim(underlying)) IN {n} THEN '' ELSE upper(trim(underlying)) END AS underlying, upper(trim(underlying_ccy)) AS underlying_ccy,
    CASE WHEN upper(trim(chosen_ticker)) IN {n} THEN '' ELSE upper(trim(chosen_ticker)) END AS chosen_ticker, reason,
    CASE WHEN upper(method) IN {n} THEN '' ELSE method END AS method, upper(replace(isin, ' ', '')) AS isin, exists_ns = 'true' AS exists_ns, FALSE AS exists_bo,
    upper(resolution_status) AS resolution_status, CASE WHEN regexp_full_match(first_seen_asof, '[0-9]{{8}}') THEN first_seen_asof ELSE '' END AS first_seen_asof
  FROM {source}"""


def records(name: str, source: str) -> str:
    return f"{name} AS (SELECT * FROM ({RECORDS.format(n=NULLISH, source=source)}) x WHERE underlying <> '' AND chosen_ticker <> '')"


def kept(name: str, source: str, last: bool, fields: str) -> str:
    pick = "arg_max" if last else "arg_min"
    cols = ", ".join(f"{pick}({c}, row_no) AS {c}" for c in fields.split(", "))
    return f"{name} AS (SELECT underlying, underlying_ccy, {cols} FROM {source} GROUP BY underlying, underlying_ccy)"


MAP_FIELDS = "chosen_ticker, reason, method, isin, exists_ns"
CACHE_FIELDS = f"{MAP_FIELDS}, resolution_status, first_seen_asof"


def effective_sql(override_view: str, cache_view: str) -> str:
    """Cache overlaid by overrides, as the table ``eff``."""
    return f"""{records('rn', override_view)}, {records('ro', cache_view)}, {kept('ov', 'rn', False, MAP_FIELDS)}, {kept('ca', 'ro', True, CACHE_FIELDS)},
eff AS (SELECT underlying, underlying_ccy, chosen_ticker, reason, method, isin FROM ov
  UNION ALL SELECT underlying, underlying_ccy, chosen_ticker, coalesce(nullif(reason, ''), 'cache'), coalesce(nullif(method, ''), 'cache'), isin FROM ca ANTI JOIN ov USING (underlying, underlying_ccy))"""


# --- candidates ------------------------------------------------------------------------------

EXISTING = "existing AS (SELECT DISTINCT ticker FROM v_existing WHERE is_there)"
CONTEXT = """plain AS (SELECT security_id, trim(underlying) AS underlying, CASE WHEN length(trim(underlying_ccy)) = 3 THEN upper(trim(underlying_ccy)) ELSE '' END AS underlying_ccy,
    upper(trim(isin)) AS isin, trim(country) AS country, trim(exchange) AS exchange, trim(chosen_ticker) AS own FROM v_securities
  WHERE trim(underlying) <> '' AND length(trim(underlying_ccy)) = 3)"""
# The chosen map goes before a row's own ticker; its ISIN stands in where the row has none.
MAPPED = f"""{CONTEXT}, {effective_sql("v_map_overrides", "v_map_cache")},
ctx AS (SELECT p.security_id, p.underlying, p.underlying_ccy, coalesce(nullif(p.isin, ''), e.isin, '') AS isin, p.country, p.exchange, coalesce(e.chosen_ticker, p.own) AS override,
    CASE WHEN e.chosen_ticker IS NOT NULL THEN 'chosen_map' WHEN p.own <> '' THEN 'row_override' ELSE '' END AS override_source,
    CASE WHEN e.chosen_ticker IS NOT NULL THEN coalesce(nullif(e.reason, ''), 'override') WHEN p.own <> '' THEN 'override' ELSE '' END AS override_reason
  FROM plain p LEFT JOIN eff e USING (underlying, underlying_ccy))"""
OPEN = "open_rows AS (SELECT * FROM ctx WHERE override = '')"
CANDIDATES = f"""{MAPPED}, {OPEN}, {SEARCH}, {EXISTING}, {guess_sql("open_rows")},
listed AS (
  SELECT security_id, 0 AS stage, 0 AS ordinal, upper(override) AS ticker, 'override' AS method, 'override' AS guess_source FROM ctx WHERE override <> '' AND override NOT LIKE 'UNSUPPORTED%'
  UNION ALL SELECT security_id, 1, f.ordinal, f.ticker, 'isin_search', 'isin_search' FROM open_rows JOIN found f USING (isin)
  UNION ALL SELECT security_id, 2, ordinal, ticker, 'heuristic', guess_source FROM guesses),
dd AS (SELECT l.*, e.ticker IS NOT NULL AS there FROM (SELECT *, row_number() OVER (PARTITION BY security_id, ticker ORDER BY stage, ordinal) AS dn FROM listed) l
  LEFT JOIN existing e ON l.ticker = e.ticker WHERE dn = 1),
pruned AS (SELECT * FROM (SELECT *, bool_or(ticker NOT LIKE '%.SG') OVER (PARTITION BY security_id) AS other FROM dd) x
  WHERE NOT (other AND regexp_full_match(ticker, '[A-Z]{{2}}[A-Z0-9]{{9}}[0-9]\\.SG'))),
ind AS (SELECT c.security_id, c.country, c.exchange, c.override, arg_min(p.ticker, stage * 100 + ordinal) FILTER (p.ticker LIKE '%.NS') AS ns,
    arg_min(p.ticker, stage * 100 + ordinal) FILTER (p.ticker LIKE '%.BO') AS bo, upper(c.country) = 'INDIA' OR upper(c.exchange) = 'NSE'
      OR contains(upper(c.exchange), 'BSE') OR contains(upper(c.exchange), 'INDIA') AS indian
  FROM ctx c LEFT JOIN pruned p USING (security_id) GROUP BY ALL),
india AS (SELECT *, CASE WHEN NOT indian OR ns IS NULL OR bo IS NULL THEN '' WHEN ns IN (SELECT ticker FROM existing) THEN 'india_ns_canonical'
    WHEN bo IN (SELECT ticker FROM existing) THEN 'india_bo_canonical' ELSE 'india_ns_default' END AS reason FROM ind),
settled AS (SELECT p.*, i.reason, i.country FROM pruned p JOIN india i USING (security_id)
  WHERE i.reason = '' OR (i.reason = 'india_bo_canonical' AND p.ticker = i.bo) OR (i.reason IN ('india_ns_canonical', 'india_ns_default') AND p.ticker = i.ns)),
pl AS (SELECT security_id, count(*) AS n, count(*) FILTER (NOT contains(ticker, '.')) AS np, bool_or(there) FILTER (NOT contains(ticker, '.')) AS ep,
    bool_or(there) FILTER (contains(ticker, '.')) AS el FROM settled GROUP BY 1),
final AS (SELECT s.security_id, s.stage, s.ordinal, s.ticker, s.method, s.guess_source, s.there,
    CASE WHEN pair AND ep AND NOT el THEN 'plain_over_local_canonical' WHEN pair AND el AND NOT ep THEN 'local_over_plain_canonical' ELSE s.reason END AS reason,
    s.reason AS india_reason
  FROM (SELECT settled.*, n = 2 AND np = 1 AND regexp_replace(upper(trim(country)), '\\s+', ' ', 'g') = upper(trim(country)) AND upper(country) IN ('ISRAEL', 'UNITED KINGDOM', 'UK', 'GREAT BRITAIN') AS pair, ep, el
    FROM settled JOIN pl USING (security_id)) s
  WHERE NOT pair OR (ep = el) OR (ep AND NOT contains(ticker, '.')) OR (el AND contains(ticker, '.')))"""


def existing(t: Tables) -> DataFrame:
    return t.view("v_existing").withColumnRenamed("is_there", "exists").groupBy("ticker").agg(F.bool_or("exists").alias("exists"))


def chosen_tickers(t: Tables) -> DataFrame:
    known = rr.effective_map(rr.overrides(t.view("v_map_overrides")), rr.cache(t.view("v_map_cache")))
    # One record a key, so their order does not matter.
    return rr.chosen_map(known.withColumn("row_no", F.lit(0)))


def securities(t: Tables) -> DataFrame:
    return cut_lineage(rs.with_row_isin(rs.attach_override(rs.security_context(t.solid("v_securities")), chosen_tickers(t))))


def resolved(t: Tables) -> DataFrame:
    df = securities(t).where(~rs.is_unsupported(F.col("override")))
    return cut_lineage(rs.resolve_candidates(df, vd.search_candidates(t.view("v_search")), rules(t), existing(t)))


@query(
    "rep7_resolve_candidates",
    f"""WITH {CANDIDATES} SELECT security_id, string_agg(ticker, ',' ORDER BY stage, ordinal) AS candidates,
      CASE WHEN any_value(method) = 'override' THEN any_value(override_reason) ELSE any_value(reason) END AS reason FROM final JOIN ctx USING (security_id) GROUP BY security_id""",
)
def _(t: Tables) -> DataFrame:
    df = resolved(t).where(F.size("candidates") > 0)
    return df.select("security_id", F.array_join(ig.tickers_of(F.col("candidates")), ",").alias("candidates"), "reason")


@query(
    "win7_india_arbitration",
    f"WITH {CANDIDATES} SELECT reason, count(*) AS securities FROM india WHERE reason <> '' GROUP BY reason",
)
def _(t: Tables) -> DataFrame:
    df = resolved(t).where(F.col("reason").startswith("india"))
    return df.groupBy("reason").agg(F.count("*").alias("securities"))


@query(
    "win8_plain_or_local",
    f"WITH {CANDIDATES} SELECT security_id, ticker, reason FROM final WHERE reason LIKE '%_canonical' AND reason NOT LIKE 'india%'",
)
def _(t: Tables) -> DataFrame:
    df = resolved(t).where(F.col("reason").isin("plain_over_local_canonical", "local_over_plain_canonical"))
    return df.select("security_id", F.col("candidates")[0]["ticker"].alias("ticker"), "reason")


@query(
    "win9_isin_alias_prune",
    f"""WITH a AS (SELECT security_id, isin || '.SG' AS ticker, 0 AS o FROM v_securities WHERE length(isin) = 12 UNION ALL SELECT security_id,
      'Q' || security_id || CASE WHEN length(underlying) % 2 = 0 THEN '.SG' ELSE '.L' END, 1 FROM v_securities WHERE length(security_id) % 2 = 1)
    SELECT security_id, string_agg(ticker, ',' ORDER BY o) AS kept FROM (SELECT *, bool_or(ticker NOT LIKE '%.SG') OVER (PARTITION BY security_id) AS other FROM a) x
    WHERE NOT (other AND regexp_full_match(ticker, '[A-Z]{{2}}[A-Z0-9]{{9}}[0-9]\\.SG')) GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    ending = F.when(F.length("underlying") % 2 == 0, ".SG").otherwise(".L")
    items = F.array_compact(
        F.array(
            F.when(F.length("isin") == 12, F.struct(F.concat("isin", F.lit(".SG")).alias("ticker"))),
            F.when(F.length("security_id") % 2 == 1, F.struct(F.concat(F.lit("Q"), "security_id", ending).alias("ticker"))),
        )
    )
    df = t.view("v_securities").withColumn("c", items)
    kept = F.array_join(ig.tickers_of(rs.drop_isin_alias(F.col("c"))), ",")
    return df.select("security_id", kept.alias("kept")).where(F.col("kept") != "")


@query(
    "prj31_security_context",
    f"WITH {CONTEXT} SELECT security_id, underlying, underlying_ccy, isin, country, exchange FROM plain",
)
def _(t: Tables) -> DataFrame:
    return rs.security_context(t.view("v_securities")).select("security_id", "underlying", "underlying_ccy", "isin", "country", "exchange")


# --- ingest ----------------------------------------------------------------------------------

WINDOW = ig.Window("19960101", "19991231")
PAYING = "paying AS (SELECT DISTINCT ticker FROM v_actions WHERE amount <> 0 AND ex_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31')"
RANK = """CASE WHEN method = 'override' THEN 0 WHEN method = 'isin_search' THEN 1 WHEN guess_source = 'exchange_rule' THEN 2 WHEN guess_source = 'country_fallback' THEN 3
  WHEN guess_source = 'ccy_fallback' THEN 4 ELSE 5 END"""
CHOSEN = f"""{CANDIDATES}, {PAYING},
per AS (SELECT c.security_id, c.override, c.override_source, c.underlying, c.underlying_ccy, c.isin, count(f.ticker) AS n, any_value(f.reason) AS reason, any_value(f.india_reason) AS ireason,
    arg_min(f.ticker, stage * 100 + ordinal) FILTER (f.ticker IN (SELECT ticker FROM paying)) AS paid,
    arg_min(f.ticker, stage * 100 + ordinal) AS first_ticker,
    first(f.ticker ORDER BY {RANK}, f.ticker) FILTER (there) AS probed, string_agg(f.ticker, ',' ORDER BY stage, ordinal) AS listed,
    string_agg('"' || f.ticker || '"', ', ' ORDER BY stage, ordinal) AS quoted
  FROM ctx c LEFT JOIN final f USING (security_id) WHERE c.override NOT LIKE 'UNSUPPORTED%' GROUP BY ALL),
ch AS (SELECT *, coalesce(paid, CASE WHEN override <> '' THEN upper(override) END, probed, first_ticker, '') AS chosen_ticker,
    coalesce(paid, probed, '') AS exists_ticker,
    CASE WHEN paid IS NOT NULL THEN 'div_found' WHEN probed IS NOT NULL THEN 'verified_exists_but_no_dividends' WHEN n > 0 THEN 'candidate_unverified'
      ELSE 'ticker_not_found' END AS resolution_status FROM per)"""


def landing(t: Tables) -> ig.Landing:
    return ig.Landing(vd.search_candidates(t.view("v_search")), existing(t), t.view("v_actions"))


def ingested(t: Tables) -> ig.Ingested:
    return ig.ingest(t.solid("v_securities"), landing(t), rules(t), chosen_tickers(t), WINDOW)


def chosen(t: Tables) -> DataFrame:
    lo, hi = WINDOW.start_day(), WINDOW.end_day()
    return cut_lineage(ig.choose(rs.choose_paying(resolved(t), vd.window_actions(t.view("v_actions"), lo, hi))))


@query("jn13_first_paying_candidate", f"WITH {CHOSEN} SELECT security_id, paid AS ticker FROM ch WHERE paid IS NOT NULL")
def _(t: Tables) -> DataFrame:
    return chosen(t).where("paid").select("security_id", F.col("pick.ticker").alias("ticker"))


@query("jn14_existence_probe", f"WITH {CHOSEN} SELECT security_id, probed AS ticker FROM ch WHERE paid IS NULL AND probed IS NOT NULL")
def _(t: Tables) -> DataFrame:
    return chosen(t).where("exists_any").select("security_id", F.col("exists_ticker").alias("ticker"))


@query("prj33_failure_choice", f"WITH {CHOSEN} SELECT security_id, chosen_ticker FROM ch WHERE paid IS NULL")
def _(t: Tables) -> DataFrame:
    return chosen(t).where("NOT paid").select("security_id", "chosen_ticker")


@query("prj30_resolution_status", f"WITH {CHOSEN} SELECT security_id, resolution_status FROM ch")
def _(t: Tables) -> DataFrame:
    return chosen(t).select("security_id", "resolution_status")


@query(
    "prj34_resolution_metadata",
    f"""WITH {CHOSEN}, c1 AS (SELECT ch.*, f.method, f.guess_source FROM ch LEFT JOIN final f ON ch.security_id = f.security_id AND ch.chosen_ticker = f.ticker)
    SELECT security_id, coalesce(guess_source, '') AS guess_source, CASE WHEN method = 'override' THEN override_source WHEN method IS NULL THEN '' ELSE 'auto_search' END AS origin,
      CASE WHEN contains(chosen_ticker, '.') THEN upper(regexp_extract(chosen_ticker, '[^.]*$')) ELSE '' END AS dotted_market FROM c1""",
)
def _(t: Tables) -> DataFrame:
    df = ig.with_metadata(chosen(t))
    dotted = F.when(F.col("chosen_ticker").contains("."), F.col("candidate_market")).otherwise("")
    return df.select("security_id", "guess_source", F.col("candidate_origin").alias("origin"), dotted.alias("dotted_market"))


@query(
    "prj35_resolution_rows",
    f"""WITH {CHOSEN} SELECT underlying, underlying_ccy, isin, chosen_ticker, resolution_status, n AS candidate_count, '[' || coalesce(quoted, '') || ']' AS candidates_json,
      exists_ticker, coalesce(probed IS NOT NULL AND paid IS NULL, FALSE) OR coalesce(ireason IN ('india_ns_canonical', 'india_bo_canonical'), FALSE) AS preverified_exists_any, '19960101' AS "start" FROM ch
    UNION ALL SELECT underlying, underlying_ccy, isin, override, 'unsupported_vendor', 1, '["' || override || '"]', override, FALSE, '19960101' FROM ctx WHERE override LIKE 'UNSUPPORTED%'""",
)
def _(t: Tables) -> DataFrame:
    return ingested(t).resolutions.select(
        "underlying", "underlying_ccy", "isin", "chosen_ticker", "resolution_status", "candidate_count", "candidates_json",
        "exists_ticker", "preverified_exists_any", "start",
    )


@query(
    "prj32_unsupported_override",
    f"WITH {MAPPED} SELECT underlying, underlying_ccy, override AS exists_ticker, 'unsupported_vendor' AS status, 1 AS candidate_count FROM ctx WHERE override LIKE 'UNSUPPORTED%'",
)
def _(t: Tables) -> DataFrame:
    df = securities(t).where(rs.is_unsupported(F.col("override")))
    return ig.unsupported_rows(df, "vendor", WINDOW)[1].select("underlying", "underlying_ccy", "exists_ticker", "status", "candidate_count")


@query(
    "rep8_no_event_rows",
    f"""WITH {CHOSEN} SELECT underlying, underlying_ccy, resolution_status AS status, exists_ticker, n AS candidate_count FROM ch
      WHERE resolution_status NOT IN ('div_found', 'ticker_not_found')
    UNION ALL SELECT underlying, underlying_ccy, 'unsupported_vendor', override, 1 FROM ctx WHERE override LIKE 'UNSUPPORTED%'""",
)
def _(t: Tables) -> DataFrame:
    return ingested(t).no_events.select("underlying", "underlying_ccy", "status", "exists_ticker", "candidate_count")


@query(
    "rep8_error_rows",
    f"WITH {CHOSEN} SELECT underlying, underlying_ccy, isin, 'ticker_not_found' AS error FROM ch WHERE resolution_status = 'ticker_not_found'",
)
def _(t: Tables) -> DataFrame:
    return ingested(t).errors.select("underlying", "underlying_ccy", "isin", "error")


@query(
    "prj8_observation_rows",
    f"""WITH {CHOSEN} SELECT c.underlying, c.isin, paid AS yfinance_ticker, paid || '|' || underlying_ccy || '|' || cast(a.ex_date AS VARCHAR) AS source_event_key,
      cast(a.ex_date AS VARCHAR) AS ex_date, a.amount, underlying_ccy AS amount_ccy, 35 AS confidence, 'cash_dividend' AS action_type, '1999-12-31' AS asof_date
    FROM ch c JOIN v_actions a ON c.paid = a.ticker WHERE a.amount <> 0 AND a.ex_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""",
)
def _(t: Tables) -> DataFrame:
    return ingested(t).observations.select(
        "underlying", "isin", "yfinance_ticker", "source_event_key", "ex_date", "amount", "amount_ccy", "confidence", "action_type", "asof_date"
    )


@query(
    "prj8_evidence",
    f"""WITH {CHOSEN} SELECT paid || '|' || underlying_ccy || '|' || cast(a.ex_date AS VARCHAR) AS source_event_key, n AS candidates, isin AS input_isin, count(*) AS "rows"
    FROM ch c JOIN v_actions a ON c.paid = a.ticker WHERE a.amount <> 0 AND a.ex_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    told = lambda path: F.get_json_object("evidence_json", path)
    return (
        ingested(t)
        .observations.groupBy(
            "source_event_key", told("$.candidates.count").cast("bigint").alias("candidates"), told("$.input_isin").alias("input_isin")
        )
        .agg(F.count("*").alias("rows"))
    )


@query(
    "agg13_status_counts",
    f"""WITH {CHOSEN}, s AS (SELECT resolution_status AS status FROM ch UNION ALL SELECT 'unsupported_vendor' FROM ctx WHERE override LIKE 'UNSUPPORTED%')
    SELECT status, count(*) AS "rows", list_position(['div_found', 'verified_exists_but_no_dividends', 'candidate_unverified', 'ticker_not_found', 'unsupported_vendor'], status) AS place
    FROM s GROUP BY status""",
)
def _(t: Tables) -> DataFrame:
    return ig.status_counts(ingested(t).resolutions)


@query(
    "jn15_override_lookup",
    """WITH m AS (SELECT upper(trim(underlying)) AS u, CASE WHEN length(trim(underlying_ccy)) = 3 THEN upper(trim(underlying_ccy)) END AS c,
        arg_max(trim(chosen_ticker), row_no) AS ticker FROM (SELECT 'u' || cast(o_custkey AS VARCHAR) AS underlying, 'usd' AS underlying_ccy,
        'M' || cast(o_orderkey AS VARCHAR) AS chosen_ticker, o_orderkey AS row_no FROM orders) x GROUP BY 1, 2)
    SELECT c_custkey, coalesce(m.ticker, CASE WHEN c_custkey % 5 = 0 THEN 'OWN' END) AS ticker,
      CASE WHEN m.ticker IS NOT NULL THEN 'chosen_map' WHEN c_custkey % 5 = 0 THEN 'row_override' END AS source
    FROM customer LEFT JOIN m ON 'U' || cast(c_custkey AS VARCHAR) = m.u""",
)
def _(t: Tables) -> DataFrame:
    raw = t.raw("orders").select(
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("underlying"),
        F.lit("usd").alias("underlying_ccy"),
        F.concat(F.lit("M"), F.col("o_orderkey").cast("string")).alias("chosen_ticker"),
        F.col("o_orderkey").alias("row_no"),
    )
    sec = t.raw("customer").select(
        "c_custkey",
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("underlying"),
        F.lit("USD").alias("underlying_ccy"),
        F.when(F.col("c_custkey") % 5 == 0, "OWN").otherwise("").alias("chosen_ticker"),
    )
    out = rs.attach_override(sec, rr.chosen_map(raw))
    return out.select("c_custkey", F.col("override.ticker").alias("ticker"), F.col("override.source").alias("source"))


BAD_NUMBERS = "(SELECT row_idx, underlying, CASE WHEN k % 9 = 0 THEN 'x' || cast(k AS string) WHEN k % 10 = 0 THEN '' ELSE cast(k AS string) END AS amount FROM {})"


@query(
    "prj7_good_numbers",
    f"SELECT row_idx, try_cast(amount AS DOUBLE) AS amount FROM {BAD_NUMBERS.format('v_obs')} b WHERE try_cast(amount AS DOUBLE) IS NOT NULL",
)
def _(t: Tables) -> DataFrame:
    df = t.sql(f"SELECT * FROM {BAD_NUMBERS.format('{v_obs}')}", v_obs=t.view("v_obs"))
    return ig.split_bad_numbers(df)[0].select("row_idx", "amount")


@query(
    "prj7_bad_numbers",
    f"""SELECT underlying, 'amount' AS bad_numeric_columns, '{{"amount":"' || amount || '"}}' AS bad_numeric_values_json, count(*) AS n FROM {BAD_NUMBERS.format('v_obs')} b
    WHERE try_cast(amount AS DOUBLE) IS NULL GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    df = t.sql(f"SELECT * FROM {BAD_NUMBERS.format('{v_obs}')}", v_obs=t.view("v_obs"))
    errors = ig.split_bad_numbers(df)[1]
    return errors.groupBy("underlying", "bad_numeric_columns", "bad_numeric_values_json").agg(F.count("*").alias("n"))


@query(
    "set2_append_errors",
    f"""WITH {CHOSEN} SELECT error, count(*) AS "rows" FROM (SELECT 'ticker_not_found' AS error FROM ch WHERE resolution_status = 'ticker_not_found'
      UNION ALL SELECT 'critical_numeric_contract_violation' FROM {BAD_NUMBERS.format('v_obs')} b WHERE try_cast(amount AS DOUBLE) IS NULL) e GROUP BY error""",
)
def _(t: Tables) -> DataFrame:
    df = t.sql(f"SELECT * FROM {BAD_NUMBERS.format('{v_obs}')}", v_obs=t.view("v_obs"))
    both = ingested(t).errors.unionByName(ig.split_bad_numbers(df)[1], allowMissingColumns=True)
    return sm.value_counts(both, "error")


# --- ticker report ---------------------------------------------------------------------------

CLEAN = "CASE WHEN trim({0}) IN ('<NA>', 'None', 'none', 'nan', 'NaN', 'NONE', 'NAN') THEN '' ELSE trim({0}) END"
REPORT = f"""p AS (SELECT row_idx, upper(trim(underlying)) AS underlying, upper(trim(underlying_ccy)) AS underlying_ccy, upper({CLEAN.format("isin")}) AS isin,
    {CLEAN.format("chosen_ticker")} AS chosen_ticker, upper(resolution_status) AS status, coalesce(nullif(resolution_reason, ''), reason) AS resolution_reason,
    candidates_json, cast(candidate_count AS BIGINT) AS candidate_count, exists_ticker, upper(guess_source) AS guess_source, holdings_tag,
    CASE upper(prefix_exchange_consistent) WHEN 'TRUE' THEN TRUE WHEN 'FALSE' THEN FALSE END AS consistent,
    preverified_exists_any = 'true' AS pre FROM v_resolutions),
fl AS (SELECT *, (chosen_ticker = '' OR status IN ('TICKER_NOT_FOUND', 'UNSUPPORTED_VENDOR', 'AMBIGUOUS', 'ERROR', 'CANDIDATE_UNVERIFIED', 'NOT_FOUND')
      OR (NOT (status IN ('SUCCESS', 'DIV_FOUND', 'MANUAL_OVERRIDE') AND exists_ticker <> '') AND exists_ticker = ''))
      AND NOT (status IN ('NO_DIVIDENDS_IN_WINDOW', 'VERIFIED_EXISTS_BUT_NO_DIVIDENDS') AND exists_ticker <> '') AS is_failed,
    coalesce(consistent = FALSE, FALSE) OR guess_source = 'CCY_FALLBACK' AS is_anomaly,
    list_transform(from_json(coalesce(nullif(candidates_json, ''), '[]'), '["VARCHAR"]'), lambda x: upper(trim(x))) AS c FROM p),
iss AS (SELECT *, CASE WHEN candidate_count <= 0 THEN 'other'
    WHEN candidate_count >= 2 AND len(list_filter(c, lambda x: regexp_full_match(x, '[A-Z]{{2}}[A-Z0-9]{{9}}[0-9]\\.SG'))) > 0 AND len(list_filter(c, lambda x: NOT x LIKE '%.SG')) > 0 THEN 'isin_sg_alias_pollution'
    WHEN candidate_count >= 2 AND len(list_filter(c, lambda x: x LIKE '%.NS')) > 0 AND len(list_filter(c, lambda x: x LIKE '%.BO')) > 0 THEN 'india_ns_bo_dual'
    WHEN candidate_count >= 2 AND len(list_filter(c, lambda x: NOT contains(x, '.'))) > 0 AND len(list_filter(c, lambda x: contains(x, '.'))) > 0 THEN 'plain_plus_local_alt'
    WHEN candidate_count >= 2 AND len(list_distinct(list_transform(list_filter(c, lambda x: contains(x, '.')), lambda x: regexp_extract(x, '[^.]*$')))) = 1 THEN 'same_venue_alias'
    WHEN candidate_count = 1 AND status = 'VERIFIED_EXISTS_BUT_NO_DIVIDENDS' THEN 'single_candidate_no_div' ELSE 'other' END AS mapping_issue_class FROM fl)"""
UNI = """uw AS (SELECT {by}underlying, underlying_ccy, upper(isin) AS isin, cast(weight AS DOUBLE) AS w FROM v_weights),
ex AS (SELECT {by}underlying, underlying_ccy, isin, sum(w) AS we FROM uw GROUP BY ALL),
fb AS (SELECT {by}underlying, underlying_ccy, sum(w) AS wf FROM uw GROUP BY ALL)"""
WEIGHTED = f"""{REPORT}, {UNI.format(by="")},
rep AS (SELECT iss.*, coalesce(we, wf, 0) AS weight, CASE WHEN we IS NOT NULL THEN 'exact_underlying_ccy_isin' WHEN wf IS NOT NULL THEN 'fallback_underlying_ccy'
    ELSE 'unmatched' END AS method FROM iss LEFT JOIN ex USING (underlying, underlying_ccy, isin) LEFT JOIN fb USING (underlying, underlying_ccy))"""


def res(t: Tables) -> DataFrame:
    return t.view("v_resolutions")


def report(t: Tables, by: list[str] | None = None) -> DataFrame:
    return tq.ticker_report(res(t), t.view("v_weights"), by=by, keep=["row_idx"])


@query(
    "prj18_normalise_resolutions",
    """WITH n AS (SELECT row_idx, upper(trim(underlying_ccy)) AS underlying_ccy, CASE WHEN isin = 'nan' THEN '' ELSE isin END AS isin,
      CASE WHEN chosen_ticker = 'None' THEN '' ELSE chosen_ticker END AS chosen_ticker, upper(resolution_status) AS resolution_status, upper(exists_ticker) AS exists_ticker,
      try_cast(candidate_count AS BIGINT) AS candidate_count, preverified_exists_any = 'true' AS preverified_exists_any FROM v_resolutions)
    SELECT row_idx, underlying_ccy, isin, chosen_ticker, resolution_status, exists_ticker, candidate_count, preverified_exists_any,
      upper(CASE WHEN exists_ticker <> '' THEN exists_ticker ELSE chosen_ticker END) AS exists_probe_symbol,
      CASE WHEN preverified_exists_any OR exists_ticker <> '' OR (resolution_status = 'VERIFIED_EXISTS_BUT_NO_DIVIDENDS' AND chosen_ticker <> '') THEN TRUE
        WHEN resolution_status IN ('TICKER_NOT_FOUND', 'UNSUPPORTED_VENDOR', 'CANDIDATE_UNVERIFIED') THEN FALSE END AS exists_probe_result FROM n""",
)
def _(t: Tables) -> DataFrame:
    out = rr.normalise_resolutions(res(t).drop("reason").withColumnRenamed("underlying_ccy", "ccy"), keep=["row_idx"])
    return out.select(
        "row_idx", "underlying_ccy", "isin", "chosen_ticker", "resolution_status", "exists_ticker", "candidate_count",
        "preverified_exists_any", "exists_probe_symbol", "exists_probe_result",
    )


@query(
    "prj19_prepare_report",
    f"""WITH {REPORT} SELECT row_idx, underlying, underlying_ccy, isin, chosen_ticker, status AS resolution_status, resolution_reason, guess_source, consistent AS prefix_exchange_consistent,
      CASE WHEN pre THEN upper(coalesce(nullif(exists_ticker, ''), chosen_ticker)) ELSE '' END AS preverified_exists_ticker, pre AND upper(coalesce(nullif(exists_ticker, ''), chosen_ticker)) LIKE '%.NS' AS exists_ns FROM p""",
)
def _(t: Tables) -> DataFrame:
    return tq.prepare_report(res(t)).select(
        "row_idx", "underlying", "underlying_ccy", "isin", "chosen_ticker", "resolution_status", "resolution_reason", "guess_source",
        "prefix_exchange_consistent", "preverified_exists_ticker", "exists_ns",
    )


@query("prj20_failure_mask", f"WITH {REPORT} SELECT row_idx, is_failed FROM fl")
def _(t: Tables) -> DataFrame:
    return tq.prepare_report(res(t)).select("row_idx", tq.is_failed().alias("is_failed"))


@query("prj21_anomaly_mask", f"WITH {REPORT} SELECT row_idx, is_anomaly FROM fl")
def _(t: Tables) -> DataFrame:
    return tq.prepare_report(res(t)).select("row_idx", tq.is_anomaly().alias("is_anomaly"))


@query("prj22_mapping_issue", f"WITH {REPORT} SELECT row_idx, mapping_issue_class FROM iss")
def _(t: Tables) -> DataFrame:
    return tq.with_mapping_issue(tq.prepare_report(res(t))).select("row_idx", "mapping_issue_class")


@query(
    "prj23_candidate_texts",
    f"""WITH {REPORT} SELECT row_idx, array_to_string(c, ' | ') AS candidate_list_pretty,
      array_to_string(list_transform(c, lambda x: CASE WHEN contains(x, '.') THEN regexp_extract(x, '[^.]*$') ELSE 'US/PLAIN' END), ',') AS candidate_suffixes FROM fl""",
)
def _(t: Tables) -> DataFrame:
    return tq.with_mapping_issue(tq.prepare_report(res(t))).select("row_idx", "candidate_list_pretty", "candidate_suffixes")


@query(
    "jn9_weight_maps",
    f"WITH {UNI.format(by='')} SELECT underlying, underlying_ccy, isin, round(we, 4) AS weight_exact, round(wf, 4) AS weight_fallback FROM ex JOIN fb USING (underlying, underlying_ccy)",
)
def _(t: Tables) -> DataFrame:
    out = tq.weight_maps(t.view("v_weights"))
    return out.withColumns({c: F.round(c, 4) for c in ("weight_exact", "weight_fallback")})


@query(
    "agg15_weight_sums",
    f"WITH {UNI.format(by='')} SELECT underlying, underlying_ccy, round(wf, 4) AS weight_fallback FROM fb",
)
def _(t: Tables) -> DataFrame:
    maps = tq.weight_maps(t.view("v_weights"))
    return maps.groupBy("underlying", "underlying_ccy").agg(F.round(F.max("weight_fallback"), 4).alias("weight_fallback"))


@query("jn8_attach_weights", f"WITH {WEIGHTED} SELECT row_idx, round(weight, 4) AS weight, method AS weight_match_method, method <> 'unmatched' AS weight_matched FROM rep")
def _(t: Tables) -> DataFrame:
    out = tq.attach_weights(tq.prepare_report(res(t)), tq.weight_maps(t.view("v_weights")))
    return out.select("row_idx", F.round("weight", 4).alias("weight"), "weight_match_method", "weight_matched")


@query(
    "rep1_ticker_report",
    f"""WITH {WEIGHTED} SELECT row_idx, underlying, chosen_ticker, status AS resolution_status, is_failed, is_anomaly, mapping_issue_class, round(weight, 4) AS weight,
      method AS weight_match_method, candidate_count, holdings_tag FROM rep""",
)
def _(t: Tables) -> DataFrame:
    return report(t).select(
        "row_idx", "underlying", "chosen_ticker", "resolution_status", "is_failed", "is_anomaly", "mapping_issue_class",
        F.round("weight", 4).alias("weight"), "weight_match_method", "candidate_count", "holdings_tag",
    )


@query("rep2_failed_tickers", f"WITH {WEIGHTED} SELECT row_idx, chosen_ticker FROM rep WHERE is_failed")
def _(t: Tables) -> DataFrame:
    return tq.failed(report(t)).select("row_idx", "chosen_ticker")


@query("rep2_anomaly_tickers", f"WITH {WEIGHTED} SELECT row_idx, chosen_ticker FROM rep WHERE is_anomaly")
def _(t: Tables) -> DataFrame:
    return tq.anomalies(report(t)).select("row_idx", "chosen_ticker")


MEASURES = """count(*) AS report_rows, count(*) FILTER (is_failed) AS failed_rows, count(*) FILTER (is_anomaly) AS anomaly_rows,
  round(coalesce(sum(weight) FILTER (is_failed), 0), 4) AS failed_weight_sum, round(coalesce(sum(weight) FILTER (is_anomaly), 0), 4) AS anomaly_weight_sum,
  round(coalesce(max(weight) FILTER (is_failed), 0), 4) AS max_failed_weight, count(*) FILTER (is_failed AND method = 'unmatched') AS unmatched_failed_count,
  round(coalesce(sum(weight) FILTER (is_failed AND method = 'unmatched'), 0), 4) AS unmatched_failed_weight_sum"""
WEIGHT_COLUMNS = ["failed_weight_sum", "anomaly_weight_sum", "max_failed_weight", "unmatched_failed_weight_sum"]


def rounded(df: DataFrame, columns: list[str] = WEIGHT_COLUMNS) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


@query("agg7_materiality", f"WITH {WEIGHTED} SELECT {MEASURES} FROM rep")
def _(t: Tables) -> DataFrame:
    return rounded(tq.materiality(report(t)))


@query("rep3_materiality_by_tag", f"WITH {WEIGHTED} SELECT holdings_tag, {MEASURES} FROM rep GROUP BY holdings_tag")
def _(t: Tables) -> DataFrame:
    return rounded(tq.materiality(report(t), ["holdings_tag"]))


@query(
    "agg8_weight_diagnostics",
    f"""WITH {WEIGHTED}, d AS (SELECT count(*) AS report_rows, count(*) FILTER (method LIKE 'exact%') AS exact_match_rows, count(*) FILTER (method LIKE 'fallback%') AS fallback_match_rows,
      count(*) FILTER (method = 'unmatched') AS unmatched_rows, round(coalesce(sum(weight) FILTER (method LIKE 'exact%'), 0), 4) AS exact_weight_sum,
      round(coalesce(sum(weight) FILTER (method LIKE 'fallback%'), 0), 4) AS fallback_weight_sum, 0 AS unmatched_weight_sum,
      count(DISTINCT underlying || '|' || underlying_ccy) FILTER (method LIKE 'fallback%') AS fallback_distinct_keys FROM rep2),
    rep2 AS (SELECT * FROM rep UNION ALL SELECT * FROM rep WHERE row_idx % 10 = 3)
    SELECT *, fallback_match_rows - fallback_distinct_keys AS fallback_duplicate_rows, fallback_match_rows > fallback_distinct_keys AS has_fallback_duplication_risk,
      CASE WHEN fallback_match_rows > fallback_distinct_keys THEN 'fallback weight may be attached to multiple report rows' ELSE '' END AS weight_match_warning FROM d""".replace(
        ", d AS (SELECT count(*) AS report_rows", ", rep2 AS (SELECT * FROM rep UNION ALL SELECT * FROM rep WHERE row_idx % 10 = 3), d AS (SELECT count(*) AS report_rows"
    ).replace(
        """,
    rep2 AS (SELECT * FROM rep UNION ALL SELECT * FROM rep WHERE row_idx % 10 = 3)
    SELECT *""",
        "\n    SELECT *",
    ),
)
def _(t: Tables) -> DataFrame:
    base = report(t)
    doubled = base.unionByName(base.where("row_idx % 10 = 3"))
    return rounded(tq.weight_diagnostics(doubled), ["exact_weight_sum", "fallback_weight_sum"]).withColumn(
        "unmatched_weight_sum", F.col("unmatched_weight_sum").cast("int")
    )


@query(
    "srt5_top_failed",
    f"""WITH {WEIGHTED} SELECT underlying, chosen_ticker, status AS resolution_status, round(weight, 4) AS weight FROM rep WHERE is_failed
    ORDER BY rep.weight DESC, underlying, chosen_ticker LIMIT 3""",
)
def _(t: Tables) -> DataFrame:
    return rounded(tq.top_failed(report(t)), ["weight"])


TAGGED = f"""{REPORT}, {UNI.format(by="holdings_tag, ")},
rep AS (SELECT iss.*, coalesce(we, wf, 0) AS weight, CASE WHEN we IS NOT NULL THEN 'exact' WHEN wf IS NOT NULL THEN 'fallback' ELSE 'unmatched' END AS method
  FROM iss LEFT JOIN ex USING (holdings_tag, underlying, underlying_ccy, isin) LEFT JOIN fb USING (holdings_tag, underlying, underlying_ccy))"""

TAGS = f"""{WEIGHTED}, tg AS (SELECT *, status IN ('TICKER_NOT_FOUND', 'UNSUPPORTED_VENDOR', 'AMBIGUOUS', 'ERROR') AS hard, status = 'CANDIDATE_UNVERIFIED' AS unv,
    is_anomaly AND (lower(guess_source) IN ('country_fallback', 'ccy_fallback') OR coalesce(consistent = FALSE, FALSE)) AS ano FROM rep),
tt AS (SELECT *, concat_ws('|', CASE WHEN hard THEN 'hard_failure' WHEN unv THEN 'candidate_unverified' END,
    CASE WHEN is_failed AND method = 'unmatched' AND NOT unv THEN 'failed_weight_unmatched' END, CASE WHEN ano THEN 'anomaly_review' END,
    CASE WHEN ano AND lower(guess_source) IN ('country_fallback', 'ccy_fallback') THEN lower(guess_source) END,
    CASE WHEN ano AND coalesce(consistent = FALSE, FALSE) THEN 'prefix_exchange_inconsistent' END) AS tags FROM tg),
q AS (SELECT *, CASE WHEN hard THEN 'hard_failure' WHEN contains(tags, 'failed_weight_unmatched') THEN 'failed_weight_unmatched' WHEN unv THEN 'candidate_unverified'
    WHEN ano THEN 'anomaly_review' ELSE '' END AS review_reason, '["' || replace(tags, '|', '", "') || '"]' AS review_tags_json FROM tt WHERE tags <> '')"""


@query("prj24_review_tags", f"WITH {TAGS} SELECT row_idx, tags AS review_tags_text, review_tags_json, review_reason FROM q")
def _(t: Tables) -> DataFrame:
    return rv.review_queue(res(t), t.view("v_weights")).select("row_idx", "review_tags_text", "review_tags_json", "review_reason")


# Every part twice, so the queue has duplicates to drop; the first of each stays.
@query(
    "rep4_review_queue",
    f"WITH {TAGS} SELECT row_idx * 2 AS row_idx, underlying, chosen_ticker, status AS resolution_status, review_reason, round(weight, 4) AS weight, is_failed FROM q",
)
def _(t: Tables) -> DataFrame:
    twice = res(t).withColumn("row_idx", F.explode(F.array(F.col("row_idx") * 2, F.col("row_idx") * 2 + 1)))
    out = rv.review_queue(twice, t.view("v_weights"))
    return out.select("row_idx", "underlying", "chosen_ticker", "resolution_status", "review_reason", F.round("weight", 4).alias("weight"), "is_failed")


@query(
    "srt4_review_queue_order",
    f"""WITH {TAGS} SELECT row_number() OVER (ORDER BY CASE review_reason WHEN 'hard_failure' THEN 0 WHEN 'failed_weight_unmatched' THEN 1 WHEN 'candidate_unverified' THEN 2 ELSE 3 END,
      weight DESC, underlying, chosen_ticker) AS place, underlying, review_reason FROM q""",
)
def _(t: Tables) -> DataFrame:
    return _numbered(rv.queue_order(rv.review_queue(res(t), t.view("v_weights"))), "underlying", "review_reason")


@query(
    "rep10_tag_qa_summary",
    f"""WITH {TAGS} SELECT holdings_tag, {MEASURES}, count(*) FILTER (tags <> '') AS review_queue_rows FROM tt GROUP BY holdings_tag""",
)
def _(t: Tables) -> DataFrame:
    queue = rv.review_queue(res(t), t.view("v_weights"))
    return rounded(sm.tag_qa_summary(report(t), queue))


def gate_sql(measures: str, limits: dict[str, float], by: str = "", eps: float = 0.0) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {by + ', ' if by else ''}'{m}' AS metric, cast({m} AS DOUBLE) AS value, cast({v} AS DOUBLE) AS threshold, {m} > {v} + {eps} AS breached FROM gm"
        for m, v in limits.items()
    )
    return f"gm AS ({measures}) {rows}"


LIMITS = {"unmatched_failed_count": 0, "max_failed_weight": 100.0, "failed_weight_sum": 90000.0}


@query(
    "gate1_tier0_ratio",
    f"""WITH {sev_sql()}, g AS (SELECT round(count(*) FILTER (t0 = 0) / count(*), 9) AS v FROM sev)
    SELECT 'tier0_ratio' AS metric, v AS value, 0.25::DOUBLE AS threshold, v > 0.25 AS breached FROM g""",
)
def _(t: Tables) -> DataFrame:
    policy = sv.SeverityPolicy(relax_split_enabled=False)
    return gates.tier0_gate(sv.event_severity(t.view("v_rows"), policy), 0.25).withColumn("value", F.round("value", 9))


@query(
    "gate2_tag_gate",
    f"WITH {WEIGHTED}, {gate_sql(f'SELECT holdings_tag, {MEASURES} FROM rep GROUP BY 1', LIMITS, 'holdings_tag')}",
)
def _(t: Tables) -> DataFrame:
    out = gates.tag_gate(report(t), unmatched=True, single=100.0, total=90000.0)
    return out.withColumn("value", F.round("value", 4))


@query("gate3_materiality_gate", f"WITH {WEIGHTED}, {gate_sql(f'SELECT {MEASURES} FROM rep', LIMITS, eps=1e-12)}")
def _(t: Tables) -> DataFrame:
    return gates.materiality_gate(report(t), unmatched=True, single=100.0, total=90000.0).withColumn("value", F.round("value", 4))


@query(
    "gate4_fallback_gate",
    f"""WITH {WEIGHTED}, r2 AS (SELECT * FROM rep UNION ALL SELECT * FROM rep WHERE row_idx % 10 = 3), d AS (SELECT count(*) FILTER (method LIKE 'fallback%')
      - count(DISTINCT underlying || '|' || underlying_ccy) FILTER (method LIKE 'fallback%') AS v FROM r2)
    SELECT 'fallback_duplicate_rows' AS metric, cast(v AS DOUBLE) AS value, 0.0::DOUBLE AS threshold, v > 0 AS breached FROM d""",
)
def _(t: Tables) -> DataFrame:
    base = report(t)
    return gates.fallback_gate(base.unionByName(base.where("row_idx % 10 = 3")))


REQUIRED_INPUTS = {
    "report": ("v_resolutions", tq.REQUIRED, ["underlying_ccy", "chosen_ticker"]),
    "pairs": ("v_rows", pr.PAIR_INPUT, ["pay_date"]),
    "decisions": ("v_decisions", sd.QA_REQUIRED, []),
    "universe": ("v_securities", ["underlying", "underlying_ccy", "isin", "sedol"], []),
}


def required_sql() -> str:
    """Each input's columns, as its rows name them, against those it must have."""
    parts = []
    for name, (view, required, dropped) in REQUIRED_INPUTS.items():
        gone = "".join(f" AND k <> '{c}'" for c in dropped)
        listed = ", ".join(f"('{c}')" for c in required)
        parts.append(
            f"""SELECT '{name}' AS input, c AS required_column, (SELECT count(*) FROM {view}) AS "rows",
      c NOT IN (SELECT k FROM (SELECT DISTINCT unnest(json_keys(to_json(v))) AS k FROM {view} v) d WHERE TRUE{gone}) AS breached FROM (VALUES {listed}) t(c)"""
        )
    return " UNION ALL ".join(parts)


@query("gate5_required_columns", required_sql())
def _(t: Tables) -> DataFrame:
    return gates.columns_gate({name: (t.view(view).drop(*dropped), required) for name, (view, required, dropped) in REQUIRED_INPUTS.items()})


@query(
    "sc22_candidate_lists",
    f"WITH {REPORT} SELECT row_idx, len(c) AS n, '[' || coalesce(nullif(array_to_string(list_transform(c, lambda x: '\"' || x || '\"'), ', '), ''), '') || ']' AS as_json FROM fl",
)
def _(t: Tables) -> DataFrame:
    listed = F.transform(tk.parse_candidates(F.col("candidates_json")), lambda x: F.upper(x))
    return res(t).select("row_idx", tk.candidate_count(listed).alias("n"), tk.candidates_json(listed).alias("as_json"))


@query(
    "sc23_lenient_lists",
    "SELECT row_idx, CASE row_idx % 4 WHEN 0 THEN 'A.NS|B.BO' WHEN 1 THEN 'X.ME|Y.L' WHEN 2 THEN '' ELSE 'C.AD' END AS items FROM v_no_events",
)
def _(t: Tables) -> DataFrame:
    return t.view("v_no_events").select("row_idx", F.array_join(tk.split_candidates(F.col("candidates_json")), "|").alias("items"))


# --- records, cache and maps -----------------------------------------------------------------

@query("src14_overrides", f"WITH {records('r', 'v_cache_raw')}, {kept('o', 'r', False, MAP_FIELDS)} SELECT * FROM o")
def _(t: Tables) -> DataFrame:
    return rr.overrides(t.view("v_cache_raw")).drop("exists_bo")


@query("src15_cache", f"WITH {records('r', 'v_cache_raw')}, {kept('o', 'r', True, CACHE_FIELDS)} SELECT * FROM o")
def _(t: Tables) -> DataFrame:
    return rr.cache(t.view("v_cache_raw")).select("underlying", "underlying_ccy", *CACHE_FIELDS.split(", "))


@query("prj37_clean_records", f"WITH {records('r', 'v_cache_old')} SELECT count(*) AS records, count(*) FILTER (exists_ns) AS ns, count(*) FILTER (first_seen_asof = '') AS undated FROM r")
def _(t: Tables) -> DataFrame:
    from eventloom import schemas

    df = rr._clean_records(t.view("v_cache_old"), schemas.CACHE_COLUMNS)
    return df.agg(
        F.count("*").alias("records"), F.count(F.when(F.col("exists_ns"), 1)).alias("ns"), F.count(F.when(F.col("first_seen_asof") == "", 1)).alias("undated")
    )


EFFECTIVE = effective_sql("v_cache_new", "v_cache_old")


@query("jn18_effective_map", f"WITH {EFFECTIVE} SELECT * FROM eff")
def _(t: Tables) -> DataFrame:
    out = rr.effective_map(rr.overrides(t.view("v_cache_new")), rr.cache(t.view("v_cache_old")))
    return out.select("underlying", "underlying_ccy", "chosen_ticker", "reason", "method", "isin")


@query(
    "srt8_map_order",
    f"WITH {EFFECTIVE} SELECT row_number() OVER (ORDER BY underlying, underlying_ccy) AS place, underlying, underlying_ccy FROM eff",
)
def _(t: Tables) -> DataFrame:
    out = rr.effective_map(rr.overrides(t.view("v_cache_new")), rr.cache(t.view("v_cache_old")))
    return _numbered(rr.map_order(out), "underlying", "underlying_ccy")


UPSERT = f"""{records('rn', 'v_cache_new')}, {records('ro', 'v_cache_old')}, {kept('nw', 'rn', True, CACHE_FIELDS)}, {kept('ol', 'ro', True, CACHE_FIELDS)}"""


@query(
    "jn17_cache_upsert",
    f"""WITH {UPSERT} SELECT underlying, underlying_ccy, coalesce(nw.chosen_ticker, ol.chosen_ticker) AS chosen_ticker, coalesce(nw.reason, ol.reason) AS reason,
      coalesce(nw.resolution_status, ol.resolution_status) AS resolution_status, coalesce(nullif(ol.first_seen_asof, ''), nw.first_seen_asof, '') AS first_seen_asof
    FROM nw FULL JOIN ol USING (underlying, underlying_ccy)""",
)
def _(t: Tables) -> DataFrame:
    out = rr.upsert_cache(rr.cache(t.view("v_cache_old")), rr.cache(t.view("v_cache_new")))
    return out.select("underlying", "underlying_ccy", "chosen_ticker", "reason", "resolution_status", "first_seen_asof")


@query(
    "rep5_cache_updates",
    """SELECT trim(upper(underlying)) AS underlying, upper(trim(underlying_ccy)) AS underlying_ccy, upper(chosen_ticker) AS chosen_ticker, upper(resolution_status) AS resolution_status,
      coalesce(nullif(resolution_reason, ''), '') AS reason, '20240601' AS first_seen_asof, 'run9' AS last_validated_run_id FROM v_resolutions
    WHERE resolution_status IN ('div_found', 'verified_exists_but_no_dividends') AND chosen_ticker <> 'None'""",
)
def _(t: Tables) -> DataFrame:
    df = res(t).drop("reason").withColumn("row_no", F.col("row_idx"))
    out = rr.cache_updates(df, "20240601", "run9")
    return out.select("underlying", "underlying_ccy", "chosen_ticker", "resolution_status", "reason", "first_seen_asof", "last_validated_run_id")


@query(
    "src16_chosen_map",
    """SELECT trim(underlying) AS underlying, upper(trim(underlying_ccy)) AS underlying_ccy, arg_max(trim(chosen_ticker), row_no) AS ticker,
      arg_max(coalesce(nullif(reason, ''), 'override'), row_no) AS reason, arg_max(CASE WHEN lower(method) IN ('', 'nan', 'none') THEN 'override' ELSE method END, row_no) AS method
    FROM v_cache_raw WHERE lower(trim(underlying)) <> 'none' GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    return rr.chosen_map(t.view("v_cache_raw")).select("underlying", "underlying_ccy", "ticker", "reason", "method")


SUGGESTED = """s AS (SELECT 'IN' || cast(o_custkey % 900 AS VARCHAR) AS isin, arg_min('S' || cast(o_orderkey AS VARCHAR), o_orderkey) AS tick,
    arg_min(CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'm' END, o_orderkey) AS meth FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1)"""


@query(
    "jn19_apply_suggestions",
    f"""WITH {SUGGESTED} SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'HAS' ELSE coalesce(tick, '') END AS chosen_ticker,
      CASE WHEN c_custkey % 4 <> 0 AND tick IS NOT NULL THEN 'override_suggested' ELSE 'old' END AS reason,
      CASE WHEN c_custkey % 4 <> 0 AND tick IS NOT NULL THEN coalesce(nullif(meth, ''), 'suggest_overrides_yahoo') ELSE '' END AS method
    FROM customer LEFT JOIN s ON 'IN' || cast(c_custkey AS VARCHAR) = s.isin""",
)
def _(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    sug = t.raw("orders").select(
        F.concat(F.lit("in"), (F.col("o_custkey") % 900).cast("string")).alias("isin"),
        F.when(k % 3 == 0, " ").otherwise(F.concat(F.lit("S"), k.cast("string"))).alias("suggested_ticker"),
        F.when(k % 2 == 0, "").otherwise("m").alias("method"),
        k.alias("row_no"),
    )
    cust = t.raw("customer").select(
        "c_custkey",
        F.concat(F.lit("IN"), F.col("c_custkey").cast("string")).alias("isin"),
        F.when(F.col("c_custkey") % 4 == 0, "HAS").otherwise("").alias("chosen_ticker"),
        F.lit("old").alias("reason"),
        F.lit("").alias("method"),
    )
    return rr.apply_suggestions(cust, sug).select("c_custkey", "chosen_ticker", "reason", "method")


@query(
    "jn20_mark_unsupported",
    """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN 'UNSUPPORTED_YF' ELSE 'T' END AS chosen_ticker,
      CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN 'unsupported' ELSE '' END AS reason FROM customer""",
)
def _(t: Tables) -> DataFrame:
    isin = lambda c: F.concat(F.lit("kr"), F.col(c).cast("string"))
    cust = t.raw("customer").select("c_custkey", isin("c_custkey").alias("isin"), F.lit("T").alias("chosen_ticker"))
    hard = t.raw("orders").where("o_orderstatus = 'P'").select(isin("o_custkey").alias("isin"))
    return rr.mark_unsupported(cust, hard).select("c_custkey", "chosen_ticker", "reason")


# --- policy, fx, keys ------------------------------------------------------------------------

LISTED = "CASE row_idx % 4 WHEN 0 THEN ['A.NS', 'B.BO'] WHEN 1 THEN ['X.ME', 'Y.L'] WHEN 2 THEN [] ELSE ['C.AD'] END"
POLICY = f"""b AS (SELECT *, upper(status) AS st, upper(country) AS co, upper(exchange) AS xc, upper(exists_ticker) AS tk, coalesce(try_cast(candidate_count AS DOUBLE), 0) AS n,
    {LISTED} AS l, upper(status) IN ('VERIFIED_EXISTS_BUT_NO_DIVIDENDS', 'CANDIDATE_UNVERIFIED', 'TICKER_NOT_FOUND') AS nd FROM v_no_events),
f AS (SELECT *, row_idx % 4 = 0 AS has_dual, row_idx % 4 = 1 AS has_me, row_idx % 4 = 3 AS has_ad, tk LIKE '%.NS' AS is_ns FROM b),
g AS (SELECT *, nd AND n > 1 AND (has_dual) AS dual,
    nd AND (contains(co, 'PHILIPPINES')) AND tk LIKE '%.PS' AS ps,
    nd AND (contains(co, 'UAE') OR contains(xc, 'ABU DHABI')) AND (tk LIKE '%.AD' OR has_ad) AS uae,
    nd AND (contains(co, 'RUSSIA') OR contains(xc, 'MOSCOW') OR isin LIKE 'RU%') AND (has_me OR NOT (tk LIKE '%.L' OR has_me)) AS ru FROM f)
SELECT row_idx, CASE WHEN dual THEN 'venue_precedence_review' WHEN ps THEN 'coverage_limited_review' WHEN uae THEN 'venue_policy_review' WHEN ru THEN 'unsupported'
    WHEN nd AND (tk = '' OR n > 1 OR (st = 'VERIFIED_EXISTS_BUT_NO_DIVIDENDS' AND tk = '')) THEN 'generic_review' ELSE 'clean' END AS policy_bucket,
  CASE WHEN dual THEN 'ns_bo_dual_listing' WHEN ps THEN 'ps_coverage_limited' WHEN uae THEN 'uae_symbol_policy_gap' WHEN ru THEN 'ru_local_unsupported'
    WHEN nd AND (tk = '' OR n > 1) THEN 'unclassified_no_div' ELSE 'none' END AS policy_reason FROM g"""


@query("prj25_venue_policy", f"WITH {POLICY}")
def _(t: Tables) -> DataFrame:
    return annotate_policy(t.view("v_no_events")).select("row_idx", "policy_bucket", "policy_reason")


RATES = """fx AS (SELECT CASE WHEN length(trim(ccy)) = 3 THEN upper(trim(ccy)) END AS ccy, arg_max(try_cast(usd_per_ccy AS DOUBLE), row_no) AS usd_per_ccy
  FROM v_fx WHERE length(trim(ccy)) = 3 AND try_cast(usd_per_ccy AS DOUBLE) IS NOT NULL GROUP BY 1)"""


@query("src18_fx_rates", f"WITH {RATES} SELECT ccy, usd_per_ccy FROM fx")
def _(t: Tables) -> DataFrame:
    return fx.usd_rates(t.view("v_fx"))


@query(
    "src18_fx_rates_from_to",
    f"WITH {RATES.replace('FROM v_fx WHERE', 'FROM v_fx WHERE row_no % 4 <> 0 AND')} SELECT ccy, usd_per_ccy FROM fx",
)
def _(t: Tables) -> DataFrame:
    to = F.when(F.col("row_no") % 4 == 0, "EUR").otherwise(" usd")
    df = t.view("v_fx").select("row_no", F.col("ccy").alias("From_Ccy"), to.alias("TO_CCY"), F.col("usd_per_ccy").alias("Rate"))
    return fx.usd_rates(df)


FX_OUT = f"""{RATES}, o AS (SELECT row_idx, amount, CASE WHEN length(trim(div_ccy)) = 3 THEN upper(trim(div_ccy)) END AS c FROM v_obs),
x AS (SELECT o.*, CASE WHEN c = 'USD' THEN 1.0 ELSE fx.usd_per_ccy END AS rate FROM o LEFT JOIN fx ON o.c = fx.ccy)"""


@query("jn16_fx_convert", f"WITH {FX_OUT} SELECT row_idx, round(amount * rate, 6) AS usd FROM x")
def _(t: Tables) -> DataFrame:
    out = fx.add_usd_value(t.view("v_obs"), "amount", "div_ccy", "usd", fx.usd_rates(t.view("v_fx")))
    return out.select("row_idx", F.round("usd", 6).alias("usd"))


@query(
    "agg9_fx_diagnostics",
    f"""WITH {FX_OUT} SELECT count(*) AS total_rows, count(*) FILTER (c <> 'USD') AS non_usd_rows, count(*) FILTER (c IS NULL) AS missing_ccy_rows,
      count(*) FILTER (c <> 'USD' AND rate IS NULL) AS missing_fx_rows, count(amount * rate) AS converted_rows FROM x""",
)
def _(t: Tables) -> DataFrame:
    rates = fx.usd_rates(t.view("v_fx"))
    return fx.fx_diagnostics(fx.add_usd_value(t.view("v_obs"), "amount", "div_ccy", "usd", rates), "div_ccy", "usd", rates)


@query(
    "sc26_lookup_keys",
    """SELECT row_idx, trim(underlying) AS underlying, CASE WHEN length(trim(div_ccy)) = 3 THEN upper(trim(div_ccy)) ELSE '' END AS ccy FROM v_obs""",
)
def _(t: Tables) -> DataFrame:
    from eventloom.functions import text as tx
    from eventloom.functions import values as vl

    return t.view("v_obs").select(
        "row_idx", tx.vendor_text(F.col("underlying")).alias("underlying"), vl.currency_or_blank(F.col("div_ccy")).alias("ccy")
    )


# --- run level -------------------------------------------------------------------------------


@query(
    "agg11_value_counts",
    """SELECT resolution_status, count(*) AS "rows" FROM v_resolutions WHERE trim(resolution_status) <> '' GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return sm.value_counts(res(t), "resolution_status")


RUNS = """runs AS (SELECT DISTINCT holdings_tag, holdings_tag = 'XYZ' AS failed, CASE holdings_tag WHEN 'EEM' THEN 1.5 WHEN 'EFA' THEN 2.0 ELSE 4.0 END AS s FROM v_securities),
cnt AS (SELECT holdings_tag, (SELECT count(*) FROM v_resolutions r WHERE r.holdings_tag = runs.holdings_tag) AS resolutions_rows,
  (SELECT count(*) FROM v_securities r WHERE r.holdings_tag = runs.holdings_tag) AS errors_rows, failed, s FROM runs)"""


def summary(t: Tables) -> DataFrame:
    sec = t.view("v_securities")
    counts = sm.rows_per_tag({"resolutions": res(t), "errors": sec})
    seconds = F.when(F.col("holdings_tag") == "EEM", 1.5).when(F.col("holdings_tag") == "EFA", 2.0).otherwise(4.0)
    runs = sec.select("holdings_tag").distinct().withColumns({"failed": F.col("holdings_tag") == "XYZ", "elapsed_seconds": seconds})
    return sm.stage1_summary(counts, runs)


@query(
    "agg12_stage1_summary",
    f"""WITH {RUNS} SELECT holdings_tag, cast(sum(resolutions_rows) AS BIGINT) AS resolutions_rows, cast(sum(errors_rows) AS BIGINT) AS errors_rows, count(*) AS tag_count,
      count(*) FILTER (failed) AS failed_tag_count, round(sum(s), 6)::DOUBLE AS total_elapsed_seconds, round(max(s), 6)::DOUBLE AS max_elapsed_seconds, round(avg(s), 6)::DOUBLE AS mean_elapsed_seconds
    FROM cnt GROUP BY ROLLUP (holdings_tag)""",
)
def _(t: Tables) -> DataFrame:
    return summary(t).select(
        "holdings_tag", "resolutions_rows", "errors_rows", "tag_count", "failed_tag_count", "total_elapsed_seconds", "max_elapsed_seconds", "mean_elapsed_seconds"
    )


@query(
    "snk7_run_status",
    f"""WITH {RUNS}, z AS (SELECT holdings_tag, sum(errors_rows) AS e, count(*) FILTER (failed) AS f FROM cnt GROUP BY ROLLUP (holdings_tag))
    SELECT holdings_tag, CASE WHEN f > 0 THEN 'partial_failure' WHEN e > 0 THEN 'complete_with_review' ELSE 'complete' END AS status FROM z""",
)
def _(t: Tables) -> DataFrame:
    return summary(t).select("holdings_tag", sm.run_status(F.col("failed_tag_count"), F.col("errors_rows")).alias("status"))


CATALOG = """(SELECT c_mktsegment AS g, 'run' || cast(c_custkey AS string) AS run_id, '/runs/' || cast(c_custkey AS string) AS run_root, c_acctbal AS finished_at,
  c_custkey % 3 = 0 AND c_mktsegment <> 'MACHINERY' AS published FROM {customer}) c"""


@query(
    "snk9_latest_run",
    f"""SELECT coalesce(arg_max(run_root, (finished_at, run_id)) FILTER (published), arg_max(run_root, (finished_at, run_id))) AS run_root
    FROM {CATALOG.replace('{customer}', 'customer')}""",
)
def _(t: Tables) -> DataFrame:
    return sm.latest_run(t.sql(f"SELECT * FROM {CATALOG}", customer=t.raw("customer")))


@query(
    "snk9_latest_unpublished_run",
    f"SELECT arg_max(run_root, (finished_at, run_id)) AS run_root FROM {CATALOG.replace('{customer}', 'customer')}",
)
def _(t: Tables) -> DataFrame:
    catalog = t.sql(f"SELECT * FROM {CATALOG}", customer=t.raw("customer"))
    return sm.latest_run(catalog.withColumn("published", F.lit(False)))
