"""Engine inputs derived from the driver tables.

The bodies are plain SQL that Spark and the oracle engine read alike; ``<name>`` stands for a table or
another view. Noise (case, spaces, blanks, bad codes) is put in on purpose.
"""

from __future__ import annotations

import re

from eventloom.operators import venues as vn

K = "cast(regexp_extract(props, '[0-9]+', 0) as int)"

VIEWS: dict[str, tuple[str, list[str]]] = {}


def _view(name: str, body: str) -> None:
    VIEWS[name] = (body, sorted(set(re.findall(r"<(\w+)>", body))))


_view(
    "v_obs",
    f"""
SELECT event_id AS row_idx,
  CASE WHEN k % 3 = 0 THEN 'vendor_a' WHEN k % 3 = 1 THEN ' Vendor_B' ELSE 'vendor_c' END AS source,
  CASE WHEN k % 5 = 0 THEN '' ELSE 'S' || cast(event_id AS string) END AS source_event_key,
  'U' || cast(user_id AS string)
    || CASE WHEN user_id % 10 = 7 THEN '.SA' WHEN user_id % 10 = 8 THEN '.KS' ELSE '' END AS underlying,
  CASE WHEN user_id % 4 = 3 THEN ''
    ELSE (CASE user_id % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'BR' ELSE 'KR' END)
      || lpad(cast(user_id AS string), 9, '0') || '7' END AS isin,
  CASE WHEN k % 2 = 0 THEN event_type ELSE upper(event_type) || ' ' END AS action_type,
  CASE WHEN k % 2 = 0 THEN 'common' WHEN k % 7 = 0 THEN '' ELSE 'preferred' END AS share_class,
  CASE WHEN user_id % 4 = 0 THEN 'USD' WHEN user_id % 4 = 1 THEN ' usd ' WHEN user_id % 4 = 2 THEN 'BRL'
    WHEN k % 23 = 0 THEN 'US' ELSE 'krw' END AS div_ccy,
  'KRW' AS underlying_ccy,
  CASE WHEN k % 29 = 0 THEN '' ELSE cast(d AS string) END AS ex_date,
  CASE WHEN k % 2 = 0 THEN cast(d + cast(1 AS int) AS string) ELSE '' END AS record_date,
  CASE WHEN k % 13 = 0 THEN '' ELSE cast(d + cast(10 + k % 3 AS int) AS string) END AS pay_date,
  CASE WHEN k % 17 = 0 THEN NULL WHEN k % 19 = 0 THEN 0.0 ELSE value END AS amount,
  CASE WHEN k % 11 = 0 THEN 'special' WHEN k % 11 < 6 THEN 'regular' ELSE '' END AS div_type,
  CASE WHEN k % 3 = 0 THEN 'historical' ELSE 'paid' END AS status,
  CASE WHEN k % 4 = 0 THEN 'O3A' WHEN k % 4 = 1 THEN 'O1' END AS case_tag,
  event_type, k, d, user_id
FROM (SELECT *, {K} AS k, cast(ts AS date) AS d FROM <events>) e
""",
)

_view(
    "v_obs_vid",
    """
SELECT o.*,
  CASE WHEN k % 6 = 0 THEN '' ELSE 'V' || cast(user_id AS string) || event_type || cast(d AS string) END
    AS vendor_event_id,
  CASE WHEN k % 31 = 0 THEN 'eco_preset_' || cast(user_id AS string) ELSE '' END AS economic_event_id
FROM <v_obs> o
""",
)

# Linked rows as a table, for operators that start from event ids. The id is a plain text here.
_view(
    "v_rows",
    """
SELECT row_idx, source, case_tag, underlying, isin, action_type, share_class, underlying_ccy, status, k, user_id, d,
  upper(trim(div_ccy)) AS div_ccy, ex_date, pay_date, amount, div_type, event_type,
  coalesce(nullif(isin, ''), underlying) AS primary_ident,
  CASE WHEN ex_date = '' THEN NULL ELSE d END AS anchor_date,
  'W' || cast(row_idx % 400 AS string) AS vendor_event_id,
  CASE WHEN k % 29 = 0 THEN '' ELSE 'E' || cast(user_id AS string) || '_' || event_type
    || '_' || cast(cast(floor((row_idx % 97) / 24.0) AS int) AS string) END AS economic_event_id
FROM <v_obs>
""",
)

_view(
    "v_decisions",
    """
SELECT row_idx AS row_no, vendor_event_id, underlying, ex_date,
  CASE WHEN k % 3 = 0 THEN 'drop' WHEN k % 3 = 1 THEN 'Set_Econ_Id' ELSE ' SET_ANCHOR_DATE' END AS action,
  CASE WHEN row_idx % 2 = 0 THEN amount END AS amount,
  CASE WHEN row_idx % 2 = 0 THEN div_ccy ELSE '' END AS div_ccy,
  'E_SET_' || cast(row_idx AS string) AS economic_event_id,
  '2024-02-01' AS anchor_date,
  CASE WHEN row_idx % 7 = 0 THEN 'false' ELSE 'TRUE' END AS enabled
FROM <v_rows>
WHERE row_idx % 13 = 0 AND k % 29 <> 0 AND NOT (row_idx % 2 = 0 AND amount IS NULL)
""",
)

# Merge statements: each links an event to one with a smaller number, which makes chains.
_view(
    "v_pair_decisions",
    """
SELECT o_orderkey AS row_no, CASE WHEN o_orderkey % 9 = 0 THEN 'no' ELSE 'True ' END AS enabled,
  'U' || cast(o_custkey AS string) AS underlying,
  'E' || cast(cast(floor(o_orderkey / 3.0) AS bigint) AS string) AS econ_id_a,
  CASE WHEN o_orderkey % 101 = 0 THEN '' ELSE 'E' || cast(o_orderkey AS string) END AS econ_id_b,
  CASE WHEN o_orderkey % 4 = 0 THEN 'keep' WHEN o_orderkey % 50 = 1 THEN 'later' ELSE 'merge' END AS decision,
  CASE WHEN o_orderkey % 5 = 0 AND o_orderkey >= 7
    THEN 'E' || cast(cast(floor(o_orderkey / 7.0) AS bigint) AS string) ELSE '' END AS canonical_econ_id
FROM <orders> WHERE o_orderkey > 0
""",
)

_view(
    "v_holdings_raw",
    """
SELECT l_orderkey * 10 + l_linenumber AS row_no,
  CASE l_suppkey % 3 WHEN 0 THEN 'EEM' WHEN 1 THEN 'EFA' ELSE 'XYZ' END AS etf,
  CASE WHEN l_partkey % 41 = 0 THEN 'usd' WHEN l_partkey % 43 = 0 THEN 'bad sym' WHEN l_partkey % 47 = 0 THEN ''
    WHEN l_partkey % 53 = 0 THEN 'nan' ELSE ' ' || lpad(cast(l_partkey AS string), 6, '0') END AS ticker,
  CASE l_partkey % 4 WHEN 0 THEN 'usd' WHEN 1 THEN ' KRW' WHEN 2 THEN 'brl ' ELSE 'HKD' END AS ccy,
  CASE WHEN l_partkey % 5 = 0 THEN 'not an isin' ELSE 'kr ' || lpad(cast(l_partkey AS string), 9, '0') || '3' END
    AS isin_code,
  CASE WHEN l_linenumber = 7 THEN 'x' WHEN l_linenumber = 6 THEN '0' ELSE cast(cast(l_quantity AS int) AS string) END
    AS weight,
  CASE WHEN l_partkey % 3 = 0 THEN 'Korea (South) ' ELSE '' END AS country
FROM <lineitem>
""",
)

_view(
    "v_securities",
    """
SELECT cast(p_partkey AS string) AS security_id,
  CASE WHEN p_partkey % 11 = 0 THEN cast(p_partkey AS string) || '.HK'
    WHEN p_partkey % 13 = 0 THEN 'AB' || cast(p_partkey AS string) || '.ZZ'
    WHEN p_partkey % 59 = 0 THEN 'no symbol' WHEN p_partkey % 61 = 0 THEN ''
    ELSE cast(p_partkey AS string) END AS underlying,
  CASE p_size % 5 WHEN 0 THEN 'HKD' WHEN 1 THEN 'inr' WHEN 2 THEN 'USD' WHEN 3 THEN 'GBP' ELSE 'BRL' END
    AS underlying_ccy,
  CASE WHEN p_size % 7 = 6 THEN ''
    ELSE (CASE p_size % 7 WHEN 0 THEN 'IN' WHEN 1 THEN 'GB' WHEN 2 THEN 'HK' WHEN 3 THEN 'US' WHEN 4 THEN 'RU'
      ELSE 'JP' END) || lpad(cast(p_partkey AS string), 9, '0') || cast(p_partkey % 10 AS string) END AS isin,
  CASE p_size % 6 WHEN 0 THEN 'India' WHEN 1 THEN 'United Kingdom' WHEN 2 THEN 'hong  kong'
    WHEN 3 THEN 'Russian Federation' WHEN 4 THEN '' ELSE 'Israel' END AS country,
  CASE p_partkey % 6 WHEN 0 THEN 'National Stock Exchange of India' WHEN 1 THEN 'NYSE'
    WHEN 2 THEN 'Hong Kong Exchanges And Clearing Ltd' WHEN 3 THEN 'Tokyo Stock Exchange - Main' WHEN 4 THEN ''
    ELSE 'Bse Ltd' END AS exchange,
  p_name AS name,
  cast(p_size AS string) AS weight,
  CASE WHEN p_partkey % 37 = 0 THEN 'Q' || cast(p_partkey AS string) || '.L' WHEN p_partkey % 67 = 0 THEN 'UNSUPPORTED_YF'
    ELSE '' END AS chosen_ticker,
  CASE p_partkey % 3 WHEN 0 THEN 'EEM' WHEN 1 THEN 'EFA' ELSE 'XYZ' END AS holdings_tag,
  'holdings.csv' AS holdings_file
FROM <part>
""",
)

# Landed vendor answers: which tickers exist, which paid, and ISIN search results.
_view(
    "v_actions",
    """
SELECT CASE l_partkey % 5 WHEN 0 THEN cast(l_partkey AS string) || '.NS' WHEN 1 THEN cast(l_partkey AS string)
    WHEN 2 THEN lpad(cast(l_partkey AS string), 4, '0') || '.HK' WHEN 3 THEN lpad(cast(l_partkey AS string), 4, '0') || '.T'
    ELSE cast(l_partkey AS string) || '.L' END AS ticker,
  cast(l_shipdate AS date) AS ex_date,
  CASE WHEN l_linenumber = 1 THEN 0.0 ELSE l_quantity / 4 END AS amount
FROM <lineitem>
""",
)

_view(
    "v_existing",
    """
SELECT ticker, p_size % 2 = 0 AS is_there FROM (
  SELECT cast(p_partkey AS string) || '.NS' AS ticker, p_size FROM <part>
  UNION ALL SELECT cast(p_partkey AS string) || '.BO', p_size + p_partkey FROM <part>
  UNION ALL SELECT cast(p_partkey AS string), p_size + 1 FROM <part>
  UNION ALL SELECT cast(p_partkey AS string) || '.L', p_size FROM <part>
) t
""",
)

_view(
    "v_search",
    """
SELECT (CASE p_size % 7 WHEN 0 THEN 'IN' WHEN 1 THEN 'GB' WHEN 2 THEN 'HK' WHEN 3 THEN 'US' WHEN 4 THEN 'RU'
      WHEN 5 THEN 'JP' ELSE 'ZZ' END) || lpad(cast(p_partkey AS string), 9, '0') || cast(p_partkey % 10 AS string) AS isin,
  '{"quotes":[{"symbol":"' || CASE WHEN p_partkey % 3 = 0 THEN cast(p_partkey AS string) || '.bo' ELSE ' ' END || '","quoteType":"EQUITY","exchDisp":"Bombay"},'
  || '{"symbol":"' || cast(p_partkey AS string) || '$","quoteType":"' || CASE WHEN p_partkey % 2 = 0 THEN 'etf' ELSE 'INDEX' END
  || '","exchange":"NMS"},{"symbol":"","quoteType":"EQUITY"},{"symbol":"ZZ' || cast(p_partkey AS string) || '.SG"}]}' AS content
FROM <part>
""",
)

_view(
    "v_resolutions",
    """
SELECT p_partkey AS row_idx, 'p' || cast(p_partkey AS string) || ' ' AS underlying,
  CASE p_size % 3 WHEN 0 THEN 'usd' WHEN 1 THEN 'KRW' ELSE ' INR' END AS underlying_ccy,
  CASE WHEN p_partkey % 4 = 0 THEN 'nan' ELSE 'IN' || lpad(cast(p_partkey AS string), 9, '0') || '1' END AS isin,
  CASE WHEN p_partkey % 19 = 0 THEN 'None' ELSE 'P' || cast(p_partkey AS string) || '.NS' END AS chosen_ticker,
  CASE p_size % 7 WHEN 0 THEN 'div_found' WHEN 1 THEN 'verified_exists_but_no_dividends'
    WHEN 2 THEN 'candidate_unverified' WHEN 3 THEN 'ticker_not_found' WHEN 4 THEN 'unsupported_vendor'
    WHEN 5 THEN 'SUCCESS' ELSE 'no_dividends_in_window' END AS resolution_status,
  CASE WHEN p_partkey % 6 = 0 THEN '' ELSE 'why' END AS resolution_reason,
  'legacy' AS reason,
  CASE p_partkey % 6 WHEN 0 THEN '["P' || cast(p_partkey AS string) || '.NS", "P' || cast(p_partkey AS string) || '.BO"]'
    WHEN 1 THEN '["P' || cast(p_partkey AS string) || '", "P' || cast(p_partkey AS string) || '.L"]'
    WHEN 2 THEN '["P' || cast(p_partkey AS string) || '.L", "PP.L"]'
    WHEN 3 THEN '["IN' || lpad(cast(p_partkey AS string), 9, '0') || '1.SG", "p' || cast(p_partkey AS string) || '.ns"]'
    WHEN 4 THEN '["P' || cast(p_partkey AS string) || '.NS"]' ELSE '[]' END AS candidates_json,
  CASE p_partkey % 6 WHEN 4 THEN '1' WHEN 5 THEN '0' ELSE '2' END AS candidate_count,
  CASE WHEN p_partkey % 2 = 0 THEN 'P' || cast(p_partkey AS string) || '.NS' ELSE '' END AS exists_ticker,
  CASE WHEN p_partkey % 8 = 0 THEN 'true' ELSE '' END AS preverified_exists_any,
  CASE p_partkey % 5 WHEN 0 THEN 'ccy_fallback' WHEN 1 THEN 'country_fallback' ELSE 'isin_search' END AS guess_source,
  CASE p_partkey % 7 WHEN 0 THEN 'False' WHEN 1 THEN 'true' ELSE '' END AS prefix_exchange_consistent,
  CASE p_partkey % 3 WHEN 0 THEN 'EEM' WHEN 1 THEN 'EFA' ELSE 'XYZ' END AS holdings_tag
FROM <part>
""",
)

_view(
    "v_weights",
    """
SELECT 'P' || cast(l_partkey AS string) AS underlying,
  CASE WHEN l_partkey % 17 = 0 THEN 'EUR' WHEN p_size % 3 = 0 THEN 'USD' WHEN p_size % 3 = 1 THEN 'KRW' ELSE 'INR' END
    AS underlying_ccy,
  CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE 'IN' || lpad(cast(l_partkey AS string), 9, '0')
    || CASE WHEN l_partkey % 10 = 3 THEN '2' ELSE '1' END END AS isin,
  cast(l_quantity AS string) AS weight,
  CASE l_partkey % 3 WHEN 0 THEN 'EEM' WHEN 1 THEN 'EFA' ELSE 'XYZ' END AS holdings_tag
FROM <lineitem> JOIN <part> ON l_partkey = p_partkey
""",
)

_view(
    "v_no_events",
    """
SELECT p_partkey AS row_idx, cast(p_partkey AS string) || CASE WHEN p_partkey % 9 = 0 THEN '.L' ELSE '' END AS underlying,
  CASE p_size % 4 WHEN 0 THEN 'verified_exists_but_no_dividends' WHEN 1 THEN 'candidate_unverified'
    WHEN 2 THEN 'ticker_not_found' ELSE 'unsupported_vendor' END AS status,
  CASE WHEN p_partkey % 12 = 0 THEN 'UNSUPPORTED_YF' WHEN p_partkey % 5 = 0 THEN cast(p_partkey AS string) || '.KS'
    WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 8 = 1 THEN cast(p_partkey AS string) || '.PS'
    WHEN p_partkey % 8 = 3 THEN cast(p_partkey AS string) || '.AD' WHEN p_partkey % 8 = 5 THEN cast(p_partkey AS string) || '.NS'
    ELSE cast(p_partkey AS string) END AS exists_ticker,
  CASE p_partkey % 4 WHEN 0 THEN '["a.NS", "b.BO"]' WHEN 1 THEN '[''x.ME'', "y.L"]' WHEN 2 THEN '' ELSE 'c.AD' END
    AS candidates_json,
  CASE p_partkey % 4 WHEN 0 THEN '2' WHEN 1 THEN '2' WHEN 2 THEN '0' ELSE 'x' END AS candidate_count,
  CASE p_size % 5 WHEN 0 THEN 'Russia' WHEN 1 THEN 'UAE' WHEN 2 THEN 'Philippines' ELSE 'India' END AS country,
  CASE p_size % 3 WHEN 0 THEN 'Abu Dhabi Securities' WHEN 1 THEN 'moscow exchange' ELSE '' END AS exchange,
  CASE WHEN p_size % 11 = 0 THEN 'RU0000000001' ELSE 'KR' || lpad(cast(p_partkey AS string), 10, '0') END AS isin
FROM <part>
""",
)

_view(
    "v_cache_raw",
    """
SELECT o_orderkey AS row_no, CASE WHEN o_orderkey % 31 = 0 THEN 'none' ELSE 'u' || cast(o_custkey % 700 AS string) END
    AS underlying,
  CASE o_custkey % 3 WHEN 0 THEN 'usd' WHEN 1 THEN 'KRW' ELSE ' inr ' END AS underlying_ccy,
  CASE WHEN o_orderkey % 17 = 0 THEN '-' ELSE 't' || cast(o_orderkey % 50 AS string)
    || CASE o_orderkey % 3 WHEN 0 THEN '.ns' WHEN 1 THEN '.BO' ELSE '' END END AS chosen_ticker,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'r' || cast(o_orderkey % 7 AS string) END AS reason,
  CASE WHEN o_orderkey % 6 = 0 THEN 'NA' ELSE 'm' END AS method,
  'in 00000' || lpad(cast(o_custkey % 1000 AS string), 4, '0') || '5' AS isin,
  CASE o_orderkey % 4 WHEN 0 THEN 'div_found' WHEN 1 THEN 'Verified_Exists_But_No_Dividends'
    WHEN 2 THEN 'ticker_not_found' ELSE '' END AS resolution_status,
  'ns' AS candidate_market, 'auto' AS resolution_source,
  CASE WHEN o_orderkey % 10 = 0 THEN '2024-01-01' ELSE '202401' || lpad(cast(o_orderkey % 28 + 1 AS string), 2, '0') END
    AS first_seen_asof,
  '20240201' AS last_seen_asof, 'run1' AS last_validated_run_id,
  CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'no' END AS exists_ns, '' AS exists_bo, o_orderkey
FROM <orders>
""",
)

# Records for the securities: the cache knows a third of them, the overrides some of those and others. The rest have
# no ticker, which makes a record void.
MAP_KEY = """CASE WHEN p_partkey % 11 = 0 THEN cast(p_partkey AS string) || '.hk' WHEN p_partkey % 13 = 0 THEN ' ab' || cast(p_partkey AS string) || '.zz'
    ELSE cast(p_partkey AS string) END AS underlying,
  CASE p_size % 5 WHEN 0 THEN 'hkd' WHEN 1 THEN 'INR' WHEN 2 THEN ' usd' WHEN 3 THEN 'GBP' ELSE 'brl' END AS underlying_ccy,
  'in 0000' || lpad(cast(p_partkey AS string), 7, '0') || '5' AS isin, CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'no' END AS exists_ns,
  'div_found' AS resolution_status, '20240101' AS first_seen_asof"""

_view(
    "v_map_cache",
    f"""
SELECT p_partkey AS row_no, {MAP_KEY}, CASE WHEN p_partkey % 6 = 0 THEN cast(p_partkey AS string) || '.ns' WHEN p_partkey % 6 = 1 THEN cast(p_partkey AS string) || '.L'
    WHEN p_partkey % 71 = 0 THEN 'unsupported_yf' ELSE '' END AS chosen_ticker,
  CASE WHEN p_size % 3 = 0 THEN '' ELSE 'seen' END AS reason, 'm' AS method FROM <part>
""",
)

_view(
    "v_map_overrides",
    f"""
SELECT p_partkey AS row_no, {MAP_KEY}, CASE WHEN p_partkey % 9 = 0 THEN 'Own' || cast(p_partkey AS string) || '.to' WHEN p_partkey % 10 = 5 THEN lpad(cast(p_partkey AS string), 4, '0') || '.ns'
    WHEN p_partkey % 73 = 0 THEN 'UNSUPPORTED_YF' ELSE 'none' END AS chosen_ticker,
  CASE WHEN p_size % 3 = 1 THEN '' ELSE 'by hand' END AS reason, 'NA' AS method FROM <part>
""",
)

_view("v_cache_old", "SELECT * FROM <v_cache_raw> WHERE o_orderkey % 2 = 0")
_view("v_cache_new", "SELECT * FROM <v_cache_raw> WHERE o_orderkey % 2 = 1")

_view(
    "v_fx",
    """
SELECT s_suppkey AS row_no,
  CASE s_suppkey % 6 WHEN 0 THEN 'usd' WHEN 1 THEN ' krw' WHEN 2 THEN 'BRL' WHEN 3 THEN 'XX' WHEN 4 THEN 'HKD' ELSE 'INR' END
    AS ccy,
  CASE WHEN s_suppkey % 6 = 4 THEN 'bad' ELSE cast(s_suppkey + 1 AS string) END AS usd_per_ccy
FROM <supplier>
""",
)

_view(
    "v_chart",
    """
SELECT 't' || cast(o_custkey AS string) AS ticker, o_orderkey,
  '{"chart":{"result":[{"events":{"dividends":{"1":{"date":' || cast(1700000000 + o_orderkey * 86400 AS string) || ',"amount":'
  || cast(o_orderkey % 40 AS string) || '.25},"2":{"date":' || cast(1600000000 + o_orderkey * 3600 AS string) || ',"amount":'
  || CASE WHEN o_orderkey % 13 = 0 THEN '"oops"' WHEN o_orderkey % 7 = 0 THEN '""' ELSE '"$1,0' || cast(o_orderkey % 10 AS string) || '0.5"' END
  || '}}}},{"events":{"dividends":{"9":{"date":1,"amount":1}}}}]}}' AS content
FROM <orders>
""",
)

_view(
    "v_snapshots",
    """
SELECT 'F' || cast(p_partkey % 5 AS string) AS fund,
  '202501' || lpad(cast(p_partkey % 28 + 1 AS string), 2, '0') || '_F' || cast(p_partkey % 5 AS string) || '.json' AS file_name,
  p_partkey,
  CASE WHEN p_partkey % 97 = 0 THEN '' WHEN p_partkey % 89 = 0 THEN 'html' WHEN p_partkey % 83 = 0 THEN '{"aaData":'
    WHEN p_partkey % 79 = 0 THEN '{"other": 1}' ELSE
  '{' || CASE WHEN p_partkey % 2 = 0 THEN '"asOfDate":"Feb 3, 2025",' ELSE '' END || '"aaData":[["00' || cast(p_partkey AS string)
  || '","' || p_name || '","Tech","Equity",{"display":"$1,000","raw":1000.5},{"display":"1.5","raw":' || cast(p_size AS string)
  || '.25},"2,000","-","C 1","kr 000","s1",{"display":"7.5"},"Korea","KRX","KRW","1","x"],["CASH","Cash","-","Cash",1,2],["B'
  || cast(p_partkey AS string) || '","n","s","EQUITY","$5","3.5"]]}' END AS content
FROM <part>
""",
)


def rules_values() -> str:
    rows = ",".join(f"('{k.upper()}','{n}','{v}','{s}',{p})" for k, n, v, s, p in vn.EXCHANGE_RULES)
    return f"(VALUES {rows}) r(match_type, match_value, canonical_exchange, suffix, priority)"


def map_values(table: dict[str, list[str]], key: str, value: str) -> str:
    rows = ",".join(f"('{k}',{i},'{s}')" for k, items in table.items() for i, s in enumerate(items))
    return f"(VALUES {rows}) m({key}, pos, {value})"


def _needed(text: str, seen: list[str]) -> None:
    for name in sorted(VIEWS):
        if re.search(rf"\b{name}\b", text) and name not in seen:
            _needed(VIEWS[name][0], seen)
            if name not in seen:
                seen.append(name)


def with_views(sql: str) -> str:
    """Oracle SQL with the definitions of the views it names put in front."""
    names: list[str] = []
    _needed(sql, names)
    plain = lambda body: re.sub(r"<(\w+)>", r"\1", body)
    defs = ",\n".join(f"{n} AS ({plain(VIEWS[n][0]).strip()})" for n in names)
    body = sql.strip()
    if not defs:
        return body
    if body[:5].upper() == "WITH ":
        recursive = body[5:].lstrip().upper().startswith("RECURSIVE ")
        rest = body[5:].lstrip()[10:] if recursive else body[5:]
        return f"WITH {'RECURSIVE ' if recursive else ''}{defs},\n{rest}"
    return f"WITH {defs}\n{body}"
