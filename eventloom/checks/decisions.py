"""Queries on decisions, pairs and overlap patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.checks.linking import ROWS_SQL, SEVERITY_SQL, _numbered, events
from eventloom.checks.registry import Tables, query
from eventloom.functions import values as vl
from eventloom.operators import decisions as dc
from eventloom.operators import overlap as ov
from eventloom.operators import pairs as pr
from eventloom.operators import severity as sv
from eventloom.operators.regions import country_bucket
from eventloom.session import cut_lineage
from eventloom.sources import decisions as sd

DECISIONS = """qd AS (SELECT row_no, trim(vendor_event_id) AS vendor_event_id, trim(underlying) AS underlying, trim(ex_date) AS ex_date,
    upper(trim(action)) AS action, amount, trim(div_ccy) AS div_ccy, economic_event_id, anchor_date
  FROM v_decisions WHERE lower(enabled) IN ('1', 'true', 'yes'))"""

APPLIED = f"""{DECISIONS},
hit AS (SELECT r.row_idx, r.economic_event_id AS old_id, r.anchor_date AS old_anchor, coalesce(x.action, w.action) AS action,
    coalesce(x.economic_event_id, w.economic_event_id) AS new_id
  FROM v_rows r
  LEFT JOIN (SELECT * FROM qd WHERE amount IS NOT NULL OR div_ccy <> '') x
    ON trim(r.vendor_event_id) = x.vendor_event_id AND trim(r.underlying) = x.underlying AND trim(r.ex_date) = x.ex_date
      AND r.amount IS NOT DISTINCT FROM x.amount AND trim(r.div_ccy) = x.div_ccy
  LEFT JOIN (SELECT * FROM qd WHERE amount IS NULL AND div_ccy = '') w
    ON trim(r.vendor_event_id) = w.vendor_event_id AND trim(r.underlying) = w.underlying AND trim(r.ex_date) = w.ex_date)"""


def qa(t: Tables) -> DataFrame:
    return sd.clean_qa_decisions(t.view("v_decisions"), check=False)


@query(
    "src12_qa_decisions",
    f"WITH {DECISIONS} SELECT row_no, vendor_event_id, underlying, ex_date, action, amount, div_ccy FROM qd",
)
def _(t: Tables) -> DataFrame:
    return sd.clean_qa_decisions(t.view("v_decisions")).select(
        "row_no", "vendor_event_id", "underlying", "ex_date", "action", "amount", "div_ccy"
    )


@query(
    "src12_qa_decision_problems",
    """SELECT count(*) FILTER (a NOT IN ('DROP', 'SET_ECON_ID')) AS unknown_actions,
      count(*) FILTER (a = 'SET_ECON_ID' AND row_no % 5 = 0) AS missing_event_ids, 0 AS missing_anchor_dates
    FROM (SELECT *, CASE WHEN upper(trim(action)) = 'SET_ANCHOR_DATE' THEN 'MOVE' ELSE upper(trim(action)) END AS a FROM v_decisions) q""",
)
def _(t: Tables) -> DataFrame:
    action = F.upper(F.trim("action"))
    df = t.view("v_decisions").withColumns(
        {
            "action": F.when(action == "SET_ANCHOR_DATE", "MOVE").otherwise(action),
            "economic_event_id": F.when(F.col("row_no") % 5 == 0, " ").otherwise(F.col("economic_event_id")),
        }
    )
    return sd.qa_decision_problems(df)


@query(
    "dec1_apply_qa_decisions",
    f"""WITH {APPLIED} SELECT row_idx, CASE WHEN action = 'SET_ECON_ID' THEN new_id ELSE old_id END AS economic_event_id,
      cast(CASE WHEN action = 'SET_ANCHOR_DATE' THEN DATE '2024-02-01' ELSE old_anchor END AS VARCHAR) AS anchor_date
    FROM hit WHERE coalesce(action, '') <> 'DROP'""",
)
def _(t: Tables) -> DataFrame:
    out = dc.apply_qa_decisions(t.view("v_rows"), qa(t), check=False)
    return out.select("row_idx", "economic_event_id", F.col("anchor_date").cast("string").alias("anchor_date"))


@query("jn7_decision_lookup", f"WITH {APPLIED} SELECT action, count(*) AS hits FROM hit WHERE action IS NOT NULL AND action <> 'DROP' GROUP BY action")
def _(t: Tables) -> DataFrame:
    # Rows keep their number, so what changed shows which decision was found.
    rows = t.view("v_rows")
    out = dc.apply_qa_decisions(rows, qa(t), check=False).select(
        "row_idx", F.col("economic_event_id").alias("new_id"), F.col("anchor_date").alias("new_anchor")
    )
    both = rows.select("row_idx", "economic_event_id", "anchor_date").join(out, "row_idx")
    action = F.when(F.col("new_id") != F.col("economic_event_id"), "SET_ECON_ID").when(
        ~F.col("new_anchor").eqNullSafe(F.col("anchor_date")), "SET_ANCHOR_DATE"
    )
    return both.select(action.alias("action")).where(F.col("action").isNotNull()).groupBy("action").agg(F.count("*").alias("hits"))


@query(
    "dec2_duplicate_decisions",
    """SELECT 'exact' AS kind, count(*) AS keys FROM (SELECT 1 FROM v_decisions WHERE amount IS NOT NULL OR div_ccy <> ''
      GROUP BY underlying, ex_date, amount, div_ccy HAVING count(*) > 1) e
    UNION ALL SELECT 'wildcard', count(*) FROM (SELECT 1 FROM v_decisions WHERE amount IS NULL AND div_ccy = ''
      GROUP BY underlying, ex_date HAVING count(*) > 1) w""",
)
def _(t: Tables) -> DataFrame:
    df = dc.duplicate_decisions(t.view("v_decisions").withColumn("vendor_event_id", F.lit("V")))
    kinds = F.explode(F.array(F.lit("exact"), F.lit("wildcard")))
    found = df.groupBy("kind").agg(F.count("*").alias("n"))
    base = found.agg(F.map_from_entries(F.collect_list(F.struct("kind", "n"))).alias("m")).select(kinds.alias("kind"), "m")
    return base.select("kind", F.coalesce(F.try_element_at("m", F.col("kind")), F.lit(0)).alias("keys"))


PAIR_DECISIONS = """pd AS (SELECT row_no, trim(econ_id_a) AS a, trim(econ_id_b) AS b, upper(trim(decision)) AS decision,
    coalesce(nullif(trim(canonical_econ_id), ''), trim(econ_id_a)) AS canon
  FROM v_pair_decisions WHERE lower(trim(enabled)) IN ('1', 'true', 'yes') AND trim(econ_id_a) <> '' AND trim(econ_id_b) <> ''
    AND upper(trim(decision)) IN ('KEEP', 'MERGE'))"""


def pair_decisions(t: Tables) -> DataFrame:
    return sd.clean_pair_decisions(t.view("v_pair_decisions"))


@query("src13_pair_decisions", f"WITH {PAIR_DECISIONS} SELECT row_no, a AS econ_id_a, b AS econ_id_b, decision FROM pd")
def _(t: Tables) -> DataFrame:
    return pair_decisions(t).select("row_no", "econ_id_a", "econ_id_b", "decision")


CLOSED = f"""{PAIR_DECISIONS},
m AS (SELECT b AS k, arg_max(canon, row_no) AS v FROM pd WHERE decision = 'MERGE' GROUP BY b),
up AS (SELECT k, v, 0 AS depth FROM m UNION ALL SELECT up.k, m.v, depth + 1 FROM up JOIN m ON up.v = m.k WHERE depth < 100),
closed AS (SELECT k, arg_max(v, depth) AS v FROM up GROUP BY k)"""


@query("set6_merge_closure", f"WITH RECURSIVE {CLOSED} SELECT k AS event_id, v AS canonical_id FROM closed")
def _(t: Tables) -> DataFrame:
    return dc.merge_map(pair_decisions(t))


# Rows whose event ids are the ones the merge statements speak of.
@query(
    "jn6_apply_merges",
    f"""WITH RECURSIVE {CLOSED} SELECT o_orderkey AS row_idx, coalesce(v, 'E' || o_orderkey) AS economic_event_id
    FROM orders LEFT JOIN closed ON 'E' || o_orderkey = k""",
)
def _(t: Tables) -> DataFrame:
    rows = t.raw("orders").select(
        F.col("o_orderkey").alias("row_idx"), F.concat(F.lit("E"), F.col("o_orderkey").cast("string")).alias("economic_event_id")
    )
    return dc.apply_merges(rows, dc.merge_map(pair_decisions(t)))


PAIR_BASE = f"""{ROWS_SQL},
b AS (SELECT row_idx, underlying, economic_event_id AS econ_id, try_cast(nullif(ex_date, '') AS DATE) AS ex,
    try_cast(nullif(pay_date, '') AS DATE) AS pay, amount, div_ccy AS ccy
  FROM r WHERE case_tag LIKE 'O3%' AND ex_date <> '')"""
PAIR_QUEUE = f"""{PAIR_BASE},
q AS (SELECT x.row_idx AS row_idx_a, y.row_idx AS row_idx_b, x.underlying, x.econ_id AS econ_id_a, y.econ_id AS econ_id_b,
    y.ex - x.ex AS ex_date_abs_shift_days, abs(y.pay - x.pay) AS pay_date_abs_shift_days, abs(x.amount - y.amount) AS amount_abs_diff,
    x.ccy = y.ccy AS same_ccy
  FROM b x JOIN b y ON x.underlying = y.underlying AND y.ex - x.ex BETWEEN 1 AND 30 AND abs(y.pay - x.pay) <= {{pay}}
    AND abs(x.amount - y.amount) <= {{amount}})"""


def pair_rows(t: Tables) -> DataFrame:
    return t.view("v_rows")


WIDE = pr.PairPolicy(pay_shift_days_le=3, amount_abs_diff_le=5.0)
PAIR_OUT = "row_idx_a, row_idx_b, ex_date_abs_shift_days, pay_date_abs_shift_days, round(amount_abs_diff, 6) AS amount_abs_diff, same_ccy"


def shown(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "row_idx_a",
        "row_idx_b",
        "ex_date_abs_shift_days",
        "pay_date_abs_shift_days",
        F.round("amount_abs_diff", 6).alias("amount_abs_diff"),
        "same_ccy",
    )


@query("jn4_pair_queue", f"WITH {PAIR_QUEUE.format(pay=3, amount=5.0)} SELECT {PAIR_OUT} FROM q")
def _(t: Tables) -> DataFrame:
    return shown(pr.pair_queue(pair_rows(t), WIDE))


@query(
    "jn4_pair_queue_all_rows",
    f"""WITH {PAIR_QUEUE.format(pay=1, amount=0.5).replace("case_tag LIKE 'O3%' AND ", "")} SELECT {PAIR_OUT} FROM q WHERE same_ccy""",
)
def _(t: Tables) -> DataFrame:
    policy = pr.PairPolicy(amount_abs_diff_le=0.5, require_same_ccy=True)
    return shown(pr.pair_queue(pair_rows(t), policy, tagged_only=False))


PAIR_REPORT = f"""{PAIR_BASE},
o AS (SELECT *, row_number() OVER (PARTITION BY underlying ORDER BY ex, pay NULLS LAST, amount NULLS LAST, row_idx) AS n FROM b),
allp AS (SELECT x.underlying, x.n AS na, y.n AS nb, x.row_idx AS row_idx_a, y.row_idx AS row_idx_b, y.ex - x.ex AS ex_date_abs_shift_days,
    abs(y.pay - x.pay) AS pay_date_abs_shift_days, abs(x.amount - y.amount) AS amount_abs_diff, x.ccy = y.ccy AS same_ccy
  FROM o x JOIN o y ON x.underlying = y.underlying AND x.n < y.n AND y.ex - x.ex <= {{window}})"""


@query(
    "srt7_first_pairs",
    f"WITH {PAIR_REPORT.format(window=30)} SELECT {PAIR_OUT} FROM allp ORDER BY underlying, na, nb LIMIT 5000",
)
def _(t: Tables) -> DataFrame:
    return shown(pr.first_pairs(pair_rows(t), max_pairs=5000))


@query(
    "srt7_first_pairs_short_window",
    f"WITH {PAIR_REPORT.format(window=2)} SELECT {PAIR_OUT} FROM allp ORDER BY underlying, na, nb LIMIT 333",
)
def _(t: Tables) -> DataFrame:
    return shown(pr.first_pairs(pair_rows(t), max_pairs=333, window_days=2))


LOOSE = pr.PairPolicy(ex_shift_days_ge=1, pay_shift_days_le=6, amount_abs_diff_le=20.0)


@query(
    "dec3_filter_pairs",
    f"""WITH {PAIR_QUEUE.format(pay=6, amount=20.0)}
    SELECT {PAIR_OUT} FROM q WHERE ex_date_abs_shift_days >= 2 AND pay_date_abs_shift_days <= 3 AND amount_abs_diff <= 5 AND same_ccy""",
)
def _(t: Tables) -> DataFrame:
    strict = pr.PairPolicy(ex_shift_days_ge=2, pay_shift_days_le=3, amount_abs_diff_le=5.0, require_same_ccy=True)
    cells = pr.filter_pairs(pr.pair_cells(pair_rows(t), LOOSE), strict)
    return shown(pr.row_pairs(cells, pr.pair_members(pair_rows(t))))


@query(
    "jn4_pair_cells",
    f"""WITH {PAIR_BASE}, o AS (SELECT underlying, ex, pay, amount, ccy, econ_id, count(*) AS n FROM b
      WHERE pay IS NOT NULL AND amount IS NOT NULL GROUP BY ALL)
    SELECT x.underlying, x.econ_id AS econ_id_a, y.econ_id AS econ_id_b, cast(x.ex AS VARCHAR) AS ex_date_a, cast(y.ex AS VARCHAR) AS ex_date_b,
      abs(y.pay - x.pay) AS pay_date_abs_shift_days, round(x.amount, 6) AS amount_a, round(y.amount, 6) AS amount_b, x.n AS rows_a, y.n AS rows_b, x.n * y.n AS n_pairs
    FROM o x JOIN o y ON x.underlying = y.underlying AND y.ex - x.ex BETWEEN 1 AND 30 AND abs(y.pay - x.pay) <= 3 AND abs(x.amount - y.amount) <= 5""",
)
def _(t: Tables) -> DataFrame:
    cells = pr.pair_cells(pair_rows(t), WIDE)
    return cells.select(
        "underlying", "econ_id_a", "econ_id_b", *[F.col(c).cast("string").alias(c) for c in ("ex_date_a", "ex_date_b")], "pay_date_abs_shift_days",
        F.round("amount_a", 6).alias("amount_a"), F.round("amount_b", 6).alias("amount_b"), "rows_a", "rows_b", "n_pairs",
    )


@query(
    "jn4_pair_members",
    f"""WITH {PAIR_QUEUE.format(pay=3, amount=5.0)} SELECT row_idx, underlying, econ_id, cast(ex AS VARCHAR) AS ex_date, cast(pay AS VARCHAR) AS pay_date,
      round(amount, 6) AS amount, ccy, count(*) OVER (PARTITION BY underlying, econ_id, ex, pay, amount, ccy) AS copies
    FROM b WHERE row_idx IN (SELECT row_idx_a FROM q UNION SELECT row_idx_b FROM q)""",
)
def _(t: Tables) -> DataFrame:
    members = pr.pair_members(pair_rows(t), pr.pair_cells(pair_rows(t), WIDE))
    sizes = members.groupBy("cell").agg(F.count(F.lit(1)).alias("copies"))
    return members.join(sizes, "cell").select(
        "row_idx", "underlying", F.col("economic_event_id").alias("econ_id"), F.col("__ex").cast("string").alias("ex_date"),
        F.col("__pay").cast("string").alias("pay_date"), F.round("__amt", 6).alias("amount"), F.col("__ccy").alias("ccy"), "copies",
    )


@query(
    "srt3_pair_queue_order",
    f"""WITH {PAIR_QUEUE.format(pay=3, amount=5.0)} SELECT row_number() OVER (ORDER BY underlying, ex_date_abs_shift_days DESC,
      amount_abs_diff, row_idx_a, row_idx_b) AS place, row_idx_a, row_idx_b FROM q""",
)
def _(t: Tables) -> DataFrame:
    return _numbered(pr.queue_order(pr.pair_queue(pair_rows(t), WIDE)), "row_idx_a", "row_idx_b")


REVIEWED = "SELECT econ_id_b AS x, econ_id_a AS y FROM q WHERE row_idx_a % 3 = 0"


@query(
    "jn5_suppress_reviewed",
    f"""WITH {PAIR_QUEUE.format(pay=3, amount=5.0)}, k AS (SELECT DISTINCT least(x, y) AS lo, greatest(x, y) AS hi FROM ({REVIEWED}) z)
    SELECT row_idx_a, row_idx_b FROM q LEFT JOIN k ON least(econ_id_a, econ_id_b) = lo AND greatest(econ_id_a, econ_id_b) = hi
    WHERE lo IS NULL""",
)
def _(t: Tables) -> DataFrame:
    queue = pr.pair_queue(pair_rows(t), WIDE)
    reviewed = queue.where(F.col("row_idx_a") % 3 == 0).select(
        F.col("econ_id_b").alias("econ_id_a"), F.col("econ_id_a").alias("econ_id_b"), F.lit("KEEP").alias("decision")
    )
    cells = dc.suppress_reviewed(pr.pair_cells(pair_rows(t), WIDE), reviewed)
    return pr.row_pairs(cells, pr.pair_members(pair_rows(t))).select("row_idx_a", "row_idx_b")


@query(
    "jn3_pair_events",
    f"""WITH {PAIR_QUEUE.format(pay=3, amount=5.0)},
    {SEVERITY_SQL.format(rows="r", guard="TRUE")}
    SELECT economic_event_id, severity_tier, row_count FROM sev
    WHERE economic_event_id IN (SELECT econ_id_a FROM q UNION SELECT econ_id_b FROM q)""",
)
def _(t: Tables) -> DataFrame:
    out = pr.pair_events(events(t), pr.pair_cells(pair_rows(t), WIDE))
    return out.select("economic_event_id", "severity_tier", "row_count")


# Merging moves every second event of a user and type into the first one.
@query(
    "dec4_merge_recompute",
    f"""WITH r0 AS (SELECT * REPLACE (CASE WHEN economic_event_id LIKE '%\\_1' ESCAPE '\\' THEN regexp_replace(economic_event_id, '1$', '0')
      WHEN economic_event_id LIKE '%\\_2' ESCAPE '\\' THEN regexp_replace(economic_event_id, '2$', '0')
      ELSE economic_event_id END AS economic_event_id) FROM v_rows),
    r AS (SELECT *, div_ccy AS ccy, primary_ident AS ident, anchor_date AS anchor FROM r0),
    {SEVERITY_SQL.format(rows="r", guard="TRUE")}
    SELECT economic_event_id, severity_tier, row_count, severity_reasons FROM sev""",
)
def _(t: Tables) -> DataFrame:
    rows = t.view("v_rows")
    ids = rows.select("economic_event_id").distinct()
    step = lambda a, b: ids.where(F.col("economic_event_id").endswith(f"_{b}")).select(
        F.lit(b).alias("row_no"),
        F.regexp_replace("economic_event_id", f"{b}$", str(a)).alias("econ_id_a"),
        F.col("economic_event_id").alias("econ_id_b"),
        F.lit("MERGE").alias("decision"),
        F.lit("").alias("canonical_econ_id"),
    )
    graded_events = cut_lineage(sv.with_summary(sv.event_severity(rows)))
    graded = cut_lineage(sv.attach_severity(rows, graded_events))
    _, merged = dc.regraded(graded, graded_events, dc.merge_map(step(0, 1).unionByName(step(0, 2))))
    return merged.select("economic_event_id", "severity_tier", "row_count", "severity_reasons")


# --- overlap patterns ------------------------------------------------------------------------

BUCKET = """CASE WHEN cc IN ('JP','AU','US','KR','BR','IN','TW','HK','GB','FR','DE','CH','SE','CA','NL','IT','ES','BE','SG') THEN cc
  WHEN cc = 'CN' AND money = 'HKD' THEN 'HK_PROXY' WHEN cc = 'CN' THEN 'CN' WHEN cc <> '' AND money = 'USD' THEN cc || '_USD_PAY' ELSE 'OTHER' END"""
BUCKET_REASON = """CASE WHEN cc IN ('JP','AU','US','KR','BR','IN','TW','HK','GB','FR','DE','CH','SE','CA','NL','IT','ES','BE','SG') THEN 'ISIN=' || cc
  WHEN cc = 'CN' AND money = 'HKD' THEN 'ISIN=CN + CCY=HKD' WHEN cc = 'CN' AND money IN ('CNY', 'CNH') THEN 'ISIN=CN + CCY=CNY/CNH'
  WHEN cc = 'CN' THEN 'ISIN=CN' WHEN cc <> '' AND money = 'USD' THEN 'non-US ISIN + USD div_ccy' ELSE 'ISIN=' || coalesce(nullif(cc, ''), 'NA') END"""


@query(
    "prj11_country_bucket",
    f"""WITH s AS (SELECT p_partkey, CASE p_size % 8 WHEN 0 THEN 'US' WHEN 1 THEN 'CN' WHEN 2 THEN 'KY' WHEN 3 THEN 'x' WHEN 4 THEN ''
        WHEN 5 THEN 'sg' WHEN 6 THEN 'CN' ELSE 'BR' END || CASE WHEN p_size % 8 IN (3, 4) THEN '' ELSE cast(p_partkey AS VARCHAR) END AS isin,
      CASE p_partkey % 4 WHEN 0 THEN 'hkd' WHEN 1 THEN 'USD ' WHEN 2 THEN 'CNY' ELSE '' END AS ccy FROM part),
    c AS (SELECT *, CASE WHEN length(trim(isin)) >= 2 THEN substr(upper(trim(isin)), 1, 2) ELSE '' END AS cc, upper(trim(ccy)) AS money FROM s)
    SELECT p_partkey, {BUCKET} AS bucket, {BUCKET_REASON} AS bucket_reason FROM c""",
)
def _(t: Tables) -> DataFrame:
    df = t.sql(
        """SELECT p_partkey, CASE p_size % 8 WHEN 0 THEN 'US' WHEN 1 THEN 'CN' WHEN 2 THEN 'KY' WHEN 3 THEN 'x' WHEN 4 THEN ''
        WHEN 5 THEN 'sg' WHEN 6 THEN 'CN' ELSE 'BR' END || CASE WHEN p_size % 8 IN (3, 4) THEN '' ELSE cast(p_partkey AS string) END AS isin,
      CASE p_partkey % 4 WHEN 0 THEN 'hkd' WHEN 1 THEN 'USD ' WHEN 2 THEN 'CNY' ELSE '' END AS ccy FROM {part}""",
        part=t.raw("part"),
    )
    bucket, reason = country_bucket(F.col("isin"), F.col("ccy"))
    return df.select("p_partkey", bucket.alias("bucket"), reason.alias("bucket_reason"))


OVERLAP = f"""n0 AS (SELECT row_idx, underlying, upper(trim(isin)) AS isin, upper(trim(div_ccy)) AS div_ccy, div_type, status, vendor_event_id,
    try_cast(nullif(trim(ex_date), '') AS DATE) AS ex, try_cast(nullif(trim(pay_date), '') AS DATE) AS pay, amount,
    CASE WHEN length(isin) >= 2 THEN substr(upper(trim(isin)), 1, 2) ELSE '' END AS cc, upper(trim(div_ccy)) AS money FROM v_rows),
n AS (SELECT *, {BUCKET} AS bucket, {BUCKET_REASON} AS bucket_reason FROM n0)"""


def overlap_rows(t: Tables) -> DataFrame:
    return ov.normalise(t.view("v_rows"))


@query(
    "prj12_overlap_normalise",
    f"""WITH {OVERLAP} SELECT row_idx, bucket, bucket_reason, isin || '|ex=' || coalesce(cast(ex AS VARCHAR), 'NA') || '|pay='
      || coalesce(cast(pay AS VARCHAR), 'NA') AS row_id, cast(ex AS VARCHAR) AS ex_date, div_ccy FROM n""",
)
def _(t: Tables) -> DataFrame:
    return overlap_rows(t).select(
        "row_idx",
        "bucket",
        "bucket_reason",
        F.regexp_replace("row_id", r"\|amt=.*$", "").alias("row_id"),
        F.col("ex_date").cast("string").alias("ex_date"),
        "div_ccy",
    )


GROUP_FLAGS = f"""{OVERLAP},
f1 AS (SELECT underlying AS u1, ex AS e1, count(DISTINCT pay) >= 2 AS o1 FROM n WHERE ex IS NOT NULL AND pay IS NOT NULL GROUP BY 1, 2),
f2 AS (SELECT underlying AS u2, ex AS e2, pay AS p2, count(DISTINCT amount) >= 2 AS o2 FROM n
  WHERE ex IS NOT NULL AND pay IS NOT NULL AND amount IS NOT NULL GROUP BY 1, 2, 3),
f5 AS (SELECT underlying AS u5, count(DISTINCT div_ccy) >= 2 AS o5 FROM n WHERE ex IS NOT NULL GROUP BY 1),
gf AS (SELECT n.*, coalesce(o1 AND pay IS NOT NULL, FALSE) AS flag_O1, coalesce(o2 AND amount IS NOT NULL, FALSE) AS flag_O2,
    coalesce(o5 AND ex IS NOT NULL, FALSE) AS flag_O5,
    count(*) OVER (PARTITION BY vendor_event_id) > 1 AS flag_O4
  FROM n LEFT JOIN f1 ON underlying = u1 AND ex = e1 LEFT JOIN f2 ON underlying = u2 AND ex = e2 AND pay = p2
    LEFT JOIN f5 ON underlying = u5)"""
CLOSE = "abs(x.amount - y.amount) <= 0.02 * greatest(abs(x.amount), abs(y.amount), 1e-9)"
NEAR_FLAGS = f"""w AS (SELECT * FROM n WHERE ex IS NOT NULL AND pay IS NOT NULL AND amount IS NOT NULL),
nf AS (SELECT x.row_idx,
    coalesce(bool_or(abs(x.ex - y.ex) IN (1, 2) AND x.pay = y.pay AND {CLOSE}), FALSE) AS flag_O3a,
    coalesce(bool_or(abs(x.ex - y.ex) IN (1, 2) AND abs(x.pay - y.pay) = 1 AND {CLOSE}), FALSE) AS flag_O3b,
    coalesce(bool_or(abs(x.ex - y.ex) IN (1, 2) AND x.pay = y.pay AND NOT {CLOSE}), FALSE) AS flag_O3c,
    coalesce(bool_or(abs(x.ex - y.ex) BETWEEN 3 AND 7 AND x.pay = y.pay AND {CLOSE}), FALSE) AS flag_O3d,
    coalesce(bool_or(x.div_type <> y.div_type AND x.div_type <> '' AND y.div_type <> ''), FALSE) AS flag_O6
  FROM w x LEFT JOIN w y ON x.underlying = y.underlying AND abs(x.ex - y.ex) BETWEEN 1 AND 7 GROUP BY 1)"""
ALL_FLAGS = f"""{GROUP_FLAGS}, {NEAR_FLAGS},
fl AS (SELECT gf.*, coalesce(flag_O3a, FALSE) AS flag_O3a, coalesce(flag_O3b, FALSE) AS flag_O3b, coalesce(flag_O3c, FALSE) AS flag_O3c,
    coalesce(flag_O3d, FALSE) AS flag_O3d, coalesce(flag_O6, FALSE) AS flag_O6 FROM gf LEFT JOIN nf USING (row_idx))"""


@query("agg18_group_flags", f"WITH {GROUP_FLAGS} SELECT row_idx, flag_O1, flag_O2, flag_O5 FROM gf")
def _(t: Tables) -> DataFrame:
    return ov.with_group_flags(overlap_rows(t)).select("row_idx", "flag_O1", "flag_O2", "flag_O5")


@query(
    "win10_near_flags",
    f"WITH {OVERLAP}, {NEAR_FLAGS} SELECT * FROM nf",
)
def _(t: Tables) -> DataFrame:
    return ov.near_flags(overlap_rows(t), "underlying")


@query("win11_repeated_vendor_id", f"WITH {GROUP_FLAGS} SELECT row_idx, flag_O4 FROM gf")
def _(t: Tables) -> DataFrame:
    return ov.with_repeated_ids(overlap_rows(t)).select("row_idx", "flag_O4")


@query("win10_all_flags", f"WITH {ALL_FLAGS} SELECT row_idx, {', '.join(f'flag_{p}' for p in ov.PATTERNS)} FROM fl")
def _(t: Tables) -> DataFrame:
    return ov.add_overlap_flags(overlap_rows(t)).select("row_idx", *[f"flag_{p}" for p in ov.PATTERNS])


_ANY = " UNION ALL ".join(
    f"SELECT '{p}' AS pattern, {chr(39) + 'MULTI_CCY' + chr(39) if p == 'O5' else 'bucket'} AS sample_bucket, * FROM fl WHERE flag_{p}"
    for p in ov.PATTERNS
)


@query(
    "win12_stratified_sample",
    f"""WITH {ALL_FLAGS}, x AS (SELECT *, {' + '.join(f'cast(flag_{p} AS INT)' for p in ov.PATTERNS)} AS nflags,
      (row_idx * 7919 + 7) % 104729 AS rk FROM ({_ANY}) a),
    pick AS (SELECT pattern, arg_min(sample_bucket, rk * 100000000 + row_idx) AS b, arg_min(underlying, rk * 100000000 + row_idx) AS g FROM x GROUP BY pattern),
    z AS (SELECT x.pattern, x.sample_bucket, x.underlying AS sample_group_value, x.row_idx,
      row_number() OVER (PARTITION BY x.pattern ORDER BY nflags > 1, rk, row_idx) AS sample_no
      FROM x JOIN pick ON x.pattern = pick.pattern AND x.sample_bucket = b AND x.underlying = g)
    SELECT * FROM z WHERE sample_no <= 5""",
)
def _(t: Tables) -> DataFrame:
    out = ov.stratified_sample(ov.add_overlap_flags(overlap_rows(t)), seed=7, k=5)
    return out.select("pattern", "sample_bucket", "sample_group_value", "row_idx", "sample_no")


@query(
    "set7_isin_pool",
    """SELECT row_number() OVER (ORDER BY isin) AS place, isin FROM (SELECT DISTINCT upper(trim(isin)) AS isin FROM (SELECT isin FROM v_securities UNION ALL SELECT isin FROM v_resolutions
      UNION ALL SELECT isin_code FROM v_holdings_raw) i WHERE isin NOT IN ('nan', 'NaN', 'NAN', 'None', '<NA>') AND length(trim(isin)) >= 2) d""",
)
def _(t: Tables) -> DataFrame:
    holdings = t.view("v_holdings_raw").withColumnRenamed("isin_code", "isin")
    return _numbered(ov.isin_pool([t.view("v_securities"), t.view("v_resolutions"), holdings]), "isin")


@query(
    "sc15_spread_and_closeness",
    """SELECT row_idx, round(CASE WHEN hi > 1e-9 THEN (hi - lo) / hi ELSE 0 END, 6) AS spread,
      coalesce(abs(amount - k) <= 0.02 * greatest(abs(amount), abs(k), 1e-9), FALSE) AS near
    FROM (SELECT *, least(abs(amount), k) AS lo, greatest(abs(amount), k) AS hi FROM v_obs) o""",
)
def _(t: Tables) -> DataFrame:
    df = t.view("v_obs")
    k = F.col("k").cast("double")
    lo, hi = F.least(F.abs("amount"), k), F.greatest(F.abs("amount"), k)
    return df.select(
        "row_idx", F.round(vl.relative_spread(lo, hi), 6).alias("spread"), vl.amount_close(F.col("amount"), k).alias("near")
    )
