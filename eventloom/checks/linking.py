"""Queries on linking and grading."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.checks.registry import Tables, query
from eventloom.functions import text as tx
from eventloom.functions import values as vl
from eventloom.operators import linking as lk
from eventloom.operators import severity as sv
from eventloom.operators import summary as sm
from eventloom.operators.regions import is_brazil, is_korea
from eventloom.session import cut_lineage

# --- oracle building blocks ------------------------------------------------------------------

DAY = "try_cast(nullif(trim({}), '') AS DATE)"


def prepared_sql(source: str) -> str:
    """Cleaned rows with anchor, tie and skip reason."""
    anchor = "coalesce(" + ", ".join(DAY.format(c) for c in ("ex_date", "record_date", "pay_date")) + ")"
    return f"""
prep0 AS (SELECT *, coalesce(nullif(upper(trim(isin)), ''), nullif(upper(trim(underlying)), '')) AS ident,
    CASE WHEN length(trim(div_ccy)) = 3 THEN upper(trim(div_ccy)) END AS ccy,
    coalesce(nullif(upper(trim(action_type)), ''), 'UNKNOWN') AS act,
    coalesce(nullif(upper(trim(share_class)), ''), 'UNKNOWN') AS shr, {anchor} AS anchor
  FROM {source}),
prep AS (SELECT *, coalesce(ident, '') || '|' || coalesce(ccy, '') || '|' || coalesce(cast(anchor AS VARCHAR), '') || '|'
      || coalesce(printf('%.8f', amount), '') || '|' || coalesce(nullif(upper(trim(div_type)), ''), 'UNKNOWN') || '|'
      || coalesce(nullif(upper(trim(status)), ''), 'UNKNOWN') AS tie_raw,
    nullif('skip:' || concat_ws(',', CASE WHEN ident IS NULL THEN 'missing_ident' END,
      CASE WHEN ccy IS NULL THEN 'missing_div_ccy' END, CASE WHEN anchor IS NULL THEN 'missing_anchor_date' END),
      'skip:') AS skip
  FROM prep0)"""


TIE = "coalesce({vendor}nullif(trim(source_event_key), ''), substr(sha256(tie_raw), 1, 32))"


def walk_sql(rows: str, zero_links: bool = False) -> str:
    """Event key per linkable row of ``rows`` (ident, act, shr, ccy, anchor, tie, amount, row_idx)."""
    zero_rule = "gap_days <= 1" if zero_links else "FALSE"
    breaker = "" if zero_links else "WHEN amount = 0 THEN 1"
    return f"""
w1 AS (SELECT *, anchor - lag(anchor) OVER g AS gap_days FROM {rows}
  WINDOW g AS (PARTITION BY ident, act, shr, ccy ORDER BY anchor, tie, row_idx)),
w2 AS (SELECT *, CASE WHEN amount <> 0 THEN 'V' WHEN amount IS NULL AND (gap_days IS NULL OR gap_days > 1) THEN 'N'
    WHEN gap_days IS NULL OR gap_days > 1 THEN 'Z' END AS setter FROM w1),
w3 AS (SELECT *, last_value(setter IGNORE NULLS) OVER p AS kind0,
    last_value(CASE WHEN amount <> 0 THEN amount END IGNORE NULLS) OVER p AS prev_amount,
    last_value(CASE WHEN setter IS NOT NULL THEN 0 {breaker} END IGNORE NULLS) OVER p AS broken FROM w2
  WINDOW p AS (PARTITION BY ident, act, shr, ccy ORDER BY anchor, tie, row_idx
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
w4 AS (SELECT *, CASE WHEN broken = 1 AND kind0 = 'V' THEN 'Z' ELSE kind0 END AS kind FROM w3),
w5 AS (SELECT *, CASE WHEN gap_days IS NULL THEN TRUE WHEN gap_days > 5 THEN TRUE
    WHEN kind = 'N' OR amount IS NULL THEN NOT gap_days <= 1 WHEN kind = 'Z' OR amount = 0 THEN NOT {zero_rule}
    WHEN abs(prev_amount - amount) <= 0.001 THEN FALSE
    WHEN greatest(abs(prev_amount), abs(amount)) <= 1e-9 THEN FALSE
    ELSE NOT abs(prev_amount - amount) / greatest(abs(prev_amount), abs(amount)) <= 0.20 END AS is_new FROM w4),
w6 AS (SELECT *, sum(cast(is_new AS INT)) OVER (PARTITION BY ident, act, shr, ccy ORDER BY anchor, tie, row_idx) AS c
  FROM w5),
walked AS (SELECT *, first_value(anchor) OVER s AS seed_anchor, first_value(tie) OVER s AS seed_tie,
    concat_ws('|', ident, act, shr, ccy, cast(first_value(anchor) OVER s AS VARCHAR), first_value(tie) OVER s) AS ekey
  FROM w6 WINDOW s AS (PARTITION BY ident, act, shr, ccy, c ORDER BY anchor, tie, row_idx))"""


# The same walk row by row: a recursive query carries what the open event was started and last valued with. It shares
# nothing with the window form, so a mistake in one does not hide in the other.
WALK_BY_ROW = """
o AS (SELECT *, row_number() OVER (PARTITION BY ident, act, shr, ccy ORDER BY anchor, tie, row_idx) AS pos FROM ok),
step AS (
  SELECT row_idx, ident, act, shr, ccy, pos, anchor, CASE WHEN amount IS NULL THEN 'N' WHEN amount = 0 THEN 'Z' ELSE 'V' END AS kind,
    amount AS held, anchor AS seed_anchor, tie AS seed_tie FROM o WHERE pos = 1
  UNION ALL
  SELECT row_idx, ident, act, shr, ccy, pos, anchor,
    CASE WHEN joins AND coalesce(amount, 0) = 0 THEN kind WHEN amount IS NULL THEN 'N' WHEN amount = 0 THEN 'Z' ELSE 'V' END,
    CASE WHEN joins AND coalesce(amount, 0) = 0 THEN held ELSE amount END,
    CASE WHEN joins THEN seed_anchor ELSE anchor END, CASE WHEN joins THEN seed_tie ELSE tie END
  FROM (SELECT o.row_idx, o.ident, o.act, o.shr, o.ccy, o.pos, o.anchor, o.tie, o.amount, s.kind, s.held, s.seed_anchor, s.seed_tie,
      CASE WHEN o.anchor - s.anchor > 5 THEN FALSE WHEN s.kind = 'N' OR o.amount IS NULL THEN o.anchor - s.anchor <= 1
        WHEN s.kind = 'Z' OR o.amount = 0 THEN FALSE WHEN abs(s.held - o.amount) <= 0.001 THEN TRUE
        WHEN greatest(abs(s.held), abs(o.amount)) <= 1e-9 THEN TRUE
        ELSE abs(s.held - o.amount) / greatest(abs(s.held), abs(o.amount)) <= 0.20 END AS joins
    FROM step s JOIN o ON o.ident = s.ident AND o.act = s.act AND o.shr = s.shr AND o.ccy = s.ccy AND o.pos = s.pos + 1) n),
walked AS (SELECT row_idx, concat_ws('|', ident, act, shr, ccy, cast(seed_anchor AS VARCHAR), seed_tie) AS ekey FROM step)"""


def linked_by_row_sql() -> str:
    """``linked``: event key and id per row of v_obs, by the row-by-row walk."""
    return f"""{prepared_sql("v_obs")},
ok AS (SELECT *, {TIE.format(vendor="")} AS tie FROM prep WHERE skip IS NULL),{WALK_BY_ROW},
linked AS (SELECT p.row_idx, coalesce(w.ekey, '') AS economic_event_key,
    coalesce('eco_' || substr(sha256(w.ekey), 1, 32), '') AS economic_event_id
  FROM prep p LEFT JOIN walked w USING (row_idx))"""


def linked_sql(source: str = "v_obs", zero_links: bool = False) -> str:
    """``linked``: rows with event id, key and reason (no vendor ids)."""
    return f"""{prepared_sql(source)},
ok AS (SELECT *, {TIE.format(vendor="")} AS tie FROM prep WHERE skip IS NULL),
{walk_sql("ok", zero_links)},
named AS (SELECT row_idx, ekey, 'eco_' || substr(sha256(ekey), 1, 32) AS eid,
    row_number() OVER (PARTITION BY ekey ORDER BY anchor, tie, substr(sha256(source || '|' || source_event_key), 1, 16), row_idx)
      AS n FROM walked),
linked AS (SELECT p.*, coalesce(n.ekey, '') AS economic_event_key, coalesce(n.eid, '') AS economic_event_id,
    CASE WHEN p.skip IS NOT NULL THEN p.skip WHEN n.n = 1 THEN 'seed' ELSE 'linked' END AS event_link_reason
  FROM prep p LEFT JOIN named n USING (row_idx))"""


VENDOR_SQL = f"""{prepared_sql("v_obs_vid")},
vp AS (SELECT *, nullif(trim(vendor_event_id), '') AS vid,
    {TIE.format(vendor="nullif(trim(vendor_event_id), ''), ")} AS tie,
    CASE WHEN skip IS NULL THEN nullif(trim(economic_event_id), '') END AS preset FROM prep),
canon AS (SELECT vid,
    first(ident ORDER BY anchor NULLS LAST, ident, ccy NULLS LAST, act, shr, tie, row_idx) FILTER (ident IS NOT NULL) AS c_ident,
    first(ccy ORDER BY anchor NULLS LAST, ident, ccy NULLS LAST, act, shr, tie, row_idx) FILTER (ccy IS NOT NULL) AS c_ccy,
    first(anchor ORDER BY anchor NULLS LAST, ident, ccy NULLS LAST, act, shr, tie, row_idx) FILTER (anchor IS NOT NULL) AS c_anchor,
    first(act ORDER BY anchor NULLS LAST, ident, ccy NULLS LAST, act, shr, tie, row_idx) AS c_act,
    first(shr ORDER BY anchor NULLS LAST, ident, ccy NULLS LAST, act, shr, tie, row_idx) AS c_shr,
    first(preset ORDER BY row_idx) FILTER (preset IS NOT NULL) AS c_preset
  FROM vp WHERE vid IS NOT NULL GROUP BY vid),
cr AS (SELECT v.row_idx, v.source, v.source_event_key, v.amount, v.tie, v.skip, v.vendor_event_id,
    CASE WHEN v.vid IS NULL THEN v.ident ELSE c_ident END AS ident, CASE WHEN v.vid IS NULL THEN v.ccy ELSE c_ccy END AS ccy,
    CASE WHEN v.vid IS NULL THEN v.anchor ELSE c_anchor END AS anchor, CASE WHEN v.vid IS NULL THEN v.act ELSE c_act END AS act,
    CASE WHEN v.vid IS NULL THEN v.shr ELSE c_shr END AS shr, coalesce(c_preset, v.preset) AS preset
  FROM vp v LEFT JOIN canon c ON v.vid = c.vid)"""

SEVERITY_SQL = """
met AS (SELECT economic_event_id, count(*) AS row_count, count(DISTINCT amount) AS amount_nunique,
    bool_or(amount IS NULL) AS missing_amount_any, min(anchor) AS anchor_min, max(anchor) AS anchor_max,
    coalesce(max(anchor) - min(anchor), 0) AS anchor_spread_days,
    count(DISTINCT try_cast(nullif(trim(pay_date), '') AS DATE)) AS pay_date_nunique,
    count(DISTINCT nullif(trim(ccy), '')) AS ccy_nunique, count(DISTINCT nullif(trim(ident), '')) AS ident_nunique,
    coalesce(first(trim(underlying) ORDER BY row_idx) FILTER (trim(underlying) <> ''), '') AS underlying,
    coalesce(first(trim(isin) ORDER BY row_idx) FILTER (trim(isin) <> ''), '') AS isin,
    coalesce(first(trim(ccy) ORDER BY row_idx) FILTER (trim(ccy) <> ''), '') AS div_ccy,
    coalesce(first(trim(underlying_ccy) ORDER BY row_idx) FILTER (trim(underlying_ccy) <> ''), '') AS underlying_ccy
  FROM {rows} WHERE trim(coalesce(economic_event_id, '')) <> '' GROUP BY economic_event_id),
br AS (SELECT *, isin LIKE 'BR%' OR div_ccy = 'BRL' OR upper(underlying) LIKE '%.SA' AS is_br FROM met),
lev AS (SELECT *, CASE WHEN amount_nunique >= 3 THEN 0 WHEN amount_nunique >= CASE WHEN is_br THEN 3 ELSE 2 END THEN 1 END AS la,
    CASE WHEN anchor_spread_days >= 7 THEN 0 WHEN anchor_spread_days >= CASE WHEN is_br THEN 7 ELSE 3 END THEN 1 END AS ls,
    CASE WHEN row_count >= 10 THEN 0 WHEN row_count >= CASE WHEN is_br THEN 8 ELSE 5 END THEN 1 END AS lr,
    (amount_nunique = 2) OR (anchor_spread_days BETWEEN 3 AND 6) OR (row_count BETWEEN 5 AND 9) AS plain1 FROM br),
tier AS (SELECT *, least(2, CASE WHEN ccy_nunique > 1 OR ident_nunique > 1 THEN 0 ELSE 2 END, coalesce(la, 2), coalesce(ls, 2),
    coalesce(lr, 2), CASE WHEN missing_amount_any THEN 1 ELSE 2 END) AS t0 FROM lev),
rel AS (SELECT *, t0 < 2 AND NOT ({guard} AND is_br) AND pay_date_nunique >= 2 AND amount_nunique <= 2
    AND anchor_spread_days <= 0 AS relaxed FROM tier),
sev AS (SELECT *, CASE WHEN relaxed THEN least(2, t0 + 1) ELSE t0 END AS severity_tier,
    coalesce(nullif(concat_ws('|', CASE WHEN ccy_nunique > 1 THEN 'ccy_nunique=' || ccy_nunique || '>1' END,
      CASE WHEN ident_nunique > 1 THEN 'ident_nunique=' || ident_nunique || '>1' END,
      'amount_nunique=' || amount_nunique || '>=tier' || la, 'anchor_spread_days=' || anchor_spread_days || '>=tier' || ls,
      'row_count=' || row_count || '>=tier' || lr, CASE WHEN missing_amount_any THEN 'missing_amount_any' END,
      CASE WHEN is_br AND plain1 AND t0 = 2 THEN 'br_relaxed_tier1' END,
      CASE WHEN relaxed THEN 'relax_split_paydate' END), ''), 'clean') AS severity_reasons FROM rel)"""

# v_rows already has plain ids; its columns under the names the block above expects.
ROWS_SQL = "r AS (SELECT *, div_ccy AS ccy, primary_ident AS ident, anchor_date AS anchor FROM v_rows)"


def sev_sql(guard: bool = True) -> str:
    return f"{ROWS_SQL}, {SEVERITY_SQL.format(rows='r', guard='TRUE' if guard else 'FALSE')}"


# --- queries ---------------------------------------------------------------------------------


def obs(t: Tables) -> DataFrame:
    return t.view("v_obs")


def linked(t: Tables) -> DataFrame:
    return lk.assign_event_ids(obs(t))


@query(
    "win1_chain_link",
    f"WITH {linked_sql()} SELECT row_idx, economic_event_key, economic_event_id, event_link_reason FROM linked",
)
def _(t: Tables) -> DataFrame:
    return linked(t).select("row_idx", "economic_event_key", "economic_event_id", "event_link_reason")


@query(
    "win1_chain_link_by_row",
    f"WITH RECURSIVE {linked_by_row_sql()} SELECT row_idx, economic_event_key, economic_event_id FROM linked",
)
def _(t: Tables) -> DataFrame:
    return linked(t).select("row_idx", "economic_event_key", "economic_event_id")


@query(
    "win1_chain_link_hot",
    f"WITH {linked_sql()} SELECT row_idx, economic_event_key, economic_event_id, event_link_reason FROM linked",
)
def _(t: Tables) -> DataFrame:
    # The largest keys of these tables have some 16 rows, so this bound walks them in chunks; plans are chosen while they are built.
    t.spark.conf.set("eventloom.hotRows", "12")
    try:
        out = linked(t)
    finally:
        t.spark.conf.unset("eventloom.hotRows")
    return out.select("row_idx", "economic_event_key", "economic_event_id", "event_link_reason")


@query(
    "sc14_zero_amount_links",
    f"WITH {linked_sql(zero_links=True)} SELECT row_idx, economic_event_id, event_link_reason FROM linked",
)
def _(t: Tables) -> DataFrame:
    policy = lk.LinkPolicy(allow_zero_amount_link=True)
    return lk.assign_event_ids(obs(t), policy).select("row_idx", "economic_event_id", "event_link_reason")


@query(
    "win2_canonical_by_vendor_id",
    f"""WITH {VENDOR_SQL} SELECT row_idx, ident AS primary_ident, ccy AS div_ccy, cast(anchor AS VARCHAR) AS anchor_date,
    act AS action_type, shr AS share_class FROM cr""",
)
def _(t: Tables) -> DataFrame:
    df = lk.prepare(t.view("v_obs_vid"), lk.LinkPolicy())
    out = lk.canonicalise(df, lk.vendor_groups(df))
    return out.select(
        "row_idx", "primary_ident", "div_ccy", F.col("anchor_date").cast("string").alias("anchor_date"), "action_type", "share_class"
    )


VENDOR_LINKED = f"""{VENDOR_SQL},
ok AS (SELECT * FROM cr WHERE skip IS NULL AND preset IS NULL),
{walk_sql("ok")},
named AS (SELECT row_idx, 'eco_' || substr(sha256(ekey), 1, 32) AS eid,
    row_number() OVER (PARTITION BY ekey ORDER BY anchor, tie, substr(sha256(source || '|' || source_event_key), 1, 16), row_idx)
      AS n FROM walked),
vlinked AS (SELECT cr.row_idx, cr.vendor_event_id, coalesce(cr.preset, n.eid, '') AS economic_event_id,
    CASE WHEN cr.preset IS NOT NULL THEN 'preset' WHEN cr.skip IS NOT NULL THEN cr.skip WHEN n.n = 1 THEN 'seed'
      ELSE 'linked' END AS event_link_reason FROM cr LEFT JOIN named n USING (row_idx))"""


@query(
    "win3_seed_label",
    f"WITH {VENDOR_LINKED} SELECT row_idx, economic_event_id, event_link_reason FROM vlinked",
)
def _(t: Tables) -> DataFrame:
    out = lk.assign_event_ids(t.view("v_obs_vid"), respect_existing=True, check=False)
    return out.select("row_idx", "economic_event_id", "event_link_reason")


@query(
    "win4_preset_spread",
    f"WITH {VENDOR_SQL} SELECT row_idx, preset FROM cr WHERE preset IS NOT NULL",
)
def _(t: Tables) -> DataFrame:
    df = lk.prepare(t.view("v_obs_vid"), lk.LinkPolicy(), respect_existing=True)
    out = lk.canonicalise(df, lk.vendor_groups(df)).where(F.col("__preset").isNotNull())
    return out.select("row_idx", F.col("__preset").alias("preset"))


@query(
    "win5_source_rank",
    """SELECT row_idx, CASE upper(trim(source)) WHEN 'VENDOR_B' THEN 1 WHEN 'VENDOR_A' THEN 2 ELSE 999999 END AS source_rank
    FROM v_obs""",
)
def _(t: Tables) -> DataFrame:
    df = obs(t)
    policy = lk.LinkPolicy(source_priority={"vendor_b": 1, "Vendor_A": 2})
    return df.select("row_idx", lk.source_rank(tx.link_text(F.col("source")), policy).alias("source_rank"))


@query(
    "agg3_vendor_guardrail",
    f"""WITH {VENDOR_SQL}, m AS (SELECT vid AS vendor_event_id, count(DISTINCT ident) AS ident_nunique,
      count(DISTINCT ccy) AS ccy_nunique, coalesce(max(anchor) - min(anchor), 0) AS anchor_spread_days,
      CASE WHEN max(abs(amount)) > 1e-9 THEN (max(abs(amount)) - min(abs(amount))) / max(abs(amount)) ELSE 0 END AS rel
      FROM vp WHERE vid IS NOT NULL GROUP BY vid)
    SELECT vendor_event_id, ident_nunique, ccy_nunique, anchor_spread_days, round(rel, 6) AS amount_rel_spread,
      ident_nunique > 1 OR ccy_nunique > 1 OR anchor_spread_days > 30 OR rel > 0.10 AS violation FROM m""",
)
def _(t: Tables) -> DataFrame:
    df = lk.vendor_measures(lk.prepare(t.view("v_obs_vid"), lk.LinkPolicy()), lk.LinkPolicy())
    return df.withColumn("amount_rel_spread", F.round("amount_rel_spread", 6))


@query(
    "srt10_guardrail_sample",
    f"""WITH {VENDOR_SQL}, bad AS (SELECT vid FROM vp WHERE vid IS NOT NULL GROUP BY vid
      HAVING count(DISTINCT ident) > 1 OR count(DISTINCT ccy) > 1 OR coalesce(max(anchor) - min(anchor), 0) > 30
        OR CASE WHEN max(abs(amount)) > 1e-9 THEN (max(abs(amount)) - min(abs(amount))) / max(abs(amount)) ELSE 0 END > 0.10)
    SELECT DISTINCT vid AS vendor_event_id, ident AS primary_ident, ccy AS div_ccy, cast(anchor AS VARCHAR) AS anchor_date,
      amount, source, source_event_key FROM vp WHERE vid IN (SELECT vid FROM bad)
    ORDER BY vendor_event_id, anchor_date NULLS FIRST, source_event_key, source, primary_ident, div_ccy NULLS FIRST,
      amount NULLS FIRST LIMIT 30""",
)
def _(t: Tables) -> DataFrame:
    df = lk.prepare(t.view("v_obs_vid"), lk.LinkPolicy())
    bad = lk.vendor_groups(df).where(lk.guard_violation(lk.LinkPolicy()))
    return lk.guard_sample(df, bad).withColumn("anchor_date", F.col("anchor_date").cast("string"))


@query(
    "agg4_preset_conflicts",
    f"""WITH {VENDOR_SQL} SELECT 'V' || event_type AS vendor_event_id, count(DISTINCT preset) AS preset_count FROM vp
    WHERE preset IS NOT NULL GROUP BY 1 HAVING count(DISTINCT preset) > 1""",
)
def _(t: Tables) -> DataFrame:
    # A user carries one preset, so coarser vendor ids are needed for a conflict.
    df = t.view("v_obs_vid").withColumn("vendor_event_id", F.concat(F.lit("V"), F.col("event_type")))
    return lk.preset_conflicts(lk.prepare(df, lk.LinkPolicy(), respect_existing=True))


@query(
    "prj13_anchor_date",
    f"WITH {prepared_sql('v_obs')} SELECT row_idx, cast(anchor AS VARCHAR) AS anchor_date FROM prep",
)
def _(t: Tables) -> DataFrame:
    df = obs(t)
    return df.select("row_idx", lk.anchor_date(df).cast("string").alias("anchor_date"))


@query("prj14_primary_ident", f"WITH {prepared_sql('v_obs')} SELECT row_idx, ident AS primary_ident FROM prep")
def _(t: Tables) -> DataFrame:
    df = obs(t)
    return df.select("row_idx", lk.primary_ident(df).alias("primary_ident"))


@query("prj15_event_currency", f"WITH {prepared_sql('v_obs')} SELECT row_idx, ccy AS div_ccy FROM prep")
def _(t: Tables) -> DataFrame:
    df = obs(t)
    return df.select("row_idx", lk.event_currency(df).alias("div_ccy"))


@query("prj16_skip_reason", f"WITH {prepared_sql('v_obs')} SELECT row_idx, skip AS skip_reason FROM prep WHERE skip IS NOT NULL")
def _(t: Tables) -> DataFrame:
    df = lk.prepare(obs(t), lk.LinkPolicy()).where(F.col("__skip").isNotNull())
    return df.select("row_idx", F.col("__skip").alias("skip_reason"))


@query(
    "prj17_stable_tie",
    f"""WITH {prepared_sql('v_obs')} SELECT row_idx, tie_raw, {TIE.format(vendor='')} AS stable_tie FROM prep""",
)
def _(t: Tables) -> DataFrame:
    df = lk.prepare(obs(t), lk.LinkPolicy())
    return df.select("row_idx", F.col("__tie_text").alias("tie_raw"), F.col("__tie").alias("stable_tie"))


EVENT_OUT = """economic_event_id, severity_tier, severity_reasons, row_count, amount_nunique, missing_amount_any,
  cast(anchor_min AS VARCHAR) AS anchor_min, cast(anchor_max AS VARCHAR) AS anchor_max, anchor_spread_days, pay_date_nunique,
  ccy_nunique, ident_nunique, underlying, isin, div_ccy, underlying_ccy"""


def dated(events: DataFrame) -> DataFrame:
    return events.withColumns({c: F.col(c).cast("string") for c in ("anchor_min", "anchor_max")})


@query("flagship_event_severity", f"WITH {linked_sql()}, {SEVERITY_SQL.format(rows='linked', guard='TRUE')} SELECT {EVENT_OUT} FROM sev")
def flagship(t: Tables) -> DataFrame:
    measured = ["row_idx", "economic_event_id", "amount", "anchor_date", "pay_date", "div_ccy", "primary_ident"]
    rows = linked(t).select(*measured, "underlying", "isin", "underlying_ccy")
    return dated(sv.event_severity(cut_lineage(rows)))


METRICS_OUT = EVENT_OUT.replace(" severity_tier, severity_reasons,", "")


@query("agg1_event_metrics", f"WITH {sev_sql()} SELECT {METRICS_OUT} FROM sev")
def _(t: Tables) -> DataFrame:
    return dated(sv.event_metrics(t.view("v_rows")))


def events(t: Tables, policy: sv.SeverityPolicy | None = None) -> DataFrame:
    return sv.event_severity(t.view("v_rows"), policy)


@query("agg2_event_tier", f"WITH {sev_sql()} SELECT economic_event_id, severity_tier, severity_reasons FROM sev")
def _(t: Tables) -> DataFrame:
    return events(t).select("economic_event_id", "severity_tier", "severity_reasons")


@query(
    "agg2_event_tier_stage2_policy",
    f"WITH {sev_sql(guard=False)} SELECT economic_event_id, severity_tier, severity_reasons FROM sev",
)
def _(t: Tables) -> DataFrame:
    return events(t, sv.stage2_policy()).select("economic_event_id", "severity_tier", "severity_reasons")


@query(
    "srt1_events_worst_first",
    f"""WITH {sev_sql()} SELECT row_number() OVER (ORDER BY severity_tier, row_count DESC, amount_nunique DESC,
      anchor_spread_days DESC, economic_event_id) AS place, economic_event_id FROM sev""",
)
def _(t: Tables) -> DataFrame:
    return _numbered(sv.worst_first(events(t)), "economic_event_id")


def _numbered(ordered: DataFrame, *columns: str) -> DataFrame:
    """Place of every row of a sorted table. Sorted partitions are numbered where they are; one row each gives the offsets."""
    at = cut_lineage(ordered.select(*columns, F.monotonically_increasing_id().alias("__at")))
    part, inside = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = at.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    met = at.withColumn("__part", part).join(offsets, "__part")
    return met.select((inside + F.col("__before") + 1).alias("place"), *columns)


@query(
    "srt2_review_events",
    f"""WITH {sev_sql()} SELECT row_number() OVER (ORDER BY severity_tier, row_count DESC, amount_nunique DESC, anchor_spread_days DESC,
      economic_event_id) AS place, economic_event_id, severity_tier, row_count FROM sev WHERE severity_tier IN (0, 1)""",
)
def _(t: Tables) -> DataFrame:
    return _numbered(sv.review_events(events(t)), "economic_event_id", "severity_tier", "row_count")


@query(
    "jn1_attach_severity",
    f"""WITH {sev_sql()} SELECT v_rows.row_idx, v_rows.economic_event_id, severity_tier, severity_reasons
    FROM v_rows LEFT JOIN sev USING (economic_event_id)""",
)
def _(t: Tables) -> DataFrame:
    out = sv.attach_severity(t.view("v_rows"), events(t))
    return out.select("row_idx", "economic_event_id", "severity_tier", "severity_reasons")


@query(
    "jn2_review_rows",
    f"WITH {sev_sql()} SELECT row_idx FROM v_rows WHERE economic_event_id IN (SELECT economic_event_id FROM sev WHERE severity_tier < 2)",
)
def _(t: Tables) -> DataFrame:
    return sv.evidence_rows(t.view("v_rows"), sv.review_events(events(t))).select("row_idx")


NOT_FLAGGED = """CASE WHEN severity_tier IN (0, 1) THEN ''
  WHEN severity_reasons LIKE '%relax%' THEN 'Not flagged: relaxed by split rule; underlying triggers were ' || coalesce(nullif(
    concat_ws(', ', CASE WHEN amount_nunique >= 2 THEN 'amount_nunique' END, CASE WHEN anchor_spread_days >= 3 THEN 'anchor_spread_days' END,
    CASE WHEN row_count >= 5 THEN 'row_count' END, CASE WHEN ccy_nunique >= 2 THEN 'currency_mixture' END), ''), 'no tier-1 triggers') || '.'
  ELSE 'Not flagged: below tier-1 on ' || coalesce(nullif(concat_ws(', ', CASE WHEN amount_nunique < 2 THEN 'amount_nunique' END,
    CASE WHEN anchor_spread_days < 3 THEN 'anchor_spread_days' END, CASE WHEN row_count < 5 THEN 'row_count' END,
    CASE WHEN ccy_nunique < 2 THEN 'currency_mixture' END), ''), 'none') || '.' END"""


@query("prj26_not_flagged_summary", f"WITH {sev_sql()} SELECT economic_event_id, {NOT_FLAGGED} AS not_flagged_summary FROM sev")
def _(t: Tables) -> DataFrame:
    return sv.with_summary(events(t)).select("economic_event_id", "not_flagged_summary")


@query(
    "prj27_tier_triggers",
    f"""WITH {sev_sql()} SELECT economic_event_id, CASE WHEN row_count % 2 = 0 THEN severity_reasons
    WHEN severity_tier = 0 THEN concat_ws(' | ',
      CASE WHEN amount_nunique >= 3 THEN 'amount_nunique(' || amount_nunique || ') >= tier0_amount_unique_ge(3)' END,
      CASE WHEN anchor_spread_days >= 7 THEN 'anchor_spread_days(' || anchor_spread_days || ') >= tier0_anchor_spread_days_ge(7)' END,
      CASE WHEN row_count >= 10 THEN 'row_count(' || row_count || ') >= tier0_row_count_ge(10)' END,
      CASE WHEN ccy_nunique >= 2 THEN 'ccy_nunique(' || ccy_nunique || ') >= 2' END,
      CASE WHEN pay_date_nunique >= 2 THEN 'pay_date_nunique(' || pay_date_nunique || ') >= 2' END)
    WHEN severity_tier = 1 THEN concat_ws(' | ',
      CASE WHEN amount_nunique >= 2 THEN 'amount_nunique(' || amount_nunique || ') >= tier1_amount_unique_ge(2)' END,
      CASE WHEN anchor_spread_days >= 3 THEN 'anchor_spread_days(' || anchor_spread_days || ') >= tier1_anchor_spread_days_ge(3)' END,
      CASE WHEN row_count >= 5 THEN 'row_count(' || row_count || ') >= tier1_row_count_ge(5)' END,
      CASE WHEN ccy_nunique >= 2 THEN 'ccy_nunique(' || ccy_nunique || ') >= 2' END,
      CASE WHEN pay_date_nunique >= 2 THEN 'pay_date_nunique(' || pay_date_nunique || ') >= 2' END)
    ELSE '' END AS tier_triggers FROM sev""",
)
def _(t: Tables) -> DataFrame:
    # Half of the events lose their reasons, so both branches are used.
    df = events(t).withColumn("severity_reasons", F.when(F.col("row_count") % 2 == 0, F.col("severity_reasons")))
    return df.select("economic_event_id", sv.tier_triggers().alias("tier_triggers"))


@query(
    "jn21_case_view",
    f"""WITH {sev_sql()} SELECT DISTINCT r.case_tag, r.economic_event_id, severity_tier, row_count, anchor_spread_days,
      coalesce(severity_reasons, '') AS tier_triggers, CASE WHEN severity_tier IS NOT NULL THEN {NOT_FLAGGED} END AS not_flagged_summary
    FROM r LEFT JOIN sev USING (economic_event_id) WHERE r.case_tag IS NOT NULL""",
)
def _(t: Tables) -> DataFrame:
    view = sv.case_view(t.view("v_rows"), sv.with_summary(events(t)))
    return view.select(
        "case_tag", "economic_event_id", "severity_tier", "row_count", "anchor_spread_days", "tier_triggers", "not_flagged_summary"
    )


@query(
    "srt9_case_view_order",
    f"""WITH {sev_sql()}, c AS (SELECT DISTINCT r.case_tag, r.economic_event_id, severity_tier, row_count
      FROM r LEFT JOIN sev USING (economic_event_id) WHERE r.case_tag IS NOT NULL)
    SELECT row_number() OVER (ORDER BY case_tag, severity_tier NULLS FIRST, row_count DESC NULLS LAST, economic_event_id) AS place,
      case_tag, economic_event_id FROM c""",
)
def _(t: Tables) -> DataFrame:
    view = sv.case_order(sv.case_view(t.view("v_rows"), events(t)))
    return _numbered(view, "case_tag", "economic_event_id")


@query(
    "agg6_tier0_ratio",
    f"""WITH {sev_sql()} SELECT count(*) FILTER (severity_tier = 0) AS tier0_count, count(*) AS total_events,
      round(count(*) FILTER (severity_tier = 0) / count(*), 9) AS tier0_ratio FROM sev""",
)
def _(t: Tables) -> DataFrame:
    return sv.tier0_ratio(events(t)).withColumn("tier0_ratio", F.round("tier0_ratio", 9))


BR = "(isin LIKE 'BR%' OR upper(trim(div_ccy)) = 'BRL' OR underlying LIKE '%.SA')"
KR = "(isin LIKE 'KR%' OR underlying LIKE '%.KS' OR underlying LIKE '%.KQ')"


@query("prj9_region_split", f"SELECT row_idx, {BR} AS brazil, NOT {BR} AS non_brazil, {KR} AS korea FROM v_obs")
def _(t: Tables) -> DataFrame:
    df = obs(t)
    return df.select("row_idx", is_brazil(df).alias("brazil"), (~is_brazil(df)).alias("non_brazil"), is_korea(df).alias("korea"))


@query(
    "set4_complement_split",
    f"SELECT 'brazil' AS part, row_idx FROM v_obs WHERE {BR} UNION ALL SELECT 'non_brazil', row_idx FROM v_obs WHERE NOT {BR}",
)
def _(t: Tables) -> DataFrame:
    from eventloom.operators.regions import region_split

    parts = region_split(obs(t))
    one = lambda name: parts[name].select(F.lit(name).alias("part"), "row_idx")
    return one("brazil").unionByName(one("non_brazil"))


@query(
    "srt6_input_order",
    f"""WITH {linked_sql()} SELECT row_number() OVER (ORDER BY row_idx) AS place, row_idx, event_link_reason FROM linked""",
)
def _(t: Tables) -> DataFrame:
    return _numbered(linked(t).orderBy("row_idx"), "row_idx", "event_link_reason")


@query(
    "sc13_hash_ids",
    """SELECT row_idx, 'eco_' || substr(sha256(trim(source_event_key)), 1, 32) AS event_id,
      'obs_' || substr(sha256(upper(trim(source)) || '|' || trim(source_event_key) || '|' || trim(underlying) || '|' || ex_date), 1, 32)
        AS observation_id,
      substr(sha256(source || '|' || source_event_key), 1, 16) AS fingerprint FROM v_obs""",
)
def _(t: Tables) -> DataFrame:
    c = F.col
    return obs(t).select(
        "row_idx",
        vl.event_id(c("source_event_key")).alias("event_id"),
        vl.observation_id(c("source"), c("source_event_key"), c("underlying"), c("ex_date")).alias("observation_id"),
        vl.digest(F.concat_ws("|", "source", "source_event_key"), 16).alias("fingerprint"),
    )


@query(
    "agg5_vendor_conflicts",
    f"""WITH {VENDOR_LINKED} SELECT vendor_event_id, count(DISTINCT economic_event_id) AS event_count FROM vlinked
    GROUP BY vendor_event_id HAVING count(DISTINCT economic_event_id) > 1""",
)
def _(t: Tables) -> DataFrame:
    out = lk.assign_event_ids(t.view("v_obs_vid"), respect_existing=True, check=False)
    return sm.conflicting_vendor_ids(out)


@query(
    "rep11_conflict_sample",
    """WITH bad AS (SELECT vendor_event_id FROM v_rows GROUP BY vendor_event_id HAVING count(DISTINCT economic_event_id) > 1
      ORDER BY vendor_event_id LIMIT 10)
    SELECT vendor_event_id, underlying, div_ccy, ex_date, amount, economic_event_id, row_idx FROM v_rows
    WHERE vendor_event_id IN (SELECT vendor_event_id FROM bad) ORDER BY row_idx LIMIT 50""",
)
def _(t: Tables) -> DataFrame:
    return sm.conflict_sample(t.view("v_rows"))


@query(
    "agg17_top_events_by_amounts",
    """SELECT economic_event_id, count(DISTINCT amount) AS amounts FROM v_rows WHERE economic_event_id <> ''
    GROUP BY 1 ORDER BY amounts DESC, economic_event_id LIMIT 20""",
)
def _(t: Tables) -> DataFrame:
    return sm.top_events(t.view("v_rows"), "amounts")


@query(
    "agg17_top_events_by_rows",
    """SELECT economic_event_id, count(*) AS "rows" FROM v_rows WHERE economic_event_id <> ''
    GROUP BY 1 ORDER BY "rows" DESC, economic_event_id LIMIT 20""",
)
def _(t: Tables) -> DataFrame:
    return sm.top_events(t.view("v_rows"), "rows")


@query(
    "set5_link_difference",
    f"""WITH {linked_sql()}, a AS (SELECT DISTINCT source_event_key, economic_event_id FROM linked),
    b AS (SELECT DISTINCT source_event_key, CASE WHEN row_idx % 50 = 0 THEN 'moved' ELSE economic_event_id END AS economic_event_id FROM linked)
    SELECT *, 'first' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT *, 'second' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def _(t: Tables) -> DataFrame:
    out = linked(t)
    moved = F.when(F.col("row_idx") % 50 == 0, "moved").otherwise(F.col("economic_event_id"))
    return sm.set_difference(out, out.withColumn("economic_event_id", moved), ["source_event_key", "economic_event_id"])
