"""Grade events into review tiers: 0 must be reviewed, 1 should be, 2 is accepted."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.functions import values as vl
from eventloom.operators.skew import split_crowded

EVENT_COLUMNS = [
    "economic_event_id",
    "severity_tier",
    "severity_reasons",
    "row_count",
    "amount_nunique",
    "missing_amount_any",
    "anchor_min",
    "anchor_max",
    "anchor_spread_days",
    "pay_date_nunique",
    "ccy_nunique",
    "ident_nunique",
    "underlying",
    "isin",
    "div_ccy",
    "underlying_ccy",
]


@dataclass(frozen=True)
class SeverityPolicy:
    tier0_amount_unique_ge: int = 3
    tier1_amount_unique_ge: int = 2
    tier0_anchor_spread_days_ge: int = 7
    tier1_anchor_spread_days_ge: int = 3
    tier0_row_count_ge: int = 10
    tier1_row_count_ge: int = 5
    tier0_ccy_unique_gt: int = 1
    tier0_ident_unique_gt: int = 1
    tier0_missing_amount_any: bool = False
    tier1_missing_amount_any: bool = True
    relax_split_enabled: bool = True
    relax_split_pay_date_nunique_ge: int = 2
    relax_split_amount_nunique_le: int = 2
    relax_split_anchor_spread_days_le: int = 0
    relax_split_reduce_tier_by: int = 1
    brazil_isin_prefix: str = "BR"
    brazil_div_ccy: str = "BRL"
    brazil_underlying_suffixes: tuple[str, ...] = (".SA",)
    relax_disable_for_brazil: bool = True
    relax_br_tier1_enabled: bool = True
    relax_br_tier1_amount_unique_ge: int = 3
    relax_br_tier1_anchor_spread_days_ge: int = 7
    relax_br_tier1_row_count_ge: int = 8
    relax_br_tag_reason: bool = True


def stage2_policy(relax_split: bool = True, relax_split_non_br_only: bool = False) -> SeverityPolicy:
    """Policy of the stage-2 job: unlike the bare default it relaxes Brazil too unless told not to."""
    return SeverityPolicy(
        relax_disable_for_brazil=relax_split_non_br_only,
        relax_split_pay_date_nunique_ge=2 if relax_split else 10**9,
    )


def require_columns(df: DataFrame, columns: list[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")


# Rows of an event that one task may hold the distinct amounts and dates of.
EVENT_ROWS = 200_000
CARRIED = ["underlying", "isin", "div_ccy", "underlying_ccy"]


def event_metrics(rows: DataFrame) -> DataFrame:
    """One row per event id with its measures; rows without an id are left out.

    An event's rows meet in one exchange of the columns that are measured, and one pass over them. Events that may have
    more than ``EVENT_ROWS`` rows go another way: aggregates only, distinct counts included, so Spark combines before
    the shuffle and a hot event costs no more than its distinct values. ``rows`` may be read several times, so pass one
    that is materialised.
    """
    require_columns(rows, ["economic_event_id"], "event metrics")
    has = set(rows.columns)
    # Values are typed before they are aggregated: distinct counts multiply rows, not expressions.
    typed = rows.where(tx.text_or_blank(F.col("economic_event_id")) != "").select(
        "economic_event_id",
        (F.col("row_idx") if "row_idx" in has else F.lit(0)).alias("__place"),
        vl.number_in(rows, "amount").alias("__amount"),
        vl.day_in(rows, "anchor_date").alias("__anchor"),
        vl.day_in(rows, "pay_date").alias("__pay"),
        *[_some_text(rows, c).alias(f"__{c}") for c in [*CARRIED, "primary_ident"]],
    )
    missing = F.col("__amount").isNull() if "amount" in has else F.lit(False)
    usual, crowded = split_crowded(typed, "economic_event_id", EVENT_ROWS, size_of=rows)
    out = _measured_together(usual, missing)
    return out if crowded is None else out.unionByName(_measured_apart(crowded, missing))


def _first_text(name: str) -> Column:
    value = F.col(f"__{name}")
    return F.coalesce(F.min_by(value, F.when(value.isNotNull(), F.struct("__place", value))), F.lit("")).alias(name)


def _measured_together(typed: DataFrame, missing: Column) -> DataFrame:
    """Measures of events whose rows fit a task."""
    distinct = lambda c: F.size(F.collect_set(c)).cast("bigint")
    # A set tells the zeros apart, a distinct count does not.
    amount = F.when(F.col("__amount") == 0.0, F.lit(0.0)).otherwise(F.col("__amount"))
    return typed.repartition("economic_event_id").groupBy("economic_event_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.bool_or(missing).alias("missing_amount_any"),
        F.min("__anchor").alias("anchor_min"),
        F.max("__anchor").alias("anchor_max"),
        F.coalesce(F.datediff(F.max("__anchor"), F.min("__anchor")), F.lit(0)).alias("anchor_spread_days"),
        distinct("__div_ccy").alias("ccy_nunique"),
        distinct("__primary_ident").alias("ident_nunique"),
        *[_first_text(c) for c in CARRIED],
        distinct(amount).alias("amount_nunique"),
        distinct("__pay").alias("pay_date_nunique"),
    )


def _measured_apart(typed: DataFrame, missing: Column) -> DataFrame:
    """The same by aggregates that hold for an event of any size."""
    texts = [f"__{c}" for c in [*CARRIED, "primary_ident"]]
    # Texts repeat within an event, so they are grouped away first; that leaves only fixed-width
    # buffers on the full table and text buffers on a few rows per event.
    cells = typed.groupBy("economic_event_id", *texts).agg(
        F.count(F.lit(1)).alias("__rows"),
        F.min("__place").alias("__place"),
        F.bool_or(missing).alias("__missing"),
        F.min("__anchor").alias("__first"),
        F.max("__anchor").alias("__last"),
    )
    described = cells.groupBy("economic_event_id").agg(
        F.sum("__rows").alias("row_count"),
        F.bool_or("__missing").alias("missing_amount_any"),
        F.min("__first").alias("anchor_min"),
        F.max("__last").alias("anchor_max"),
        F.coalesce(F.datediff(F.max("__last"), F.min("__first")), F.lit(0)).alias("anchor_spread_days"),
        F.countDistinct("__div_ccy").alias("ccy_nunique"),
        F.countDistinct("__primary_ident").alias("ident_nunique"),
        *[_first_text(c) for c in CARRIED],
    )
    # Amounts and pay dates do vary, so their distinct counts take the rows themselves, two columns wide.
    spread = typed.groupBy("economic_event_id").agg(
        F.countDistinct("__amount").alias("amount_nunique"), F.countDistinct("__pay").alias("pay_date_nunique")
    )
    return described.join(spread, "economic_event_id")


def _some_text(df: DataFrame, name: str) -> Column:
    """Stripped text or null when blank or when the table has no such column."""
    return tx.blank_to_null(F.col(name)) if name in df.columns else F.lit(None).cast("string")


def is_brazil_event(policy: SeverityPolicy) -> Column:
    return (
        F.upper(tx.text_or_blank(F.col("isin"))).startswith(policy.brazil_isin_prefix)
        | (F.upper(tx.text_or_blank(F.col("div_ccy"))) == policy.brazil_div_ccy)
        | tx.ends_with_any(
            F.upper(tx.text_or_blank(F.col("underlying"))), [s.upper() for s in policy.brazil_underlying_suffixes]
        )
    )


def grade(metrics: DataFrame, policy: SeverityPolicy | None = None) -> DataFrame:
    """Tier and reasons from event measures. Reasons are joined by ``|`` in rule order."""
    p = policy or SeverityPolicy()
    brazil = is_brazil_event(p)
    eased = brazil if p.relax_br_tier1_enabled else F.lit(False)

    # measure, tier-0 limit, tier-1 limit, tier-1 limit when eased
    graded = [
        ("amount_nunique", p.tier0_amount_unique_ge, p.tier1_amount_unique_ge, p.relax_br_tier1_amount_unique_ge),
        (
            "anchor_spread_days",
            p.tier0_anchor_spread_days_ge,
            p.tier1_anchor_spread_days_ge,
            p.relax_br_tier1_anchor_spread_days_ge,
        ),
        ("row_count", p.tier0_row_count_ge, p.tier1_row_count_ge, p.relax_br_tier1_row_count_ge),
    ]
    tiers: list[Column] = []
    reasons: list[Column] = []
    plain_tier1 = F.lit(False)

    for name, limit in (("ccy_nunique", p.tier0_ccy_unique_gt), ("ident_nunique", p.tier0_ident_unique_gt)):
        hit = F.col(name) > limit
        tiers.append(F.when(hit, 0))
        reasons.append(F.when(hit, F.concat(F.lit(f"{name}="), F.col(name).cast("string"), F.lit(">1"))))
    for name, ge0, ge1, ge1_eased in graded:
        value = F.col(name)
        level = F.when(value >= ge0, 0).when(value >= F.when(eased, ge1_eased).otherwise(ge1), 1)
        tiers.append(level)
        reasons.append(F.concat(F.lit(f"{name}="), value.cast("string"), F.lit(">=tier"), level.cast("string")))
        plain_tier1 = plain_tier1 | ((value >= ge1) & (value < ge0))
    if p.tier0_missing_amount_any or p.tier1_missing_amount_any:
        hit = F.col("missing_amount_any")
        tiers.append(F.when(hit, 0 if p.tier0_missing_amount_any else 1))
        reasons.append(F.when(hit, F.lit("missing_amount_any")))

    df = metrics.withColumn("__tier", F.least(F.lit(2), *[F.coalesce(t, F.lit(2)) for t in tiers]))
    tag_eased = eased & plain_tier1 & (F.col("__tier") == 2) if p.relax_br_tag_reason else F.lit(False)
    reasons.append(F.when(tag_eased, F.lit("br_relaxed_tier1")))

    relaxed = F.lit(False)
    if p.relax_split_enabled:
        relaxed = (
            (F.col("__tier") < 2)
            & (~brazil if p.relax_disable_for_brazil else F.lit(True))
            & (F.col("pay_date_nunique") >= p.relax_split_pay_date_nunique_ge)
            & (F.col("amount_nunique") <= p.relax_split_amount_nunique_le)
            & (F.col("anchor_spread_days") <= p.relax_split_anchor_spread_days_le)
        )
    reasons.append(F.when(relaxed, F.lit("relax_split_paydate")))

    tier = F.when(relaxed, F.least(F.lit(2), F.col("__tier") + p.relax_split_reduce_tier_by)).otherwise(F.col("__tier"))
    text = F.concat_ws("|", *reasons)
    return df.withColumns(
        {"severity_tier": tier, "severity_reasons": F.when(text == "", "clean").otherwise(text)}
    ).drop("__tier")


def event_severity(rows: DataFrame, policy: SeverityPolicy | None = None) -> DataFrame:
    return grade(event_metrics(rows), policy).select(*EVENT_COLUMNS)


def worst_first(events: DataFrame) -> DataFrame:
    return events.orderBy(
        "severity_tier", F.desc("row_count"), F.desc("amount_nunique"), F.desc("anchor_spread_days"), "economic_event_id"
    )


def review_events(events: DataFrame) -> DataFrame:
    """Events of tier 0 and 1, worst first."""
    return events.where(F.col("severity_tier").isin(0, 1)).orderBy(
        "severity_tier", F.desc("row_count"), F.desc("amount_nunique"), F.desc("anchor_spread_days"), "economic_event_id"
    )


def spread_key(df: DataFrame, name: str) -> Column:
    """Join key in which every blank is different, so rows without an id do not crowd one task."""
    own = F.concat(F.lit("#"), F.xxhash64(*df.columns).cast("string"))
    return F.when(tx.text_or_blank(F.col(name)) == "", own).otherwise(F.concat(F.lit("v"), F.col(name)))


def attach_severity(rows: DataFrame, events: DataFrame) -> DataFrame:
    """Event tier and reasons on every row; rows without an event id stay null."""
    left = rows.withColumn("__key", spread_key(rows, "economic_event_id"))
    right = events.select(
        F.concat(F.lit("v"), F.col("economic_event_id")).alias("__key"), "severity_tier", "severity_reasons"
    )
    return left.join(right, "__key", "left").drop("__key")


def evidence_rows(rows: DataFrame, queue: DataFrame) -> DataFrame:
    """Rows whose event is in the review queue.

    The queue is a function of the tier, so rows that already carry a tier need no join.
    """
    if "severity_tier" in rows.columns:
        return rows.where(F.col("severity_tier").isin(0, 1))
    return rows.join(queue.select("economic_event_id"), "economic_event_id", "left_semi")


def not_flagged_summary(policy: SeverityPolicy | None = None) -> Column:
    """Why an accepted event was not flagged; blank for flagged ones."""
    p = policy or SeverityPolicy()
    signals = [
        ("amount_nunique", F.col("amount_nunique") >= p.tier1_amount_unique_ge),
        ("anchor_spread_days", F.col("anchor_spread_days") >= p.tier1_anchor_spread_days_ge),
        ("row_count", F.col("row_count") >= p.tier1_row_count_ge),
        ("currency_mixture", F.col("ccy_nunique") >= 2),
    ]
    met = F.concat_ws(", ", *[F.when(hit, F.lit(name)) for name, hit in signals])
    below = F.concat_ws(", ", *[F.when(~hit, F.lit(name)) for name, hit in signals])
    met = F.when(met == "", F.lit("no tier-1 triggers")).otherwise(met)
    below = F.when(below == "", F.lit("none")).otherwise(below)
    return (
        F.when(F.coalesce(F.col("severity_tier"), F.lit(999)).isin(0, 1), F.lit(""))
        .when(
            F.lower(F.col("severity_reasons")).contains("relax"),
            F.concat(F.lit("Not flagged: relaxed by split rule; underlying triggers were "), met, F.lit(".")),
        )
        .otherwise(F.concat(F.lit("Not flagged: below tier-1 on "), below, F.lit(".")))
    )


def tier_triggers(policy: SeverityPolicy | None = None) -> Column:
    """The reasons text, or one rebuilt from measures and limits when it is blank."""
    p = policy or SeverityPolicy()

    def over(name: str, limit: int, label: str | None = None) -> Column:
        value = F.coalesce(F.col(name).cast("bigint"), F.lit(0))
        shown = f"{label}({limit})" if label else str(limit)
        return F.when(value >= limit, F.concat(F.lit(f"{name}("), value.cast("string"), F.lit(f") >= {shown}")))

    def rebuilt(tier: int) -> Column:
        return F.concat_ws(
            " | ",
            *[
                over(name, getattr(p, f"tier{tier}_{limit}"), f"tier{tier}_{limit}")
                for name, limit in (
                    ("amount_nunique", "amount_unique_ge"),
                    ("anchor_spread_days", "anchor_spread_days_ge"),
                    ("row_count", "row_count_ge"),
                )
            ],
            over("ccy_nunique", 2),
            over("pay_date_nunique", 2),
        )

    tier = F.col("severity_tier")
    return F.coalesce(
        F.nullif(tx.text_or_blank(F.col("severity_reasons")), F.lit("")),
        F.when(tier == 0, rebuilt(0)).when(tier == 1, rebuilt(1)),
        F.lit(""),
    )


def with_summary(events: DataFrame, policy: SeverityPolicy | None = None) -> DataFrame:
    return events.withColumn("not_flagged_summary", not_flagged_summary(policy))


def case_view(rows: DataFrame, events: DataFrame, policy: SeverityPolicy | None = None) -> DataFrame:
    """Distinct (case tag, event) with the event's measures and triggers."""
    shown = [
        "severity_tier",
        "row_count",
        "amount_nunique",
        "pay_date_nunique",
        "ccy_nunique",
        "anchor_spread_days",
        "severity_reasons",
        "not_flagged_summary",
    ]
    cases = rows.select("case_tag", "economic_event_id").dropna().distinct()
    view = cases.join(
        events.select("economic_event_id", *[c for c in shown if c in events.columns]), "economic_event_id", "left"
    )
    return view.withColumn("tier_triggers", tier_triggers(policy))


def case_order(view: DataFrame) -> DataFrame:
    return view.orderBy("case_tag", "severity_tier", F.desc("row_count"), "economic_event_id")


def tier0_ratio(events: DataFrame) -> DataFrame:
    """One row: tier-0 events, all events, their ratio (0 when there are none)."""
    tier0 = F.count(F.when(F.col("severity_tier") == 0, 1))
    total = F.count(F.lit(1))
    return events.agg(
        tier0.alias("tier0_count"),
        total.alias("total_events"),
        F.when(total > 0, tier0 / total).otherwise(0.0).alias("tier0_ratio"),
    )
