"""Operator decisions: overrides on rows, reviewed pairs and merged events."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.functions import values as vl
from eventloom.operators import severity as sv
from eventloom.operators.linking import column_or
from eventloom.operators.severity import require_columns, spread_key
from eventloom.session import cut_lineage
from eventloom.sources.tables import with_row_no

WILD_KEY = ["vendor_event_id", "underlying", "ex_date"]
EXACT_KEY = [*WILD_KEY, "amount", "div_ccy"]


def _match_columns(df: DataFrame) -> dict[str, Column]:
    """Decision key: texts compare stripped, the amount as a number."""
    out = {f"__{c}": tx.text_or_blank(column_or(df, c)) for c in [*WILD_KEY, "div_ccy"]}
    return out | {"__amount": vl.number_in(df, "amount")}


def _split_keys(decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    keyed = decisions.withColumns(_match_columns(decisions))
    wild = (tx.text_or_blank(column_or(decisions, "amount")) == "") & (F.col("__div_ccy") == "")
    values = ["action", "economic_event_id", "anchor_date"]
    keyed = keyed.withColumns({c: tx.text_or_blank(column_or(decisions, c)) for c in values})
    exact = keyed.where(~wild).select(*[f"__{c}" for c in EXACT_KEY], F.struct(*values).alias("__exact"))
    loose = keyed.where(wild).select(*[f"__{c}" for c in WILD_KEY], F.struct(*values).alias("__wild"))
    return exact, loose


def duplicate_decisions(decisions: DataFrame) -> DataFrame:
    """Decision keys stated more than once, exact and wildcard keys apart."""
    exact, loose = _split_keys(decisions)
    names = lambda cols: [F.col(f"__{c}").alias(c) for c in cols]
    exact = exact.groupBy(*names(EXACT_KEY)).count().withColumn("kind", F.lit("exact"))
    loose = loose.groupBy(*names(WILD_KEY)).count().withColumn("kind", F.lit("wildcard"))
    return exact.unionByName(loose, allowMissingColumns=True).where(F.col("count") > 1)


def apply_qa_decisions(rows: DataFrame, decisions: DataFrame, check: bool = True) -> DataFrame:
    """DROP, SET_ECON_ID and SET_ANCHOR_DATE; an exact key beats a wildcard key."""
    require_columns(rows, [*EXACT_KEY, "economic_event_id"], "decisions")
    if check:
        repeated = duplicate_decisions(decisions).limit(20).collect()
        if repeated:
            raise ValueError(f"decision keys stated more than once: {[r.asDict() for r in repeated]}")
    exact, loose = _split_keys(decisions)
    df = rows.withColumns(_match_columns(rows))
    exact_match = F.lit(True)
    for c in [*WILD_KEY, "div_ccy"]:
        exact_match = exact_match & (df[f"__{c}"] == exact[f"__{c}"])
    exact_match = exact_match & df["__amount"].eqNullSafe(exact["__amount"])
    df = df.join(exact, exact_match, "left").select(df["*"], exact["__exact"])
    df = df.join(loose, [f"__{c}" for c in WILD_KEY], "left")

    hit = F.coalesce(F.col("__exact"), F.col("__wild"))
    df = df.withColumn("__hit", hit).where(F.coalesce(F.col("__hit.action") != "DROP", F.lit(True)))
    out = df.withColumn(
        "economic_event_id",
        F.when(F.col("__hit.action") == "SET_ECON_ID", F.col("__hit.economic_event_id")).otherwise(
            F.col("economic_event_id")
        ),
    )
    if "anchor_date" in rows.columns:
        out = out.withColumn(
            "anchor_date",
            F.when(F.col("__hit.action") == "SET_ANCHOR_DATE", vl.to_day(F.col("__hit.anchor_date"))).otherwise(
                vl.day_in(rows, "anchor_date")
            ),
        )
    return out.select(*rows.columns)


# --- reviewed pairs --------------------------------------------------------------------------


def pair_key(a: Column, b: Column) -> Column:
    """Order-independent key of two event ids."""
    a, b = tx.text_or_blank(a), tx.text_or_blank(b)
    return F.concat(F.least(a, b), F.lit("||"), F.greatest(a, b))


def suppress_reviewed(pairs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Drop pairs reviewed as KEEP, whichever way round they were written."""
    keep = decisions.where(F.col("decision") == "KEEP").select(
        pair_key(F.col("econ_id_a"), F.col("econ_id_b")).alias("__pair")
    )
    keyed = pairs.withColumn("__pair", pair_key(F.col("econ_id_a"), F.col("econ_id_b")))
    return keyed.join(keep, "__pair", "left_anti").drop("__pair")


def merge_pairs(decisions: DataFrame) -> DataFrame:
    """(event id, canonical id) stated by MERGE decisions; the last statement per id wins."""
    decisions = with_row_no(decisions)
    a, b = tx.text_or_blank(F.col("econ_id_a")), tx.text_or_blank(F.col("econ_id_b"))
    canonical = F.coalesce(F.nullif(tx.text_or_blank(column_or(decisions, "canonical_econ_id")), F.lit("")), a)
    return (
        decisions.where((F.col("decision") == "MERGE") & (a != "") & (b != ""))
        .groupBy(b.alias("event_id"))
        .agg(F.max_by(canonical, F.col("row_no")).alias("canonical_id"))
    )


def close_map(pairs: DataFrame) -> DataFrame:
    """Follow chains of (event_id -> canonical_id) to their ends by pointer jumping.

    Every round doubles the distance covered, so a chain of n links needs log2(n) rounds. A cycle has
    no end and is an error.
    """
    current = cut_lineage(pairs.select("event_id", "canonical_id"))
    own_before = current.where(F.col("event_id") == F.col("canonical_id")).count()
    rounds = max(1, math.ceil(math.log2(max(2, current.count()))) + 1)
    for _ in range(rounds):
        nxt = current.select(F.col("event_id").alias("canonical_id"), F.col("canonical_id").alias("__next"))
        moved = F.coalesce(F.col("__next") != F.col("canonical_id"), F.lit(False))
        jumped = cut_lineage(
            current.join(nxt, "canonical_id", "left").select(
                "event_id", F.coalesce("__next", "canonical_id").alias("canonical_id"), moved.alias("__moved")
            )
        )
        current = jumped.drop("__moved")
        if jumped.where("__moved").isEmpty():
            if current.where(F.col("event_id") == F.col("canonical_id")).count() == own_before:
                return current
            break
    raise ValueError("merge decisions form a cycle")


def merge_map(decisions: DataFrame) -> DataFrame:
    return close_map(merge_pairs(decisions))


def apply_merges(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace event ids by their canonical ids."""
    left = rows.withColumn("__key", spread_key(rows, "economic_event_id"))
    right = mapping.select(F.concat(F.lit("v"), F.col("event_id")).alias("__key"), "canonical_id")
    out = left.join(right, "__key", "left")
    return out.withColumn("economic_event_id", F.coalesce("canonical_id", "economic_event_id")).select(*rows.columns)


def regraded(
    graded: DataFrame, events: DataFrame, mapping: DataFrame, policy: sv.SeverityPolicy | None = None
) -> tuple[DataFrame, DataFrame]:
    """Graded rows and events after a merge, as if all rows had been graded anew.

    Only the events that ``mapping`` names, on either side, can change: their rows are moved and graded, all others stay
    as they are. A mapping is a table of decisions, written before, so Spark knows its size; kept rows are told from
    moved ones by it wherever they are read, without a shuffle when it is small. ``graded`` and ``events`` are read
    twice, so pass written ones.
    """
    named = mapping.select("event_id").union(mapping.select("canonical_id")).distinct()
    named = named.select(F.concat(F.lit("v"), F.col("event_id")).alias("__key"))
    keyed = graded.withColumn("__key", spread_key(graded, "economic_event_id"))
    moved = keyed.join(named, "__key", "left_semi").drop("__key", "severity_tier", "severity_reasons")
    moved = cut_lineage(apply_merges(moved, mapping))
    fresh = cut_lineage(sv.with_summary(sv.event_severity(moved, policy), policy))
    kept_rows = keyed.join(named, "__key", "left_anti").drop("__key")
    kept_events = events.withColumn("__key", F.concat(F.lit("v"), F.col("economic_event_id")))
    kept_events = kept_events.join(named, "__key", "left_anti").drop("__key")
    return kept_rows.unionByName(sv.attach_severity(moved, fresh)), kept_events.unionByName(fresh)
