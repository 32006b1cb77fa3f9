"""Operator decision files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.operators.linking import column_or
from eventloom.operators.severity import require_columns
from eventloom.sources.tables import read_table, with_row_no

QA_REQUIRED = ["vendor_event_id", "underlying", "ex_date", "action"]
QA_OPTIONAL = ["amount", "div_ccy", "economic_event_id", "anchor_date", "note"]
QA_ACTIONS = ["DROP", "SET_ECON_ID", "SET_ANCHOR_DATE"]
PAIR_COLUMNS = ["enabled", "underlying", "econ_id_a", "econ_id_b", "decision", "canonical_econ_id", "note"]
ENABLED = ["1", "true", "yes"]


def qa_decision_problems(decisions: DataFrame) -> DataFrame:
    """One row: unknown actions and actions without the value they need."""
    action = F.col("action")
    blank = lambda c: tx.text_or_blank(column_or(decisions, c)) == ""
    return decisions.agg(
        F.count(F.when(~action.isin(QA_ACTIONS), 1)).alias("unknown_actions"),
        F.count(F.when((action == "SET_ECON_ID") & blank("economic_event_id"), 1)).alias("missing_event_ids"),
        F.count(F.when((action == "SET_ANCHOR_DATE") & blank("anchor_date"), 1)).alias("missing_anchor_dates"),
    )


def clean_qa_decisions(raw: DataFrame, check: bool = True) -> DataFrame:
    """Trimmed decisions with upper-case actions; disabled rows are left out, bad ones are an error."""
    require_columns(raw, QA_REQUIRED, "decisions")
    texts = [c for c in [*QA_REQUIRED, *QA_OPTIONAL] if c in raw.columns and c not in ("amount", "note")]
    df = raw.withColumns({c: tx.text_or_blank(F.col(c)) for c in texts}).withColumn("action", F.upper("action"))
    if check:
        problems = {k: v for k, v in qa_decision_problems(df).first().asDict().items() if v}
        if problems:
            raise ValueError(f"decisions are not usable: {problems}")
    if "enabled" in df.columns:
        df = df.where(F.lower(F.col("enabled").cast("string")).isin(ENABLED))
    return df


def read_qa_decisions(spark: SparkSession, path: str) -> DataFrame:
    return clean_qa_decisions(read_table(spark, path, multi_line=True))


def clean_pair_decisions(raw: DataFrame) -> DataFrame:
    """Enabled KEEP / MERGE decisions that name two events."""
    df = with_row_no(raw)
    df = df.withColumns({c: tx.text_or_blank(column_or(df, c)) for c in PAIR_COLUMNS})
    df = df.withColumns({"enabled": F.lower("enabled"), "decision": F.upper("decision")})
    return df.where(
        F.col("enabled").isin(ENABLED)
        & F.col("decision").isin("KEEP", "MERGE")
        & (F.col("econ_id_a") != "")
        & (F.col("econ_id_b") != "")
    )


def read_pair_decisions(spark: SparkSession, path: str) -> DataFrame:
    return clean_pair_decisions(read_table(spark, path, multi_line=True))
