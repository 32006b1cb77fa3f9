"""Run-level gates: one-row verdict tables, and functions that stop the run on a breach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators import ticker_qa as tq
from eventloom.operators.severity import tier0_ratio

EPSILON = 1e-12


class GateError(RuntimeError):
    """A run-level limit is breached."""


def verdicts(measures: DataFrame, limits: dict[str, float | None], epsilon: float = 0.0, by: list[str] | None = None):
    """(by..., metric, value, threshold, breached) for every limit that is set."""
    cells = [
        F.struct(
            F.lit(metric).alias("metric"),
            F.col(metric).cast("double").alias("value"),
            F.lit(float(limit)).alias("threshold"),
            (F.col(metric) > F.lit(float(limit)) + F.lit(epsilon)).alias("breached"),
        )
        for metric, limit in limits.items()
        if limit is not None
    ]
    if not cells:
        raise ValueError("no limit is set")
    return measures.select(*(by or []), F.inline(F.array(*cells)))


def require(verdict: DataFrame, what: str, detail: str = "") -> None:
    breached = verdict.where("breached").limit(20).collect()
    if breached:
        raise GateError(f"{what}: {[r.asDict() for r in breached]} {detail}".strip())


def tier0_gate(events: DataFrame, max_ratio: float) -> DataFrame:
    if not 0.0 <= max_ratio <= 1.0:
        raise ValueError(f"max tier-0 ratio must lie in [0, 1], got {max_ratio}")
    return verdicts(tier0_ratio(events), {"tier0_ratio": max_ratio})


def _limits(unmatched: bool, single: float | None, total: float | None) -> dict[str, float | None]:
    return {
        "unmatched_failed_count": 0.0 if unmatched else None,
        "max_failed_weight": single,
        "failed_weight_sum": total,
    }


def tag_gate(
    report: DataFrame, unmatched: bool = False, single: float | None = None, total: float | None = None
) -> DataFrame:
    """Limits per dataset tag; strict comparison."""
    measures = tq.materiality(report, ["holdings_tag"])
    return verdicts(measures, _limits(unmatched, single, total), by=["holdings_tag"])


def materiality_gate(
    report: DataFrame, unmatched: bool = False, single: float | None = None, total: float | None = None
) -> DataFrame:
    """Limits over a whole report; weights may exceed theirs by rounding."""
    return verdicts(tq.materiality(report), _limits(unmatched, single, total), EPSILON)


def require_materiality(report: DataFrame, **limits) -> None:
    """Stop on a breach and name the heaviest failed rows."""
    verdict = materiality_gate(report, **limits)
    if not verdict.where("breached").isEmpty():
        require(verdict, "ticker materiality", f"top_failed=[{tq.top_failed_text(report)}]")


def fallback_gate(report: DataFrame) -> DataFrame:
    """Breached when a fallback weight is attached to more than one row."""
    return verdicts(tq.weight_diagnostics(report), {"fallback_duplicate_rows": 0.0})


def columns_gate(inputs: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(input, required_column, rows, breached) for every column a stage asks of its inputs.

    ``rows`` counts what the stage would have read, so a table without the column and one without rows are told apart.
    """
    if not inputs:
        raise ValueError("no input is named")
    out = None
    for name, (df, required) in inputs.items():
        cells = [F.struct(F.lit(c).alias("required_column"), F.lit(c not in df.columns).alias("breached")) for c in required]
        counted = df.agg(F.count(F.lit(1)).alias("rows"))
        one = counted.select(F.lit(name).alias("input"), "rows", F.inline(F.array(*cells)))
        one = one.select("input", "required_column", "rows", "breached")
        out = one if out is None else out.unionByName(one)
    return out
