"""Stage 2: link observations, grade events, apply decisions and route the rest to review."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators import decisions as dc
from eventloom.operators import gates
from eventloom.operators import pairs as pr
from eventloom.operators import severity as sv
from eventloom.operators.linking import LinkPolicy, assign_event_ids
from eventloom.operators.regions import region_split
from eventloom.session import cut_lineage
from eventloom.sinks.tables import write_table


@dataclass(frozen=True)
class Stage2Options:
    link: LinkPolicy = field(default_factory=LinkPolicy)
    severity: sv.SeverityPolicy = field(default_factory=sv.stage2_policy)
    respect_existing: bool = False
    max_tier0_ratio: float | None = None
    pairs_enabled: bool = False
    pairs: pr.PairPolicy = field(default_factory=pr.PairPolicy)
    suppress_reviewed: bool = False


@dataclass(frozen=True)
class Stage2Tables:
    rows: DataFrame
    events: DataFrame
    review_events: DataFrame
    review_rows: DataFrame
    regions: dict[str, DataFrame]
    cases: DataFrame | None = None
    pairs: DataFrame | None = None
    pair_queue: DataFrame | None = None
    pair_members: DataFrame | None = None
    row_pairs: DataFrame | None = None
    pair_events: DataFrame | None = None


# Where events and graded rows are written before the rest reads them: by table and artefact name.
Keep = Callable[[DataFrame, str], DataFrame]


def _keep_aside(df: DataFrame, name: str) -> DataFrame:
    return cut_lineage(df)


def _keep_in(base: str) -> Keep:
    def keep(df: DataFrame, name: str) -> DataFrame:
        write_table(df, f"{base}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{base}/{name}")

    return keep


def outputs(rows: DataFrame, options: Stage2Options, keep: Keep = _keep_aside) -> Stage2Tables:
    """Events and everything that follows from linked rows; events and graded rows are written once and read by the rest."""
    events = keep(sv.with_summary(sv.event_severity(rows, options.severity), options.severity), "events")
    return _tables(keep(sv.attach_severity(rows, events), "rows"), events, options)


def _tables(graded: DataFrame, events: DataFrame, options: Stage2Options) -> Stage2Tables:
    queue = sv.review_events(events)
    has_cases = "case_tag" in graded.columns
    has_pairs = set(pr.PAIR_INPUT) <= set(graded.columns)
    return Stage2Tables(
        rows=graded,
        events=events,
        review_events=queue,
        review_rows=sv.evidence_rows(graded, queue),
        regions=region_split(graded),
        cases=sv.case_order(sv.case_view(graded, events, options.severity)) if has_cases else None,
        pairs=pr.pair_cells(graded, options.pairs) if has_pairs else None,
    )


def stage2(
    observations: DataFrame,
    qa_decisions: DataFrame | None = None,
    pair_decisions: DataFrame | None = None,
    options: Stage2Options = Stage2Options(),
    keep: Keep = _keep_aside,
) -> Stage2Tables:
    """Decisions come after linking, so they never re-link rows.

    After a merge the events it names are graded anew; all tables but the pair queue follow from the new grades.
    """
    rows = assign_event_ids(observations, options.link, respect_existing=options.respect_existing)
    if qa_decisions is not None:
        rows = dc.apply_qa_decisions(rows, qa_decisions)
    # Linking is the costly part and four tables read its result.
    rows = cut_lineage(rows)
    tables = outputs(rows, options, keep)
    if options.pairs_enabled and tables.pairs is not None:
        tables = _with_pair_queue(tables, pair_decisions, options)
    if options.max_tier0_ratio is not None:
        gates.require(gates.tier0_gate(tables.events, options.max_tier0_ratio), "tier-0 share of events")
    return tables


def _with_pair_queue(tables: Stage2Tables, decisions: DataFrame | None, options: Stage2Options) -> Stage2Tables:
    """The queue as a table of cell pairs with their members, and as all its row pairs, which the reviewers go through."""
    # Written once: the pairs are an artefact of their own, and the queue, its members and their events follow from them.
    pairs = cut_lineage(tables.pairs)
    tables = replace(tables, pairs=pairs)
    graded, queue = tables.rows, pairs
    if decisions is not None:
        if options.suppress_reviewed:
            queue = dc.suppress_reviewed(queue, decisions)
        if not decisions.where(F.col("decision") == "MERGE").isEmpty():
            tables = _tables(*dc.regraded(graded, tables.events, dc.merge_map(decisions), options.severity), options)
    if queue is not pairs:
        queue = cut_lineage(queue)
    members = pr.pair_members(graded, queue)
    return replace(
        tables,
        pair_queue=pr.cell_order(queue),
        pair_members=members.select("cell", "row_idx", "case_tag", "vendor_event_id"),
        row_pairs=pr.queue_order(pr.row_pairs(queue, members)),
        pair_events=pr.pair_events(tables.events, queue),
    )


def write(tables: Stage2Tables, root: str, no_events: DataFrame | None = None, written: bool = False) -> None:
    """Every stage-2 artefact; pair tables only when the pair queue was asked for. ``written``: rows and events lie there."""
    base = f"{root}/stage2"
    if not written:
        write_table(tables.rows, f"{base}/rows")
        write_table(tables.events, f"{base}/events")
    write_table(tables.review_events, f"{base}/review_events")
    write_table(tables.review_rows, f"{base}/review_rows")
    for name, df in tables.regions.items():
        write_table(df, f"{base}/rows_{name}")
    if no_events is not None:
        for name, df in region_split(no_events).items():
            if name != "non_brazil":
                write_table(df, f"{base}/no_events_{name}")
    # The queue on disk has the row pairs; its cells lie beside it.
    last = {name: getattr(tables, name) for name in ("cases", "pairs", "pair_members", "pair_events")}
    for name, df in (last | {"pair_cells": tables.pair_queue, "pair_queue": tables.row_pairs}).items():
        if df is not None:
            write_table(df, f"{base}/{name}")


def run(
    spark: SparkSession,
    root: str,
    observations: DataFrame,
    qa_decisions: DataFrame | None = None,
    pair_decisions: DataFrame | None = None,
    no_events: DataFrame | None = None,
    options: Stage2Options = Stage2Options(),
) -> Stage2Tables:
    """Gates first, then the writes. Rows and events that nothing can stop or change go to their place at once."""
    final = options.max_tier0_ratio is None and pair_decisions is None
    keep = _keep_in(f"{root}/stage2") if final else _keep_aside
    tables = stage2(observations, qa_decisions, pair_decisions, options, keep)
    write(tables, root, no_events, written=final)
    return tables
