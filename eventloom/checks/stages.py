"""Queries on whole stages: what a run computes and what it writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.checks.decisions import PAIR_QUEUE, WIDE
from eventloom.checks.holdings import scratch
from eventloom.checks.linking import BR, KR, SEVERITY_SQL, linked_sql
from eventloom.checks.registry import Tables, query
from eventloom.plans import stage2 as s2

STAGE2 = f"{linked_sql()}, {SEVERITY_SQL.format(rows='linked', guard='FALSE')}, graded AS (SELECT l.*, severity_tier FROM linked l LEFT JOIN sev USING (economic_event_id))"
# Regions are split after linking, so they see the cleaned currency and the raw ISIN.
COUNTS = f"""SELECT 'rows' AS artefact, count(*) AS n FROM graded UNION ALL SELECT 'events', count(*) FROM sev
UNION ALL SELECT 'review_events', count(*) FROM sev WHERE severity_tier < 2 UNION ALL SELECT 'review_rows', count(*) FROM graded WHERE severity_tier < 2
UNION ALL SELECT 'rows_brazil', count(*) FROM graded WHERE {BR} UNION ALL SELECT 'rows_non_brazil', count(*) FROM graded WHERE NOT {BR}
UNION ALL SELECT 'rows_korea', count(*) FROM graded WHERE {KR}
UNION ALL SELECT 'cases', count(*) FROM (SELECT DISTINCT case_tag, economic_event_id FROM graded WHERE case_tag IS NOT NULL) c"""
PLAIN = ["rows", "events", "review_events", "review_rows", "rows_brazil", "rows_non_brazil", "rows_korea", "cases"]


def observations(t: Tables) -> DataFrame:
    return t.view("v_obs").withColumn("vendor_event_id", F.lit(""))


def counted(frames: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in frames.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("artefact"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("rep9_stage2", f"WITH {STAGE2} {COUNTS}")
def _(t: Tables) -> DataFrame:
    tables = s2.stage2(observations(t))
    frames = {n: getattr(tables, n) for n in PLAIN if not n.startswith("rows_")}
    return counted(frames | {f"rows_{name}": df for name, df in tables.regions.items()})


@query("snk5_stage2_artefacts", f"WITH {STAGE2} {COUNTS}")
def _(t: Tables) -> DataFrame:
    root = scratch(t, "stage2")
    s2.run(t.spark, root, observations(t))
    return counted({name: t.spark.read.parquet(f"{root}/stage2/{name}") for name in PLAIN})


LINKED_PAIRS = PAIR_QUEUE.format(pay=3, amount=5.0).replace("r AS (SELECT *, div_ccy AS ccy, primary_ident AS ident, anchor_date AS anchor FROM v_rows)", "r AS (SELECT * REPLACE (coalesce(ccy, '') AS div_ccy) FROM linked)")


@query(
    "snk6_pair_artefacts",
    f"""WITH {STAGE2}, {LINKED_PAIRS},
    c AS (SELECT DISTINCT x.underlying, x.econ_id, x.ex, x.pay, x.amount, x.ccy, y.econ_id AS econ_id_2, y.ex AS ex_2, y.pay AS pay_2, y.amount AS amount_2, y.ccy AS ccy_2
      FROM q JOIN b x ON x.row_idx = row_idx_a JOIN b y ON y.row_idx = row_idx_b)
    SELECT 'pair_queue' AS artefact, count(*) AS n FROM q UNION ALL SELECT 'pair_cells', count(*) FROM c
    UNION ALL SELECT 'pair_members', count(*) FROM (SELECT row_idx_a FROM q UNION SELECT row_idx_b FROM q) m
    UNION ALL SELECT 'pair_events', count(*) FROM sev WHERE economic_event_id IN (SELECT econ_id_a FROM q UNION SELECT econ_id_b FROM q)""",
)
def _(t: Tables) -> DataFrame:
    root = scratch(t, "pairs")
    options = s2.Stage2Options(pairs_enabled=True, pairs=WIDE)
    s2.run(t.spark, root, observations(t), options=options)
    return counted({name: t.spark.read.parquet(f"{root}/stage2/{name}") for name in ("pair_queue", "pair_cells", "pair_members", "pair_events")})
