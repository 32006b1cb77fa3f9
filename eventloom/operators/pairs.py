"""Pairs of near-by observations of one underlying that may be one event with a drifting ex date."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.functions import values as vl
from eventloom.operators.severity import require_columns
from eventloom.session import cut_lineage

PAIR_INPUT = [
    "case_tag",
    "underlying",
    "ex_date",
    "pay_date",
    "amount",
    "div_ccy",
    "economic_event_id",
    "vendor_event_id",
]
OBSERVATION = ["ex_date", "pay_date", "amount", "div_ccy", "econ_id"]
SIDE = ["case_tag", "economic_event_id", "vendor_event_id", "ex_date", "pay_date", "amount"]


@dataclass(frozen=True)
class PairPolicy:
    ex_shift_days_ge: int = 1
    pay_shift_days_le: int = 1
    amount_abs_diff_le: float = 0.02
    require_same_ccy: bool = False
    max_ex_shift_window_days: int = 30


def pair_rows(rows: DataFrame, tagged_only: bool = True) -> DataFrame:
    """Rows that may pair: a case tag starting with ``O3`` and an ex date.

    ``tagged_only=False`` pairs every row with an ex date.
    """
    require_columns(rows, PAIR_INPUT, "pairs")
    df = rows.withColumns(
        {
            "__ex": vl.day_in(rows, "ex_date"),
            "__pay": vl.day_in(rows, "pay_date"),
            "__amt": vl.number_in(rows, "amount"),
            "__ccy": F.upper(tx.text_or_blank(F.col("div_ccy"))),
        }
    ).where(F.col("__ex").isNotNull() & F.col("underlying").isNotNull())
    if tagged_only:
        df = df.where(F.col("case_tag").startswith("O3"))
    return df.select(*PAIR_INPUT, "row_idx", "__ex", "__pay", "__amt", "__ccy")


def _side(df: DataFrame, letter: str) -> DataFrame:
    """Rename every column but the underlying so that two sides can be joined."""
    return df.select("underlying", *[F.col(c).alias(f"{c}_{letter}") for c in df.columns if c != "underlying"])


def _place(letter: str) -> Column:
    """Order of rows with the same ex date: pay date, amount (missing last), input order."""
    return F.struct(
        F.col(f"__pay_{letter}").isNull(),
        F.col(f"__pay_{letter}"),
        F.col(f"__amt_{letter}").isNull(),
        F.col(f"__amt_{letter}"),
        F.col(f"row_idx_{letter}"),
    )


def _describe(joined: DataFrame) -> DataFrame:
    """Pair columns from two joined sides."""
    names = {"economic_event_id": "econ_id"}
    return joined.select(
        "underlying",
        *[F.col(f"{c}_{s}").alias(f"{names.get(c, c)}_{s}") for c in SIDE for s in "ab"],
        F.col("__ccy_a").alias("div_ccy"),
        (F.col("__ccy_a") == F.col("__ccy_b")).alias("same_ccy"),
        F.abs(F.col("__amt_a") - F.col("__amt_b")).alias("amount_abs_diff"),
        F.datediff("__ex_b", "__ex_a").alias("ex_date_abs_shift_days"),
        F.abs(F.datediff("__pay_b", "__pay_a")).alias("pay_date_abs_shift_days"),
        "row_idx_a",
        "row_idx_b",
    )


CELL = ["underlying", "__ex", "__pay", "__amt"]


def _complete(rows: DataFrame, tagged_only: bool) -> DataFrame:
    return pair_rows(rows, tagged_only).where(F.col("__pay").isNotNull() & F.col("__amt").isNotNull())


def _cell_pairs(base: DataFrame, p: PairPolicy) -> DataFrame:
    """Pairs of distinct (underlying, ex, pay, amount) cells within the limits."""
    pay_width = p.pay_shift_days_le + 1
    amount_width = max(p.amount_abs_diff_le, 1e-9)
    cells = base.select(*CELL).distinct()
    banded = cells.withColumns(
        {
            "__pb": F.floor(F.unix_date("__pay") / pay_width),
            "__ab": F.floor(F.col("__amt") / amount_width),
        }
    )
    near = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    left = _side(banded, "a").withColumn("__pb", F.explode(F.transform(near, lambda d: F.col("__pb_a") + d)))
    left = left.withColumn("__ab", F.explode(F.transform(near, lambda d: F.col("__ab_a") + d))).drop("__pb_a", "__ab_a")
    right = _side(banded, "b").withColumnsRenamed({"__pb_b": "__pb", "__ab_b": "__ab"})
    shift = F.datediff("__ex_b", "__ex_a")
    met = left.join(right, ["underlying", "__pb", "__ab"]).where(
        shift.between(max(p.ex_shift_days_ge, 0), p.max_ex_shift_window_days)
        & (F.abs(F.datediff("__pay_b", "__pay_a")) <= p.pay_shift_days_le)
        & (F.abs(F.col("__amt_a") - F.col("__amt_b")) <= p.amount_abs_diff_le)
    )
    return met.drop("__pb", "__ab")


SEEN = [*CELL, "__ccy", "economic_event_id"]


def _cell_id() -> Column:
    """Id of an observation: the same for all its copies, in every run. Missing parts differ from empty ones."""
    return F.substring(F.sha2(F.to_json(F.struct(*SEEN)), 256), 1, 32)


def pair_cells(rows: DataFrame, policy: PairPolicy | None = None, tagged_only: bool = True) -> DataFrame:
    """All pairs of distinct observations within the limits, with the row counts of either side.

    An observation, or cell, is (underlying, ex, pay, amount, currency, event); copies of it are counted, not paired,
    so the table follows what was observed and not how often. ``pair_members`` says which rows a cell has, and
    ``row_pairs`` pairs them where somebody asks. Without a least ex shift an observation also pairs with its own copies.
    """
    p = policy or PairPolicy()
    base = _complete(rows, tagged_only)
    seen = SEEN
    counted = base.groupBy(*seen).agg(F.count(F.lit(1)).alias("rows")).withColumn("cell", _cell_id())
    a, b = _side(counted, "a"), _side(counted, "b")
    joined = _cell_pairs(base, p).join(a, [CELL[0], *[f"{c}_a" for c in CELL[1:]]]).join(b, [CELL[0], *[f"{c}_b" for c in CELL[1:]]])
    n_pairs = F.col("rows_a") * F.col("rows_b")
    if p.ex_shift_days_ge <= 0:
        place = lambda s: F.struct(*[F.col(f"{c}_{s}") for c in seen[1:]])
        same = place("a") == place("b")
        joined = joined.where((place("a") < place("b")) | (same & (F.col("rows_a") > 1)))
        n_pairs = F.when(same, F.floor(F.col("rows_a") * (F.col("rows_a") - 1) / 2)).otherwise(n_pairs)
    if p.require_same_ccy:
        joined = joined.where(F.col("__ccy_a") == F.col("__ccy_b"))
    return joined.select(
        "underlying",
        *[F.col(f"{c}_{s}").alias(f"{n}_{s}") for c, n in zip(seen[1:], OBSERVATION, strict=True) for s in "ab"],
        (F.col("__ccy_a") == F.col("__ccy_b")).alias("same_ccy"),
        F.abs(F.col("__amt_a") - F.col("__amt_b")).alias("amount_abs_diff"),
        F.datediff("__ex_b", "__ex_a").alias("ex_date_abs_shift_days"),
        F.abs(F.datediff("__pay_b", "__pay_a")).alias("pay_date_abs_shift_days"),
        "rows_a",
        "rows_b",
        n_pairs.alias("n_pairs"),
        "cell_a",
        "cell_b",
    )


def pair_members(rows: DataFrame, cells: DataFrame | None = None, tagged_only: bool = True) -> DataFrame:
    """Rows of every cell: cell, row_idx and what tells the rows of a cell apart. With ``cells``, only those it pairs."""
    base = _complete(rows, tagged_only).withColumn("cell", _cell_id())
    members = base.select("cell", "row_idx", "case_tag", "vendor_event_id", "ex_date", "pay_date", "amount", *CELL, "__ccy", "economic_event_id")
    if cells is not None:
        paired = cells.select(F.explode(F.array("cell_a", "cell_b")).alias("cell")).distinct()
        members = members.join(paired, "cell", "left_semi")
    return members


def row_pairs(cells: DataFrame, members: DataFrame) -> DataFrame:
    """The row pairs of the given cell pairs: as many as rows meet, so for those that are looked at one by one.

    The first row is the one of the earlier ex date, then pay date, amount and input order.
    """
    a, b = _side(members, "a").drop("underlying"), _side(members, "b").drop("underlying")
    met = cells.select("underlying", "cell_a", "cell_b").join(a, "cell_a").join(b, "cell_b")
    met = met.where((F.col("cell_a") != F.col("cell_b")) | (F.col("row_idx_a") < F.col("row_idx_b")))
    # Cells that differ only in currency or event are not ordered by what orders rows.
    turned = (F.col("__ex_a") == F.col("__ex_b")) & (_place("b") < _place("a"))
    names = [c.removesuffix("_a") for c in met.columns if c.endswith("_a") and c != "cell_a"]
    sides = [F.when(turned, F.col(f"{c}_{o}")).otherwise(F.col(f"{c}_{s}")).alias(f"{c}_{s}") for c in names for s, o in ("ab", "ba")]
    return _describe(met.select("underlying", *sides))


def pair_queue(rows: DataFrame, policy: PairPolicy | None = None, tagged_only: bool = True) -> DataFrame:
    """All row pairs within the ex, pay and amount limits; nothing is capped.

    Cells meet first, on underlying, pay band and amount band, which holds for a hot underlying too. Their rows are
    paired last, so this is as large as the copies make it: stages keep cells and membership instead.
    """
    cells = pair_cells(rows, policy, tagged_only)
    return row_pairs(cells, pair_members(rows, tagged_only=tagged_only))


def queue_order(pairs: DataFrame) -> DataFrame:
    return pairs.orderBy(
        "underlying", F.desc("ex_date_abs_shift_days"), "amount_abs_diff", "row_idx_a", "row_idx_b"
    )


def cell_order(cells: DataFrame) -> DataFrame:
    return cells.orderBy("underlying", F.desc("ex_date_abs_shift_days"), "amount_abs_diff", "cell_a", "cell_b")


def filter_pairs(pairs: DataFrame, policy: PairPolicy | None = None) -> DataFrame:
    """The same limits on a pair table that exists already; an unknown pay shift fails."""
    p = policy or PairPolicy()
    keep = (
        (F.coalesce(F.col("ex_date_abs_shift_days"), F.lit(0)) >= p.ex_shift_days_ge)
        & (F.coalesce(F.col("pay_date_abs_shift_days").try_cast("bigint"), F.lit(10**9)) <= p.pay_shift_days_le)
        & F.coalesce(F.col("amount_abs_diff") <= p.amount_abs_diff_le, F.lit(False))
    )
    if p.require_same_ccy:
        keep = keep & F.coalesce(tx.flag(F.col("same_ccy")), F.lit(False))
    return pairs.where(keep)


def first_pairs(
    rows: DataFrame, max_pairs: int, window_days: int = 30, tagged_only: bool = True
) -> DataFrame:
    """The first ``max_pairs`` pairs within the ex window, in order of underlying, first and second row.

    A report of fixed size over a set that grows with the square of the rows, so pairs are counted
    before any is built: counts per underlying and ex date say which dates hold the report's pairs,
    and only as many rows of those dates as it can need are read.
    """
    df = pair_rows(rows, tagged_only)
    per_day = df.groupBy("underlying", "__ex").agg(F.count(F.lit(1)).alias("n"))
    by_day = Window.partitionBy("underlying").orderBy(F.unix_date("__ex"))
    per_day = per_day.withColumn("later", F.coalesce(F.sum("n").over(by_day.rangeBetween(1, window_days)), F.lit(0)))
    n, later = F.col("n").cast("double"), F.col("later").cast("double")
    per_day = per_day.withColumn("pairs", n * (n - 1) / 2 + n * later)

    # Every listed underlying has a pair, so the report cannot reach beyond the first max_pairs of them.
    totals = per_day.groupBy("underlying").agg(F.sum("pairs").alias("pairs")).where(F.col("pairs") > 0)
    totals = totals.orderBy("underlying").limit(max_pairs)
    before = Window.orderBy("underlying").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("quota", max_pairs - F.coalesce(F.sum("pairs").over(before), F.lit(0.0)))
    totals = totals.where(F.col("quota") > 0).select("underlying", "quota")

    earlier = Window.partitionBy("underlying").orderBy("__ex").rowsBetween(Window.unboundedPreceding, -1)
    days = per_day.join(totals, "underlying")
    days = days.withColumn("before", F.coalesce(F.sum("pairs").over(earlier), F.lit(0.0)))
    days = days.withColumn("starts", (F.col("before") < F.col("quota")) & (F.col("pairs") > 0))
    whole = Window.partitionBy("underlying")
    first_day = F.min(F.when(F.col("starts"), F.col("__ex"))).over(whole)
    last_day = F.date_add(F.max(F.when(F.col("starts"), F.col("__ex"))).over(whole), window_days)
    # No row beyond these of a day can be in the report, and a day's rows come after those of the days before.
    most = 2 * max_pairs + 1
    days = days.withColumn("reached", F.col("__ex").between(first_day, last_day)).where("reached").drop("reached")
    days = days.withColumn("offset", F.coalesce(F.sum(F.least("n", F.lit(most))).over(earlier), F.lit(0)))
    days = days.withColumn("parts", F.greatest(F.ceil(F.sqrt(F.col("n") / most)), F.lit(1)))
    # As large as the report, not the rows; written, so that the planner knows.
    days = cut_lineage(days)
    starts = days.where("starts").drop("starts", "offset", "parts")

    # The first rows of a day are those of its parts, so no task ranks a whole hot day, let alone an underlying.
    near = df.join(days.select("underlying", "__ex", "offset", "parts"), ["underlying", "__ex"])
    near = near.withColumn("part", F.pmod(F.xxhash64("row_idx"), F.col("parts")))
    place = [F.col("__pay").asc_nulls_last(), F.col("__amt").asc_nulls_last(), F.col("row_idx")]
    for cut in (["underlying", "__ex", "part"], ["underlying", "__ex"]):
        near = near.withColumn("r", F.row_number().over(Window.partitionBy(*cut).orderBy(*place))).where(F.col("r") <= most)
    near = near.withColumn("pos", F.col("offset") + F.col("r")).drop("offset", "parts", "part")

    r = F.col("r").cast("double")
    n, later = F.col("n").cast("double"), F.col("later").cast("double")
    first = near.join(starts, ["underlying", "__ex"])
    first = first.withColumns(
        {
            "partners": F.col("n") - F.col("r") + F.col("later"),
            "start": F.col("before") + (r - 1) * (n + later) - (r - 1) * r / 2,
        }
    )
    take = F.least(F.col("partners").cast("double"), F.col("quota") - F.col("start")).cast("int")
    first = first.withColumn("take", take).where((F.col("partners") > 0) & (F.col("take") > 0))
    first = first.drop("n", "later", "pairs", "quota", "before", "partners", "start")
    a = _side(first, "a").withColumn("pos_b", F.explode(F.expr("sequence(pos_a + 1, pos_a + take_a)")))
    return _describe(a.join(_side(near, "b"), ["underlying", "pos_b"]))


def pair_events(events: DataFrame, pairs: DataFrame) -> DataFrame:
    """Events named on either side of a pair, worst first."""
    ids = pairs.select(F.explode(F.array("econ_id_a", "econ_id_b")).alias("economic_event_id"))
    ids = ids.where(tx.text_or_blank(F.col("economic_event_id")) != "").distinct()
    shown = [
        "economic_event_id",
        "underlying",
        "severity_tier",
        "row_count",
        "amount_nunique",
        "pay_date_nunique",
        "ccy_nunique",
        "anchor_spread_days",
    ]
    return (
        events.join(ids, "economic_event_id", "left_semi")
        .select(*[c for c in shown if c in events.columns])
        .orderBy("severity_tier", F.desc("row_count"), "economic_event_id")
    )


__all__ = [
    "PairPolicy",
    "cell_order",
    "filter_pairs",
    "first_pairs",
    "pair_cells",
    "pair_events",
    "pair_members",
    "pair_queue",
    "pair_rows",
    "queue_order",
    "row_pairs",
]
