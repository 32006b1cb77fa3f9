"""Overlap patterns: rows of one group that collide on dates, amounts, currencies or types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.functions import values as vl
from eventloom.operators.linking import column_or
from eventloom.operators.regions import country_bucket

PATTERNS = ["O1", "O2", "O3a", "O3b", "O3c", "O3d", "O4", "O5", "O6"]
TEXT_COLUMNS = [
    "isin",
    "div_ccy",
    "underlying",
    "div_type",
    "status",
    "vendor_event_id",
    "source",
    "note",
    "source_event_key",
]
DATE_COLUMNS = ["declared_date", "ex_date", "record_date", "pay_date"]
MAX_EX_DIFF = 7


def normalise(df: DataFrame) -> DataFrame:
    """Typed overlap table with country bucket and a readable row id."""
    cleaned = {c: tx.overlap_text(column_or(df, c, None)) for c in TEXT_COLUMNS}
    out = df.withColumns(
        cleaned
        | {c: vl.day_in(df, c) for c in DATE_COLUMNS}
        | {
            "amount": vl.number_in(df, "amount"),
            "synthetic": F.coalesce(tx.flag(column_or(df, "synthetic", None)), F.lit(False)),
        }
    )
    money = F.upper(tx.strip(F.col("div_ccy")))
    if "currency" in df.columns:
        money = F.coalesce(money, F.upper(tx.strip(tx.overlap_text(F.col("currency")))))
    out = out.withColumns(
        {
            "isin": F.upper(tx.strip(F.col("isin"))),
            "div_ccy": money,
            "underlying": tx.strip(F.col("underlying")),
        }
    )
    bucket, reason = country_bucket(F.col("isin"), F.col("div_ccy"))
    na = lambda c: F.coalesce(c.cast("string"), F.lit("NA"))
    row_id = F.concat(
        na(F.col("isin")),
        F.lit("|ex="),
        na(F.col("ex_date")),
        F.lit("|pay="),
        na(F.col("pay_date")),
        F.lit("|amt="),
        F.coalesce(F.round("amount", 8).cast("string"), F.lit("nan")),
        F.lit("|ccy="),
        na(F.col("div_ccy")),
        F.lit("|type="),
        na(F.col("div_type")),
        F.lit("|status="),
        na(F.col("status")),
        F.lit("|syn="),
        F.initcap(F.col("synthetic").cast("string")),
    )
    return out.withColumns({"bucket": bucket, "bucket_reason": reason, "row_id": row_id})


def _cell_match(rows: DataFrame, cells: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for c in keys:
        cond = cond & rows[c].eqNullSafe(cells[c])
    return cond


def group_flags(df: DataFrame, group: str) -> DataFrame:
    """O1, O2, O5: several pay dates, amounts or currencies where one is expected.

    "At least two distinct values" is min < max, which combines before the shuffle, so a hot group is a few
    partial rows. The finest grain (group, ex, pay) is aggregated once; the coarser ones follow from it.
    """
    grain = [group, "ex_date", "pay_date"]
    base = df.where(F.col(group).isNotNull() & F.col("ex_date").isNotNull())
    cells = base.groupBy(*grain).agg(
        F.min("amount").alias("a0"), F.max("amount").alias("a1"), F.min("div_ccy").alias("c0"), F.max("div_ccy").alias("c1")
    )
    several = lambda lo, hi: F.coalesce(lo < hi, F.lit(False))
    days = cells.groupBy(group, "ex_date").agg(several(F.min("pay_date"), F.max("pay_date")).alias("__o1"))
    groups = cells.groupBy(group).agg(several(F.min("c0"), F.max("c1")).alias("flag_O5"))
    has_pay = F.col("pay_date").isNotNull()
    return (
        cells.join(days, [group, "ex_date"])
        .join(groups, group)
        .select(
            *grain,
            (F.col("__o1") & has_pay).alias("flag_O1"),
            (several(F.col("a0"), F.col("a1")) & has_pay).alias("__o2"),
            "flag_O5",
        )
    )


def with_group_flags(df: DataFrame, group: str = "underlying") -> DataFrame:
    """The rows with flag_O1, flag_O2 and flag_O5."""
    cells = group_flags(df, group)
    out = df.join(cells, _cell_match(df, cells, [group, "ex_date", "pay_date"]), "left")
    false = lambda c: F.coalesce(c, F.lit(False))
    return out.select(
        df["*"],
        false(cells["flag_O1"]).alias("flag_O1"),
        false(cells["__o2"] & df["amount"].isNotNull()).alias("flag_O2"),
        false(cells["flag_O5"]).alias("flag_O5"),
    )


def with_repeated_ids(df: DataFrame) -> DataFrame:
    """The rows with flag_O4: the vendor id is on another row, too. Rows without one do not meet under a null key."""
    repeated = df.groupBy("vendor_event_id").agg((F.count(F.lit(1)) > 1).alias("flag_O4"))
    repeated = repeated.where("flag_O4 AND vendor_event_id IS NOT NULL").select(
        F.col("vendor_event_id").alias("__id"), "flag_O4"
    )
    own = F.coalesce(F.col("vendor_event_id"), F.concat(F.lit("\x00none-"), F.col("row_idx").cast("string")))
    keyed = df.withColumn("__own", own)
    out = keyed.join(repeated, keyed["__own"] == repeated["__id"], "left")
    return out.select(*[keyed[c] for c in df.columns], F.coalesce("flag_O4", F.lit(False)).alias("flag_O4"))


# Sizes of the boxes in which cells meet: amount bands, ex days and pay days.
BOXES = {"__band": 4, "__week": 16, "__pay": 4}


def _boxed(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells once per box they ask for near cells, and cells in their own box.

    The band is the logarithm of the amount in steps of the widest close pair, so close amounts are at most a step
    apart. Boxes are wider than what is searched, so a cell asks one or two in each direction: some three in all.
    """
    # vl.amount_close allows two parts in a hundred of the larger amount, at least of 1e-9.
    step, floor = 0.0203, 1e-9
    place = F.signum("amount") * F.log(F.greatest(F.abs("amount"), F.lit(floor)) / floor) / step
    ex, pay = F.unix_date("ex_date"), F.unix_date("pay_date")
    box = lambda value, name: F.floor(value / BOXES[name]).cast("long")
    placed = cells.withColumns({"__band": box(place, "__band"), "__week": box(ex, "__week"), "__pay": box(pay, "__pay")})
    probes = cells
    for column, lo, hi in (("__band", place - 1, place + 1), ("__week", ex + 1, ex + MAX_EX_DIFF), ("__pay", pay - 1, pay + 1)):
        probes = probes.withColumn(column, F.explode(F.sequence(box(lo, column), box(hi, column))))
    return probes, placed


def _near_cells(cells: DataFrame, group: str) -> DataFrame:
    """Cells with their O3a, O3b, O3d flags: another cell of the group with a close amount, days apart.

    Cells meet in boxes of ex days, pay days and amount bands. Each pair is met once, from its earlier ex date, and
    counts for both.
    """
    keys = [group, *BOXES]
    probes, placed = _boxed(cells)
    a = probes.select(*keys, *[F.col(c).alias(f"{c}_a") for c in ("ex_date", "pay_date", "amount")])
    b = placed.select(*keys, *[F.col(c).alias(f"{c}_b") for c in ("ex_date", "pay_date", "amount")])
    ex, pay = F.datediff("ex_date_b", "ex_date_a"), F.abs(F.datediff("pay_date_b", "pay_date_a"))
    near = a.join(b, keys).where(
        ex.between(1, MAX_EX_DIFF) & ((pay == 0) | ((pay == 1) & (ex <= 2))) & vl.amount_close(F.col("amount_a"), F.col("amount_b"))
    )
    sides = F.explode(
        F.array(*[F.struct(*[F.col(f"{c}_{s}").alias(c) for c in ("ex_date", "pay_date", "amount")]) for s in "ab"])
    )
    hits = near.select(group, (ex <= 2).alias("__soon"), (pay == 0).alias("__same"), sides.alias("__cell"))
    return hits.groupBy(group, "__cell").agg(
        F.bool_or(F.col("__soon") & F.col("__same")).alias("flag_O3a"),
        F.bool_or(F.col("__soon") & ~F.col("__same")).alias("flag_O3b"),
        F.bool_or(~F.col("__soon") & F.col("__same")).alias("flag_O3d"),
    ).select(group, "__cell.*", "flag_O3a", "flag_O3b", "flag_O3d")


def _far_cells(cells: DataFrame, group: str) -> DataFrame:
    """Cells with O3c: the same pay date within two days of ex, and an amount that is not close.

    Close amounts are an interval, so the least or the largest amount of a day decides for all of them.
    """
    days = cells.groupBy(group, "ex_date", "pay_date").agg(F.min("amount").alias("__lo"), F.max("amount").alias("__hi"))
    lent = days.select(
        group, "pay_date", F.explode(F.array(*[F.date_add("ex_date", d) for d in (-2, -1, 1, 2)])).alias("ex_date"), "__lo", "__hi"
    )
    lent = lent.groupBy(group, "ex_date", "pay_date").agg(F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"))
    apart = ~vl.amount_close(F.col("__lo"), F.col("amount")) | ~vl.amount_close(F.col("__hi"), F.col("amount"))
    return cells.join(lent, [group, "ex_date", "pay_date"]).where(apart).select(
        group, "ex_date", "pay_date", "amount", F.lit(True).alias("flag_O3c")
    )


def _type_days(work: DataFrame, group: str) -> DataFrame:
    """Least and largest type of the other days within a week, per group and ex date; one row per day, no row pairs."""
    days = work.where("div_type <> ''").groupBy(group, "ex_date").agg(F.min("div_type").alias("t0"), F.max("div_type").alias("t1"))
    steps = [d for d in range(-MAX_EX_DIFF, MAX_EX_DIFF + 1) if d]
    lent = days.select(group, F.explode(F.array(*[F.date_add("ex_date", d) for d in steps])).alias("ex_date"), "t0", "t1")
    return lent.groupBy(group, "ex_date").agg(F.min("t0").alias("__t0"), F.max("t1").alias("__t1"))


def near_flags(df: DataFrame, group: str) -> DataFrame:
    """``row_idx`` with O3a-d and O6, for rows that have group, dates and amount.

    A row is compared with all rows of its group within the days of the pattern. The work follows distinct
    (group, ex, pay, amount) cells, so copies cost nothing, and a hot group is spread over its days and amounts.
    """
    keys = [group, "ex_date", "pay_date", "amount"]
    work = df.where(
        F.col(group).isNotNull()
        & F.col("ex_date").isNotNull()
        & F.col("pay_date").isNotNull()
        & F.col("amount").isNotNull()
    ).select("row_idx", *keys, "div_type")
    cells = work.select(*keys).distinct()
    types = F.coalesce(
        (F.col("div_type") != "") & ((F.col("__t0") != F.col("div_type")) | (F.col("__t1") != F.col("div_type"))), F.lit(False)
    )
    flags = ["flag_O3a", "flag_O3b", "flag_O3c", "flag_O3d"]
    out = work.join(_near_cells(cells, group), keys, "left").join(_far_cells(cells, group), keys, "left")
    out = out.join(_type_days(work, group), [group, "ex_date"], "left")
    return out.select("row_idx", *[F.coalesce(f, F.lit(False)).alias(f) for f in flags], types.alias("flag_O6"))


def add_overlap_flags(df: DataFrame, group: str = "underlying") -> DataFrame:
    """All pattern flags on every row of a normalised table; needs a unique ``row_idx``."""
    out = with_repeated_ids(with_group_flags(df, group)).join(near_flags(df, group), "row_idx", "left")
    flags = [f"flag_{p}" for p in PATTERNS]
    return out.select(*df.columns, *[F.coalesce(f, F.lit(False)).alias(f) for f in flags])


def sample_rank(seed: int) -> Column:
    """Deterministic shuffle order of rows for a seed."""
    return (F.col("row_idx") * F.lit(7919) + F.lit(seed)) % F.lit(104_729)


def stratified_sample(
    flagged: DataFrame, seed: int = 7, k: int = 5, group: str = "underlying", pure_only: bool = False
) -> DataFrame:
    """Per pattern one (bucket, group) and up to ``k`` of its rows, single-pattern rows first."""
    flags = [f"flag_{p}" for p in PATTERNS]
    marked = flagged.withColumns(
        {
            "__flags": sum((F.col(f).cast("int") for f in flags), F.lit(0)),
            "__rank": sample_rank(seed),
            "pattern": F.explode(F.array_compact(F.array(*[F.when(F.col(f"flag_{p}"), F.lit(p)) for p in PATTERNS]))),
        }
    ).where(F.col(group).isNotNull())
    # O5 mixes currencies, which may spread a group over buckets.
    marked = marked.withColumn(
        "sample_bucket", F.when(F.col("pattern") == "O5", F.lit("MULTI_CCY")).otherwise(F.col("bucket"))
    )
    chosen = marked.groupBy("pattern").agg(
        F.min_by(F.struct(F.col("sample_bucket"), F.col(group).alias("g")), F.struct("__rank", "row_idx")).alias("__pick")
    )
    chosen = chosen.select("pattern", "__pick.*").withColumnRenamed("g", group)
    rows = marked.join(chosen, ["pattern", "sample_bucket", group])
    if pure_only:
        rows = rows.where(F.col("__flags") == 1)
    order = [F.col("__flags") > 1, "__rank", "row_idx"]
    # The first k of each lane, then the first k of those: no task sees a whole hot group.
    lanes = Window.partitionBy("pattern", F.pmod(F.xxhash64("row_idx"), F.lit(64))).orderBy(*order)
    rows = rows.withColumn("sample_no", F.row_number().over(lanes)).where(F.col("sample_no") <= k)
    w = Window.partitionBy("pattern").orderBy(*order)
    rows = rows.withColumn("sample_no", F.row_number().over(w)).where(F.col("sample_no") <= k)
    note = F.concat(
        F.lit("random pick: bucket="), F.col("sample_bucket"), F.lit(f", {group}="), F.col(group).cast("string")
    )
    return rows.withColumns(
        {
            "sample_seed": F.lit(seed),
            "sample_group_key": F.lit(group),
            "sample_group_value": F.col(group).cast("string"),
            "note": F.concat_ws(" | ", F.nullif(tx.text_or_blank(F.col("note")), F.lit("")), note),
        }
    ).drop("__flags", "__rank")


def isin_pool(tables: list[DataFrame]) -> DataFrame:
    """Distinct ISINs of several holdings tables, sorted."""
    pool = None
    for table in tables:
        if "isin" in table.columns:
            one = table.select(F.upper(tx.strip(tx.overlap_text(F.col("isin")))).alias("isin"))
            pool = one if pool is None else pool.unionByName(one)
    if pool is None:
        raise ValueError("no holdings table has an isin column")
    return pool.where(F.length("isin") >= 2).distinct().orderBy("isin")
