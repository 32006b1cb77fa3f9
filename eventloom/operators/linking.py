"""Link observations that describe the same cash event.

Rows of one identity, action, share class and currency are walked in date order. A row joins the
running event when it is close enough in time and amount to what came before, otherwise it starts a
new event. The walk looks sequential, but all it needs from earlier rows is the latest value of a few
expressions, so it runs as window aggregates.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.functions import values as vl
from eventloom.operators.skew import CHUNK, OrderedScan, same_keys, split_by_heat
from eventloom.session import cut_lineage

GROUP = ["primary_ident", "action_type", "share_class", "div_ccy"]
UNRANKED = 999_999


class LinkGuardError(ValueError):
    """A vendor id groups rows that cannot be the same event."""


@dataclass(frozen=True)
class LinkPolicy:
    max_day_shift: int = 5
    max_amount_rel_move: float = 0.20
    max_day_shift_when_amount_missing: int = 1
    allow_zero_amount_link: bool = False
    min_absolute_diff_ignore: float = 0.001
    min_amount_denominator: float = 1e-9
    stable_amount_decimals: int = 8
    source_priority: dict[str, int] = field(default_factory=dict)
    vendor_group_max_anchor_spread_days: int = 30
    vendor_group_max_amount_rel_spread: float = 0.10

    def __post_init__(self) -> None:
        for name in (
            "max_day_shift",
            "max_day_shift_when_amount_missing",
            "min_absolute_diff_ignore",
            "min_amount_denominator",
            "stable_amount_decimals",
            "vendor_group_max_anchor_spread_days",
            "vendor_group_max_amount_rel_spread",
        ):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be negative")
        if not 0 <= self.max_amount_rel_move <= 1:
            raise ValueError("max_amount_rel_move must lie in [0, 1]")
        ranks = {}
        for source, rank in self.source_priority.items():
            name = str(source or "").strip().upper()
            if not name:
                raise ValueError("source_priority needs a source name")
            if not isinstance(rank, int):
                raise ValueError("source_priority ranks must be int")
            ranks[name] = rank
        object.__setattr__(self, "source_priority", ranks)


def column_or(df: DataFrame, name: str, default: str | None = "") -> Column:
    return F.col(name) if name in df.columns else F.lit(default).cast("string")


# --- preparation -----------------------------------------------------------------------------


def anchor_date(df: DataFrame) -> Column:
    """Ex date, else record date, else pay date."""
    return F.coalesce(*[vl.day_in(df, name) for name in ("ex_date", "record_date", "pay_date")])


def primary_ident(df: DataFrame) -> Column:
    return F.coalesce(tx.link_text(column_or(df, "isin")), tx.link_text(column_or(df, "underlying")))


def event_currency(df: DataFrame) -> Column:
    """Currency of the first of these columns that the table has; values do not fall through."""
    for name in ("div_ccy", "amount_ccy", "currency"):
        if name in df.columns:
            return vl.currency(F.col(name))
    return F.lit(None).cast("string")


def skip_reason() -> Column:
    """Why a prepared row cannot be linked, null when it can."""
    missing = F.concat_ws(
        ",",
        F.when(F.col("primary_ident").isNull(), "missing_ident"),
        F.when(F.col("div_ccy").isNull(), "missing_div_ccy"),
        F.when(F.col("anchor_date").isNull(), "missing_anchor_date"),
    )
    return F.when(missing != "", F.concat(F.lit("skip:"), missing))


def source_rank(source: Column, policy: LinkPolicy) -> Column:
    """Rank of a cleaned source name; sources without one come last."""
    out = F.lit(UNRANKED)
    for name, rank in policy.source_priority.items():
        out = F.when(source == name, F.lit(rank)).otherwise(out)
    return out


def prepare(rows: DataFrame, policy: LinkPolicy, respect_existing: bool = False) -> DataFrame:
    """Cleaned columns, anchor date, tie and skip reason; one projection over the input.

    ``row_idx`` is the input order and must be a unique column of the input.
    """
    if "row_idx" not in rows.columns:
        raise ValueError("rows need a unique row_idx column that states their order")
    # Texts are stripped once, in a projection of their own; everything else reads the result.
    texts = ["isin", "underlying", "action_type", "share_class", "vendor_event_id", "source_event_key", "div_type", "status"]
    texts += ["source"] if policy.source_priority else []
    texts += ["economic_event_id"] if respect_existing else []
    df = rows.withColumns({f"__s_{c}": tx.strip(F.col(c)) for c in texts if c in rows.columns})
    raw = lambda c: F.col(f"__s_{c}") if c in rows.columns else F.lit("")
    text = lambda c: tx.link_text(raw(c), stripped=True)
    some = lambda c: F.nullif(raw(c), F.lit(""))
    or_unknown = lambda c: F.coalesce(text(c), F.lit("UNKNOWN"))
    df = df.withColumns(
        {
            "__vendor": some("vendor_event_id"),
            "__vendor_ident": F.upper(F.coalesce(some("isin"), some("underlying"))),
            "__preset": some("economic_event_id") if respect_existing else F.lit(None).cast("string"),
            "action_type": or_unknown("action_type"),
            "share_class": or_unknown("share_class"),
            "primary_ident": F.coalesce(text("isin"), text("underlying")),
            "div_ccy": event_currency(rows),
            "anchor_date": anchor_date(rows),
            "__amount": vl.number_in(rows, "amount"),
            "__rank": source_rank(text("source"), policy),
            "economic_event_key": F.coalesce(column_or(rows, "economic_event_key").cast("string"), F.lit("")),
        }
    )
    tie_text = F.concat_ws(
        "|",
        F.coalesce(F.col("primary_ident"), F.lit("")),
        F.coalesce(F.col("div_ccy"), F.lit("")),
        F.coalesce(F.col("anchor_date").cast("string"), F.lit("")),
        vl.fixed_decimals(F.col("__amount"), policy.stable_amount_decimals),
        or_unknown("div_type"),
        or_unknown("status"),
    )
    # Order of rows on one date: vendor id, else source key, else a content hash.
    tie = F.coalesce(F.col("__vendor"), some("source_event_key"), vl.digest(tie_text, 32))
    df = df.withColumns({"__tie_text": tie_text, "__tie": tie, "__skip": skip_reason()})
    df = df.withColumn("__preset", F.when(F.col("__skip").isNull(), F.col("__preset")))
    return df.drop(*[f"__s_{c}" for c in texts])


# --- vendor ids ------------------------------------------------------------------------------

# Canonical column -> column of the prepared rows it is taken from.
CANONICAL = {
    "primary_ident": "__vendor_ident",
    "div_ccy": "div_ccy",
    "anchor_date": "anchor_date",
    "action_type": "action_type",
    "share_class": "share_class",
}


def vendor_groups(prepared: DataFrame) -> DataFrame:
    """One row per vendor id: canonical values, guardrail measures and the preset id.

    A plain aggregate, so hot vendor ids are reduced before the shuffle.
    """
    precedence = ["__rank", "anchor_date", "__vendor_ident", "div_ccy", "action_type", "share_class", "__tie"]
    nulls_last = [f for name in precedence for f in (F.col(name).isNull(), F.col(name))]
    place = F.struct(*[c.alias(f"p{i}") for i, c in enumerate([*nulls_last, F.col("row_idx")])])
    size = F.abs(F.col("__amount"))
    return (
        prepared.where(F.col("__vendor").isNotNull())
        .groupBy("__vendor")
        .agg(
            *[
                F.min_by(F.col(source), F.when(F.col(source).isNotNull(), place)).alias(f"__canon_{target}")
                for target, source in CANONICAL.items()
            ],
            F.min("primary_ident").alias("ident_min"),
            F.max("primary_ident").alias("ident_max"),
            F.min("div_ccy").alias("ccy_min"),
            F.max("div_ccy").alias("ccy_max"),
            F.min("anchor_date").alias("anchor_min"),
            F.max("anchor_date").alias("anchor_max"),
            vl.relative_spread(F.min(size), F.max(size)).alias("amount_rel_spread"),
            F.min_by("__preset", F.when(F.col("__preset").isNotNull(), F.col("row_idx"))).alias("__vendor_preset"),
            F.coalesce(F.min("__preset") != F.max("__preset"), F.lit(False)).alias("preset_conflict"),
        )
    )


def guard_violation(policy: LinkPolicy) -> Column:
    """True for a vendor group whose rows cannot be one event."""
    spread = F.coalesce(F.datediff("anchor_max", "anchor_min"), F.lit(0))
    differ = lambda lo, hi: F.coalesce(F.col(lo) != F.col(hi), F.lit(False))
    return (
        differ("ident_min", "ident_max")
        | differ("ccy_min", "ccy_max")
        | (spread > policy.vendor_group_max_anchor_spread_days)
        | (F.coalesce(F.col("amount_rel_spread"), F.lit(0.0)) > policy.vendor_group_max_amount_rel_spread)
    )


def vendor_measures(prepared: DataFrame, policy: LinkPolicy) -> DataFrame:
    """Guardrail report: exact measures per vendor id and whether they breach the policy."""
    size = F.abs(F.col("__amount"))
    report = (
        prepared.where(F.col("__vendor").isNotNull())
        .groupBy(F.col("__vendor").alias("vendor_event_id"))
        .agg(
            F.countDistinct("primary_ident").alias("ident_nunique"),
            F.countDistinct("div_ccy").alias("ccy_nunique"),
            vl.relative_spread(F.min(size), F.max(size)).alias("amount_rel_spread"),
            F.coalesce(F.datediff(F.max("anchor_date"), F.min("anchor_date")), F.lit(0)).alias("anchor_spread_days"),
        )
    )
    return report.withColumn("amount_rel_spread", F.coalesce("amount_rel_spread", F.lit(0.0))).withColumn(
        "violation",
        (F.col("ident_nunique") > 1)
        | (F.col("ccy_nunique") > 1)
        | (F.col("anchor_spread_days") > policy.vendor_group_max_anchor_spread_days)
        | (F.col("amount_rel_spread") > policy.vendor_group_max_amount_rel_spread),
    )


def guard_sample(prepared: DataFrame, violators: DataFrame, rows: int = 30) -> DataFrame:
    """The first distinct rows of breaching vendor ids, for the error text."""
    shown = [c for c in ("source", "source_event_key") if c in prepared.columns]
    out = prepared.join(violators.select("__vendor"), "__vendor", "left_semi").select(
        F.col("__vendor").alias("vendor_event_id"), "primary_ident", "div_ccy", "anchor_date", "__amount", *shown
    )
    out = out.withColumnRenamed("__amount", "amount").distinct()
    order = ["vendor_event_id", "anchor_date", *reversed(shown), "primary_ident", "div_ccy", "amount"]
    return out.orderBy(*order).limit(rows)


def preset_conflicts(prepared: DataFrame) -> DataFrame:
    """Vendor ids whose rows carry more than one preset event id."""
    return (
        prepared.where(F.col("__vendor").isNotNull() & F.col("__preset").isNotNull())
        .groupBy(F.col("__vendor").alias("vendor_event_id"))
        .agg(F.countDistinct("__preset").alias("preset_count"))
        .where(F.col("preset_count") > 1)
    )


def check_vendor_groups(prepared: DataFrame, groups: DataFrame, policy: LinkPolicy) -> None:
    bad = groups.where(guard_violation(policy))
    clashing = groups.where(F.col("preset_conflict"))
    counts = groups.agg(
        F.count(F.when(guard_violation(policy), 1)).alias("bad"),
        F.count(F.when(F.col("preset_conflict"), 1)).alias("clashing"),
    ).first()
    if counts["bad"]:
        sample = guard_sample(prepared, bad).toPandas().to_string(index=False)
        raise LinkGuardError(f"{counts['bad']} vendor ids mix different events, for example\n{sample}")
    if counts["clashing"]:
        sample = [r[0] for r in clashing.select("__vendor").orderBy("__vendor").limit(30).collect()]
        raise LinkGuardError(f"{counts['clashing']} vendor ids carry conflicting preset event ids: {sample}")


def canonicalise(prepared: DataFrame, groups: DataFrame) -> DataFrame:
    """Give every row of a vendor id the group's canonical values and preset.

    Rows without a vendor id get a key of their own, so they spread instead of meeting in one task.
    """
    key = F.coalesce(F.concat(F.lit("v"), F.col("__vendor")), F.concat(F.lit("#"), F.col("row_idx").cast("string")))
    left = prepared.withColumn("__vendor_key", key)
    right = groups.select(
        F.concat(F.lit("v"), F.col("__vendor")).alias("__vendor_key"),
        *[f"__canon_{name}" for name in CANONICAL],
        "__vendor_preset",
    )
    joined = left.join(right, "__vendor_key", "left")
    has_vendor = F.col("__vendor").isNotNull()
    return joined.withColumns(
        {
            name: F.when(has_vendor, F.col(f"__canon_{name}")).otherwise(F.col(name)) for name in CANONICAL
        }
        | {"__preset": F.coalesce(F.col("__vendor_preset"), F.col("__preset"))}
    ).drop("__vendor_key", "__vendor_preset", *[f"__canon_{name}" for name in CANONICAL])


# --- the walk --------------------------------------------------------------------------------


def links(days: Column, prev_kind: Column, prev_amount: Column, amount: Column, policy: LinkPolicy) -> Column:
    """Whether a row joins the running event.

    ``prev_kind`` is the state of the event's amount: ``V`` a value, ``N`` missing, ``Z`` zero.
    """
    near = days <= policy.max_day_shift_when_amount_missing
    zero = (prev_kind == "Z") | (amount == 0.0)
    diff = F.abs(prev_amount - amount)
    larger = F.greatest(F.abs(prev_amount), F.abs(amount))
    return (
        F.when(days > policy.max_day_shift, False)
        .when((prev_kind == "N") | amount.isNull(), near)
        .when(zero, near if policy.allow_zero_amount_link else F.lit(False))
        .when(diff <= policy.min_absolute_diff_ignore, True)
        .when(larger <= policy.min_amount_denominator, True)
        .otherwise(diff / larger <= policy.max_amount_rel_move)
    )


def _gap(days: Column, policy: LinkPolicy) -> Column:
    return days.isNull() | (days > min(policy.max_day_shift, policy.max_day_shift_when_amount_missing))


def _setter(amount: Column, gap: Column) -> Column:
    """The state a row leaves behind for sure, or null.

    A non-zero amount always becomes the event's amount. A missing or zero amount does so only when it starts an event
    for sure, which a gap guarantees. Without a gap a missing amount changes nothing and a zero one ends a valued event
    (unless zero links are allowed).
    """
    return (
        F.when(amount != 0.0, F.struct(F.lit("V").alias("kind"), amount.alias("amount")))
        .when(amount.isNull() & gap, F.struct(F.lit("N").alias("kind"), F.lit(None).cast("double").alias("amount")))
        .when(gap, F.struct(F.lit("Z").alias("kind"), F.lit(0.0).alias("amount")))
    )


def _breaker(setter: Column, amount: Column, policy: LinkPolicy) -> Column:
    """1 where a row ends a valued event without a state of its own, 0 where it has one."""
    mark = F.when(setter.isNotNull(), F.lit(0))
    return mark if policy.allow_zero_amount_link else mark.when(amount == 0.0, F.lit(1))


def _kind(state: Column, broken: Column) -> Column:
    return F.when((broken == 1) & (state["kind"] == "V"), "Z").otherwise(state["kind"])


def walk(df: DataFrame, scan: OrderedScan, policy: LinkPolicy) -> DataFrame:
    """Add ``__new`` (row starts an event) and ``__seed`` (anchor and tie of the event's first row)."""
    amount = F.col("__amount")
    carried: dict[str, Column] | None = None
    if scan.chunked:
        chunks = carried_states(df, scan, policy)
        names = ["__prev_anchor", "__state", "__broken", "__seed"]
        df = scan.carry(df, chunks.withColumnsRenamed({n: f"__c{n}" for n in names}), [f"__c{n}" for n in names])
        carried = {n: F.col(f"__c{n}") for n in names}

    out = scan.last_seen(df, {"__prev_anchor": F.col("anchor_date")}, carried=carried)
    days = F.datediff("anchor_date", "__prev_anchor")
    setter = _setter(amount, _gap(days, policy))
    out = scan.last_seen(out, {"__state": setter, "__broken": _breaker(setter, amount, policy)}, carried=carried)

    kind = _kind(F.col("__state"), F.col("__broken"))
    is_new = F.col("__prev_anchor").isNull() | ~links(days, kind, F.col("__state.amount"), amount, policy)
    out = out.withColumn("__new", is_new)

    seed = F.when(F.col("__new"), F.struct(F.col("anchor_date").alias("anchor"), F.col("__tie").alias("tie")))
    out = scan.last_seen(out, {"__seed": seed}, inclusive=True, carried=carried)
    return out.drop("__prev_anchor", "__state", "__broken", *[f"__c{n}" for n in carried if n != "__seed"] if carried else [])


def carried_states(df: DataFrame, scan: OrderedScan, policy: LinkPolicy) -> DataFrame:
    """What the walk carries into every chunk: previous anchor, state, break and seed; a row per chunk.

    A chunk is summed up without knowing what comes before it, as a change of state, in one pass over narrow rows. What
    it cannot know is small: its first row's distance, and how the rows before its first own state go on. Among those a
    missing amount near its predecessor is never new, a zero one is new unless the state is a missing amount, and the
    first non-zero one (``odd``) is compared with the state. The changes are then applied in order, chunk by chunk.
    """
    amount, place = F.col("__amount"), F.struct(*scan.order)
    start = F.struct(F.col("anchor_date").alias("anchor"), F.col("__tie").alias("tie"))
    rows = df.select(*scan.partition, *scan.order, "__amount")
    w = scan.window()
    rows = rows.withColumn("__days", F.datediff("anchor_date", F.lag("anchor_date").over(w)))
    rows = rows.withColumn("__first", F.row_number().over(w) == 1)
    gap = ~F.col("__first") & _gap(F.col("__days"), policy)
    # The first row sets a state here only if it does so at any distance.
    setter = _setter(amount, gap)
    rows = rows.withColumns({"__set": setter, "__mark": _breaker(setter, amount, policy)})
    frame = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"__p{c}": F.last(c, ignorenulls=True).over(frame) for c in ("__set", "__mark")})
    inner, known = ~F.col("__first"), F.col("__p__set").isNotNull()
    zero = F.coalesce(amount == 0.0, F.lit(False))
    plain = F.coalesce(amount != 0.0, F.lit(False))
    linked = links(F.col("__days"), _kind(F.col("__p__set"), F.col("__p__mark")), F.col("__p__set.amount"), amount, policy)
    sure = inner & F.when(known, ~linked).otherwise(gap & ~plain)
    rows = rows.withColumn("__sure", sure)
    last = lambda value, where: F.max_by(value, F.when(where, place))
    odd = F.struct(start.alias("start"), F.col("__days").alias("days"), amount.alias("amount"))
    chunks = cut_lineage(
        rows.groupBy(*scan.partition).agg(
            F.min_by(F.struct(start.alias("start"), amount.alias("amount")), place).alias("head"),
            F.max_by("anchor_date", place).alias("tail_anchor"),
            last(F.col("__set"), inner & F.col("__set").isNotNull()).alias("tail_set"),
            last(F.col("__mark"), inner & F.col("__mark").isNotNull()).alias("tail_mark"),
            last(start, F.col("__sure")).alias("sure_seed"),
            last(start, inner & ~known & ~gap & zero).alias("zero_seed"),
            F.max(F.when(inner & ~known & plain, odd)).alias("odd"),
        )
    )

    made = scan.before(chunks, {"__prev_anchor": F.col("tail_anchor")})
    head, head_days = F.col("head.amount"), F.datediff("head.start.anchor", "__prev_anchor")
    made = made.withColumn("head_set", _setter(head, _gap(head_days, policy)))
    made = made.withColumn("head_mark", _breaker(F.col("head_set"), head, policy))
    states = {"__state": F.coalesce("tail_set", "head_set"), "__broken": F.coalesce("tail_mark", "head_mark")}
    made = scan.before(made, states)

    before = _kind(F.col("__state"), F.col("__broken"))
    head_new = F.col("__prev_anchor").isNull() | ~links(head_days, before, F.col("__state.amount"), head, policy)
    # After the first row: its state, or the carried one with its break.
    state, broken = F.coalesce("head_set", "__state"), F.coalesce("head_mark", "__broken")
    zero_new = F.lit(not policy.allow_zero_amount_link) & (_kind(state, broken) != "N")
    odd_kind = _kind(state, F.when(F.col("zero_seed").isNotNull() & F.lit(not policy.allow_zero_amount_link), 1).otherwise(broken))
    odd_new = ~links(F.col("odd.days"), odd_kind, state["amount"], F.col("odd.amount"), policy)
    seed = F.coalesce(
        F.col("sure_seed"),
        F.when(odd_new, F.col("odd.start")),
        F.when(zero_new, F.col("zero_seed")),
        F.when(head_new, F.col("head.start")),
    )
    made = scan.before(made, {"__seed": seed})
    # A row per chunk; written, so that the planner knows how small it is.
    return cut_lineage(made.select(*scan.partition, "__prev_anchor", "__state", "__broken", "__seed"))


def label_seeds(df: DataFrame, scan: OrderedScan) -> DataFrame:
    """Mark one row per event as its seed: the least fingerprint among rows at the event's start."""
    fingerprint = vl.digest(F.concat_ws("|", F.col("__source"), F.col("__source_key")), 16)
    at_start = (F.col("anchor_date") == F.col("__seed.anchor")) & (F.col("__tie") == F.col("__seed.tie"))
    if not scan.chunked:
        # Rows at a start agree in anchor and tie with their seed, so those of a start lie side by side in the order of
        # the walk: these windows need neither an exchange nor a sort.
        run = Window.partitionBy(*scan.keys, "anchor_date", "__tie")
        so_far = run.orderBy("row_idx").rowsBetween(Window.unboundedPreceding, 0)
        df = df.withColumn("__fp", F.when(at_start, fingerprint))
        df = df.withColumn("__least", F.coalesce(F.col("__fp") == F.min("__fp").over(run), F.lit(False)))
        first = F.col("__least") & (F.count(F.when(F.col("__least"), 1)).over(so_far) == 1)
        return df.withColumn("__is_seed", first).drop("__fp", "__least")
    df = df.withColumn("__fp", F.when(at_start, F.struct(fingerprint.alias("fp"), "row_idx")))
    # Starts within a chunk are settled there. Those that an event carried into a chunk may share with it are compared
    # over chunks: a seed for each chunk at most.
    shared = df.select(*scan.keys, F.col("__c__seed").alias("__seed")).where(F.col("__seed").isNotNull()).distinct()
    tops = df.where(F.col("__fp").isNotNull()).select(*scan.keys, "__seed", "__fp")
    tops = tops.join(shared, same_keys(tops, shared, [*scan.keys, "__seed"]), "left_semi")
    tops = cut_lineage(tops.groupBy(*scan.keys, "__seed").agg(F.min("__fp").alias("__top")))
    local = F.min("__fp").over(Window.partitionBy(*scan.partition, "__seed"))
    df = df.withColumn("__local", local)
    joined = df.join(tops, same_keys(df, tops, [*scan.keys, "__seed"]), "left").select(df["*"], tops["__top"])
    is_seed = F.col("__fp") == F.coalesce("__top", "__local")
    return joined.withColumn("__is_seed", F.coalesce(is_seed, F.lit(False))).drop("__fp", "__local", "__top", "__c__seed")


def assign_event_ids(
    rows: DataFrame,
    policy: LinkPolicy | None = None,
    *,
    respect_existing: bool = False,
    check: bool = True,
    keep_debug_cols: bool = False,
) -> DataFrame:
    """Rows with ``economic_event_id``, ``economic_event_key``, ``event_link_reason`` and the group columns.

    ``check`` runs one small aggregate action and raises when a vendor id mixes different events.
    """
    policy = policy or LinkPolicy()
    df = prepare(rows, policy, respect_existing)
    # Kept under own names: the input may lack these columns.
    df = df.withColumns(
        {
            "__source": F.coalesce(column_or(rows, "source").cast("string"), F.lit("")),
            "__source_key": F.coalesce(column_or(rows, "source_event_key").cast("string"), F.lit("")),
        }
    )
    if "vendor_event_id" in rows.columns:
        groups = vendor_groups(df)
        if check:
            check_vendor_groups(df, groups, policy)
        df = canonicalise(df, groups)

    # Rows outside the walk take a lane of their own each: one pass over the input, no crowd of nulls.
    outside = F.col("__skip").isNotNull() | F.col("__preset").isNotNull()
    df = df.withColumn("__lane", F.when(outside, F.xxhash64("row_idx")).otherwise(F.lit(0).cast("bigint")))

    keys, order = [*GROUP, "__lane"], ["anchor_date", "__tie", "row_idx"]
    parts = [label_seeds(walk(part, scan, policy), scan).drop(CHUNK) for part, scan in split_by_heat(df, keys, order, size_of=rows)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)

    key = F.concat_ws("|", *GROUP, F.col("__seed.anchor").cast("string"), F.col("__seed.tie"))
    preset, skipped = F.col("__preset").isNotNull(), F.col("__skip").isNotNull()
    out = out.withColumns(
        {
            "economic_event_key": F.when(preset | skipped, F.col("economic_event_key")).otherwise(key),
            "economic_event_id": F.when(preset, F.col("__preset"))
            .when(skipped, F.lit(""))
            .otherwise(vl.event_id(key)),
            "event_link_reason": F.when(preset, F.lit("preset"))
            .when(skipped, F.col("__skip"))
            .when(F.col("__is_seed"), F.lit("seed"))
            .otherwise(F.lit("linked")),
        }
    )
    if keep_debug_cols:
        out = out.withColumn("debug_tie_raw", F.col("__tie_text"))
    return out.drop(*[c for c in out.columns if c.startswith("__")])
