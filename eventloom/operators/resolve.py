"""Turn securities into candidate vendor tickers, and candidates into a chosen one.

Everything the vendor would answer live is read from landed tables, so a whole universe resolves in a
few joins. Candidates are one row each while they are compared with vendor tables and one array per
security (a handful of entries) while rules look at them together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.functions import tickers as tk
from eventloom.functions import values as vl
from eventloom.operators import venues as vn
from eventloom.operators.linking import column_or

MAX_SYMBOL_LENGTH = 64
SYMBOL_PATTERN = r"^[0-9A-Za-z.\-_=*]+$"
LOCAL_PATTERN = r"^([0-9A-Za-z*]+)\.([A-Za-z]{1,4})$"

CANDIDATE_FIELDS = [
    "ticker",
    "market",
    "method",
    "origin",
    "canonical_exchange",
    "guess_source",
    "isin_prefix",
    "prefix_exchange_consistent",
]


# --- exchange rules --------------------------------------------------------------------------


def exchange_name(c: Column) -> Column:
    s = F.regexp_replace(tx.resolution_text(c, upper=True), r"\s+", " ")
    for old, new in (("&", "AND"), ("CO.", "COMPANY"), ("LTD", "LTD."), ("  ", " ")):
        s = F.replace(s, F.lit(old), F.lit(new))
    return s


def country_name(c: Column) -> Column:
    return F.regexp_replace(tx.resolution_text(c, upper=True), r"\s+", " ")


RULE_COLUMNS = ["match_type", "match_value", "canonical_exchange", "suffixes", "priority", "is_active", "note"]


def rule_problems(rules: DataFrame) -> DataFrame:
    """Rules that cannot be used, with the reason; active exact names stated twice included."""
    df = _typed_rules(rules)
    broken = (
        F.when(~F.col("match_type").isin("EXACT", "CONTAINS"), "match_type")
        .when(F.col("match_value") == "", "match_value")
        .when(F.col("canonical_exchange") == "", "canonical_exchange")
        .when(F.col("priority").isNull(), "priority")
        .when(F.col("is_active").isNull(), "is_active")
    )
    bad = df.withColumn("problem", broken).where(F.col("problem").isNotNull()).select("match_value", "problem")
    twice = df.where((F.col("match_type") == "EXACT") & F.col("is_active")).groupBy("match_value").count()
    twice = twice.where(F.col("count") > 1).select("match_value", F.lit("duplicate").alias("problem"))
    return bad.unionByName(twice)


def _typed_rules(rules: DataFrame) -> DataFrame:
    active = tx.resolution_text(column_or(rules, "is_active", "1"), upper=True)
    priority = tx.resolution_text(F.col("priority"))
    parts = F.transform(F.split(F.coalesce(F.col("suffixes"), F.lit("")), r"\|"), lambda x: tx.resolution_text(x, True))
    return rules.select(
        tx.resolution_text(F.col("match_type"), upper=True).alias("match_type"),
        exchange_name(F.col("match_value")).alias("match_value"),
        tx.resolution_text(F.col("canonical_exchange"), upper=True).alias("canonical_exchange"),
        F.filter(parts, lambda x: x.isin(vn.VENDOR_SUFFIXES)).alias("suffixes"),
        F.when(priority.rlike(r"^\d+$"), priority.try_cast("int")).alias("priority"),
        F.when(active.isin("0", "FALSE", "N", "NO"), False).when(active.isin("1", "TRUE", "Y", "YES", ""), True).alias(
            "is_active"
        ),
        tx.resolution_text(column_or(rules, "note")).alias("note"),
    )


def exchange_rules(raw: DataFrame, check: bool = True) -> DataFrame:
    """Active rules with typed columns; suffixes the vendor does not know are left out."""
    missing = [c for c in RULE_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"exchange rules lack the columns {missing}")
    if check:
        listed = rule_problems(raw).limit(20).collect()
        if listed:
            raise ValueError(f"exchange rules are not usable: {[r.asDict() for r in listed]}")
    return _typed_rules(raw).where("is_active").drop("is_active")


def default_rules(spark: SparkSession) -> DataFrame:
    """The built-in exchange rules in file form."""
    rows = [(*rule[:4], str(rule[4]), "1", "") for rule in vn.EXCHANGE_RULES]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RULE_COLUMNS))


# Letters of the pieces by which ``contains`` rules are looked up.
GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """Distinct pieces of ``size`` letters; none of a shorter text."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, size)))).otherwise(
        F.array().cast("array<string>")
    )


def _contains_matches(names: DataFrame, rules: DataFrame) -> DataFrame:
    """(name, the first ``contains`` rule it holds) by an inverted index over the rules' texts.

    A rule is filed under that piece of its text which the fewest rules share, so a piece that many have in common leads
    to few of them; a text shorter than a piece is filed under itself. Names look all their pieces up and are verified.
    """
    answer = F.struct("canonical_exchange", "suffixes")
    parts = rules.where(F.col("match_type") == "CONTAINS").groupBy(F.col("match_value").alias("__part"))
    parts = parts.agg(F.min("priority").alias("__rank"), F.min_by(answer, F.struct("priority", "canonical_exchange")).alias("__fuzzy"))
    part = F.col("__part")
    filed = F.when(F.length(part) >= GRAM, _grams(part, GRAM)).otherwise(F.array(part))
    index = parts.withColumn("__gram", F.explode(filed))
    index = index.withColumn("__shared", F.count(F.lit(1)).over(Window.partitionBy("__gram")))
    index = index.groupBy("__part").agg(
        F.min_by("__gram", F.struct("__shared", "__gram")).alias("__gram"), F.first("__rank").alias("__rank"), F.first("__fuzzy").alias("__fuzzy")
    )
    name = F.col("__name")
    pieces = F.concat(F.array(F.lit("")), *[_grams(name, size) for size in range(1, GRAM + 1)])
    met = names.withColumn("__gram", F.explode(pieces)).join(index, "__gram").where(F.contains(name, part))
    return met.groupBy("__name").agg(F.min_by("__fuzzy", F.struct("__rank", "__part")).alias("__fuzzy"))


def match_exchange(df: DataFrame, rules: DataFrame, exchange: str = "exchange") -> DataFrame:
    """Add ``rule_exchange`` and ``rule_suffixes``: the exact rule, else the first ``contains`` rule by priority.

    Names are matched once per distinct exchange, by equality and by pieces of their texts: the work follows the rules a
    name can hold and not the number of rules. Of several rules for one text the one of least priority counts, then the
    least exchange.
    """
    keyed = df.withColumn("__name", exchange_name(column_or(df, exchange)))
    names = keyed.select("__name").where(F.col("__name") != "").distinct()
    exact = rules.where(F.col("match_type") == "EXACT").groupBy(F.col("match_value").alias("__name"))
    exact = exact.agg(F.min_by(F.struct("canonical_exchange", "suffixes"), F.struct("priority", "canonical_exchange")).alias("__exact"))
    found = names.join(_contains_matches(names, rules), "__name", "left")
    best = F.coalesce(F.col("__exact"), F.col("__fuzzy"))
    found = found.join(exact, "__name", "left").select(
        "__name", best["canonical_exchange"].alias("rule_exchange"), best["suffixes"].alias("rule_suffixes")
    )
    out = keyed.join(found, "__name", "left").drop("__name")
    return out.withColumn("rule_exchange", F.coalesce("rule_exchange", F.lit("")))


# --- guessing --------------------------------------------------------------------------------


def literal_map(table: dict[str, str] | dict[str, list[str]]) -> Column:
    """A fixed table as a map literal: a lookup in it is an expression, not a join."""
    cells = []
    for key, value in table.items():
        many = isinstance(value, list)
        cells += [F.lit(key), F.array(*[F.lit(v) for v in value]).cast("array<string>") if many else F.lit(value)]
    return F.create_map(*cells)


def unsupported_jurisdiction(df: DataFrame) -> Column:
    return (
        country_name(column_or(df, "country")).isin(vn.UNSUPPORTED_COUNTRIES)
        | exchange_name(column_or(df, "exchange")).isin(vn.UNSUPPORTED_EXCHANGES)
        | tk.soft_prefix(tx.resolution_text(column_or(df, "isin"))).isin(vn.UNSUPPORTED_ISIN_PREFIXES)
    )


def looks_like_ticker(c: Column) -> Column:
    """Exactly one dot, something before it and a known suffix after it."""
    s = tx.strip(c)
    return s.rlike(r"^[^.]+\.[^.]*$") & F.upper(F.substring_index(s, ".", -1)).isin(vn.VENDOR_SUFFIXES)


def strip_local_suffix(c: Column) -> Column:
    s = tx.strip(c)
    return F.when(~looks_like_ticker(s) & s.rlike(LOCAL_PATTERN), F.regexp_extract(s, LOCAL_PATTERN, 1)).otherwise(s)


def ticker_from_suffix(bare: Column, suffix: Column) -> Column:
    """Ticker of a symbol without local suffix; numeric symbols are padded where the venue wants it."""
    widths = sorted(set(vn.PADDED.values()))
    width = F.lit(0)
    for w in widths:
        width = F.when(suffix.isin([s for s, n in vn.PADDED.items() if n == w]), F.lit(w)).otherwise(width)
    short = bare.rlike(r"^\d+$") & (F.length(bare) < width)
    padded = F.when(short, F.lpad(bare, width, F.lit("0"))).otherwise(bare)
    return F.when((suffix == "") | (bare == ""), padded).otherwise(F.concat(padded, F.lit("."), suffix))


def prefix_matches_venue(df: DataFrame, prefix: str, venue: str, out: str) -> DataFrame:
    """``out``: the venue is one the ISIN prefix allows; unknown prefix or venue counts as fine."""
    allowed = F.try_element_at(literal_map(vn.PREFIX_VENUES), F.col(prefix))
    fine = (F.col(venue) == "") | F.coalesce(F.array_contains(allowed, F.col(venue)), F.lit(True))
    return df.withColumn(out, fine)


def prefix_matches_tokens(df: DataFrame, isin: Column, exchange: str, out: str) -> DataFrame:
    """``out``: the exchange text names a suffix the ISIN prefix allows; null when either is unknown."""
    allowed = F.try_element_at(literal_map(vn.PREFIX_TOKENS), tk.soft_prefix(isin))
    words = tk.exchange_tokens(F.col(exchange))
    return df.withColumn(out, F.when(F.size(words) > 0, F.arrays_overlap(words, allowed)))


def guess_tickers(securities: DataFrame, rules: DataFrame) -> DataFrame:
    """Heuristic candidates, one row each, with ``ordinal`` in preference order.

    A symbol that already is a vendor ticker is taken as it is. Otherwise suffixes come from the
    exchange rule, else the country, else the currency. ``securities`` needs ``security_id``.
    """
    symbol = tx.text_or_blank(F.col("underlying"))
    usable = (symbol != "") & (F.length(symbol) <= MAX_SYMBOL_LENGTH) & symbol.rlike(SYMBOL_PATTERN)
    as_is = looks_like_ticker(symbol)
    df = securities.where(usable & (as_is | ~unsupported_jurisdiction(securities)))
    df = df.select(
        "security_id",
        symbol.alias("underlying"),
        column_or(df, "exchange").alias("exchange"),
        country_name(column_or(df, "country")).alias("__country"),
        tx.resolution_text(F.col("underlying_ccy"), upper=True).alias("__ccy"),
        tk.soft_prefix(tx.resolution_text(column_or(df, "isin"))).alias("isin_prefix"),
        as_is.alias("__as_is"),
    )
    df = match_exchange(df, rules)
    df = df.withColumns(
        {
            "__by_country": F.try_element_at(literal_map(vn.COUNTRY_SUFFIXES), F.col("__country")),
            "__by_ccy": F.try_element_at(literal_map(vn.CURRENCY_SUFFIXES), F.col("__ccy")),
        }
    )
    by_rule = F.coalesce(F.size("rule_suffixes") > 0, F.lit(False))
    source = (
        F.when(F.col("__as_is"), "asis")
        .when(by_rule, "exchange_rule")
        .when(F.col("__by_country").isNotNull(), "country_fallback")
        .when(F.col("__by_ccy").isNotNull(), "ccy_fallback")
    )
    df = df.withColumn("guess_source", source)
    suffixes = (
        F.when(F.col("__as_is"), F.array(F.lit("")))
        .when(by_rule, F.col("rule_suffixes"))
        .otherwise(F.coalesce("__by_country", "__by_ccy"))
    )
    df = df.withColumn("__bare", F.when(F.col("__as_is"), F.col("underlying")).otherwise(strip_local_suffix(F.col("underlying"))))
    # No source means a null list, and a null list gives no rows; a filter would repeat all of the above.
    df = df.select("*", F.posexplode(suffixes).alias("ordinal", "__suffix"))
    df = df.withColumn("__ticker", ticker_from_suffix(F.col("__bare"), F.col("__suffix")))
    ticker = F.col("__ticker")
    market = F.when(F.col("__as_is"), "ASIS").when(ticker.contains("."), tk.suffix(ticker)).otherwise("US")
    df = df.withColumns(
        {
            "market": market,
            "ticker": tk.ticker_key(ticker),
            "canonical_exchange": F.when(F.col("guess_source") == "exchange_rule", F.col("rule_exchange")).otherwise(""),
            "method": F.lit("heuristic"),
            "origin": F.lit("auto_search"),
        }
    ).where(F.col("ticker") != "")
    df = prefix_matches_venue(df, "isin_prefix", "canonical_exchange", "prefix_exchange_consistent")
    return df.select("security_id", "ordinal", *CANDIDATE_FIELDS)


# --- candidates per security -----------------------------------------------------------------


def security_context(universe: DataFrame) -> DataFrame:
    """Securities with clean keys; rows without a symbol or a currency are left out.

    Each distinct input row becomes one security, identified by a hash of its content unless the input
    brings ``security_id``.
    """
    cols = {
        "underlying": tx.vendor_text(F.col("underlying")),
        "underlying_ccy": vl.currency_or_blank(F.col("underlying_ccy")),
        "isin": F.upper(tx.vendor_text(column_or(universe, "isin"))),
        "country": tx.vendor_text(column_or(universe, "country")),
        "exchange": tx.vendor_text(column_or(universe, "exchange")),
        "name": tx.vendor_text(column_or(universe, "name")),
        "weight": vl.optional_number(column_or(universe, "weight", None)),
    }
    df = universe.withColumns(cols).where((F.col("underlying") != "") & (F.col("underlying_ccy") != ""))
    if "security_id" in df.columns:
        return df
    content = F.to_json(F.struct(*df.columns))
    return df.distinct().withColumn("security_id", F.sha2(content.cast("binary"), 256))


def attach_override(securities: DataFrame, chosen: DataFrame) -> DataFrame:
    """``override`` struct: the chosen map's entry for (underlying, ccy), else the row's own ticker."""
    fields = ["ticker", "reason", "method", "source", "isin"]
    entry = chosen.select("underlying", "underlying_ccy", F.struct(*fields).alias("__mapped"))
    joined = securities.join(entry, ["underlying", "underlying_ccy"], "left")
    own = tx.vendor_text(column_or(securities, "chosen_ticker"))
    or_override = lambda *cs: F.coalesce(*[F.nullif(tx.vendor_text(c), F.lit("")) for c in cs], F.lit("override"))
    row_level = F.when(
        own != "",
        F.struct(
            own.alias("ticker"),
            or_override(column_or(securities, "resolution_reason"), column_or(securities, "reason")).alias("reason"),
            or_override(column_or(securities, "resolution_method"), column_or(securities, "method")).alias("method"),
            F.lit("row_override").alias("source"),
            F.upper(tx.vendor_text(column_or(securities, "isin"))).alias("isin"),
        ),
    )
    return joined.withColumn("override", F.coalesce(F.col("__mapped"), row_level)).drop("__mapped")


def with_row_isin(df: DataFrame) -> DataFrame:
    """ISIN of the row, else the one its override brings."""
    own = F.nullif(F.col("isin"), F.lit(""))
    return df.withColumn("row_isin", F.coalesce(own, F.nullif(F.col("override.isin"), F.lit("")), F.lit("")))


def is_unsupported(override: Column) -> Column:
    return F.coalesce(F.upper(override["ticker"]).startswith(tk.UNSUPPORTED_PREFIX), F.lit(False))


def override_candidate(row_isin: Column, override: Column) -> Column:
    return F.struct(
        tk.ticker_key(override["ticker"]).alias("ticker"),
        tk.listing_market(override["ticker"]).alias("market"),
        override["method"].alias("method"),
        override["source"].alias("origin"),
        F.lit("").alias("canonical_exchange"),
        F.lit("override").alias("guess_source"),
        tk.soft_prefix(row_isin).alias("isin_prefix"),
        F.lit(None).cast("boolean").alias("prefix_exchange_consistent"),
    )


def first_per_ticker(candidates: DataFrame) -> DataFrame:
    """Keep the first candidate of every (security, ticker)."""
    rest = [c for c in CANDIDATE_FIELDS if c != "ticker"]
    kept = candidates.groupBy("security_id", "ticker").agg(
        F.min_by(F.struct("stage", "ordinal", *rest), F.struct("stage", "ordinal")).alias("__c")
    )
    return kept.select("security_id", "ticker", "__c.*")


def candidate_lists(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """One array of candidates per security, in preference order, each with its ``exists`` flag.

    The list of a security has one entry per search result or suffix, so it is small by construction.
    """
    # A ticker probed several times exists if any probe found it, and is one candidate all the same.
    known = existing.groupBy("ticker").agg(F.bool_or("exists").alias("exists")).where("exists")
    flagged = candidates.join(known, "ticker", "left").withColumn("exists", F.coalesce("exists", F.lit(False)))
    entry = F.struct("stage", "ordinal", *CANDIDATE_FIELDS, "exists")
    return flagged.groupBy("security_id").agg(F.array_sort(F.collect_list(entry)).alias("candidates"))


def drop_isin_alias(candidates: Column) -> Column:
    """Drop ``<ISIN>.SG`` aliases when any candidate is not of that venue."""
    others = F.exists(candidates, lambda c: ~c["ticker"].endswith(".SG"))
    return F.when(others, F.filter(candidates, lambda c: ~c["ticker"].rlike(tk.ISIN_ALIAS_PATTERN))).otherwise(candidates)


def looks_indian(df: DataFrame) -> Column:
    country, exchange = F.upper(F.col("country")), F.upper(F.col("exchange"))
    return (
        country.isin(vn.INDIA_COUNTRIES)
        | exchange.isin(vn.INDIA_EXCHANGES)
        | tx.contains_any(exchange, vn.INDIA_EXCHANGE_WORDS)
    )


def _first(candidates: Column, test) -> Column:
    return F.try_element_at(F.filter(candidates, test), F.lit(1))


def arbitrate(df: DataFrame) -> DataFrame:
    """Settle NS/BO and plain/local doubles by which ticker exists.

    Adds ``reason``, ``preverified_any`` and ``preverified_ticker``.
    """
    c = F.col("candidates")
    ns = _first(c, lambda x: x["ticker"].endswith(".NS"))
    bo = _first(c, lambda x: x["ticker"].endswith(".BO"))
    df = df.withColumns({"__ns": ns, "__bo": bo})
    double = looks_indian(df) & F.col("__ns").isNotNull() & F.col("__bo").isNotNull()
    verdict = (
        F.when(double & F.col("__ns.exists"), "india_ns_canonical")
        .when(double & F.col("__bo.exists"), "india_bo_canonical")
        .when(double, "india_ns_default")
        .otherwise("")
    )
    df = df.withColumn("reason", verdict)
    pick = F.when(F.col("reason") == "india_bo_canonical", F.col("__bo")).when(F.col("reason") != "", F.col("__ns"))
    verified = F.col("reason").isin("india_ns_canonical", "india_bo_canonical")
    df = df.withColumns(
        {
            "candidates": F.when(F.col("reason") != "", F.array(pick)).otherwise(c),
            "preverified_any": verified,
            "preverified_ticker": F.when(verified, pick["ticker"]).otherwise(""),
        }
    )
    c = F.col("candidates")
    plain, local = _first(c, lambda x: tk.is_plain(x["ticker"])), _first(c, lambda x: tk.is_local(x["ticker"]))
    df = df.withColumns({"__plain": plain, "__local": local})
    pair = (
        (F.size(c) == 2)
        & F.upper(F.col("country")).isin(vn.PLAIN_OR_LOCAL_COUNTRIES)
        & F.col("__plain").isNotNull()
        & F.col("__local").isNotNull()
    )
    only_plain = pair & F.col("__plain.exists") & ~F.col("__local.exists")
    only_local = pair & F.col("__local.exists") & ~F.col("__plain.exists")
    return df.withColumns(
        {
            "candidates": F.when(only_plain, F.array("__plain")).when(only_local, F.array("__local")).otherwise(c),
            "reason": F.when(only_plain, "plain_over_local_canonical")
            .when(only_local, "local_over_plain_canonical")
            .otherwise(F.col("reason")),
        }
    ).drop("__ns", "__bo", "__plain", "__local")


def resolve_candidates(securities: DataFrame, search: DataFrame, rules: DataFrame, existing: DataFrame) -> DataFrame:
    """Securities with ``candidates``, ``reason`` and preverification.

    ``securities`` carry ``security_id``, ``row_isin`` and ``override``; ``search`` are landed ISIN search
    candidates, ``existing`` is (ticker, exists).
    """
    own = securities.where(F.col("override").isNotNull()).select(
        "security_id",
        F.lit(0).alias("stage"),
        F.lit(0).alias("ordinal"),
        F.inline(F.array(override_candidate(F.col("row_isin"), F.col("override")))),
    )
    open_rows = securities.where(F.col("override").isNull())
    searched = open_rows.select("security_id", tx.compact_id(F.col("row_isin")).alias("isin")).where(
        tk.looks_like_isin(F.col("isin"))
    )
    found = searched.join(search, "isin").select("security_id", F.lit(1).alias("stage"), "ordinal", *CANDIDATE_FIELDS)
    guess_input = open_rows.withColumn("isin", F.col("row_isin"))
    guessed = guess_tickers(guess_input, rules).withColumn("stage", F.lit(2))
    listed = own.unionByName(found).unionByName(guessed).where(F.col("ticker") != "")
    lists = candidate_lists(first_per_ticker(listed), existing)

    df = securities.join(lists, "security_id", "left")
    df = df.withColumn("candidates", F.coalesce("candidates", F.array().cast(lists.schema["candidates"].dataType)))
    # An override is a single candidate, which neither pruning nor arbitration would change.
    settled = arbitrate(df.withColumn("candidates", drop_isin_alias(F.col("candidates"))))
    return settled.withColumn(
        "reason", F.when(F.col("override").isNotNull(), F.col("override.reason")).otherwise(F.col("reason"))
    )


# Order in which candidates are probed for existence.
PROBE_RANKS = ["override", "isin_search", "exchange_rule", "country_fallback", "ccy_fallback", "heuristic"]
LAST_RANK = 9


def probe_rank(candidate: Column) -> Column:
    method, source = F.lower(tx.text_or_blank(candidate["method"])), F.lower(tx.text_or_blank(candidate["guess_source"]))
    out = F.lit(LAST_RANK)
    for rank, name in reversed(list(enumerate(PROBE_RANKS))):
        field = method if name in ("override", "isin_search", "heuristic") else source
        out = F.when(field == name, F.lit(rank)).otherwise(out)
    return out


def first_existing(candidates: Column) -> Column:
    """Existing ticker that comes first in probe order, null when none exists."""
    ranked = F.transform(
        F.filter(candidates, lambda c: c["exists"]), lambda c: F.struct(probe_rank(c).alias("rank"), c["ticker"].alias("ticker"))
    )
    return F.try_element_at(F.array_sort(ranked), F.lit(1))["ticker"]


def choose_paying(resolved: DataFrame, actions: DataFrame) -> DataFrame:
    """Add ``chosen``: the first candidate, in list order, with a dividend in the window.

    ``actions`` is already limited to the window; its tickers are reduced to a distinct list first.
    ``resolved`` is read twice, so pass one that is materialised.
    """
    paying = actions.select("ticker").distinct()
    spread = resolved.select("security_id", F.posexplode("candidates").alias("pos", "c"))
    spread = spread.withColumn("ticker", F.col("c.ticker"))
    hits = spread.join(paying, "ticker", "left_semi")
    best = hits.groupBy("security_id").agg(F.min_by("c", "pos").alias("chosen"))
    return resolved.join(best, "security_id", "left")
