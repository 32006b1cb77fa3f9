"""Ordered scans that hold when one key owns a large share of all rows.

A window function sends every row of a key to one task. For ordinary keys that is what we want;
for a hot key it is a job that never ends. ``ordered_scan`` therefore keeps ordinary keys on plain
windows and cuts the rows of hot keys into bounded, ordered chunks (range partitioning on the full
order). What a window would carry from row to row is then carried from chunk to chunk through one
small table with a row per chunk.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.session import cut_lineage

# A key with more rows than this is scanned in chunks of about this size.
HOT_ROWS = 2_000_000
# Rows of a range that one task sorts and cuts into chunks, at least.
RANGE_ROWS = 50_000
CHUNK = "__chunk"


def hot_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("eventloom.hotRows", str(HOT_ROWS)))


def hot_keys(
    df: DataFrame, keys: list[str], limit: int | None = None, size_of: DataFrame | None = None
) -> DataFrame | None:
    """Keys with more than ``limit`` rows, or None when there are none.

    The row count comes first: no key can be hot in a table that is not larger than the limit.
    ``size_of`` names a cheaper table with at least as many rows, such as the scan ``df`` starts from,
    which Spark counts without reading a column. The result has at most rows / limit entries.
    """
    limit = hot_limit(df) if limit is None else limit
    if (df if size_of is None else size_of).count() <= limit:
        return None
    hot = cut_lineage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > limit))
    return None if hot.isEmpty() else hot


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for key in keys:
        cond = cond & left[key].eqNullSafe(right[key])
    return cond


# Hash groups of keys that are counted instead of the keys, at least.
KEY_GROUPS = 1 << 16


def split_crowded(df: DataFrame, key: str, limit: int, size_of: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose key has at most ``limit`` rows for sure, and the others, or None when there are none.

    Rows are counted by hash groups of the keys: a pass over one column with a small shuffle, however many keys there
    are. A crowded group takes along the few other keys that fall into it. ``size_of`` is as for ``hot_keys``.
    """
    rows = (df if size_of is None else size_of).count()
    if rows <= limit:
        return df, None
    group = F.pmod(F.xxhash64(key), F.lit(max(KEY_GROUPS, 16 * rows // limit)))
    counted = df.groupBy(group.alias("__group")).agg(F.count(F.lit(1)).alias("__rows"))
    # At most rows / limit entries; written, so that the planner knows.
    crowded = cut_lineage(counted.where(F.col("__rows") > limit).select("__group"))
    if crowded.isEmpty():
        return df, None
    grouped = df.withColumn("__group", group)
    return tuple(grouped.join(crowded, "__group", how).drop("__group") for how in ("left_anti", "left_semi"))


@dataclass(frozen=True)
class OrderedScan:
    """Running values over ``keys`` in the order of ``order``; chunked when ``chunked`` is set."""

    keys: list[str]
    order: list[str]
    chunked: bool = False

    @property
    def partition(self) -> list[str]:
        return self.keys + ([CHUNK] if self.chunked else [])

    def window(self):
        return Window.partitionBy(*self.partition).orderBy(*self.order)

    def last_seen(
        self, df: DataFrame, values: dict[str, Column], inclusive: bool = False, carried: dict[str, Column] | None = None
    ) -> DataFrame:
        """Add the latest non-null value of each expression at or before the row.

        With ``inclusive`` unset the row itself does not count. ``carried`` holds what earlier chunks leave behind, for
        scans whose state over chunks is known already (see ``carry``); otherwise a chunked scan finds it itself, with
        a pass over the rows and a written table for each call.
        """
        marked = df.withColumns({f"__v_{name}": value for name, value in values.items()})
        frame = self.window().rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        local = marked.withColumns(
            {name: F.last(F.col(f"__v_{name}"), ignorenulls=True).over(frame) for name in values}
        )
        helpers = [f"__v_{name}" for name in values]
        if carried is not None:
            return local.withColumns({name: F.coalesce(F.col(name), carried[name]) for name in values}).drop(*helpers)
        if not self.chunked:
            return local.drop(*helpers)

        place = F.struct(*self.order)
        tails = marked.groupBy(*self.partition).agg(
            *[
                F.max_by(F.col(f"__v_{name}"), F.when(F.col(f"__v_{name}").isNotNull(), place)).alias(f"__t_{name}")
                for name in values
            ]
        )
        across = Window.partitionBy(*self.keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carried = tails.select(
            *self.partition,
            *[F.last(F.col(f"__t_{name}"), ignorenulls=True).over(across).alias(f"__c_{name}") for name in values],
        )
        joined = local.join(carried, same_keys(local, carried, self.partition), "left").select(
            local["*"], *[carried[f"__c_{name}"] for name in values]
        )
        out = joined.withColumns({name: F.coalesce(F.col(name), F.col(f"__c_{name}")) for name in values})
        # Later scans read this result twice; cutting here keeps the work linear in the number of scans.
        return cut_lineage(out.drop(*helpers, *[f"__c_{name}" for name in values]))

    def before(self, chunks: DataFrame, values: dict[str, Column]) -> DataFrame:
        """Of a table with a row per chunk: the latest non-null value of each expression in the chunks before."""
        across = Window.partitionBy(*self.keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        return chunks.withColumns({name: F.last(value, ignorenulls=True).over(across) for name, value in values.items()})

    def carry(self, df: DataFrame, chunks: DataFrame, names: list[str]) -> DataFrame:
        """Rows with the columns ``names`` of their chunk."""
        cond = same_keys(df, chunks, self.partition)
        return df.join(chunks, cond, "left").select(df["*"], *[chunks[name] for name in names])

    def running_sum(self, df: DataFrame, name: str, value: Column) -> DataFrame:
        """Add the sum of ``value`` over the rows up to and including this one."""
        marked = df.withColumn("__v", value)
        frame = self.window().rowsBetween(Window.unboundedPreceding, 0)
        local = marked.withColumn(name, F.sum("__v").over(frame))
        if not self.chunked:
            return local.drop("__v")
        totals = marked.groupBy(*self.partition).agg(F.sum("__v").alias("__t"))
        across = Window.partitionBy(*self.keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        before = totals.select(*self.partition, F.coalesce(F.sum("__t").over(across), F.lit(0)).alias("__carried"))
        joined = local.join(before, same_keys(local, before, self.partition), "left").select(local["*"], before["__carried"])
        return joined.withColumn(name, F.col(name) + F.col("__carried")).drop("__v", "__carried")


def into_chunks(df: DataFrame, keys: list[str], order: list[str], rows: int, limit: int) -> DataFrame:
    """Cut rows into ordered chunks of at most ``limit`` rows; the last order column must be unique.

    The rows are dealt in ranges that suit a task, and each sorted range is cut by position, so small chunks do not make
    as many tasks and files.
    """
    parts = max(2, -(-rows // max(limit, RANGE_ROWS)))
    ranged = df.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order)
    # The id is range * 2^33 + position: it grows with the order, and no chunk holds rows of two ranges.
    chunked = ranged.withColumn(CHUNK, F.floor(F.monotonically_increasing_id() / limit))
    # Range bounds come from a sample, so they are fixed once and for all before anything reads them.
    return cut_lineage(chunked)


def split_by_heat(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    limit: int | None = None,
    size_of: DataFrame | None = None,
) -> list[tuple[DataFrame, OrderedScan]]:
    """Rows with the scan that suits them: one entry, or an ordinary and a hot one."""
    limit = hot_limit(df) if limit is None else limit
    hot = hot_keys(df, keys, limit, size_of)
    if hot is None:
        return [(df, OrderedScan(keys, order))]
    rows = hot.agg(F.sum("__rows")).first()[0]
    listed = hot.select(*keys)
    cold_rows = df.join(listed, same_keys(df, listed, keys), "left_anti")
    hot_rows = df.join(listed, same_keys(df, listed, keys), "left_semi")
    return [
        (cold_rows, OrderedScan(keys, order)),
        (into_chunks(hot_rows, keys, order, rows, limit), OrderedScan(keys, order, chunked=True)),
    ]
