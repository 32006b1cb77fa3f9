"""WARC revisits: find the full response that a not-modified answer stands for, and merge its headers.

An as-of join by canonical URL to the latest earlier full response. Rows of one URL are cut into time slots: a
window looks back inside a slot, and the last response of each slot is carried on through a table with one row per
URL and slot. So the rows of a busy URL are spread over its slots and no task holds them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Seconds of a time slot.
SLOT_SECONDS = 3600

# Query keys that do not change what a URL names, and headers that a 304 may not replace
# (message framing, hop-by-hop and representation metadata of HTTP caching).
TRACKING_KEYS = ["fbclid", "gclid", "ref", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term"]
KEPT_HEADERS = [
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
]


def canonical_url(url: Column) -> Column:
    """Lower-case host without user, "www." or default port; no scheme, fragment, tracking keys or final slash; keys sorted."""
    plain = F.regexp_replace(F.trim(url), r"#.*$", "")
    rest = F.regexp_replace(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    keys = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")
    known = F.array(*[F.lit(k) for k in TRACKING_KEYS])
    kept = F.array_sort(
        F.filter(keys, lambda k: (k != "") & ~F.array_contains(known, F.lower(F.substring_index(k, "=", 1))))
    )
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), r"^[Ww]/", "")


def verdict(found: Column, etag: Column, own_etag: Column, modified: Column, own_modified: Column) -> Column:
    """Entity tags decide by weak comparison where both sides have one, else equal dates; without either nothing is proven."""
    return (
        F.when(~found, "no_earlier_response")
        .when(etag.isNotNull() & own_etag.isNotNull(), F.when(_weak(etag) == _weak(own_etag), "resolved").otherwise("validator_mismatch"))
        .when(modified.isNotNull() & own_modified.isNotNull(), F.when(modified == own_modified, "resolved").otherwise("validator_mismatch"))
        .otherwise("no_validator")
    )


def resolve_revisits(records: DataFrame, slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """One row per revisit (status 304) of ``records``: record_id, url, ts, status, headers (map of lower-case names).

    Adds canonical_url, the earlier response's id and ts, ``resolution`` and the merged ``headers``: those of the
    response, with every header of the revisit in place of its own unless that header belongs to the stored message.
    Only a revisit whose validators agree gets merged headers; others keep their own. Of responses at one time the
    largest record_id counts; a response at the revisit's own time is not earlier. Records without url or ts are never
    looked up and end as "no_key". A repeated record counts as often as it is there; other columns are left out.
    """
    base = records.select(
        "record_id",
        "ts",
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("own"),
        canonical_url(F.col("url")).alias("canonical_url"),
        (F.col("status") == 304).alias("revisit"),
        F.col("status").between(200, 299).alias("full"),
    ).where("revisit OR full")
    keyless = base.where("revisit AND (canonical_url IS NULL OR ts IS NULL)")
    rows = base.where("canonical_url IS NOT NULL AND ts IS NOT NULL").withColumn(
        "slot", F.floor(F.col("ts").cast("long") / slot_seconds)
    )
    response = F.when(F.col("full"), F.struct("ts", "record_id", "own"))
    keys = ["canonical_url", "slot"]
    # Revisits come before responses of the same time, so they do not see them.
    inside = Window.partitionBy(*keys).orderBy("ts", F.col("full").asc(), F.col("record_id").asc_nulls_first())
    local = rows.withColumn(
        "near", F.last(response, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    ).where("revisit")
    # Headers take no part in the order; the id decides between responses of one time.
    tails = rows.where("full").groupBy(*keys).agg(
        F.max_by(F.struct("ts", "record_id", "own"), F.struct("ts", F.col("record_id").isNotNull(), "record_id")).alias("tail")
    )
    marks = tails.select(*keys, "tail").unionByName(
        local.select(*keys).distinct().withColumn("tail", F.lit(None).cast(tails.schema["tail"].dataType))
    )
    across = Window.partitionBy("canonical_url").orderBy("slot").rangeBetween(Window.unboundedPreceding, -1)
    carried = (
        marks.groupBy(*keys)
        .agg(F.first("tail", ignorenulls=True).alias("tail"))
        .withColumn("before", F.last("tail", ignorenulls=True).over(across))
        .select(*keys, "before")
    )
    joined = local.join(carried, keys, "left").withColumn("seen", F.coalesce("near", "before"))
    seen, own = F.col("seen.own"), F.col("own")
    said = verdict(
        F.col("seen").isNotNull(), seen["etag"], own["etag"], seen["last-modified"], own["last-modified"]
    )
    fixed = F.array(*[F.lit(h) for h in KEPT_HEADERS])
    fresh = F.map_filter(own, lambda k, _: ~F.array_contains(fixed, k))
    stays = F.map_filter(seen, lambda k, _: ~F.array_contains(F.map_keys(fresh), k))
    out = joined.withColumn("resolution", said).select(
        "record_id",
        "canonical_url",
        "ts",
        F.col("seen.record_id").alias("response_id"),
        F.col("seen.ts").alias("response_ts"),
        "resolution",
        F.when(F.col("resolution") == "resolved", F.map_concat(stays, fresh)).otherwise(own).alias("headers"),
    )
    return out.unionByName(
        keyless.select(
            "record_id",
            "canonical_url",
            "ts",
            F.lit(None).cast(records.schema["record_id"].dataType).alias("response_id"),
            F.lit(None).cast(records.schema["ts"].dataType).alias("response_ts"),
            F.lit("no_key").alias("resolution"),
            F.col("own").alias("headers"),
        )
    )


def captures(pages: DataFrame) -> DataFrame:
    """Crawl records derived from ``pages``: three visits of every page.

    The first visit is a full response with the page's digest as entity tag. The second, under a variant of the URL, is
    a 304 with the same tag for two pages of three, with a foreign tag for the rest. The third is a 304 with dates
    only, which are those of the response for odd ids. Every seventh page has no first visit.
    """
    day = F.timestamp_seconds(F.lit(1700000000) + F.col("page_id") % 1000 * 60)
    tag = F.concat(F.lit('"'), F.md5(F.col("html").cast("binary")), F.lit('"'))
    size = F.octet_length("html").cast("string")
    date = F.concat(F.lit("day "), (F.col("page_id") % 28 + 1).cast("string"))
    first = F.struct(
        (F.col("page_id") * 4).alias("record_id"), F.col("url").alias("url"), day.alias("ts"), F.lit(200).alias("status"),
        F.create_map(
            F.lit("etag"), tag, F.lit("last-modified"), date, F.lit("content-length"), size, F.lit("cache-control"), F.lit("max-age=60"),
        ).alias("headers"),
    )
    second = F.struct(
        (F.col("page_id") * 4 + 1).alias("record_id"), F.concat(F.col("url"), F.lit("#again")).alias("url"),
        (day + F.expr("INTERVAL 50 MINUTES")).alias("ts"), F.lit(304).alias("status"),
        F.create_map(
            F.lit("etag"), F.when(F.col("page_id") % 3 < 2, F.concat(F.lit("W/"), tag)).otherwise(F.lit('"other"')),
            F.lit("content-length"), F.lit("0"), F.lit("cache-control"), F.lit("no-cache"),
        ).alias("headers"),
    )
    third = F.struct(
        (F.col("page_id") * 4 + 2).alias("record_id"), F.col("url").alias("url"),
        (day + F.expr("INTERVAL 9 HOURS")).alias("ts"), F.lit(304).alias("status"),
        F.create_map(
            F.lit("last-modified"), F.when(F.col("page_id") % 2 == 1, date).otherwise(F.lit("day 0")), F.lit("age"), F.lit("9"),
        ).alias("headers"),
    )
    visits = F.when(F.col("page_id") % 7 == 0, F.array(second, third)).otherwise(F.array(first, second, third))
    return pages.select(F.explode(visits).alias("r")).select("r.*")
