"""Writers for stage artefacts. Parquet inside; CSV and JSON only as exports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.functions import tickers as tk
from eventloom.operators.skew import split_by_heat
from eventloom.operators.universe import classify_no_events
from eventloom.session import cut_lineage
from eventloom.sources.decisions import PAIR_COLUMNS, QA_OPTIONAL, QA_REQUIRED
from eventloom.sources.tables import is_absent

# Artefact contracts by table name.
CONTRACTS = {
    "observations": schemas.OBSERVATIONS_REQUIRED,
    "errors": schemas.ERRORS,
    "no_events": schemas.NO_EVENTS,
    "resolutions": schemas.RESOLUTIONS,
    "rejections": schemas.REJECTIONS,
}


def write_table(df: DataFrame, path: str, columns: list[str] | None = None, mode: str = "overwrite") -> None:
    """Parquet with the contract's columns first (missing ones blank) and extra columns kept."""
    (schemas.fit(df, columns) if columns else df).write.mode(mode).parquet(path)


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, which is all a CSV can hold."""
    cols = []
    for field in df.schema:
        kind = field.dataType.typeName()
        if kind == "array" and field.dataType.elementType.typeName() == "string":
            cols.append(tk.candidates_json(F.col(field.name)).alias(field.name))
        elif kind in ("array", "struct", "map"):
            cols.append(F.to_json(F.col(field.name)).alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)


def export_csv(df: DataFrame, path: str, columns: list[str] | None = None, mode: str = "overwrite") -> None:
    out = flat(schemas.fit(df, columns) if columns else df)
    out.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def stamp(df: DataFrame, tag: str, file_name: str) -> DataFrame:
    return df.withColumns({"holdings_tag": F.lit(tag), "holdings_file": F.lit(file_name)})


def write_by_tag(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """One folder per dataset tag, in few files; rebalancing splits a hot tag over tasks instead of gathering it."""
    out = schemas.fit(df, columns) if columns else df
    out.hint("rebalance", "holdings_tag").write.mode("overwrite").partitionBy("holdings_tag").parquet(path)


def union_tables(frames: list[DataFrame], columns: list[str]) -> DataFrame:
    """All rows of several tables, contract columns first, numbers as numbers."""
    out = None
    for df in frames:
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("nothing to unite")
    out = schemas.fit(out, columns)
    numbers = [c for c in ("amount", "weight") if c in out.columns]
    return out.withColumns({c: F.col(c).try_cast("double") for c in numbers})


def write_buckets(no_events: DataFrame, path: str) -> None:
    """No-event rows in one folder per bucket table; suspect rows appear in two."""
    classified = classify_no_events(no_events)
    tables = F.when(F.col("suspect_mapping"), F.array(F.lit("rest"), F.lit("rest_suspect"))).otherwise(F.array("bucket"))
    rows = classified.withColumn("bucket_table", F.explode(tables))
    rows.hint("rebalance", "bucket_table").write.mode("overwrite").partitionBy("bucket_table").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """Small summaries: one JSON object per row."""
    df.coalesce(1).write.mode("overwrite").json(path)


def append_row(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


# --- landing log -----------------------------------------------------------------------------


# Folders of a landing log; part of its layout, so it must not change for a log that exists.
LOG_BUCKETS = 256


def log_bucket() -> Column:
    """Folder of a payload: by its day alone, since a batch has many funds and few days."""
    return F.pmod(F.xxhash64("asof"), F.lit(LOG_BUCKETS)).cast("int")


def newest_logged(landing: DataFrame, path: str) -> DataFrame:
    """Hash and number of the newest version of each (fund, asof), read from the folders that ``landing`` touches."""
    spark = landing.sparkSession
    try:
        log = spark.read.parquet(path)
    except AnalysisException as error:
        if not is_absent(error):
            raise
        log = spark.createDataFrame([], "fund string, asof string, content_hash string, version int, bucket int")
    if "bucket" not in log.columns:
        raise ValueError(f"{path} is not in buckets; write it anew with the bucket of each row")
    touched = [r.bucket for r in landing.select(log_bucket().alias("bucket")).distinct().collect()]
    return log.where(F.col("bucket").isin(touched)).groupBy("fund", "asof").agg(
        F.max_by("content_hash", "version").alias("content_hash"), F.max("version").alias("__base")
    )


def append_if_changed(landing: DataFrame, path: str, order: str = "seq") -> DataFrame:
    """Append payloads (fund, asof, content) whose hash differs from the one before, starting from the newest logged.

    ``order`` is a unique column of ``landing``. Several payloads of one (fund, asof) are compared in that order and
    numbered on from the log, so equal ones in a row are logged once. The log keeps the content, so each version can be
    read back; only hashes are compared. The log lies in folders by day, of which an append reads those of its own days.
    Returns what was appended.
    """
    kind = landing.schema[order].dataType
    hashed = landing.select("fund", "asof", F.col(order), F.sha2(F.col("content").cast("binary"), 256).alias("content_hash"))
    newest = newest_logged(landing, path)
    logged = newest.select("fund", "asof", F.lit(None).cast(kind).alias(order), "content_hash", F.lit(False).alias("__new"))
    both = logged.unionByName(hashed.withColumn("__new", F.lit(True)))
    out = None
    for part, scan in split_by_heat(both, ["fund", "asof"], ["__new", order], size_of=landing):
        seen = scan.last_seen(part, {"__before": F.col("content_hash")})
        changed = F.col("__new") & ~F.col("content_hash").eqNullSafe(F.col("__before"))
        numbered = scan.running_sum(seen.withColumn("__changed", changed), "__step", F.col("__changed").cast("int"))
        kept = numbered.where("__changed").select("fund", "asof", order, "content_hash", "__step")
        out = kept if out is None else out.unionByName(kept)
    versions = out.join(newest.select("fund", "asof", "__base"), ["fund", "asof"], "left").select(
        order, "content_hash", (F.coalesce("__base", F.lit(0)) + F.col("__step")).cast("int").alias("version")
    )
    # Written before the log grows: the plan reads the log.
    added = cut_lineage(landing.join(versions, order).select(*landing.columns, "content_hash", "version"))
    placed = added.withColumn("bucket", log_bucket()).hint("rebalance", "bucket")
    placed.write.mode("append").partitionBy("bucket").parquet(path)
    return added


# --- decision templates ----------------------------------------------------------------------

# Example rows of the decision templates.
QA_TEMPLATE = [
    ("VENDOR_EXAMPLE_001", "VALE3", "2025-12-27", "SET_ECON_ID", "", "", "ECON_VALE3_20251227", "", "every row of this key"),
    ("VENDOR_EXAMPLE_002", "PETR4", "2025-01-15", "DROP", "0.10", "BRL", "", "", "only this amount and currency"),
    ("VENDOR_EXAMPLE_003", "005930", "2025-12-27", "SET_ANCHOR_DATE", "", "", "", "2025-12-27", "rows with an anchor date"),
]
PAIR_TEMPLATE = [
    ("true", "EXAMPLE1", "eco_example_a", "eco_example_b", "KEEP", "", "reviewed, two events"),
    ("true", "EXAMPLE2", "eco_example_c", "eco_example_d", "MERGE", "", "reviewed, one event"),
]


def ensure_template(spark: SparkSession, path: str, kind: str) -> bool:
    """Write the example decision file when there is none yet; True when it was written."""
    rows, columns = (QA_TEMPLATE, QA_REQUIRED + QA_OPTIONAL) if kind == "qa" else (PAIR_TEMPLATE, PAIR_COLUMNS)
    try:
        spark.read.option("header", True).csv(path)
        return False
    except AnalysisException as error:
        if not is_absent(error):
            raise
        template = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
        export_csv(template.coalesce(1), path, mode="errorifexists")
        return True
