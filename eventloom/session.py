"""Session helpers: a tuned builder and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "eventloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are written for; every one can be overridden."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A skewed lookup key is worth one more exchange.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # The JVM does not compile longer methods; wide projections run faster in split form.
        "spark.sql.codegen.hugeMethodLimit": "8000",
    } | {key.replace("__", "."): value for key, value in conf.items()}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Scratch folders of local sessions that name none, by application.
_SCRATCH: dict[str, str] = {}


def checkpoint_folder(spark: SparkSession) -> str:
    """Shared folder for written tables: the session's own, or a scratch one on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = tempfile.mkdtemp(prefix="eventloom-checkpoint-")
    return _SCRATCH[app]


# Removes an execution's shuffle files when it ends (Spark 4.1); else they stay until the driver collects garbage.
_DROPS_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame, drop_shuffles: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Lost executors then cost a read instead of a recomputation, and unlike an RDD checkpoint the
    result has sizes the planner can use and columns that are read only when needed. With
    ``drop_shuffles`` the shuffle files of the writing are gone when it is done.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/eventloom-{uuid.uuid4().hex}"
    before = spark.conf.get(_DROPS_SHUFFLES, None)
    if drop_shuffles:
        spark.conf.set(_DROPS_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if drop_shuffles:
            spark.conf.unset(_DROPS_SHUFFLES) if before is None else spark.conf.set(_DROPS_SHUFFLES, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete what ``cut_lineage`` wrote for ``frames``, once nothing reads it any more; other frames are left alone."""
    for df in frames:
        path = getattr(df, "_written_path", None)
        if path:
            target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over all cores, for costly work on rows of small files, which Spark reads in few tasks."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))
