"""Table readers shared by all stages."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom import schemas

TEXT_FORMATS = {".csv": "csv", ".json": "json", ".orc": "orc"}


def is_absent(error: AnalysisException) -> bool:
    """Whether a read failed because there is nothing at the path; any other failure is a fault and not an empty table."""
    return error.getCondition() == "PATH_NOT_FOUND"


def has_broken_cells(spark: SparkSession, path: str) -> bool:
    """Whether a CSV line below ``path`` has an odd number of quotes, as the first line of a cell with a line break has.

    A quote alone in an unquoted cell is found as well, which does no harm: read whole, the file means the same.
    """
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def read_table(spark: SparkSession, path: str, fmt: str | None = None, multi_line: bool | None = None) -> DataFrame:
    """Parquet unless the name says otherwise. CSV columns are read as text, so codes keep leading zeros.

    A quoted cell of a CSV file may hold line breaks. Such a file cannot be split and is one task's work, so by default
    the quotes of each line are counted first, and only tables that need it are read file by file. ``multi_line`` says
    what to do without counting: False saves a pass over large tables known to have no such cell.
    """
    fmt = fmt or next((f for ending, f in TEXT_FORMATS.items() if path.endswith(ending)), "parquet")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        if multi_line is None:
            multi_line = has_broken_cells(spark, path)
        reader = reader.option("header", True).option("encoding", "UTF-8").option("escape", '"')
        reader = reader.option("multiLine", multi_line)
    df = reader.load(path)
    return df.withColumnsRenamed({c: c.replace("\ufeff", "").strip() for c in df.columns})


def read_or_empty(spark: SparkSession, path: str, columns: list[str], fmt: str | None = None) -> DataFrame:
    """The table, or an empty one with the contract's columns when nothing is at the path or a file has no header."""
    try:
        df = read_table(spark, path, fmt)
    except AnalysisException as error:
        if not is_absent(error):
            raise
        df = None
    if df is None or not df.columns:
        return spark.createDataFrame([], schemas.empty_schema(columns))
    return df


def read_first(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The first of several locations where there is something."""
    for path in paths:
        try:
            return read_table(spark, path)
        except AnalysisException as error:
            if not is_absent(error):
                raise
    raise FileNotFoundError(f"none of these tables exists: {paths}")


def with_row_no(df: DataFrame, name: str = "row_no") -> DataFrame:
    """The order of rows in their files as a column to compare by, unless the table already has one.

    Rows of files are placed by file, start of the split and order within it, which hold however Spark packs the splits
    into tasks. Rows given in the program have their own order. Tables made by a query have none: they need the column.
    """
    if name in df.columns:
        return df
    inside = F.monotonically_increasing_id()
    try:
        block = df.select("_metadata.file_path", "_metadata.file_block_start").columns
    except AnalysisException:
        block = []
    if block:
        place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), inside.alias("inside"))
        return df.select("*", place.alias(name))
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    if leaves.size() == 1 and leaves.apply(0).nodeName() in ("LocalRelation", "LogicalRDD"):
        return df.withColumn(name, inside)
    raise ValueError(f"a table made by a query has no file order; give it a {name} column")


def read_observations(spark: SparkSession, run_root: str, name: str = "observations") -> DataFrame:
    """Stage-1 observations of a run: stage folder first, then the run root."""
    return read_first(spark, [f"{run_root}/{folder}{name}{end}" for folder in ("stage1/", "") for end in ("", ".csv")])
