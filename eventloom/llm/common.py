"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts are worked on in slices of about so many bytes, so that a task's memory follows this and not the batch.
SLICE_BYTES = 2_000_000


def crc_bucket(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % modulus


def sampled(df: DataFrame, rows: int, seed: str, *key: str) -> DataFrame:
    """At most ``rows`` rows, picked by a hash of ``key``: the same rows whatever the partitioning."""
    place = F.xxhash64(F.lit(seed), *key)
    return df.orderBy(place, *key).limit(rows)


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [start, end) of rows whose texts hold about ``limit`` bytes; a longer text is a run of its own.

    Only lengths are looked at, so that no more than a run's texts have to be Python objects at a time.
    """
    start, held = 0, 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


# Rows of an Arrow batch between the executors' Java and Python sides. A row is a whole text here, so the default of
# 10,000 rows would hold tens of megabytes on either side of every running task.
BATCH_ROWS = 500


def map_in_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``df.mapInArrow`` in batches of at most ``BATCH_ROWS`` rows; lowers the session's setting, which plans read when they run."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def map_rows(
    df: DataFrame, columns: list[str], fn: Callable[[dict[str, list]], dict[str, list]], schema: T.StructType
) -> DataFrame:
    """Run ``fn`` over Arrow batches of ``columns``; the first of them is the text that slices are made by.

    ``fn`` gets and returns columns as lists of equal length. No shuffle, one pass, row order kept.
    """
    types = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in slices(batch.column(0)):
                part = batch.slice(start, end - start)
                cols = {name: part.column(i).to_pylist() for i, name in enumerate(columns)}
                out = fn(cols)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[field.name], type=field.type) for field in types], schema=types
                )

    return map_in_arrow(df.select(*columns), run, schema)


def keep_rows(docs: DataFrame, judge: Callable[[], Callable[[list[str | None]], list[bool]]]) -> DataFrame:
    """Rows of ``docs``, with all columns, whose text is kept; ``judge`` makes a task's function from texts to verdicts."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = judge()
        for batch in batches:
            texts = batch.column(place)
            keep = [ok for start, end in slices(texts) for ok in own(texts.slice(start, end - start).to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return map_in_arrow(docs, run, docs.schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
    "string": T.StringType(), "binary": T.BinaryType(), "bigints": T.ArrayType(T.LongType()),
    "ints": T.ArrayType(T.IntegerType()), "strings": T.ArrayType(T.StringType()),
    "doubles": T.ArrayType(T.DoubleType()),
    "spans": T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
}


def schema_of(text: str) -> T.StructType:
    """Schema from "name type, name type"; needs no session, so modules can state theirs."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (part.split() for part in text.split(","))])
