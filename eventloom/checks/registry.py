"""Queries over the driver tables, each with the SQL that must give the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventloom.checks import views
from eventloom.session import cut_lineage

Query = Callable[["Tables"], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver tables of one scale folder, and the engine inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        body, sources = views.VIEWS[name]
        text = body.replace("{", "{{").replace("}", "}}")
        for source in sources:
            text = text.replace(f"<{source}>", "{" + source + "}")
        inputs = {s: self.view(s) if s in views.VIEWS else self.raw(s) for s in sources}
        return self.spark.sql(text, **inputs)

    def solid(self, name: str) -> DataFrame:
        """A view written to the shared folder first, for queries that read it several times."""
        return cut_lineage(self.view(name))

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        return self.spark.sql(text, **frames)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, when SQL can say the same, its oracle."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = views.with_views(sql)
        return fn

    return register
