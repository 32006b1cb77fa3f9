from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from eventloom.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Rows given as dicts; the schema text names the columns."""

    def make(schema: str, rows: list[dict]):
        names = [part.strip().split()[0] for part in schema.split(",")]
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    return make
