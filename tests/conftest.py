from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).parents[1]
for folder in (str(ROOT), str(ROOT / "tests")):
    if folder not in sys.path:
        sys.path.insert(0, folder)

from kerbside.session import local_session  # noqa: E402
from kerbside.spec import SPECS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield session
    session.stop()


def ts(text: str | None) -> datetime | None:
    return text and datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def trips(spark):
    """Build one service's canonical trips from dicts; what is not given is NULL."""

    def build(service: str, rows: list[dict]):
        schema = SPECS[service].trip_schema
        times = {f.name for f in schema if f.dataType.typeName() == "timestamp_ntz"}
        values = [
            tuple(ts(r.get(c)) if c in times else r.get(c) for c in schema.names) for r in rows
        ]
        return spark.createDataFrame(values, schema)

    return build


@pytest.fixture(scope="session")
def hourly(spark):
    """Build a rollup from (service, hour, column values)."""

    def build(rows: list[dict], columns: str):
        schema = f"service string, pickup_hour timestamp_ntz, {columns}"
        names = [c.split()[0] for c in columns.split(",")]
        values = [
            (r["service"], ts(r["pickup_hour"]), *(r.get(n) for n in names)) for r in rows
        ]
        return spark.createDataFrame(values, schema)

    return build


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
