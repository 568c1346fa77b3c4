"""The load record: what has been loaded, up to which bound, and is in the rollup.

A month's entry is removed before the month is touched and written after its trips are in the
published rollup. A run that ends in between leaves months without an entry, which the next run
takes up. There is one small file per service and month.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import SparkSession

from kerbside.sources import discovery, paths

Key = tuple[str, str]
UNKNOWN = datetime(1970, 1, 1)  # a bound for months of which it is not known how far they were loaded
SCHEMA = "loaded_until timestamp_ntz, num_rows long, service string, file_month string"


class Loaded(NamedTuple):
    """Rows of a loaded month; ``loaded_until`` is its exclusive bound, None for a whole file."""

    loaded_until: datetime | None
    num_rows: int


def read(spark: SparkSession, record_dir: str) -> dict[Key, Loaded]:
    """All entries: one per monthly file."""
    if not paths.exists(spark, record_dir):
        return {}
    rows = spark.read.schema(SCHEMA).parquet(record_dir).collect()
    return {(r.service, r.file_month): Loaded(r.loaded_until, r.num_rows) for r in rows}


def before_records(spark: SparkSession, trips_dir: str, parts_dir: str) -> dict[Key, Loaded]:
    """Entries for a warehouse that has none yet: months with trips and parts.

    How far the latest month of a service was loaded is not known, so it gets no entry.
    """
    kept = set(discovery.loaded_months(spark, trips_dir)) & set(discovery.loaded_months(spark, parts_dir))
    latest = {service: month for service, month in sorted(kept)}
    return {key: Loaded(None, 0) for key in kept if latest[key[0]] != key[1]}


def forget(spark: SparkSession, record_dir: str, keys: Iterable[Key]) -> None:
    for service, month in keys:
        paths.delete(spark, f"{record_dir}/service={service}/file_month={month}")


def write(spark: SparkSession, record_dir: str, found: dict[Key, Loaded]) -> None:
    """Add entries, replacing those of the same months."""
    if not found:
        return
    rows = [(x.loaded_until, x.num_rows, *key) for key, x in found.items()]
    (
        spark.createDataFrame(rows, SCHEMA)
        .repartition("service", "file_month")
        .write.partitionBy("service", "file_month")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(record_dir)
    )
