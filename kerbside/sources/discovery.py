"""Which trip files and tables there are."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions import names
from kerbside.sources import paths, store
from kerbside.spec import SERVICES, SPECS


class TripFile(NamedTuple):
    """One month of one service: a file, or a folder of part files.

    ``sources`` identify the files as they are now.
    """

    service: str
    table_name: str
    file_month: str
    path: str
    bytes: int
    sources: tuple[str, ...] = ()


class Landing(NamedTuple):
    """A landing folder's trip files, and the names of what is none or of an unknown service."""

    files: list[TripFile]
    ignored: list[str]


def list_landing(spark: SparkSession, landing: str) -> Landing:
    """List the landing folder: one call for it and one for each month that is a folder.

    It has an entry per monthly file, so the listing stays small whatever the files hold. Hidden
    names are passed over.
    """
    files, ignored = [], []
    for entry in paths.entries(spark, f"{landing.rstrip('/')}/*"):
        if entry.name[0] in "._":
            continue
        found = re.search(names.TRIP_FILE, entry.name)
        service = found and found[1].removesuffix("_tripdata")
        held = paths.data_files(spark, entry.path) if entry.is_folder else [entry]
        if service not in SPECS or not held:
            ignored.append(entry.name)
            continue
        size = sum(e.length for e in held)
        sources = tuple(sorted(e.identity for e in held))
        files.append(TripFile(service, found[1], f"{found[2]}-{found[3]}", entry.path, size, sources))
    return Landing(files, ignored)


def discover_files(spark: SparkSession, landing: str) -> DataFrame:
    """Monthly trip files under ``landing``: (service, table_name, file_month, path, bytes).

    A month may be one file or a folder of part files; either is one row.
    """
    schema = "service string, table_name string, file_month string, path string, bytes long"
    return spark.createDataFrame([f[:5] for f in list_landing(spark, landing).files], schema)


def trip_files(names_df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose ``column`` names a trip file of a known service; add what the name says."""
    path = F.col(column)
    return names_df.withColumns(
        {
            "service": names.service_of(path),
            "table_name": names.table_of(path),
            "file_month": names.file_month_of(path),
        }
    ).filter(F.col("service").isin(SERVICES))


def discover_tables(files: DataFrame) -> DataFrame:
    """Distinct tables the files belong to: (service, table_name)."""
    return files.select("service", "table_name").distinct()


def existing_tables(trips: DataFrame) -> DataFrame:
    """Distinct services that have trips."""
    return trips.select("service").distinct()


def loaded_services(spark: SparkSession, trips_dir: str) -> list[str]:
    """Services that the store has trips of, from its log alone."""
    return sorted({p.service for p in store.pieces(spark, trips_dir)})


def loaded_months(spark: SparkSession, trips_dir: str) -> list[tuple[str, str]]:
    """(service, file_month) that the store has rows of, from its log alone."""
    return sorted({p.key for p in store.pieces(spark, trips_dir) if p.service in SPECS})


def new_tables(discovered: DataFrame, existing: DataFrame) -> DataFrame:
    """Discovered services that are not loaded yet."""
    return discovered.join(existing, "service", "left_anti")
