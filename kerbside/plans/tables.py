"""The warehouse's stores as tables and views of Spark's catalog, found by name.

For each service ``<service>_tripdata`` is a view of the live trips and ``<service>_hourly`` one of its
rollup; ``hourly`` has all services. Behind them are external tables, ``<service>_loads`` and
``hourly_loads``, whose partitions are the stores' pieces: (load, file_month) and (service, load). A
view names the pieces of one version, so bringing a name up to date is one statement, and a query sees
the version before or the one after.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from kerbside.operators.rollup import rollup_schema
from kerbside.plans.warehouse import Warehouse
from kerbside.sources import store
from kerbside.spec import HOURLY_COLUMNS, SERVICES, SPECS


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _spec(values: dict[str, str | int]) -> str:
    return ", ".join(f"{k} = '{v}'" if isinstance(v, str) else f"{k} = {v}" for k, v in values.items())


def _external(spark: SparkSession, table: str, schema: T.StructType, partitions: str, root: str) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({_columns(schema)}, {partitions}) USING parquet"
        f" PARTITIONED BY ({', '.join(p.split()[0] for p in partitions.split(', '))}) LOCATION '{root}'"
    )


def _bring_up(spark: SparkSession, table: str, wanted: dict[str, str]) -> set[str]:
    """Add the partitions (by their spec, with their folders) that the table lacks; the other ones."""
    have = {
        ", ".join(_spec({k: int(v) if k == "load" else v}) for k, v in (x.split("=", 1) for x in r[0].split("/")))
        for r in spark.sql(f"SHOW PARTITIONS {table}").collect()
    }
    new = [f"PARTITION ({p}) LOCATION '{wanted[p]}'" for p in sorted(wanted.keys() - have)]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(new)}")
    return have - wanted.keys()


def _drop(spark: SparkSession, table: str, partitions: set[str]) -> None:
    """Forget partitions; the files of an external table stay."""
    if partitions:
        specs = ", ".join(f"PARTITION ({p})" for p in sorted(partitions))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")


def _view(spark: SparkSession, view: str, columns: list[str], table: str, partitions: list[str]) -> None:
    named = " OR ".join(f"({p.replace(', ', ' AND ')})" for p in partitions) or "false"
    listed = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {listed} FROM {table} WHERE {named}")


def register(spark: SparkSession, warehouse: Warehouse, database: str) -> None:
    """Create the database, its tables and views, or bring them to the stores' current versions.

    A service that has no trips, or no rollup, has no view; one that it had goes.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{warehouse.root}/catalog'")
    trips = store.pieces(spark, warehouse.trips)
    for service in SERVICES:
        table, schema = f"{database}.{service}_loads", SPECS[service].trip_schema
        own = {
            _spec({"load": p.load, "file_month": p.file_month}): store.piece_dir(warehouse.trips, p)
            for p in trips
            if p.service == service
        }
        if not own:
            spark.sql(f"DROP VIEW IF EXISTS {database}.{service}_tripdata")
            continue
        _external(spark, table, schema, "load bigint, file_month string", store.service_dir(warehouse.trips, service))
        gone = _bring_up(spark, table, own)
        _view(spark, f"{database}.{service}_tripdata", [*schema.names, "file_month"], table, sorted(own))
        _drop(spark, table, gone)
    rollups = store.pieces(spark, warehouse.rollup)
    table = f"{database}.hourly_loads"
    by_service = {
        p.service: (_spec({"service": p.service, "load": p.load}), store.piece_dir(warehouse.rollup, p)) for p in rollups
    }
    if rollups:
        _external(spark, table, rollup_schema(), "service string, load bigint", warehouse.rollup)
        gone = _bring_up(spark, table, dict(by_service.values()))
        every = sorted(spec for spec, _ in by_service.values())
        _view(spark, f"{database}.hourly", ["service", *HOURLY_COLUMNS], table, every)
        for service, (spec, _) in by_service.items():
            _view(spark, f"{database}.{service}_hourly", SPECS[service].rollup_columns, table, [spec])
        _drop(spark, table, gone)
    else:
        spark.sql(f"DROP VIEW IF EXISTS {database}.hourly")
    for service in SERVICES:
        if service not in by_service:
            spark.sql(f"DROP VIEW IF EXISTS {database}.{service}_hourly")


def _services_with(spark: SparkSession, database: str, suffix: str) -> list[str]:
    if not spark.catalog.databaseExists(database):
        return []
    return [s for s in SERVICES if spark.catalog.tableExists(f"{database}.{s}_{suffix}")]


def existing_tables(spark: SparkSession, database: str) -> list[str]:
    """Services whose trips the catalog knows."""
    return _services_with(spark, database, "tripdata")


def existing_rollups(spark: SparkSession, database: str) -> list[str]:
    """Services whose rollup the catalog knows."""
    return _services_with(spark, database, "hourly")
