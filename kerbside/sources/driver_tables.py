"""Trips and metric samples derived from the driver's ``lineitem`` and ``events`` tables.

The adapters are narrow projections: whatever size the tables have, so has the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.clock import month_label
from kerbside.session import job_session
from kerbside.spec import SPECS, ServiceSpec

# Columns the adapters read; declaring them saves the job that infers a schema.
_LINEITEM = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_returnflag string"
)
_EVENTS = "event_id long, user_id long, event_type string, value double"

_TRIPS = [
    "CASE (l_partkey + l_suppkey) % 4 WHEN 0 THEN 'fhvhv' WHEN 1 THEN 'fhv'"
    " WHEN 2 THEN 'yellow' ELSE 'green' END AS service",
    "request_datetime",
    "CASE WHEN l_linenumber <> 7 THEN"
    " request_datetime + (l_partkey % 900) * INTERVAL '1' SECOND END AS on_scene_datetime",
    "request_datetime + INTERVAL '20' MINUTE AS pickup_datetime",
    "CASE WHEN l_linenumber <> 6 THEN"
    " request_datetime + (1200 + trip_time) * INTERVAL '1' SECOND END AS dropoff_datetime",
    "trip_time",
    "l_quantity * 0.5D AS trip_distance",
    "l_extendedprice AS base_fare",
    "l_quantity * 0.25D AS extra",
    "l_quantity * 2D AS tolls",
    "l_quantity * 0.5D AS black_car_fund",
    "l_quantity AS tax",
    "1D AS improvement",
    "2.75D AS congestion",
    "CASE WHEN l_returnflag <> 'N' THEN l_quantity * 3D END AS tips",
    "CASE WHEN l_linenumber <= 3 THEN 1.75D END AS airport_fee",
    "l_quantity * 10D AS driver_pay",
]

# Column of the adapter behind each raw column whose name differs.
_RAW_SOURCE = {
    "tpep_pickup_datetime": "pickup_datetime",
    "lpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "lpep_dropoff_datetime": "dropoff_datetime",
    "dropOff_datetime": "dropoff_datetime",
    "trip_miles": "trip_distance",
    "base_passenger_fare": "base_fare",
    "fare_amount": "base_fare",
    "bcf": "black_car_fund",
    "sales_tax": "tax",
    "mta_tax": "tax",
    "tip_amount": "tips",
    "tolls_amount": "tolls",
    "improvement_surcharge": "improvement",
    "congestion_surcharge": "congestion",
    "Airport_fee": "airport_fee",
}


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of all services from ``lineitem``, January to June 2024, with generic column names."""
    return (
        spark.read.schema(_LINEITEM)
        .parquet(f"{sf_dir}/lineitem.parquet")
        .selectExpr(
            "*",
            "TIMESTAMP_NTZ '2024-01-01 00:00:00' + INTERVAL '1' SECOND"
            " * ((l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 911) % 15724800)"
            " AS request_datetime",
            "60 + (l_partkey * 13) % 3600 AS trip_time",
        )
        .selectExpr(*_TRIPS)
    )


def raw_trips(all_trips: DataFrame, service: str, *more: str) -> DataFrame:
    """One service's trips under the column names of its raw files, with ``more`` columns."""
    chosen = all_trips.filter(f"service = '{service}'")
    return chosen.selectExpr(*_raw_columns(SPECS[service]), *more)


def _raw_columns(spec: ServiceSpec) -> list[str]:
    return [f"{_RAW_SOURCE.get(c, c)} AS {c}" for c in spec.raw_schema.fieldNames()]


FILE_SIZE = "128m"
# Month whose file holds a trip. By request time, so a file can hold next month's pick-up.
FILE_MONTH = month_label("request_datetime")


def write_files(trips: DataFrame, folder: str) -> None:
    """Write trips to a folder for each value of their column ``file``.

    A month's part files follow its size, not how many tasks have seen its trips.
    """
    trips.hint("rebalance", "file").write.partitionBy("file").mode("append").parquet(folder)


def landing_session(spark: SparkSession) -> SparkSession:
    """A session whose :func:`write_files` makes part files of some ``FILE_SIZE`` in the shuffle."""
    job = job_session(spark)
    job.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", FILE_SIZE)
    return job


def write_landing(spark: SparkSession, sf_dir: str, landing: str, services: list[str]) -> None:
    """Write the services' trips as monthly raw files, one job per service.

    Months are folders named ``file={table}_{YYYY-MM}.parquet``.
    """
    job = landing_session(spark)
    for service in services:
        spec = SPECS[service]
        source = trips(job, sf_dir).filter(F.col("service") == service)
        name = f"concat('{spec.table}_', {FILE_MONTH}, '.parquet') AS file"
        write_files(source.selectExpr(*_raw_columns(spec), name), landing)


# Metric name and value of each sample an event yields: counters that reset, and two gauges.
_SAMPLES = {
    "container_cpu_usage_seconds_total": "(event_id * 7) % 5000",
    "container_memory_usage_bytes": "value * 1000",
    "container_memory_cache": "value * 250",
    "container_network_receive_bytes_total": "(event_id * 11) % 7000",
    "container_network_transmit_bytes_total": "(event_id * 13) % 9000",
    "container_fs_reads_bytes_total": "(event_id * 17) % 8000",
    "container_fs_writes_bytes_total": "(event_id * 19) % 6000",
}


def samples(spark: SparkSession, sf_dir: str, *metrics: str) -> DataFrame:
    """Metric samples from ``events``: (ts, metric, id, name, interface, value).

    Every event yields one sample of each of ``metrics``, by default all; only network metrics have
    an interface.
    """
    pairs = ", ".join(
        f"struct('{metric}' AS metric, CAST({value} AS DOUBLE) AS value)"
        for metric, value in _SAMPLES.items()
        if metric in (metrics or _SAMPLES)
    )
    return (
        spark.read.schema(_EVENTS)
        .parquet(f"{sf_dir}/events.parquet")
        .selectExpr(
            "TIMESTAMP_NTZ '2024-01-01 00:00:00' + event_id * 15 * INTERVAL '1' SECOND AS ts",
            "event_type AS name",
            "CASE WHEN event_type = 'error' THEN '/system/error'"
            " ELSE concat('/docker/', event_type) END AS id",
            "CASE WHEN user_id % 2 = 0 THEN 'eth0' ELSE 'lo' END AS nic",
            f"explode(array({pairs})) AS s",
        )
        .selectExpr(
            "ts",
            "s.metric AS metric",
            "id",
            "name",
            "CASE WHEN s.metric LIKE 'container_network%' THEN nic END AS interface",
            "s.value AS value",
        )
    )
