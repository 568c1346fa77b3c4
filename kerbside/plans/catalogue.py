"""Every operator as a query over the driver's tables.

Doubles are rounded here, not in the library, so that results do not show the order in which a sum
was taken: amounts to cents, quantiles and rates to 6 places. Hourly averages are compared to the
last bit, as whole seconds and half miles sum up exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from kerbside.functions import clock, names
from kerbside.operators import metrics, rollup, serving, slices
from kerbside.plans import tables
from kerbside.plans.cycle import Warehouse, run_cycle
from kerbside.plans.ingest import load_slices, plan_slices
from kerbside.plans.refresh import merged_rollup
from kerbside.session import scratch_dir
from kerbside.sources import csv_export, discovery, driver_tables
from kerbside.sources.trips import canonicalise, load_trips, scan_files
from kerbside.spec import HOURLY_COLUMNS, SERVICES, SPECS
from kerbside.streaming.hourly import latest_hours, stream_hourly
from kerbside.streaming.ingest import compact, stream_ingest

Query = Callable[[SparkSession, str], DataFrame]

START, END = "2024-02-01", "2024-06-01"
AS_OF = "2024-03-15 10:00:00"
# Latest pick-up loaded so far, by service, for the planning queries; green is not loaded yet.
LOADED_UNTIL = {"fhvhv": "2024-01-20", "fhv": "2024-03-10", "yellow": "2024-02-20"}


def stable(df: DataFrame) -> DataFrame:
    """Round doubles: ``total_*`` and ``amount`` to 2 places, all others but averages to 6."""
    cents = ("total_", "amount")

    def column(field: StructField) -> str:
        name = field.name
        if not isinstance(field.dataType, DoubleType) or name.startswith("avg_"):
            return name
        return f"round({name}, {2 if name.startswith(cents) else 6}) AS {name}"

    return df.selectExpr(*map(column, df.schema))


# Inputs


def service_trips(spark: SparkSession, sf_dir: str, *services: str) -> dict[str, DataFrame]:
    """Trips by service, under canonical column names."""
    every = driver_tables.trips(spark, sf_dir)
    return {
        s: canonicalise(driver_tables.raw_trips(every, s)) for s in services or SERVICES
    }


def hourly(
    spark: SparkSession, sf_dir: str, *services: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    trips = service_trips(spark, sf_dir, *services)
    return rollup.all_services_hourly(trips, start, end)


def served(spark: SparkSession, sf_dir: str, *services: str) -> DataFrame:
    """The rollup over the serving range, filtered on the raw pick-up times."""
    return hourly(spark, sf_dir, *services, start=START, end=END)


def landing(spark: SparkSession, sf_dir: str, *services: str) -> tuple[str, Warehouse, str]:
    """Monthly raw files of the services in a new shared folder, an empty warehouse beside it."""
    root = scratch_dir(spark, "kerbside")
    driver_tables.write_landing(spark, sf_dir, f"{root}/landing", list(services or SERVICES))
    return f"{root}/landing", Warehouse(f"{root}/warehouse"), root


# Discovery and planning


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the trips' monthly files, among others that are no trip files."""
    trips = driver_tables.trips(spark, sf_dir)
    month = driver_tables.FILE_MONTH
    spellings = [
        f"concat(service, '_tripdata_', {month}, '.parquet')",
        "concat('.', service, '_tripdata.crc')",
        "concat(service, '_zones_2024-01.parquet')",
        f"concat('x_', {month}, '.parquet')",
    ]
    return trips.selectExpr(f"explode(array({', '.join(spellings)})) AS file_name").distinct()


def discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = discovery.trip_files(file_names(spark, sf_dir), "file_name")
    return discovery.discover_tables(files)


def loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips picked up by the time each service was last loaded."""
    until = " ".join(f"WHEN '{s}' THEN {clock.ntz(t)}" for s, t in LOADED_UNTIL.items())
    return driver_tables.trips(spark, sf_dir).filter(
        f"pickup_datetime <= CASE service {until} END"
    )


def start_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fhv has no file any more, green is not loaded."""
    found = discovered(spark, sf_dir).filter("service <> 'fhv'")
    return slices.table_start_times(found, rollup.watermark(loaded(spark, sf_dir)))


def slice_plan(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    plan = slices.slice_plan(start_times(spark, sf_dir), AS_OF, year=2024, mode=mode)
    return plan.select("file_name", "table_name", "start_time", "end_time")


def bounded_slices(spark: SparkSession, sf_dir: str) -> list[slices.Bounds]:
    """A slice per loaded service, from its watermark to the latest pick-up before ``AS_OF``.

    Both bounds are pick-up times that exist. fhv, of which no trip follows, is loaded to the end.
    Both come from one pass, and there is one row per service.
    """
    until = " ".join(f"WHEN '{s}' THEN {clock.ntz(t)}" for s, t in LOADED_UNTIL.items())
    trips = driver_tables.trips(spark, sf_dir).filter(f"pickup_datetime <= {clock.ntz(AS_OF)}")
    rows = trips.groupBy("service").agg(
        F.expr(f"max(pickup_datetime) FILTER (WHERE pickup_datetime <= CASE service {until} END)").alias("start"),
        F.max("pickup_datetime").alias("end"),
    )
    return [(r.service, r.start, r.end) for r in rows.collect() if r.service in LOADED_UNTIL]


def slice_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = driver_tables.trips(spark, sf_dir).select("service", "pickup_datetime", "trip_time")
    return slices.slice_filter(trips, bounded_slices(spark, sf_dir))


def slice_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = driver_tables.trips(spark, sf_dir).select("service", "pickup_datetime")
    return slices.slice_count(trips, bounded_slices(spark, sf_dir))


# Scans, stores and streams


FARE = {"fhvhv": "base_passenger_fare", "yellow": "fare_amount", "green": "fare_amount"}
AIRPORT = {"fhvhv": "airport_fee", "yellow": "Airport_fee"}


def scan_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan all monthly files of each service at once; per file month, what came in."""
    folder, _, _ = landing(spark, sf_dir)
    found: dict[str, list[str]] = {}
    for file in discovery.list_landing(spark, folder).files:
        found.setdefault(file.service, []).append(file.path)
    return _summary({s: scan_files(spark, SPECS[s], paths) for s, paths in found.items()})


def _summary(trips: dict[str, DataFrame]) -> DataFrame:
    """Per service and file month: rows, first and last times, fares, trips with an airport fee."""
    parts = [
        df.selectExpr(
            "service",
            "CAST(file_month AS STRING) AS file_month",
            "pickup_datetime",
            "dropoff_datetime",
            f"{FARE.get(s, 'CAST(NULL AS DOUBLE)')} AS fare",
            f"{AIRPORT.get(s, 'CAST(NULL AS DOUBLE)')} AS airport",
        )
        for s, df in trips.items()
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return stable(
        merged.groupBy("service", "file_month").agg(
            F.count(F.lit(1)).alias("num_rows"),
            F.min("pickup_datetime").alias("first_pickup"),
            F.max("dropoff_datetime").alias("last_dropoff"),
            F.sum("fare").alias("total_fare"),
            F.count("airport").alias("with_airport_fee"),
        )
    )


def _stored(spark: SparkSession, store: Warehouse) -> dict[str, DataFrame]:
    """The store's trips by service."""
    return {s: load_trips(spark, store.trips, spec) for s, spec in SPECS.items()}


def canonical_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four services' raw columns brought to common names; pick-ups and drop-offs per service."""
    times = [
        df.selectExpr(f"'{s}' AS service", "pickup_datetime", "dropoff_datetime")
        for s, df in service_trips(spark, sf_dir).items()
    ]
    merged = times[0]
    for frame in times[1:]:
        merged = merged.unionByName(frame)
    return merged


def ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load up to mid March, then again later and twice over; the store holds every trip once."""
    folder, store, _ = landing(spark, sf_dir)
    run_cycle(spark, folder, store, "2024-03-15 10:00:00")
    run_cycle(spark, folder, store, "2024-07-02")
    run_cycle(spark, folder, store, "2024-07-02")
    return _summary(_stored(spark, store))


def refresh_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored rollups after an early load and an incremental refresh."""
    folder, store, _ = landing(spark, sf_dir)
    run_cycle(spark, folder, store, "2024-04-10")
    return stable(run_cycle(spark, folder, store, "2024-07-02").rollup)


def cycle_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollups of a cycle that follows two runs which loaded trips and ended before the rest."""
    folder, store, _ = landing(spark, sf_dir)
    run_cycle(spark, folder, store, "2024-02-10")
    for as_of in ("2024-04-20", "2024-05-03"):
        load_slices(spark, plan_slices(spark, folder, store.trips, as_of).slices, store.trips)
    return stable(run_cycle(spark, folder, store, "2024-07-02").rollup)


def cycle_with_stray_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store after three cycles, where a pick-up of the year 2098 is in every January file.

    February is first loaded with a bound; the stray pick-ups must not keep it that way.
    """
    folder, store, _ = landing(spark, sf_dir)
    for spec in SPECS.values():
        january = f"{folder}/file={spec.table}_2024-01.parquet"
        first = spark.read.parquet(january).orderBy(spec.pickup, spec.dropoff).limit(1)
        far = F.lit("2098-01-01").cast("timestamp_ntz")
        first.withColumn(spec.pickup, far).write.mode("append").parquet(january)
    for as_of in ("2024-02-15", "2024-03-15", "2024-07-02"):
        run_cycle(spark, folder, store, as_of)
    known = {s: df.filter("pickup_datetime < '2090-01-01'") for s, df in _stored(spark, store).items()}
    return _summary(known)


def stream_ingest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files loaded as a stream, five per batch, then once more without new files."""
    folder, store, root = landing(spark, sf_dir)
    for _ in range(2):
        stream_ingest(spark, folder, store, f"{root}/checkpoint", files_per_batch=5)
    return _summary(_stored(spark, store))


def stream_hourly_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of all services closed by a watermark one hour behind."""
    folder, _, root = landing(spark, sf_dir)
    hours = []
    for service, spec in SPECS.items():
        out = f"{root}/hours/{service}"
        stream_hourly(spark, folder, spec, out, f"{root}/checkpoint/{service}")
        hours.append(spark.read.parquet(out))
    return stable(rollup.union_services(hours))


def _arrive(spark: SparkSession, source: str, folder: str, months: list[str]) -> None:
    """Put the monthly files of some months, of all services, into a landing folder."""
    job = driver_tables.landing_session(spark)
    arrived: dict[str, list[str]] = {}
    for file in discovery.list_landing(job, source).files:
        if file.file_month in months:
            arrived.setdefault(file.service, []).append(file.path)
    for _, files in sorted(arrived.items()):
        driver_tables.write_files(job.read.option("basePath", source).parquet(*files), folder)


def _months(spark: SparkSession, folder: str) -> list[str]:
    return sorted({f.file_month for f in discovery.list_landing(spark, folder).files})


def stream_hourly_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed hours of all services, where every second month's files arrive after all others."""
    every, _, root = landing(spark, sf_dir)
    months = _months(spark, every)
    for part in (months[::2], months[1::2]):
        _arrive(spark, every, f"{root}/late", part)
        for service, spec in SPECS.items():
            stream_hourly(spark, f"{root}/late", spec, f"{root}/hours/{service}", f"{root}/checkpoint/{service}")
    return stable(rollup.union_services([
        latest_hours(spark, f"{root}/hours/{s}").withColumn("service", F.lit(s)) for s in SPECS
    ]))


def cycle_after_restatement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup after files were first published without trips that lack a drop-off, later in full.

    All months are loaded, then the two oldest of each service are rewritten in place: they are loaded
    again, though the watermark stands months later. The last month arrives short and is restated, too.
    """
    every, store, root = landing(spark, sf_dir)
    months = _months(spark, every)
    short = [*months[:2], months[-1]]
    folder = f"{root}/published"
    for file in discovery.list_landing(spark, every).files:
        name = file.path.rstrip("/").rsplit("/", 1)[1]
        trips = spark.read.parquet(file.path)
        if file.file_month in short:
            trips = trips.filter(F.col(SPECS[file.service].dropoff).isNotNull())
        trips.write.parquet(f"{folder}/{name}")
    run_cycle(spark, folder, store, "2024-07-02")
    for file in discovery.list_landing(spark, every).files:
        if file.file_month in short:
            name = file.path.rstrip("/").rsplit("/", 1)[1]
            spark.read.parquet(file.path).write.mode("overwrite").parquet(f"{folder}/{name}")
    return stable(run_cycle(spark, folder, store, "2024-07-02").rollup)


def rollup_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup as a reader took it before further cycles loaded later months: up to the bound then."""
    folder, store, _ = landing(spark, sf_dir)
    held = run_cycle(spark, folder, store, AS_OF).rollup
    for as_of in ("2024-05-03", "2024-07-02"):
        run_cycle(spark, folder, store, as_of)
    return stable(held)


def mixed_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store after streams and batches took turns on the same services, compacted in between."""
    every, store, root = landing(spark, sf_dir)
    months, folder = _months(spark, every), f"{root}/mixed"
    _arrive(spark, every, folder, months[:2])
    stream_ingest(spark, folder, store, f"{root}/checkpoint", files_per_batch=5)
    _arrive(spark, every, folder, months[2:4])
    run_cycle(spark, folder, store, AS_OF)
    compact(spark, store)
    _arrive(spark, every, folder, months[4:])
    stream_ingest(spark, folder, store, f"{root}/checkpoint", files_per_batch=5)
    run_cycle(spark, folder, store, "2024-07-02")
    return _summary(_stored(spark, store))


def tables_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips and hours per service by the names of the catalog, after two cycles: SQL alone."""
    folder, store, root = landing(spark, sf_dir)
    database = "trips_" + root.rsplit("-", 1)[1]
    for as_of in (AS_OF, "2024-07-02"):
        run_cycle(spark, folder, store, as_of, database=database)
    known = sorted(set(tables.existing_tables(spark, database)) & set(tables.existing_rollups(spark, database)))
    return spark.sql(" UNION ALL ".join(
        f"""SELECT '{s}' AS service, (SELECT count(*) FROM {database}.{s}_tripdata) AS num_rows,
            (SELECT count(DISTINCT file_month) FROM {database}.{s}_tripdata) AS months,
            (SELECT count(*) FROM {database}.{s}_hourly) AS hours,
            (SELECT sum(num_trips) FROM {database}.hourly WHERE service = '{s}') AS rolled_up"""
        for s in known
    ))


def export_query(spark: SparkSession, sf_dir: str, service: str, with_index: bool) -> DataFrame:
    """A service's export, read back from its CSV files."""
    rows = hourly(spark, sf_dir, service)
    folder = scratch_dir(spark, "kerbside")
    schema = csv_export.export_rows(rows, service, START, END, with_index).schema
    path = csv_export.export_range(rows, service, START, END, folder, with_index)
    return stable(spark.read.schema(schema).option("header", True).csv(path))


# Rollups


def hourly_one(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    trips = service_trips(spark, sf_dir, service)[service]
    return stable(rollup.hourly_rollup(trips, SPECS[service]))


def hourly_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All services' rollups merged from parts per file month, so hours may have several."""
    parts = None
    every = driver_tables.trips(spark, sf_dir).withColumn("slice", F.expr(driver_tables.FILE_MONTH))
    for service in SERVICES:
        sliced = canonicalise(driver_tables.raw_trips(every, service, "slice"))
        part = rollup.hourly_parts(sliced, SPECS[service], "slice")
        parts = part if parts is None else parts.unionByName(part, allowMissingColumns=True)
    return stable(merged_rollup(parts)).select("service", *HOURLY_COLUMNS)


# Metrics


def counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = driver_tables.samples(spark, sf_dir, "container_cpu_usage_seconds_total")
    return stable(metrics.counter_rate(samples)).select("ts", "id", "rate")


def cpu_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel(spark, sf_dir, "cpu_usage").select("ts", "id", F.col("value").alias("cpu_percent"))


def panel(spark: SparkSession, sf_dir: str, title: str) -> DataFrame:
    samples = driver_tables.samples(spark, sf_dir, metrics.PANELS[title].metric)
    chosen = ["click", "view"] if title == "container_receive" else None
    points = metrics.panel(samples, title, chosen)
    return stable(points.select("ts", "id", "name", "interface", "legend", "value"))


def label_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples per series whose id is a container's and whose name is selected."""
    samples = driver_tables.samples(spark, sf_dir)
    chosen = metrics.label_filter(samples, None, "/docker/.+", ["click", "view", "error"])
    return stable(
        chosen.groupBy("metric", "id", "name").agg(
            F.count(F.lit(1)).alias("num_samples"), F.max("value").alias("max_value")
        )
    )


def label_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    metric = "container_memory_usage_bytes"
    return metrics.label_values(driver_tables.samples(spark, sf_dir, metric), metric, "name")


def gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel(spark, sf_dir, "memory_usage").select("ts", "id", "value")


TREND_METRICS = {"trips": "num_trips", "payed": "total_amount_payed"}
HISTOGRAMS = {
    "trip_time": "avg_trip_time_min",
    "trip_miles": "avg_trip_miles",
    "on_scene": "avg_request_to_on_scene_time_min",
}


def trend(spark: SparkSession, sf_dir: str, metric: str, by: str, agg: str = "sum") -> DataFrame:
    return stable(serving.trend(served(spark, sf_dir), metric, by, START, END, agg))


def unavailable_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that fhv's rollup answers each average with: none for those it does not have."""
    rows = served(spark, sf_dir, "fhv")
    counts = [
        serving.available(rows, m).agg(F.lit(m).alias("metric"), F.count(F.lit(1)).alias("hours"))
        for m in names.AVERAGED_METRICS.values()
    ]
    return reduce(DataFrame.unionByName, counts)


def _on_average(operator, spark: SparkSession, sf_dir: str, metric: str) -> DataFrame:
    rows = served(spark, sf_dir, *serving.services_with(metric))
    return stable(operator(rows, metric, START, END))


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "discover_tables": discovered,
        "existing_tables": lambda s, d: discovery.existing_tables(driver_tables.trips(s, d)),
        "new_tables": lambda s, d: discovery.new_tables(
            discovered(s, d), discovery.existing_tables(loaded(s, d))
        ),
        "table_start_times": start_times,
        "watermark": lambda s, d: rollup.watermark(driver_tables.trips(s, d)),
        "slice_plan": partial(slice_plan, mode="append"),
        "slice_plan_replace": partial(slice_plan, mode="replace"),
        "slice_filter": slice_filter,
        "slice_count": slice_count,
        "scan_trips": scan_trips,
        "canonical_columns": canonical_columns,
        "ingest_roundtrip": ingest_roundtrip,
        "refresh_rollup": refresh_rollup,
        "stream_ingest": stream_ingest_query,
        "stream_hourly": stream_hourly_query,
        "stream_hourly_late": stream_hourly_late,
        "cycle_after_failure": cycle_after_failure,
        "cycle_after_restatement": cycle_after_restatement,
        "rollup_snapshot": rollup_snapshot,
        "mixed_loads": mixed_loads,
        "tables_by_name": tables_by_name,
        "cycle_with_stray_pickup": cycle_with_stray_pickup,
        "export_range": partial(export_query, service="yellow", with_index=False),
        "export_range_indexed": partial(export_query, service="yellow", with_index=True),
        "all_services_hourly": lambda s, d: stable(hourly(s, d)),
        "hourly_from_parts": hourly_from_parts,
        "rollup_key_check": lambda s, d: rollup.key_check(hourly(s, d)),
        "calendar_view": lambda s, d: stable(serving.calendar_view(hourly(s, d))).orderBy(
            "service", "pickup_hour"
        ),
        "unavailable_metric": unavailable_metric,
        "metric_availability": lambda s, d: serving.metric_availability(served(s, d)),
        "card_num_trips": lambda s, d: serving.card_num_trips(served(s, d), START, END),
        "card_total_payed": lambda s, d: stable(
            serving.card_total_payed(served(s, d), START, END)
        ),
        "trends_all": lambda s, d: stable(serving.trends(served(s, d), START, END)),
        "trend_avg_payed_month": partial(
            trend, metric="total_amount_payed", by="month", agg="avg"
        ),
        "trend_median_trips_day_of_week": partial(
            trend, metric="num_trips", by="day_of_week", agg="median"
        ),
        "metric_label_filter": label_query,
        "metric_label_values": label_values,
        "metric_gauge": gauge,
        "counter_rate_5m": counter_rate,
        "cpu_percent": cpu_percent,
    }
    for service in SERVICES:
        found[f"hourly_{service}"] = partial(hourly_one, service=service)
        if service != "yellow":
            found[f"export_range_{service}"] = partial(
                export_query, service=service, with_index=False
            )
            found[f"export_range_indexed_{service}"] = partial(
                export_query, service=service, with_index=True
            )
    for short, metric in TREND_METRICS.items():
        for unit in clock.CALENDAR:
            found[f"trend_{short}_{unit}"] = partial(trend, metric=metric, by=unit)
    for service in serving.PAYING_SERVICES:
        found[f"contrib_{service}"] = lambda s, d, service=service: stable(
            serving.contributions(served(s, d, service), service, START, END)
        )
    for short, metric in HISTOGRAMS.items():
        for prefix, operator in (
            ("p99", serving.upper_quantile),
            ("p99_trim", serving.trim_upper),
            ("hist", serving.histogram),
        ):
            found[f"{prefix}_{short}"] = partial(_on_average, operator, metric=metric)
    for title in metrics.PANELS:
        if title not in ("cpu_usage", "memory_usage"):
            found[f"panel_{title}"] = partial(panel, title=title)
    return found
