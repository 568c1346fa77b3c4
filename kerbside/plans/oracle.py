"""The catalogue's queries in DuckDB SQL, written from the semantics and not from the library."""

from __future__ import annotations

START, END = "TIMESTAMP '2024-02-01'", "TIMESTAMP '2024-06-01'"
AS_OF = "TIMESTAMP '2024-03-15 10:00:00'"
UNITS = {"hour_of_day": "hour", "day_of_week": "dow", "day_of_month": "day", "month": "month"}

TRIPS = """
requests AS (
  SELECT *, 60 + (l_partkey * 13) % 3600 AS trip_time,
    TIMESTAMP '2024-01-01'
      + to_seconds((l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 911) % 15724800)
      AS request_datetime
  FROM lineitem),
trips AS (
  SELECT ['fhvhv', 'fhv', 'yellow', 'green'][1 + (l_partkey + l_suppkey) % 4] AS service,
    request_datetime, trip_time,
    CASE WHEN l_linenumber <> 7 THEN request_datetime + to_seconds(l_partkey % 900) END
      AS on_scene_datetime,
    request_datetime + to_minutes(20) AS pickup_datetime,
    CASE WHEN l_linenumber <> 6
      THEN request_datetime + to_minutes(20) + to_seconds(trip_time) END AS dropoff_datetime,
    l_quantity * 0.5 AS miles, l_extendedprice AS base_fare, l_quantity * 0.25 AS extra,
    l_quantity * 2 AS tolls, l_quantity * 0.5 AS black_car_fund, l_quantity AS tax,
    1.0::DOUBLE AS improvement, 2.75::DOUBLE AS congestion,
    CASE WHEN l_returnflag <> 'N' THEN l_quantity * 3 END AS tips,
    CASE WHEN l_linenumber <= 3 THEN 1.75::DOUBLE END AS airport_fee,
    l_quantity * 10 AS driver_pay, strftime(request_datetime, '%Y-%m') AS file_month
  FROM requests)"""

# Rollup column, adapter column and the services that have it.
_AMOUNTS = [
    ("total_base_fare_amount", "base_fare", ("fhvhv", "yellow", "green")),
    ("total_extra", "extra", ("yellow", "green")),
    ("total_tolls", "tolls", ("fhvhv", "yellow", "green")),
    ("total_black_car_fund", "black_car_fund", ("fhvhv",)),
    ("total_tax", "tax", ("fhvhv", "yellow", "green")),
    ("total_improvement_surcharge", "improvement", ("yellow", "green")),
    ("total_congestion_surcharge", "congestion", ("fhvhv", "yellow", "green")),
    ("total_airport_fees", "airport_fee", ("fhvhv", "yellow")),
    ("total_tips", "tips", ("fhvhv", "yellow", "green")),
    ("total_driver_pay", "driver_pay", ("fhvhv",)),
]
_AVERAGES = ["avg_request_to_on_scene_time_min", "avg_trip_time_min", "avg_trip_miles"]


def _columns(service: str) -> list[str]:
    averages = {"fhvhv": _AVERAGES, "fhv": _AVERAGES[1:2]}.get(service, _AVERAGES[1:])
    amounts = [out for out, _, services in _AMOUNTS if service in services]
    return [
        "pickup_hour", "num_trips", *averages, *amounts, *(["total_amount_payed"] if amounts else [])
    ]


def _rounded(columns: list[str]) -> str:
    """Amounts are rounded to cents where a query ends, and nowhere before."""
    return ", ".join(f"round({c}, 2) AS {c}" if c.startswith("total_") else c for c in columns)


def _hourly() -> str:
    """A CTE with all services' rollups; columns a service lacks are NULL."""
    sums = ",\n    ".join(
        f"sum(CASE WHEN service IN {(*services, '')} THEN {source} END) AS {out}"
        for out, source, services in _AMOUNTS
    )
    totals = "\n      ".join(
        "WHEN '{}' THEN {}".format(
            service,
            " + ".join(
                f"sum({source})"
                for out, source, services in _AMOUNTS
                if service in services and out != "total_driver_pay"
            ),
        )
        for service in ("fhvhv", "yellow", "green")
    )
    return f"""
hourly AS (
  SELECT service, date_trunc('hour', pickup_datetime)::TIMESTAMP AS pickup_hour,
    count(*) AS num_trips,
    avg(CASE WHEN service = 'fhvhv'
      THEN extract(epoch FROM on_scene_datetime - request_datetime) END) / 60
      AS avg_request_to_on_scene_time_min,
    CASE WHEN service = 'fhvhv' THEN avg(trip_time // 60)
      ELSE avg(extract(epoch FROM dropoff_datetime - pickup_datetime)) / 60 END
      AS avg_trip_time_min,
    avg(CASE WHEN service <> 'fhv' THEN miles END) AS avg_trip_miles,
    {sums},
    CASE service {totals} END AS total_amount_payed
  FROM trips GROUP BY service, date_trunc('hour', pickup_datetime))"""


HOURLY = _hourly()
ALL_COLUMNS = ["service", "pickup_hour", "num_trips", *_AVERAGES, *(a[0] for a in _AMOUNTS), "total_amount_payed"]
EVERY_HOUR = f"SELECT {_rounded(ALL_COLUMNS)} FROM hourly"
SERVED = f"""
served AS (SELECT * FROM hourly WHERE pickup_hour >= {START} AND pickup_hour < {END})"""
CALENDAR = ", ".join(f"date_part('{p}', pickup_hour)::INTEGER AS {c}" for c, p in UNITS.items())

LOADED = """
loaded AS (
  SELECT * FROM trips WHERE pickup_datetime <= CASE service WHEN 'fhvhv' THEN DATE '2024-01-20'
    WHEN 'fhv' THEN DATE '2024-03-10' WHEN 'yellow' THEN DATE '2024-02-20' END),
marks AS (SELECT service, max(pickup_datetime) AS watermark FROM loaded GROUP BY service),
names AS (
  SELECT DISTINCT unnest([concat(service, '_tripdata_', file_month, '.parquet'),
    concat('.', service, '_tripdata.crc'), concat(service, '_zones_2024-01.parquet'),
    concat('x_', file_month, '.parquet')]) AS file_name
  FROM trips),
found AS (
  SELECT DISTINCT split_part(file_name, '_tripdata_', 1) AS service,
    split_part(file_name, '_2024', 1) AS table_name
  FROM names WHERE file_name LIKE '%\\_tripdata\\_2024-%.parquet' ESCAPE '\\'),
starts AS (
  SELECT service, watermark
  FROM (SELECT service FROM found WHERE service <> 'fhv') FULL JOIN marks USING (service))"""

BOUNDED = f"""
bounded AS (
  SELECT m.service, m.watermark AS start_time,
    (SELECT max(t.pickup_datetime) FROM trips t
     WHERE t.service = m.service AND t.pickup_datetime <= {AS_OF}) AS end_time
  FROM marks m),
inside AS (
  SELECT t.service, t.pickup_datetime, t.trip_time FROM trips t JOIN bounded b USING (service)
  WHERE t.pickup_datetime > b.start_time AND t.pickup_datetime < b.end_time)"""


def _plan(lower: str) -> str:
    return f"""
SELECT concat(service, '_tripdata_', strftime(m, '%Y-%m'), '.parquet') AS file_name,
  concat(service, '_tripdata') AS table_name,
  CASE WHEN m = DATE '2024-03-01' THEN {lower} END AS start_time,
  CASE WHEN m = DATE '2024-03-01' THEN {AS_OF} END AS end_time
FROM (
  SELECT service, since, unnest(generate_series(
    date_trunc('month', since)::TIMESTAMP, TIMESTAMP '2024-03-01', INTERVAL 1 MONTH)) AS m
  FROM (SELECT service, least(coalesce(watermark, TIMESTAMP '2024-01-01'), {AS_OF}) AS since
        FROM starts))"""


def _samples() -> str:
    values = {
        "container_cpu_usage_seconds_total": "(event_id * 7) % 5000",
        "container_memory_usage_bytes": "value * 1000",
        "container_memory_cache": "value * 250",
        "container_network_receive_bytes_total": "(event_id * 11) % 7000",
        "container_network_transmit_bytes_total": "(event_id * 13) % 9000",
        "container_fs_reads_bytes_total": "(event_id * 17) % 8000",
        "container_fs_writes_bytes_total": "(event_id * 19) % 6000",
    }
    branches = "\n  UNION ALL ".join(
        f"""SELECT TIMESTAMP '2024-01-01' + to_seconds(event_id * 15) AS ts, '{metric}' AS metric,
    concat(CASE event_type WHEN 'error' THEN '/system/' ELSE '/docker/' END, event_type) AS id,
    event_type AS name,
    {"CASE user_id % 2 WHEN 0 THEN 'eth0' ELSE 'lo' END" if "network" in metric else "NULL"}
      AS interface, ({value})::DOUBLE AS value FROM events"""
        for metric, value in values.items()
    )
    return f"samples AS (\n  {branches})"


SAMPLES = _samples()
RATES = """
steps AS (
  SELECT *, CASE WHEN value < lag(value) OVER s THEN value ELSE value - lag(value) OVER s END AS step
  FROM samples
  WINDOW s AS (PARTITION BY metric, id, name, interface ORDER BY ts)),
rates AS (
  SELECT ts, metric, id, name, interface,
    (sum(step) OVER w - coalesce(first_value(step) OVER w, 0))
      / nullif(extract(epoch FROM ts - first_value(ts) OVER w), 0) AS rate
  FROM steps
  WINDOW w AS (PARTITION BY metric, id, name, interface ORDER BY ts
    RANGE BETWEEN INTERVAL '299999999' MICROSECOND PRECEDING AND CURRENT ROW))"""

_FILE_SUMMARY = """
SELECT service, file_month, count(*) AS num_rows, min(pickup_datetime) AS first_pickup,
  max(dropoff_datetime) AS last_dropoff,
  round(sum(CASE WHEN service <> 'fhv' THEN base_fare END), 2) AS total_fare,
  count(CASE WHEN service IN ('fhvhv', 'yellow') THEN airport_fee END) AS with_airport_fee
FROM trips GROUP BY service, file_month"""


def _with(*parts_and_query: str) -> str:
    *parts, query = parts_and_query
    return "WITH " + ",".join(parts) + "\n" + query.strip()


def _trend(column: str, unit: str, how: str) -> str:
    services = "service <> 'fhv'" if column == "total_amount_payed" else "true"
    return _with(
        TRIPS, HOURLY, SERVED,
        f"""SELECT service, date_part('{UNITS[unit]}', pickup_hour)::INTEGER AS {unit},
  {how} AS {column} FROM served WHERE {services} GROUP BY ALL""",
    )


def _averages(short: str, column: str) -> dict[str, str]:
    having = {"avg_trip_miles": "<> 'fhv'", "avg_request_to_on_scene_time_min": "= 'fhvhv'"}
    chosen = f"""
chosen AS (SELECT service, pickup_hour, {column} AS x FROM served
  WHERE service {having.get(column, "<> ''")}),
limits AS (SELECT service, quantile_cont(x, 0.99) AS p99 FROM chosen GROUP BY service),
kept AS (SELECT service, pickup_hour, x FROM chosen JOIN limits USING (service) WHERE x <= p99)"""
    bins = """
edges AS (SELECT service, min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 30 AS w
  FROM kept GROUP BY service),
slots AS (SELECT service, lo, w, unnest(range(CASE WHEN w > 0 THEN 30 ELSE 1 END))::INTEGER AS bin
  FROM edges),
placed AS (SELECT service,
    CASE WHEN w > 0 THEN least(floor((x - lo) / w)::INTEGER, 29) ELSE 0 END AS bin
  FROM kept JOIN edges USING (service))"""
    base = (TRIPS, HOURLY, SERVED, chosen)
    return {
        f"p99_{short}": _with(*base, "SELECT service, round(p99, 6) AS p99 FROM limits"),
        f"p99_trim_{short}": _with(*base, f"SELECT service, pickup_hour, x AS {column} FROM kept"),
        f"hist_{short}": _with(
            *base, bins,
            """SELECT service, bin, round(lo + bin * w, 6) AS bin_low,
  round(lo + (bin + 1) * w, 6) AS bin_high,
  (SELECT count(*) FROM placed p WHERE p.service = s.service AND p.bin = s.bin) AS num_hours
FROM slots s""",
        ),
    }


def _contributions(service: str) -> str:
    branches = " UNION ALL ".join(
        f"SELECT '{out.replace('total_', '')}' AS expense,"
        f" round(coalesce(sum({out}), 0), 2) AS amount FROM served WHERE service = '{service}'"
        for out, _, services in _AMOUNTS
        if service in services
    )
    return _with(TRIPS, HOURLY, SERVED, branches)


def _panel(metric: str, legend: str, names: str = "true") -> str:
    columns = f"ts, id, name, interface, {legend} AS legend"
    condition = f"WHERE metric = '{metric}' AND {names}"
    if metric.startswith("container_memory"):
        return _with(
            SAMPLES,
            f"SELECT {columns}, round(value, 6) AS value FROM samples {condition}"
            " AND id LIKE '/docker/_%'",
        )
    return _with(
        SAMPLES, RATES, f"SELECT {columns}, round(rate, 6) AS value FROM rates {condition}"
    )


def oracle_sql() -> dict[str, str]:
    sql = {
        "discover_tables": _with(TRIPS, LOADED, "SELECT service, table_name FROM found"),
        "existing_tables": _with(TRIPS, "SELECT DISTINCT service FROM trips"),
        "new_tables": _with(
            TRIPS, LOADED,
            "SELECT * FROM found WHERE service NOT IN (SELECT service FROM loaded)",
        ),
        "table_start_times": _with(TRIPS, LOADED, "SELECT * FROM starts"),
        "watermark": _with(
            TRIPS,
            "SELECT service, max(pickup_datetime) AS watermark FROM trips GROUP BY service",
        ),
        "slice_plan": _with(TRIPS, LOADED, _plan("since")),
        "slice_plan_replace": _with(TRIPS, LOADED, _plan("NULL::TIMESTAMP")),
        "slice_filter": _with(TRIPS, LOADED, BOUNDED, "SELECT * FROM inside"),
        "slice_count": _with(
            TRIPS, LOADED, BOUNDED,
            """SELECT service, n AS num_rows, n = 0 AS skipped FROM (
  SELECT service, (SELECT count(*) FROM inside i WHERE i.service = b.service) AS n
  FROM bounded b)""",
        ),
        "scan_trips": _with(TRIPS, _FILE_SUMMARY),
        "ingest_roundtrip": _with(TRIPS, _FILE_SUMMARY),
        "canonical_columns": _with(
            TRIPS, "SELECT service, pickup_datetime, dropoff_datetime FROM trips"
        ),
        "refresh_rollup": _with(TRIPS, HOURLY, EVERY_HOUR),
        "cycle_after_failure": _with(TRIPS, HOURLY, EVERY_HOUR),
        "cycle_with_stray_pickup": _with(TRIPS, _FILE_SUMMARY),
        "stream_ingest": _with(TRIPS, _FILE_SUMMARY),
        "stream_hourly": _with(
            TRIPS, HOURLY,
            f"""{EVERY_HOUR} h WHERE pickup_hour + INTERVAL 2 HOUR <=
  (SELECT max(pickup_datetime) FROM trips t WHERE t.service = h.service)""",
        ),
        "stream_hourly_late": _with(
            TRIPS, HOURLY,
            f"""{EVERY_HOUR} h WHERE pickup_hour + INTERVAL 2 HOUR <=
  (SELECT max(pickup_datetime) FROM trips t WHERE t.service = h.service)""",
        ),
        "cycle_after_restatement": _with(TRIPS, HOURLY, EVERY_HOUR),
        "rollup_snapshot": _with(
            TRIPS.replace("trips AS (", "every_trip AS ("),
            """
trips AS (SELECT * FROM every_trip
  WHERE file_month <= '2024-03' AND pickup_datetime < TIMESTAMP '2024-03-15 10:00:00')""",
            HOURLY, EVERY_HOUR,
        ),
        "mixed_loads": _with(TRIPS, _FILE_SUMMARY),
        "tables_by_name": _with(
            TRIPS,
            """SELECT service, count(*) AS num_rows, count(DISTINCT file_month) AS months,
  count(DISTINCT date_trunc('hour', pickup_datetime)) AS hours, count(*) AS rolled_up
FROM trips GROUP BY service""",
        ),
        "trends_all": _with(TRIPS, HOURLY, SERVED, " UNION ALL ".join(
            f"""
SELECT service, '{unit}' AS calendar_unit, date_part('{part}', pickup_hour)::INTEGER AS position,
  sum(num_trips)::BIGINT AS num_trips,
  CASE WHEN service <> 'fhv' THEN round(coalesce(sum(total_amount_payed), 0), 2) END AS total_amount_payed
FROM served GROUP BY service, position"""
            for unit, part in UNITS.items()
        )),
        "all_services_hourly": _with(TRIPS, HOURLY, EVERY_HOUR),
        "hourly_from_parts": _with(TRIPS, HOURLY, EVERY_HOUR),
        "rollup_key_check": _with(
            TRIPS, HOURLY,
            """SELECT service, count(*) AS hours, count(DISTINCT pickup_hour) AS distinct_hours,
  count(*) = count(DISTINCT pickup_hour) AS ok FROM hourly GROUP BY service""",
        ),
        "calendar_view": _with(
            TRIPS, HOURLY, f"SELECT {CALENDAR}, {_rounded(ALL_COLUMNS)} FROM hourly"
        ),
        "unavailable_metric": _with(
            TRIPS, HOURLY, SERVED,
            """SELECT metric, CASE metric WHEN 'avg_trip_time_min'
  THEN (SELECT count(*) FROM served WHERE service = 'fhv') ELSE 0 END AS hours
FROM (VALUES ('avg_trip_time_min'), ('avg_trip_miles'), ('avg_request_to_on_scene_time_min')) m(metric)""",
        ),
        "metric_availability": _with(
            TRIPS, HOURLY, SERVED,
            """SELECT service, metric, count(*) AS hours
FROM served, (VALUES ('num_trips', ''), ('total_amount_payed', 'fhv'), ('avg_trip_time_min', ''),
  ('avg_trip_miles', 'fhv'), ('avg_request_to_on_scene_time_min', 'fhv,yellow,green')
) m(metric, lacking)
WHERE NOT list_contains(string_split(lacking, ','), service) GROUP BY service, metric""",
        ),
        "card_num_trips": _with(
            TRIPS, HOURLY, SERVED,
            "SELECT service, sum(num_trips)::BIGINT AS num_trips FROM served GROUP BY service",
        ),
        "card_total_payed": _with(
            TRIPS, HOURLY, SERVED,
            """SELECT service, round(coalesce(sum(total_amount_payed), 0), 2) AS total_amount_payed
FROM served WHERE service <> 'fhv' GROUP BY service""",
        ),
        "trend_avg_payed_month": _trend(
            "total_amount_payed", "month", "round(avg(total_amount_payed), 2)"
        ),
        "trend_median_trips_day_of_week": _trend(
            "num_trips", "day_of_week", "round(median(num_trips), 6)"
        ),
        "metric_label_filter": _with(
            SAMPLES,
            """SELECT metric, id, name, count(*) AS num_samples, round(max(value), 6) AS max_value
FROM samples WHERE regexp_full_match(id, '/docker/.+') AND name IN ('click', 'view', 'error')
GROUP BY ALL""",
        ),
        "metric_label_values": _with(
            SAMPLES,
            """SELECT DISTINCT name FROM samples
WHERE metric = 'container_memory_usage_bytes' AND name IS NOT NULL""",
        ),
        "metric_gauge": _with(
            SAMPLES,
            """SELECT ts, id, round(value, 6) AS value FROM samples
WHERE metric = 'container_memory_usage_bytes' AND regexp_full_match(id, '/docker/.+')""",
        ),
        "counter_rate_5m": _with(
            SAMPLES, RATES,
            """SELECT ts, id, round(rate, 6) AS rate FROM rates
WHERE metric = 'container_cpu_usage_seconds_total'""",
        ),
        "cpu_percent": _with(
            SAMPLES, RATES,
            """SELECT ts, id, round(rate * 100, 6) AS cpu_percent FROM rates
WHERE metric = 'container_cpu_usage_seconds_total' AND regexp_full_match(id, '/docker/.+')""",
        ),
    }
    for service in ("fhvhv", "fhv", "yellow", "green"):
        columns = _rounded(_columns(service))
        ending = "" if service == "yellow" else f"_{service}"
        sql[f"hourly_{service}"] = _with(
            TRIPS, HOURLY, f"SELECT service, {columns} FROM hourly WHERE service = '{service}'"
        )
        sql[f"export_range{ending}"] = _with(
            TRIPS, HOURLY, SERVED,
            f"SELECT {CALENDAR}, {columns} FROM served WHERE service = '{service}'",
        )
        sql[f"export_range_indexed{ending}"] = _with(
            TRIPS, HOURLY,
            f"""SELECT * FROM (
  SELECT (row_number() OVER (ORDER BY pickup_hour) - 1)::INTEGER AS row_index, {CALENDAR}, {columns}
  FROM hourly WHERE service = '{service}')
WHERE pickup_hour >= {START} AND pickup_hour < {END}""",
        )
    for unit in UNITS:
        sql[f"trend_trips_{unit}"] = _trend("num_trips", unit, "sum(num_trips)::BIGINT")
        sql[f"trend_payed_{unit}"] = _trend(
            "total_amount_payed", unit, "round(coalesce(sum(total_amount_payed), 0), 2)"
        )
    for service in ("fhvhv", "yellow", "green"):
        sql[f"contrib_{service}"] = _contributions(service)
    sql |= _averages("trip_time", "avg_trip_time_min")
    sql |= _averages("trip_miles", "avg_trip_miles")
    sql |= _averages("on_scene", "avg_request_to_on_scene_time_min")
    receive, transmit = (f"container_network_{w}_bytes_total" for w in ("receive", "transmit"))
    sql |= {
        "panel_memory_cached": _panel("container_memory_cache", "id"),
        "panel_network_received": _panel(receive, "interface"),
        "panel_network_sent": _panel(transmit, "interface"),
        "panel_container_receive": _panel(receive, "name", "name IN ('click', 'view')"),
        "panel_container_transmit": _panel(transmit, "name"),
        "panel_disk_reads": _panel("container_fs_reads_bytes_total", "name"),
        "panel_disk_writes": _panel("container_fs_writes_bytes_total", "name"),
    }
    return sql
