"""Batch ingest of monthly trip files into the trip store.

The store is parquet, partitioned by ``service`` and ``file_month``, the month in the file's name, and
versioned, see :mod:`kerbside.sources.store`. Pick-up times are no partition key: files hold stray ones,
and replacing a partition by pick-up time would drop rows that came from another file.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions import clock
from kerbside.operators.rollup import watermark, watermark_from_parts
from kerbside.operators.slices import between, slice_plan, table_start_times
from kerbside.plans.record import Key
from kerbside.sources import discovery, paths, store
from kerbside.sources.trips import load_trips, scan_files
from kerbside.spec import SPECS, ServiceSpec


@dataclass(frozen=True)
class Slice:
    """One monthly file to load, with its exclusive bounds."""

    service: str
    file_month: str
    path: str
    start_time: datetime | None = None
    end_time: datetime | None = None
    sources: tuple[str, ...] = ()

    @property
    def key(self) -> Key:
        return self.service, self.file_month


@dataclass(frozen=True)
class Plan:
    """What to load, the planned months that have no file, and names that are no trip files.

    ``restated`` are months among the slices whose files changed since they were loaded.
    """

    slices: list[Slice]
    missing: list[Key] = field(default_factory=list)
    ignored: list[str] = field(default_factory=list)
    restated: list[Key] = field(default_factory=list)


def read_slices(spark: SparkSession, spec: ServiceSpec, slices: Iterable[Slice]) -> DataFrame:
    """Rows of the slices of one service. Files with equal bounds share a scan.

    The bounds filter the raw pick-up column, so they reach the parquet reader; whole months are
    not filtered at all.
    """
    by_bounds: dict[tuple, list[str]] = defaultdict(list)
    for s in slices:
        by_bounds[s.start_time, s.end_time].append(s.path)
    frames = [
        between(scan_files(spark, spec, paths), *bounds) for bounds, paths in by_bounds.items()
    ]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged


def _month_start(month: str) -> datetime:
    return datetime.fromisoformat(f"{month}-01")


def _month_end(month: str) -> datetime:
    """The last moment of a month."""
    later = (_month_start(month) + timedelta(days=31)).replace(day=1)
    return later - timedelta(microseconds=1)


def _watermarks(
    spark: SparkSession, trips_dir: str, parts: DataFrame | None, until: datetime | None
) -> DataFrame:
    """Latest pick-up per service, from the parts if given, else from the trips.

    With ``until`` only pick-ups up to it count, which the trips alone can tell.
    """
    if parts is not None and until is None:
        return watermark_from_parts(parts)
    found = spark.createDataFrame([], "service string, watermark timestamp_ntz")
    for service in discovery.loaded_services(spark, trips_dir):
        if service in SPECS:
            trips = load_trips(spark, trips_dir, SPECS[service])
            if until is not None:
                trips = trips.filter(f"pickup_datetime <= {clock.ntz(until)}")
            found = found.union(watermark(trips))
    return found


def plan_slices(
    spark: SparkSession,
    landing: str,
    trips_dir: str,
    as_of: clock.Moment,
    mode: str = "replace",
    year: int | None = None,
    parts: DataFrame | None = None,
) -> Plan:
    """Slices to load whose file exists, and what else was planned or found.

    In ``replace`` mode months are planned from the watermark on, but never from later than the
    end of the latest loaded file month, so that a stray pick-up hides nothing; further every
    earlier month that was never loaded, that was loaded with a bound, or whose files are not those
    that were loaded: others in number, name, length or time of modification. In ``append`` mode only
    pick-ups up to ``as_of`` make the watermark. What is collected has a row per service or monthly
    file, and no data.
    """
    moment = clock.clock_in_year(as_of, year) if year else clock.as_datetime(as_of)
    listed = discovery.list_landing(spark, landing)
    files = {(f.service, f.file_month): f for f in listed.files}
    stored = discovery.loaded_months(spark, trips_dir)
    names = [(f.service, f.table_name) for f in listed.files]
    tables = spark.createDataFrame(names, "service string, table_name string").distinct()
    marks = _watermarks(spark, trips_dir, parts, moment if mode == "append" else None)
    starts = table_start_times(tables, marks)
    if mode == "replace":
        latest = [(service, _month_end(month)) for service, month in sorted(stored)]
        ends = spark.createDataFrame(list(dict(latest).items()), "service string, end timestamp_ntz")
        starts = starts.join(ends, "service", "left").selectExpr(
            "service", "CASE WHEN end IS NULL THEN watermark ELSE least(watermark, end) END AS watermark"
        )
    planned = {
        (r.service, r.file_month): (r.start_time, r.end_time)
        for r in slice_plan(starts, as_of, year, mode).collect()
    }
    restated = []
    if mode == "replace":
        known = loaded_sources(spark, trips_dir)
        for key, file in files.items():
            if key in known and known[key] and set(file.sources) != known[key]:
                restated.append(key)
            elif key in known:
                continue
            if key[1] < f"{moment:%Y-%m}":
                planned.setdefault(key, (None, None))
    slices = [
        Slice(*k, files[k].path, *bounds, files[k].sources) for k, bounds in sorted(planned.items()) if k in files
    ]
    missing = [k for k in sorted(planned) if k not in files]
    return Plan(slices, missing, listed.ignored, sorted(set(restated) & {s.key for s in slices}))


def loaded_sources(spark: SparkSession, trips_dir: str) -> dict[Key, set[str]]:
    """The files each month was loaded from, of months that are loaded whole.

    A month without rows is one of them. The set is empty where the files are not known.
    """
    found: dict[Key, set[str]] = defaultdict(set)
    bounded = set()
    for piece in store.current(spark, trips_dir)[1]:
        found[piece.key] |= set(piece.sources)
        if piece.loaded_until is not None:
            bounded.add(piece.key)
    return {key: sources for key, sources in found.items() if key not in bounded}


def load_slices(
    spark: SparkSession, slices: list[Slice], trips_dir: str, mode: str = "replace"
) -> dict[Key, int]:
    """Write the slices and return rows per (service, file_month).

    ``replace`` puts a new piece in place of all a month had, so loading a month again changes
    nothing; a slice without rows leaves its month without any. ``append`` adds, and adds nothing for
    such a slice. All months change at once, with the new version; readers of the one before keep it.
    A task that is lost is run again and its output committed once. Rows of all months are counted by
    one job, from the footers of what was written.
    """
    if not slices:
        return {}
    by_service: dict[str, list[Slice]] = defaultdict(list)
    for s in slices:
        by_service[s.service].append(s)
    load = store.claim(spark, trips_dir)

    def write(service: str) -> None:
        store.write(read_slices(spark, SPECS[service], by_service[service]), trips_dir, load, service)

    # Services are separate jobs with separate folders; started together, one fills the cluster
    # while the last tasks of another run.
    with ThreadPoolExecutor(max_workers=len(SPECS)) as pool:
        list(pool.map(write, by_service))
    counted = rows_of_load(spark, trips_dir, load)
    rows = {s.key: counted.get(s.key, 0) for s in slices}
    new = [
        store.Piece(*s.key, load, rows[s.key], s.end_time, s.sources)
        for s in slices
        if rows[s.key] or mode == "replace"
    ]
    replaced = set(rows) if mode == "replace" else set()
    store.publish(spark, trips_dir, lambda p: p.key in replaced, new)
    return rows


def rows_of_load(spark: SparkSession, trips_dir: str, load: int) -> dict[Key, int]:
    """Rows a load wrote, by service and file month: one job that reads no column."""
    folders = paths.glob(spark, f"{trips_dir.rstrip('/')}/service=*/load={load}/file_month=*")
    if not folders:
        return {}
    written = (
        spark.read.schema("service string, file_month string, load long")
        .option("basePath", trips_dir)
        .parquet(*folders)
    )
    return {(r[0], r[1]): r[2] for r in written.groupBy("service", "file_month").count().collect()}
