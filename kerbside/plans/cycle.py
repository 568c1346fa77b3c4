"""One run of the whole job: ingest, then refresh, then serve from the result."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from kerbside.functions.clock import Moment
from kerbside.plans import record
from kerbside.plans.ingest import load_slices, plan_slices
from kerbside.plans.refresh import (
    drop_orphans,
    load_parts,
    load_rollup,
    not_rolled_up,
    refresh_parts,
    refresh_rollup,
    uncovered,
)
from kerbside.plans.tables import register
from kerbside.plans.warehouse import Warehouse
from kerbside.session import job_session
from kerbside.sources import discovery, paths, store


@dataclass(frozen=True)
class CycleReport:
    """Rows loaded per (service, file_month), the refreshed rollup, and what was left out.

    ``missing`` are planned months without a file, ``ignored`` names in the landing folder that are
    no trip files of a known service, ``empty`` loaded months without a row, ``taken_up`` months
    that an earlier run or a stream had loaded and not rolled up, and ``restated`` months that were
    loaded again as their files had changed. ``rollup`` stays as it is when later cycles run.
    """

    loaded: dict[record.Key, int]
    rollup: DataFrame
    missing: list[record.Key] = field(default_factory=list)
    ignored: list[str] = field(default_factory=list)
    taken_up: list[record.Key] = field(default_factory=list)
    restated: list[record.Key] = field(default_factory=list)

    @property
    def empty(self) -> list[record.Key]:
        return [key for key, rows in self.loaded.items() if not rows]


def run_cycle(
    spark: SparkSession,
    landing: str,
    warehouse: Warehouse,
    as_of: Moment,
    mode: str = "replace",
    year: int | None = None,
    database: str | None = None,
) -> CycleReport:
    """Load what is due at ``as_of`` and bring the rollup up to date. Errors end the run.

    What a run that ended early has loaded is rolled up by the next one, which knows it by the load
    record. Otherwise only the new files and what was just loaded are read, as the partial rollups
    have the watermark. Running it again with the same ``as_of`` changes nothing in ``replace`` mode.
    Streams may load into the same warehouse; their months are rolled up and not loaded again. With
    ``database`` its tables and views are brought up to date, see :mod:`kerbside.plans.tables`.
    """
    job = job_session(spark)
    known = record.read(job, warehouse.record)
    if not paths.exists(job, warehouse.record):
        known = record.before_records(job, warehouse.trips, warehouse.parts)
        record.write(job, warehouse.record, known)
    parts = load_parts(job, warehouse.parts) if store.pieces(job, warehouse.parts) else None
    plan = plan_slices(job, landing, warehouse.trips, as_of, mode, year, parts)
    bounds = {s.key: s.end_time for s in plan.slices}
    record.forget(job, warehouse.record, bounds)
    loaded = load_slices(job, plan.slices, warehouse.trips, mode)
    stored = discovery.loaded_months(job, warehouse.trips)
    pending = not_rolled_up(job, warehouse.parts, warehouse.rollup)
    pending |= uncovered(job, warehouse.trips, warehouse.parts).keys()
    stale = [key for key in stored if key in bounds or key not in known or key in pending]
    refresh_parts(job, warehouse.trips, warehouse.parts, stale)
    gone = drop_orphans(job, warehouse.trips, warehouse.parts)
    refresh_rollup(job, warehouse.parts, warehouse.rollup, {s for s, _ in stale} | gone)
    done = {key: record.Loaded(bounds[key], rows) for key, rows in loaded.items()}
    taken_up = [key for key in stale if key not in bounds]
    done |= {key: record.Loaded(record.UNKNOWN, -1) for key in taken_up}
    record.write(job, warehouse.record, done)
    if database:
        register(job, warehouse, database)
    for folder in (warehouse.trips, warehouse.parts, warehouse.rollup):
        store.vacuum(job, folder, warehouse.retained)
    rollup = load_rollup(spark, warehouse.rollup)
    return CycleReport(loaded, rollup, plan.missing, plan.ignored, taken_up, plan.restated)


__all__ = ["CycleReport", "Warehouse", "run_cycle"]
