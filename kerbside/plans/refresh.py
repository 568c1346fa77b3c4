"""Stored rollups: created when absent, refreshed when present, incrementally."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from kerbside.operators.rollup import (
    assert_unique_hours,
    hourly_parts,
    merge_parts,
    parts_schema,
    rollup_schema,
    union_services,
)
from kerbside.sources import discovery, store
from kerbside.spec import HOURLY_COLUMNS, SPECS


def load_parts(spark: SparkSession, parts_dir: str) -> DataFrame:
    """The current partial rollups, with ``service`` and ``file_month``."""
    live = store.pieces(spark, parts_dir)
    return store.read(spark, parts_dir, parts_schema(), live, "service", "file_month")


def uncovered(
    spark: SparkSession, trips_dir: str, parts_dir: str, months: Iterable[tuple[str, str]] | None = None
) -> dict[tuple[str, str], set[int]]:
    """Loads of each month's trips that no part of the month stands for; of given months or of all.

    A part that stands for a load the month no longer has does not count.
    """
    live: dict[tuple[str, str], set[int]] = defaultdict(set)
    for piece in store.pieces(spark, trips_dir):
        if piece.service in SPECS:
            live[piece.key].add(piece.load)
    wanted = {k: set(live[k]) for k in (live if months is None else months) if k in live}
    for part in store.pieces(spark, parts_dir):
        if part.key in wanted and set(part.of) <= live[part.key]:
            wanted[part.key] -= set(part.of)
    return {k: loads for k, loads in wanted.items() if loads}


def refresh_parts(
    spark: SparkSession,
    trips_dir: str,
    parts_dir: str,
    months: Iterable[tuple[str, str]] | None = None,
) -> set[str]:
    """Compute the partial rollups that given (service, file_month), or all, lack; the services changed.

    Only the trips of loads that have none yet are read, and only the columns the rollup needs. All
    services go in one job. Parts of trips that were replaced leave with the same version.
    """
    missing = uncovered(spark, trips_dir, parts_dir, months)
    if not missing:
        return set()
    chosen: dict[str, list[tuple[str, int]]] = defaultdict(list)
    for (service, month), loads in missing.items():
        chosen[service] += [(month, load) for load in loads]
    merged: DataFrame | None = None
    for service, pairs in chosen.items():
        spec = SPECS[service]
        live = [p for p in store.pieces(spark, trips_dir, service) if (p.file_month, p.load) in pairs]
        trips = store.read(spark, trips_dir, spec.trip_schema, live, "file_month")
        parts = hourly_parts(trips, spec, "file_month")
        merged = parts if merged is None else merged.unionByName(parts, allowMissingColumns=True)
    load = store.claim(spark, parts_dir)
    store.write(merged, parts_dir, load)
    loads_now: dict[tuple[str, str], set[int]] = defaultdict(set)
    for piece in store.pieces(spark, trips_dir):
        loads_now[piece.key].add(piece.load)
    new = [store.Piece(*key, load, of=tuple(sorted(loads))) for key, loads in missing.items()]
    store.publish(
        spark, parts_dir, lambda p: p.key in missing and not set(p.of) <= loads_now[p.key], new
    )
    return set(chosen)


def merged_rollup(parts: DataFrame) -> DataFrame:
    """The rollup of all services from their parts."""
    return union_services([merge_parts(parts, spec) for spec in SPECS.values()])


def drop_orphans(spark: SparkSession, trips_dir: str, parts_dir: str) -> set[str]:
    """Take out parts of months that have no trips any more; the services they belonged to."""
    kept = set(discovery.loaded_months(spark, trips_dir))
    orphans = {k for k in discovery.loaded_months(spark, parts_dir) if k not in kept}
    if orphans:
        store.publish(spark, parts_dir, lambda p: p.key in orphans, [])
    return {service for service, _ in orphans}


def not_rolled_up(spark: SparkSession, parts_dir: str, rollup_dir: str) -> set[tuple[str, str]]:
    """Months with parts that the stored rollup was not computed from."""
    rolled = {p.service: set(p.of) for p in store.pieces(spark, rollup_dir)}
    return {p.key for p in store.pieces(spark, parts_dir) if p.load not in rolled.get(p.service, ())}


def load_rollup(spark: SparkSession, rollup_dir: str) -> DataFrame:
    """The stored rollup, one row per service and hour.

    A frame goes on answering from the version it was read from while that is retained.
    """
    live = store.pieces(spark, rollup_dir)
    return store.read(spark, rollup_dir, rollup_schema(), live, "service").select("service", *HOURLY_COLUMNS)


def refresh_rollup(
    spark: SparkSession, parts_dir: str, rollup_dir: str, services: Iterable[str] | None = None
) -> DataFrame:
    """Rebuild the stored rollup of the given services, or of all, from their parts; return it all.

    The parts have a row per file month and hour, so a full rebuild is small and no question of
    which hours changed arises. It is written once, to folders that no version lists; its keys are
    checked there, and only then a new version takes them in. A service without parts has no rollup.
    """
    by_service: dict[str, list[store.Piece]] = defaultdict(list)
    for piece in store.pieces(spark, parts_dir):
        by_service[piece.service].append(piece)
    chosen = [s for s in SPECS if services is None or s in services]
    rebuilt = [s for s in chosen if s in by_service]
    new: list[store.Piece] = []
    if rebuilt:
        read = [p for s in rebuilt for p in by_service[s]]
        parts = store.read(spark, parts_dir, parts_schema(), read, "service", "file_month")
        load = store.claim(spark, rollup_dir)
        merged = union_services([merge_parts(parts, SPECS[s]) for s in rebuilt])
        # 8,784 hours per service and year at most: one file each.
        store.write(merged.repartition("service"), rollup_dir, load)
        loads = {s: {p.load for p in read} for s, read in by_service.items()}
        new = [store.Piece(s, None, load, of=tuple(sorted(loads[s]))) for s in rebuilt]
        assert_unique_hours(store.read(spark, rollup_dir, rollup_schema(), new, "service"))
    if chosen:
        store.publish(spark, rollup_dir, lambda p: p.service in chosen, new)
    return load_rollup(spark, rollup_dir)


def existing_rollups(spark: SparkSession, rollup_dir: str) -> list[str]:
    """Services that have a stored rollup."""
    return sorted({p.service for p in store.pieces(spark, rollup_dir)})
