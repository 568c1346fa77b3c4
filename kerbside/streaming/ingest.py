"""Incremental ingest of new trip files, each exactly once, into a warehouse that batches load, too.

A stream sees a file once. A file that is rewritten in place later is a case for the batch plan, which
finds that it is not the one that was loaded.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions import names
from kerbside.plans.warehouse import Warehouse
from kerbside.plans.ingest import rows_of_load
from kerbside.plans.refresh import refresh_parts
from kerbside.session import job_session
from kerbside.sources import store
from kerbside.sources.trips import scan_files
from kerbside.spec import SPECS

#: Files of a batch. A batch lists its files on the driver, so their number is bounded.
FILES_PER_BATCH = 1000


def stream_files(spark: SparkSession, landing: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """A stream of (service, file_month, path, source): the trip files of known services.

    Files, folders of part files and ``key=value`` folders count. Only names are read: the files'
    content is a column that nothing asks for. ``source`` identifies a file as discovery does.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.parquet")
    reader = reader.option("maxFilesPerTrigger", files_per_batch)
    found = reader.option("recursiveFileLookup", True).load(landing)
    identity = F.concat_ws("|", "path", "length", F.unix_millis("modificationTime"))
    path = F.col("path")
    return found.select(
        names.service_of(path).alias("service"),
        names.month_in_trip_path(path).alias("file_month"),
        "path",
        identity.alias("source"),
    ).filter(F.col("service").isin([*SPECS]))


def stream_ingest(
    spark: SparkSession,
    landing: str,
    warehouse: Warehouse,
    checkpoint: str,
    services: list[str] | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Load all files that arrived since the last run, with their partial rollups, and stop.

    One stream serves all services. Its batches are lists of new files, which the batch scan reads,
    so columns, types and drift between files come out as they do there. Months may arrive in any
    number of files; each batch adds a piece, see :func:`compact`. Refreshing the rollup reads no trips.

    Files that a batch run has loaded, or this batch before a failure, are passed over. A month that was
    loaded with a bound, or from an earlier state of a file, is loaded anew from all its files.
    """
    job = job_session(spark)
    query = (
        stream_files(job, landing, files_per_batch or FILES_PER_BATCH)
        .writeStream.foreachBatch(_batch_writer(warehouse, services or [*SPECS]))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .queryName("ingest")
        .start()
    )
    query.awaitTermination()


def _path(source: str) -> str:
    return source.rsplit("|", 2)[0]


def load_new_files(spark: SparkSession, trips_dir: str, found: dict[tuple[str, str], set[str]]) -> set[tuple[str, str]]:
    """Bring files, given by month as sources, into the trip store; the months that changed."""
    live = [p for p in store.current(spark, trips_dir)[1] if p.key in found]
    chosen: dict[tuple[str, str], set[str]] = {}
    replaced: set[tuple[str, str]] = set()
    for key, sources in found.items():
        own = [p for p in live if p.key == key]
        whole = {x for p in own if p.loaded_until is None for x in p.sources}
        new = sources - whole
        if not new:
            continue
        paths = {_path(x) for x in new}
        if any(p.loaded_until is not None or paths & set(map(_path, p.sources)) for p in own):
            replaced.add(key)
            new |= {x for p in own for x in p.sources if _path(x) not in paths}
        chosen[key] = new
    if not chosen:
        return set()
    load = store.claim(spark, trips_dir)
    by_service: dict[str, list[str]] = defaultdict(list)
    for (service, _), sources in chosen.items():
        by_service[service] += sorted(map(_path, sources))
    for service, files in sorted(by_service.items()):
        store.write(scan_files(spark, SPECS[service], files), trips_dir, load, service)
    rows = rows_of_load(spark, trips_dir, load)
    new = [
        store.Piece(*key, load, rows.get(key, 0), None, tuple(sorted(sources))) for key, sources in chosen.items()
    ]
    store.publish(spark, trips_dir, lambda p: p.key in replaced, new)
    return set(chosen)


def _batch_writer(warehouse: Warehouse, services: list[str]):
    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        found: dict[tuple[str, str], set[str]] = defaultdict(set)
        for row in batch.collect():  # a row per new file, FILES_PER_BATCH at most
            if row.service in services:
                found[row.service, row.file_month].add(row.source)
        load_new_files(spark, warehouse.trips, found)
        # Of a batch that failed in between, the trips are there and their parts are not.
        refresh_parts(spark, warehouse.trips, warehouse.parts, found)
        for folder in (warehouse.trips, warehouse.parts):
            store.vacuum(spark, folder, warehouse.retained)

    return write


def compact(spark: SparkSession, warehouse: Warehouse, pieces: int = 1) -> list[tuple[str, str]]:
    """Rewrite months that have more than ``pieces`` pieces as one each; the months that changed.

    All columns of the files are kept. Readers of the versions before are not disturbed.
    """
    job = job_session(spark)
    by_month: dict[tuple[str, str], list[store.Piece]] = defaultdict(list)
    for piece in store.current(job, warehouse.trips)[1]:
        by_month[piece.key].append(piece)
    chosen = {k: x for k, x in by_month.items() if sum(p.rows != 0 for p in x) > pieces}
    if not chosen:
        return []
    load = store.claim(job, warehouse.trips)
    for service in sorted({s for s, _ in chosen}):
        folders = [store.piece_dir(warehouse.trips, p) for k, x in chosen.items() if k[0] == service for p in x if p.rows]
        trips = job.read.option("basePath", warehouse.trips).option("mergeSchema", True).parquet(*folders)
        # The month's rows meet in one shuffle; a month of many files is split by the rows' hash.
        dealt = trips.drop("load").repartition("file_month", F.pmod(F.xxhash64("pickup_datetime"), F.lit(8)))
        store.write(dealt, warehouse.trips, load, service)
    rows = rows_of_load(job, warehouse.trips, load)
    new = []
    for key, old in chosen.items():
        bounds = [p.loaded_until for p in old if p.loaded_until is not None]
        sources = tuple(sorted({x for p in old for x in p.sources}))
        new.append(store.Piece(*key, load, rows[key], min(bounds) if bounds else None, sources))
    merged = {p for x in chosen.values() for p in x}
    store.publish(job, warehouse.trips, lambda p: p in merged, new)
    refresh_parts(job, warehouse.trips, warehouse.parts, chosen)
    return sorted(chosen)
