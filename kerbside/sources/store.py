"""Versioned stores: folders of parquet whose current files a small log names.

A load writes to folders of its own, ``service=../load=<number>[/file_month=..]``, and is seen by
nobody until a new version of the log lists it; versions are whole lists of the live pieces. Nothing is
overwritten: a frame read from one version answers the same after the next. What no retained version
lists is removed by :func:`vacuum`.

A version is a file that can be created once, so of two writers one starts again from the other's
version. A version that is still being written has no last line yet and does not count. The log has a
row per live piece, which is one per monthly file, or a few where files arrive one by one.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.sources import paths

RETAINED = 10  # versions that readers may still hold
END = "end of version"


class Piece(NamedTuple):
    """What one load wrote for a service, and for a month in stores that have them.

    ``rows`` is 0 for a month without rows, which has no folder, and None where rows are not counted.
    ``loaded_until`` is the exclusive bound, None for whole files. ``sources`` identify the files read,
    ``of`` the loads of another store that this one was computed from.
    """

    service: str
    file_month: str | None
    load: int
    rows: int | None = None
    loaded_until: datetime | None = None
    sources: tuple[str, ...] = ()
    of: tuple[int, ...] = ()

    @property
    def key(self) -> tuple[str, str | None]:
        return self.service, self.file_month


def _log(root: str) -> str:
    return f"{root.rstrip('/')}/_log"


def service_dir(root: str, service: str) -> str:
    """A service's folder in a store."""
    return f"{root.rstrip('/')}/service={service}"


def piece_dir(root: str, piece: Piece) -> str:
    month = f"/file_month={piece.file_month}" if piece.file_month else ""
    return f"{service_dir(root, piece.service)}/load={piece.load}{month}"


def _to_json(piece: Piece) -> str:
    until = piece.loaded_until and piece.loaded_until.isoformat()
    return json.dumps(piece._replace(loaded_until=until)._asdict())


def _from_json(line: str) -> Piece:
    d = json.loads(line)
    d["loaded_until"] = d["loaded_until"] and datetime.fromisoformat(d["loaded_until"])
    return Piece(**d | {"sources": tuple(d["sources"]), "of": tuple(d["of"])})


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the log's versions, the one that is being written among them."""
    return [int(e.name.removesuffix(".json")) for e in paths.entries(spark, f"{_log(root)}/*.json")]


def _read(spark: SparkSession, root: str, version: int) -> list[Piece] | None:
    lines = paths.read_text(spark, f"{_log(root)}/{version:010d}.json").splitlines()
    return [_from_json(x) for x in lines[:-1]] if lines and lines[-1] == END else None


def current(spark: SparkSession, root: str) -> tuple[int, list[Piece]]:
    """The latest version that is complete, and its pieces; version 0 has none."""
    for version in reversed(versions(spark, root)):
        pieces = _read(spark, root, version)
        if pieces is not None:
            return version, pieces
    return 0, []


def pieces(spark: SparkSession, root: str, service: str | None = None) -> list[Piece]:
    """The live pieces that have rows, of one service or of all."""
    return [p for p in current(spark, root)[1] if p.rows != 0 and service in (None, p.service)]


def claim(spark: SparkSession, root: str) -> int:
    """A number that no other load of the store has."""
    taken = [int(e.name.removesuffix(".load")) for e in paths.entries(spark, f"{_log(root)}/*.load")]
    number = max(taken, default=0) + 1
    while not paths.create(spark, f"{_log(root)}/{number:010d}.load", ""):
        number += 1
    return number


def publish(spark: SparkSession, root: str, drop: Callable[[Piece], bool], add: Iterable[Piece]) -> int:
    """A new version: the current one without the pieces to ``drop`` and with those to ``add``."""
    added = list(add)
    while True:
        version, live = current(spark, root)
        kept = sorted([p for p in live if not drop(p)] + added, key=lambda p: (p.service, p.file_month or "", p.load))
        if kept == sorted(live, key=lambda p: (p.service, p.file_month or "", p.load)) and version:
            return version
        text = "\n".join([*map(_to_json, kept), END])
        after = max(versions(spark, root), default=0) + 1
        if paths.create(spark, f"{_log(root)}/{after:010d}.json", text):
            return after


def read(
    spark: SparkSession, root: str, schema: T.StructType, live: list[Piece], *partitions: str
) -> DataFrame:
    """The given pieces' rows with the schema's columns and ``partitions``; a filter on these prunes."""
    wanted = [*schema.names, *partitions]
    kinds = [T.StructField(p, T.LongType() if p == "load" else T.StringType()) for p in partitions]
    full = T.StructType([*schema.fields, *kinds])
    if not live:
        return spark.createDataFrame([], full).select(*wanted)
    folders = [piece_dir(root, p) for p in live]
    return spark.read.schema(full).option("basePath", root).parquet(*folders).select(*wanted)


def write(df: DataFrame, root: str, load: int, service: str | None = None) -> None:
    """Write a load's rows to its folders, which no version lists yet.

    Output folders are the load's own, so writers at work at the same time do not meet. Rows of one
    service go to their place; those of several, with a column ``service``, are written by one job
    beside it and their folders moved there.
    """
    months = [c for c in ("file_month",) if c in df.columns]
    if service:
        df.drop("service").write.partitionBy(*months).parquet(f"{service_dir(root, service)}/load={load}")
        return
    aside = f"{_log(root)}/writing-{load}"
    df.write.partitionBy("service", *months).parquet(aside)
    for entry in paths.entries(df.sparkSession, f"{aside}/service=*"):
        paths.move(df.sparkSession, entry.path, f"{root.rstrip('/')}/{entry.name}/load={load}")
    paths.delete(df.sparkSession, aside)


def vacuum(spark: SparkSession, root: str, keep: int = RETAINED) -> int:
    """Remove versions but the last ``keep``, and the folders that only they list; how many went.

    Folders of loads that were never published stay; they belong to a writer at work or to one that failed.
    """
    numbers = versions(spark, root)
    old, recent = numbers[:-keep], numbers[-keep:]
    if not old:
        return 0
    held = {piece_dir(root, p) for v in recent for p in _read(spark, root, v) or []}
    gone = {piece_dir(root, p) for v in old for p in _read(spark, root, v) or []} - held
    for folder in sorted(gone):
        paths.delete(spark, folder)
    for version in old:
        paths.delete(spark, f"{_log(root)}/{version:010d}.json")
    return len(gone)

