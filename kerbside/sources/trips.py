"""Reading raw monthly trip files and the trip store."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions import names
from kerbside.sources import paths, store
from kerbside.spec import ServiceSpec

CANONICAL_TIMES = ("pickup_datetime", "dropoff_datetime")


def canonicalise(df: DataFrame) -> DataFrame:
    """Give the pick-up and drop-off columns their common names.

    The first column whose name contains ``pickup_datetime`` (``dropoff_datetime``), in any case,
    is it. Renaming keeps filters pushable to the parquet reader. No such column is an error.
    """
    renames = {}
    for wanted in CANONICAL_TIMES:
        found = next((c for c in df.columns if wanted in c.lower()), None)
        if found is None:
            raise ValueError(f"no column contains {wanted!r} among {df.columns}")
        renames[found] = wanted
    return df.withColumnsRenamed(renames)


def conform(df: DataFrame, spec: ServiceSpec) -> DataFrame:
    """Cast the service's declared columns to their declared types; other columns stay as they are.

    Published files drift between months (an integer column one month, a floating one the next, or
    a column that is absent). Casting on the way in keeps the store's columns of one type; an
    absent amount is NULL. Durations stored as floating numbers go to a column of their own.
    """
    present = {c.lower(): c for c in df.columns}
    declared = {}
    for column, dtype in spec.trip_columns.items():
        source = present.get(column.lower())
        declared[column] = (F.col(source) if source else F.lit(None)).cast(dtype)
    stored = present.get(spec.seconds.lower()) if spec.seconds else None
    if stored and not isinstance(df.schema[stored].dataType, T.IntegralType):
        declared[spec.floating_seconds] = F.col(stored).cast("double")
        declared[spec.seconds] = F.lit(None).cast("long")
    declared_lower = {c.lower() for c in declared}
    rest = [c for c in df.columns if c.lower() not in declared_lower]
    return df.select(*(value.alias(name) for name, value in declared.items()), *rest)


def _merged_schema(spark: SparkSession, files: list[str]) -> T.StructType | None:
    """One schema for all files, from their footers in one distributed job; None if none fits."""
    try:
        merged = spark.read.option("mergeSchema", True).parquet(*files).schema
    except Py4JJavaError as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        return None
    lower = [c.lower() for c in merged.names]
    once = all(sum(time in c for c in lower) <= 1 for time in CANONICAL_TIMES)
    return merged if once or len(files) == 1 else None


def _schemas(spark: SparkSession, files: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Groups of files that can be read with one schema.

    Where types conflict between files, or the time columns are spelled differently, the list is
    halved until each half agrees: types change at some month and stay, so of n files in order few
    jobs of a logarithmic number are needed, and each merges its footers on the cluster. Groups of
    one schema are read together.
    """
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    pending = [sorted(files)]
    while pending:
        some = pending.pop()
        schema = _merged_schema(spark, some)
        if schema is None:
            middle = len(some) // 2
            pending += [some[middle:], some[:middle]]
        else:
            groups.setdefault(schema.json(), (schema, []))[1].extend(some)
    return list(groups.values())


def scan_files(spark: SparkSession, spec: ServiceSpec, months: list[str]) -> DataFrame:
    """All given monthly files of one service as one DataFrame with ``service``, ``file_month``.

    Files whose schemas agree are one multi-file scan, however many months they cover. A folder
    counts as its part files, which may differ, too. The month comes from the file's path.
    """
    files = [e.path for month in months for e in paths.data_files(spark, month)]
    scans = [
        conform(
            canonicalise(spark.read.schema(schema).parquet(*same)).withColumns(
                {
                    "service": F.lit(spec.name),
                    "file_month": names.month_in_trip_path(F.col("_metadata.file_path")),
                }
            ),
            spec,
        )
        for schema, same in _schemas(spark, files)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def load_trips(
    spark: SparkSession, trips_dir: str, spec: ServiceSpec, *more_partitions: str
) -> DataFrame:
    """One service's trips from the store's current version, declared columns only, plus ``file_month``.

    A filter on ``file_month`` prunes months. ``load`` can be asked for as a further column.
    """
    live = store.pieces(spark, trips_dir, spec.name)
    trips = store.read(spark, trips_dir, spec.trip_schema, live, "file_month", *more_partitions)
    return trips.withColumn("service", F.lit(spec.name))
