"""Hourly rollups of trips, and their mergeable parts.

Grouping keys are hours, so partial aggregation shrinks the data before the shuffle to one row per
task and hour: the shuffle does not grow with the trips, and an hour that holds a third of them is
no hot spot.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions import clock
from kerbside.spec import HOURLY_COLUMNS, SPECS, ServiceSpec


def averaged(trips: DataFrame, spec: ServiceSpec) -> dict[str, str]:
    """What each average of the rollup is taken over, per trip. NULLs drop out of the average.

    Durations between two times are in seconds, see :func:`unit`.
    """
    over = {}
    if spec.wait:
        over["avg_request_to_on_scene_time_min"] = clock.seconds_between(*spec.wait)
    if spec.seconds is None:
        over["avg_trip_time_min"] = clock.seconds_between("pickup_datetime", "dropoff_datetime")
    elif not isinstance(trips.schema[spec.seconds].dataType, T.IntegralType):
        over["avg_trip_time_min"] = f"{spec.seconds} / 60"
    else:
        # Stored whole seconds count as whole minutes, cut toward zero, before averaging.
        over["avg_trip_time_min"] = f"{spec.seconds} DIV 60"
        if spec.floating_seconds in trips.columns:
            floating = f"{spec.floating_seconds} / 60"
            over["avg_trip_time_min"] = f"coalesce({spec.seconds} DIV 60, {floating})"
    if spec.distance:
        over["avg_trip_miles"] = spec.distance
    return over


def unit(average: str, spec: ServiceSpec) -> str:
    """What an average is divided by after averaging.

    Whole seconds sum up exactly in any order, minutes with their fractions do not.
    """
    in_seconds = ["avg_request_to_on_scene_time_min"]
    if spec.seconds is None:
        in_seconds.append("avg_trip_time_min")
    return " / 60" if average in in_seconds else ""


HOUR = clock.hour_number("pickup_datetime") + " AS hour_number"


def _aggregate(trips: DataFrame, keys: list[str], outputs: dict[str, str]) -> DataFrame:
    """Group by SQL expressions and compute SQL aggregates under their output names."""
    return trips.groupBy(*map(F.expr, keys)).agg(
        *(F.expr(f"{value} AS {name}") for name, value in outputs.items())
    )


def _finish(grouped: DataFrame, spec: ServiceSpec) -> DataFrame:
    """Name the hour and add the total, as a sum of sums: NULL as soon as one of them is NULL."""
    exact = {
        "pickup_hour": clock.hour_start("hour_number") + " AS pickup_hour",
        "num_trips": "num_trips",
    }
    values = {"total_amount_payed": " + ".join(spec.totalled)}
    return grouped.selectExpr(
        f"'{spec.name}' AS service",
        *(
            exact.get(c) or f"CAST({values.get(c, c)} AS DOUBLE) AS {c}"
            for c in spec.rollup_columns
        ),
    )


def pickups_between(
    trips: DataFrame, start: clock.Moment | None, end: clock.Moment | None
) -> DataFrame:
    """Trips whose pick-up hour lies in ``[start, end)``, filtered on the raw column.

    For bounds on whole hours this equals the filter on ``pickup_hour``, which parquet statistics
    cannot use because it is computed. Other bounds are an error.
    """
    conditions = []
    for bound, compare in ((start, ">="), (end, "<")):
        if bound is not None:
            moment = clock.as_datetime(bound)
            if (moment.minute, moment.second, moment.microsecond) != (0, 0, 0):
                raise ValueError(f"bound {bound} is not on a whole hour")
            conditions.append(f"pickup_datetime {compare} {clock.ntz(moment)}")
    return trips.filter(" AND ".join(conditions)) if conditions else trips


def hourly_rollup(
    trips: DataFrame,
    spec: ServiceSpec,
    start: clock.Moment | None = None,
    end: clock.Moment | None = None,
) -> DataFrame:
    """One row per hour with the service's counts, averages, sums and total.

    ``trips`` has canonical column names. Trips without a pick-up time form an hour of their own,
    NULL.
    """
    trips = pickups_between(trips, start, end)
    outputs = {"num_trips": "count(1)"}
    outputs |= {
        out: f"avg({value}){unit(out, spec)}" for out, value in averaged(trips, spec).items()
    }
    outputs |= {out: f"sum({source})" for out, source in spec.money.items()}
    return _finish(_aggregate(trips, [HOUR], outputs), spec)


def union_services(frames: list[DataFrame]) -> DataFrame:
    """Rollups of several services as one DataFrame; a column a service lacks is NULL there."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    present = set(merged.columns)
    return merged.select("service", *(c for c in HOURLY_COLUMNS if c in present))


def all_services_hourly(
    trips: Mapping[str, DataFrame],
    start: clock.Moment | None = None,
    end: clock.Moment | None = None,
) -> DataFrame:
    """The rollups of all given services, keyed by service name, in one DataFrame."""
    return union_services(
        [hourly_rollup(df, SPECS[service], start, end) for service, df in trips.items()]
    )


def _sum_of(average: str) -> str:
    return f"{average}__sum"


def _count_of(average: str) -> str:
    return f"{average}__count"


def hourly_parts(trips: DataFrame, spec: ServiceSpec, *slice_columns: str) -> DataFrame:
    """Partial rollup per (slice, hour) that :func:`merge_parts` can combine exactly.

    A slice is the unit of reloading, such as a file month: when it is replaced only its own parts
    are recomputed, although its stray pick-ups touch hours of other months. An average is kept as
    a sum and a count. ``max_pickup`` carries the watermark, so asking for it reads no trips.
    """
    outputs = {"num_trips": "count(1)", "max_pickup": "max(pickup_datetime)"}
    for out, value in averaged(trips, spec).items():
        outputs[_sum_of(out)] = f"sum(CAST({value} AS DOUBLE))"
        outputs[_count_of(out)] = f"count({value})"
    outputs |= {out: f"CAST(sum({source}) AS DOUBLE)" for out, source in spec.money.items()}
    parts = _aggregate(trips, [*slice_columns, HOUR], outputs)
    return parts.withColumn("service", F.lit(spec.name))


def merge_parts(parts: DataFrame, spec: ServiceSpec) -> DataFrame:
    """The service's rollup from its parts; equals :func:`hourly_rollup` over all its trips."""
    outputs = {"num_trips": "sum(num_trips)"}
    for average in spec.averages:
        total, count = _sum_of(average), _count_of(average)
        outputs[average] = f"sum({total}) / nullif(sum({count}), 0){unit(average, spec)}"
    outputs |= {out: f"sum({out})" for out in spec.money}
    own = parts.filter(F.col("service") == spec.name)
    return _finish(_aggregate(own, ["hour_number"], outputs), spec)


def parts_schema() -> T.StructType:
    """Schema of a store of parts of all services."""
    schema = T.StructType(
        [
            T.StructField("hour_number", T.LongType()),
            T.StructField("num_trips", T.LongType()),
            T.StructField("max_pickup", T.TimestampNTZType()),
        ]
    )
    for average in dict.fromkeys(a for spec in SPECS.values() for a in spec.averages):
        schema.add(_sum_of(average), T.DoubleType()).add(_count_of(average), T.LongType())
    for amount in dict.fromkeys(m for spec in SPECS.values() for m in spec.money):
        schema.add(amount, T.DoubleType())
    return schema


def rollup_schema() -> T.StructType:
    """Schema of a stored rollup of all services, without the service."""
    special = {"pickup_hour": T.TimestampNTZType(), "num_trips": T.LongType()}
    return T.StructType(
        [T.StructField(c, special.get(c, T.DoubleType())) for c in HOURLY_COLUMNS]
    )


def watermark(trips: DataFrame) -> DataFrame:
    """Latest pick-up per service: (service, watermark). Reads one column of the trips."""
    return trips.groupBy("service").agg(F.max("pickup_datetime").alias("watermark"))


def watermark_from_parts(parts: DataFrame) -> DataFrame:
    """The same answer from the partial rollups, without reading trips."""
    return parts.groupBy("service").agg(F.max("max_pickup").alias("watermark"))


def duplicate_hours(rollup: DataFrame) -> DataFrame:
    """Keys a rollup holds more than once; empty for a sound one. NULL hours are no duplicates."""
    return (
        rollup.filter(F.col("pickup_hour").isNotNull())
        .groupBy("service", "pickup_hour")
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def key_check(rollup: DataFrame) -> DataFrame:
    """Per service: hours, distinct hours and whether each hour occurs once."""
    hours = F.count("pickup_hour")
    distinct = F.count_distinct("pickup_hour")
    return rollup.groupBy("service").agg(
        hours.alias("hours"), distinct.alias("distinct_hours"), (hours == distinct).alias("ok")
    )


def assert_unique_hours(rollup: DataFrame) -> None:
    """Raise when an hour occurs twice."""
    found = duplicate_hours(rollup).take(3)
    if found:
        raise ValueError(f"rollup holds hours more than once, such as {found}")
