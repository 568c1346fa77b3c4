"""Which months to load and between which times: slices as DataFrames.

There is one row per service and month, so these frames stay as small as the file listing.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import clock


def table_start_times(discovered: DataFrame, watermarks: DataFrame) -> DataFrame:
    """(service, watermark): NULL for a table not loaded yet.

    A loaded table keeps its watermark even when no file of it is on disk.
    """
    return discovered.select("service").join(watermarks, "service", "full_outer")


def slice_plan(
    start_times: DataFrame, as_of: clock.Moment, year: int | None = None, mode: str = "append"
) -> DataFrame:
    """Slices from each service's watermark to ``as_of``.

    Output: (service, file_month, file_name, table_name, start_time, end_time). Every month before
    that of ``as_of`` is a whole file, without bounds. The month of ``as_of`` has bounds:

    * ``append``: after the watermark (1 January of the year when there is none), before ``as_of``;
    * ``replace``: before ``as_of`` only, as the month is rebuilt and late rows count.

    Both bounds are exclusive. ``year`` moves the clock into another year. A watermark after
    ``as_of``, from a stray pick-up, is taken as ``as_of``.
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"mode is append or replace, not {mode!r}")
    moment = clock.clock_in_year(as_of, year) if year else clock.as_datetime(as_of)
    end, opening = clock.ntz(moment), clock.ntz(f"{moment.year:04d}-01-01")
    this_month = f"DATE '{moment:%Y-%m}-01'"
    bounded = f"CASE WHEN first_day = {this_month} THEN"
    return (
        start_times.selectExpr(
            "service", f"least(coalesce(watermark, {opening}), {end}) AS since"
        )
        .selectExpr(
            "service",
            "since",
            "concat(service, '_tripdata') AS table_name",
            f"explode(sequence(trunc(since, 'MM'), {this_month}, INTERVAL '1' MONTH)) AS first_day",
        )
        .withColumn("file_month", F.expr(clock.month_label("first_day")))
        .selectExpr(
            "service",
            "file_month",
            "concat(table_name, '_', file_month, '.parquet') AS file_name",
            "table_name",
            f"{bounded} {'since' if mode == 'append' else 'CAST(NULL AS TIMESTAMP_NTZ)'} END"
            " AS start_time",
            f"{bounded} {end} END AS end_time",
        )
    )


def between(trips: DataFrame, start: clock.Moment | None, end: clock.Moment | None) -> DataFrame:
    """Trips picked up strictly between the bounds; a bound that is None does not apply."""
    if start is not None:
        trips = trips.filter(f"pickup_datetime > {clock.ntz(start)}")
    if end is not None:
        trips = trips.filter(f"pickup_datetime < {clock.ntz(end)}")
    return trips


#: A slice as collected: service, exclusive lower and upper bound; None for no bound.
Bounds = tuple[str, datetime | None, datetime | None]


def _inside(bounds: Bounds) -> str:
    service, start, end = bounds
    limits = [f"service = '{service}'"]
    limits += [f"pickup_datetime > {clock.ntz(start)}"] if start is not None else []
    limits += [f"pickup_datetime < {clock.ntz(end)}"] if end is not None else []
    return " AND ".join(limits)


def slice_filter(trips: DataFrame, slices: Sequence[Bounds]) -> DataFrame:
    """Trips of many slices in one pass: those of a slice's service, strictly inside its bounds.

    There is one slice per service at most, or per service and file; with its bounds as literals
    the filter reaches the reader, like that of the load. Trips without a slice drop out.
    """
    return trips.filter(" OR ".join(f"({_inside(s)})" for s in slices) or "false")


def slice_count(trips: DataFrame, slices: Sequence[Bounds]) -> DataFrame:
    """Trips per service with a slice, 0 for an empty one: (service, num_rows, skipped), in one scan."""
    counts = trips.agg(
        *(F.expr(f"count_if({_inside(s)}) AS n{i}") for i, s in enumerate(slices))
    )
    rows = ", ".join(f"struct('{s[0]}' AS service, n{i} AS num_rows)" for i, s in enumerate(slices))
    return counts.select(F.expr(f"inline(array({rows}))")).withColumn(
        "skipped", F.expr("num_rows = 0")
    )
