"""CSV export of a date range of the calendar view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.clock import CALENDAR, Moment, as_datetime
from kerbside.operators.serving import calendar_view, in_range
from kerbside.spec import SPECS


def export_name(service: str, start: Moment, end: Moment) -> str:
    """``{service}_from_{start}_to_{end}.csv`` with dates for bounds."""
    first, last = as_datetime(start).date(), as_datetime(end).date()
    return f"{service}_from_{first}_to_{last}.csv"


def export_rows(
    hourly: DataFrame, service: str, start: Moment, end: Moment, with_index: bool = False
) -> DataFrame:
    """The rows an export holds, ordered by hour.

    ``with_index`` adds ``row_index``, the row's position among *all* hours of the service, counted
    before the range is cut. Its window is one ordered partition, but one of hourly rows: at most
    8,784 a year, whatever the number of trips.
    """
    view = calendar_view(hourly.filter(F.col("service") == service))
    columns = [*CALENDAR, *SPECS[service].rollup_columns]
    if with_index:
        position = "row_number() OVER (PARTITION BY service ORDER BY pickup_hour) - 1"
        view = view.withColumn("row_index", F.expr(position))
        columns = ["row_index", *columns]
    return in_range(view, start, end).select(*columns).orderBy("pickup_hour")


def export_range(
    hourly: DataFrame,
    service: str,
    start: Moment,
    end: Moment,
    folder: str,
    with_index: bool = False,
    single_file: bool = False,
) -> str:
    """Write the range as CSV with a header and return the path, a folder named like the export."""
    path = f"{folder.rstrip('/')}/{export_name(service, start, end)}"
    rows = export_rows(hourly, service, start, end, with_index)
    if single_file:
        rows = rows.coalesce(1)
    rows.write.mode("overwrite").option("header", True).csv(path)
    return path
