"""File and table names, and the labels users pick metrics and calendar units by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A trip file (or folder) name: table, year, month. Matched anywhere in a path, so a file, a folder
# of part files and a ``key=value`` folder all work; other names do not match.
TRIP_FILE = r"(?:^|[/=])([A-Za-z0-9]+_tripdata)_(\d{4})-(\d{2})\.parquet(?:/|$)"

# Labels of the calendar units and metrics.
CALENDAR_UNITS = {
    "By hour of day": "hour_of_day",
    "By day of week": "day_of_week",
    "By day of month": "day_of_month",
    "By month": "month",
}
SUMMED_METRICS = {
    "Total number of trips": "num_trips",
    "Total amounts payed": "total_amount_payed",
}
AVERAGED_METRICS = {
    "Average trip duration, min": "avg_trip_time_min",
    "Average trim distance, miles": "avg_trip_miles",
    "Average taxi request - on scene time, min": "avg_request_to_on_scene_time_min",
}


def resolve(label: str, choices: dict[str, str]) -> str:
    """The column behind a label; a column name stands for itself; anything else is an error."""
    if label in choices:
        return choices[label]
    if label in choices.values():
        return label
    raise ValueError(f"unknown name {label!r}; choose from {[*choices, *choices.values()]}")


def _part(path: Column, group: int) -> Column:
    return F.regexp_extract(path, TRIP_FILE, group)


def table_of(path: Column) -> Column:
    """Table a trip file belongs to, ``''`` when the name is not a trip file's."""
    return _part(path, 1)


def service_of(path: Column) -> Column:
    return F.split_part(table_of(path), F.lit("_tripdata"), F.lit(1))


def file_month_of(path: Column) -> Column:
    """Month the file covers, ``YYYY-MM``, taken from its name and not from its rows."""
    return F.concat(_part(path, 2), F.lit("-"), _part(path, 3))


def month_in_trip_path(path: Column) -> Column:
    """The same month for paths known to name a trip file, without a regular expression."""
    return F.left(F.substring_index(path, "_tripdata_", -1), F.lit(7))


def expense_label(column: Column) -> Column:
    """A contribution's label: every ``total_`` in the name goes, wherever it stands."""
    return F.replace(column, F.lit("total_"), F.lit(""))
