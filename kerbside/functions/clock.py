"""Wall-clock time expressions as SQL text, independent of the session time zone.

Trip times carry no zone. ``date_trunc`` would send them through the session zone and move hours at
a daylight-saving change, and is several times slower than the integer arithmetic used here. Text
rather than Column objects keeps building a query cheap: one call to the JVM for an expression
instead of one for each of its parts.
"""

from __future__ import annotations

from datetime import date, datetime

Moment = str | date | datetime


def as_datetime(moment: Moment) -> datetime:
    """An ISO string, date or datetime as a naive datetime; a date means its midnight."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if not isinstance(moment, datetime):
        moment = datetime(moment.year, moment.month, moment.day)
    if moment.tzinfo is not None:
        raise ValueError(f"wall-clock time expected, got a zoned one: {moment}")
    return moment


def ntz(moment: Moment) -> str:
    """A ``timestamp_ntz`` literal, typed so that comparisons with it reach the parquet reader."""
    return f"TIMESTAMP_NTZ '{as_datetime(moment).isoformat(sep=' ', timespec='microseconds')}'"


EPOCH = ntz("1970-01-01")


def hour_number(ts: str) -> str:
    """Hours since 1970-01-01 00:00, rounded down: a cheap grouping key."""
    # unix_timestamp truncates toward zero, so times before 1970 are first moved down.
    down = f"CASE WHEN {ts} >= {EPOCH} THEN {ts} ELSE {ts} - INTERVAL '0.999999' SECOND END"
    return f"floor(unix_timestamp({down}) / 3600)"


def hour_start(number: str) -> str:
    """The ``timestamp_ntz`` at which hour ``number`` begins; inverse of :func:`hour_number`."""
    return f"{EPOCH} + {number} * INTERVAL '1' HOUR"


def epoch_micros(ts: str) -> str:
    """Microseconds since 1970-01-01 00:00 on the wall clock."""
    return f"CAST(CAST({ts} - {EPOCH} AS DECIMAL(18, 6)) * 1000000 AS BIGINT)"


def seconds_between(start: str, end: str) -> str:
    """Elapsed seconds with their fraction; NULL when either end is."""
    return f"CAST(CAST({end} - {start} AS DECIMAL(18, 6)) AS DOUBLE)"


# Weeks start on Sunday, day 0.
_CALENDAR = {
    "hour_of_day": "hour({0})",
    "day_of_week": "dayofweek({0}) - 1",
    "day_of_month": "dayofmonth({0})",
    "month": "month({0})",
}
CALENDAR = list(_CALENDAR)


def calendar_part(unit: str, hour: str = "pickup_hour") -> str:
    """One of the four calendar columns of an hour, named after the unit."""
    return f"{_CALENDAR[unit].format(hour)} AS {unit}"


def month_label(ts: str) -> str:
    """``YYYY-MM`` with a zero-padded month."""
    return f"concat(lpad(year({ts}), 4, '0'), '-', lpad(month({ts}), 2, '0'))"


def clock_in_year(moment: Moment, year: int = 2024) -> datetime:
    """The same month, day and time of day in another year.

    Files of a past year are replayed against today's clock. 29 February needs a leap year.
    """
    return as_datetime(moment).replace(year=year)
