"""Answers from the hourly rollups: cards, trends, contributions, histograms.

Input is a rollup with a ``service`` column: one service, or all of them. It has one row per service
and hour, however many trips that stands for: at most 8,784 per service and year. The calendar so
bounds the exact percentiles and the windows per service below. All services are answered in one
pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import clock, names
from kerbside.spec import PAYING_SERVICES, SERVICES, SPECS, services_with

TRIM_QUANTILE = 0.99  # fixed value: share of hours a histogram keeps
AGGREGATES = {
    "sum": "coalesce(sum({0}), 0)",
    "avg": "avg({0})",
    "min": "min({0})",
    "max": "max({0})",
    "count": "count({0})",
    "median": "median({0})",
}


def calendar_view(hourly: DataFrame) -> DataFrame:
    """The rollup with its four calendar columns in front. Order it at the output, if at all."""
    return hourly.selectExpr(*map(clock.calendar_part, clock.CALENDAR), "*")


def in_range(
    hourly: DataFrame,
    start: clock.Moment,
    end: clock.Moment,
    end_inclusive_midnight: bool = False,
) -> DataFrame:
    """Hours from ``start`` up to, not including, ``end``; dates stand for their midnight.

    ``end_inclusive_midnight`` also keeps the one hour that begins exactly at ``end``.
    """
    upto = "<=" if end_inclusive_midnight else "<"
    return hourly.filter(
        f"pickup_hour >= {clock.ntz(start)} AND pickup_hour {upto} {clock.ntz(end)}"
    )


def available(hourly: DataFrame, metric: str) -> DataFrame:
    """Hours of the services that have ``metric``; none at all when no column carries it."""
    if metric not in hourly.columns:
        hourly = hourly.withColumn(metric, F.lit(None).cast("double")).filter("false")
    having = services_with(metric)
    return hourly if having == SERVICES else hourly.filter(F.col("service").isin(having))


def metric_availability(hourly: DataFrame) -> DataFrame:
    """(service, metric, hours): metrics each service has, with the number of hours they cover."""
    metrics = [*names.SUMMED_METRICS.values(), *names.AVERAGED_METRICS.values()]
    has = ", ".join(
        f"CASE WHEN service IN ({str(services_with(metric))[1:-1]}) THEN '{metric}' END"
        for metric in metrics
    )
    hours = hourly.groupBy("service").agg(F.count(F.lit(1)).alias("hours"))
    return hours.selectExpr("service", f"explode(array_compact(array({has}))) AS metric", "hours")


def _per_service(hourly: DataFrame, column: str, services: list[str]) -> DataFrame:
    """Sum of ``column`` for each of ``services``, 0 for one without hours: one global aggregate."""
    sums = [
        F.expr(f"coalesce(sum({column}) FILTER (WHERE service = '{s}'), 0) AS {s}")
        for s in services
    ]
    return hourly.agg(*sums).unpivot([], services, "service", column)


def card_num_trips(hourly: DataFrame, start: clock.Moment, end: clock.Moment) -> DataFrame:
    """Trips in the range for each of the four services."""
    return _per_service(in_range(hourly, start, end), "num_trips", SERVICES)


def card_total_payed(hourly: DataFrame, start: clock.Moment, end: clock.Moment) -> DataFrame:
    """Amount paid in the range, to cents, for each service that has amounts."""
    cards = _per_service(in_range(hourly, start, end), "total_amount_payed", PAYING_SERVICES)
    return cards.selectExpr("service", "bround(total_amount_payed, 2) AS total_amount_payed")


def trend(
    hourly: DataFrame,
    metric: str,
    by: str,
    start: clock.Moment,
    end: clock.Moment,
    agg: str = "sum",
) -> DataFrame:
    """A metric over a calendar unit, per service: (service, <unit>, <metric>), ascending.

    ``metric`` and ``by`` are labels or column names. Sums skip NULL hours and are 0 when nothing
    is left. Services without the metric have no rows.
    """
    column = names.resolve(metric, names.SUMMED_METRICS)
    unit = names.resolve(by, names.CALENDAR_UNITS)
    if agg not in AGGREGATES:
        raise ValueError(f"unknown aggregate {agg!r}; choose from {list(AGGREGATES)}")
    view = available(in_range(hourly, start, end), column)
    return (
        view.groupBy("service", F.expr(clock.calendar_part(unit)))
        .agg(F.expr(AGGREGATES[agg].format(column)).alias(column))
        .orderBy("service", unit)
    )


def trends(hourly: DataFrame, start: clock.Moment, end: clock.Moment) -> DataFrame:
    """All summed metrics over all calendar units, per service, in one pass.

    (service, calendar_unit, position, <each metric>), as :func:`trend` gives them one by one: grouping
    sets over the units. A metric a service does not have is NULL.
    """
    metrics = list(names.SUMMED_METRICS.values())
    view = calendar_view(in_range(hourly, start, end))
    sums = [
        F.expr(
            f"CASE WHEN service IN ({str(services_with(m))[1:-1]}) THEN {AGGREGATES['sum'].format(m)} END AS {m}"
        )
        for m in metrics
    ]
    units = list(clock.CALENDAR)
    grouped = view.groupingSets([[F.col("service"), F.col(u)] for u in units], "service", *units).agg(
        *(F.expr(f"grouping({u}) AS no_{u}") for u in units), *sums
    )
    unit = " ".join(f"WHEN no_{u} = 0 THEN '{u}'" for u in units)
    position = " ".join(f"WHEN no_{u} = 0 THEN {u}" for u in units)
    return grouped.selectExpr(
        "service", f"CASE {unit} END AS calendar_unit", f"CASE {position} END AS position", *metrics
    ).orderBy("service", "calendar_unit", "position")


def contributions(
    hourly: DataFrame, service: str, start: clock.Moment, end: clock.Moment
) -> DataFrame:
    """Each price component's share of the range: (expense, amount), in the component order."""
    columns = list(SPECS[service].money)
    if not columns:
        raise ValueError(f"service {service!r} has no amounts")
    chosen = in_range(hourly.filter(F.col("service") == service), start, end)
    sums = chosen.agg(*(F.expr(f"coalesce(sum({c}), 0D) AS {c}") for c in columns))
    return sums.unpivot([], columns, "expense", "amount").withColumn(
        "expense", names.expense_label(F.col("expense"))
    )


def _quantile(column: str, approximate: bool) -> str:
    if approximate:
        return f"percentile_approx({column}, {TRIM_QUANTILE}, 10000)"
    return f"percentile({column}, {TRIM_QUANTILE})"


def upper_quantile(
    hourly: DataFrame,
    metric: str,
    start: clock.Moment,
    end: clock.Moment,
    approximate: bool = False,
) -> DataFrame:
    """The 0.99 quantile of an hourly average per service, interpolated: (service, p99).

    Each hour counts once, however many trips it has.
    """
    column = names.resolve(metric, names.AVERAGED_METRICS)
    view = available(in_range(hourly, start, end), column)
    return view.groupBy("service").agg(F.expr(f"{_quantile(column, approximate)} AS p99"))


def trim_upper(
    hourly: DataFrame,
    metric: str,
    start: clock.Moment,
    end: clock.Moment,
    approximate: bool = False,
) -> DataFrame:
    """Hours whose average is at most the quantile: (service, pickup_hour, <metric>).

    The quantile is taken over a window, so the rollup is evaluated once and nothing is joined.
    """
    column = names.resolve(metric, names.AVERAGED_METRICS)
    limit = f"{_quantile(column, approximate)} OVER (PARTITION BY service) AS p99"
    return (
        available(in_range(hourly, start, end), column)
        .selectExpr("service", "pickup_hour", column, limit)
        .filter(f"{column} <= p99")
        .drop("p99")
    )


def histogram(
    hourly: DataFrame,
    metric: str,
    start: clock.Moment,
    end: clock.Moment,
    nbins: int = 30,
    approximate: bool = False,
) -> DataFrame:
    """Equal-width histogram of the trimmed hourly averages, per service.

    (service, bin, bin_low, bin_high, num_hours), empty bins included; the last bin is closed. When
    all values are equal there is one bin. Everything after the first shuffle by service stays in
    that partitioning.
    """
    column = names.resolve(metric, names.AVERAGED_METRICS)
    kept = trim_upper(hourly, column, start, end, approximate)
    last = f"CASE WHEN width > 0 THEN {nbins - 1} ELSE 0 END"
    counts = (
        kept.selectExpr(
            "service",
            f"{column} AS x",
            f"min({column}) OVER (PARTITION BY service) AS lo",
            f"max({column}) OVER (PARTITION BY service) AS hi",
        )
        .selectExpr("service", "x", "lo", f"(hi - lo) / {nbins} AS width")
        .selectExpr(
            "service",
            "lo",
            "width",
            f"CASE WHEN width > 0 THEN least(floor((x - lo) / width), {nbins - 1}) ELSE 0 END"
            " AS bin",
        )
        .groupBy("service", "lo", "width", "bin")
        .agg(F.expr("count(1) AS num_hours"))
    )
    # A service has at most nbins counts: gather them to list its empty bins too.
    return (
        counts.groupBy("service", "lo", "width")
        .agg(F.expr("map_from_entries(collect_list(struct(bin, num_hours))) AS by_bin"))
        .selectExpr("service", "lo", "width", "by_bin", f"explode(sequence(0, {last})) AS bin")
        .selectExpr(
            "service",
            "bin",
            "lo + bin * width AS bin_low",
            "lo + (bin + 1) * width AS bin_high",
            "coalesce(by_bin[bin], 0L) AS num_hours",
        )
    )
