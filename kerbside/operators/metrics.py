"""Range queries over metric samples (ts, metric, id, name, interface, value).

A series is one combination of metric, id, name and interface, with one sample per timestamp.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import clock

SERIES = ["metric", "id", "name", "interface"]
MICROS = 1_000_000


def label_filter(
    samples: DataFrame,
    metric: str | None = None,
    id_regex: str | None = None,
    names: list[str] | None = None,
) -> DataFrame:
    """Samples of a metric whose labels match.

    ``id_regex`` has to match the whole id. ``names`` are the selected names; None selects all.
    """
    if metric is not None:
        samples = samples.filter(F.col("metric") == metric)
    if id_regex is not None:
        samples = samples.filter(F.col("id").rlike(f"^(?:{id_regex})$"))
    if names is not None:
        samples = samples.filter(F.col("name").isin(names))
    return samples


def label_values(samples: DataFrame, metric: str, label: str) -> DataFrame:
    """Distinct values of a label among the metric's series, ascending."""
    chosen = label_filter(samples, metric).select(label).filter(F.col(label).isNotNull())
    return chosen.distinct().orderBy(label)


def counter_rate(
    samples: DataFrame,
    window_seconds: int = 300,
    bucket_seconds: int = 3600,
    assume_unique: bool = False,
) -> DataFrame:
    """Per-second increase of counters at each sample: the input's series, ``ts``, ``rate``.

    At time t the window is ``(t - window, t]``. The increase is the sum of steps between samples
    inside the window; a step down is a counter reset and counts the new value. It is divided by
    the time from the first to the last sample of the window; with fewer than two samples the rate
    is NULL. There is no extrapolation to the window's edges.

    A series may be most of the data, so no task holds a whole series: time is cut into buckets,
    and a sample also goes to later buckets its window reaches into. A result depends on one window
    only, so this is exact; it copies about ``window / bucket`` of the samples. Samples with the
    same series and time collapse to the largest one before that shuffle, which bounds a bucket by
    its clock ticks; ``assume_unique`` saves that step when it is known that there are none.
    """
    if not assume_unique:
        samples = samples.groupBy(*SERIES, "ts").agg(F.expr("max(value) AS value"))
    width, reach = bucket_seconds * MICROS, window_seconds * MICROS - 1

    def bucket(micros: str) -> str:
        return f"({micros} - pmod({micros}, {width})) DIV {width}"

    # Sorting compares the number first and rarely gets to the labels.
    labels = ", ".join([*SERIES, "bucket"])
    group = f"PARTITION BY group_hash, {labels}"
    before = f"lag(value) OVER ({group} ORDER BY at)"
    gained = (
        samples.selectExpr("ts", *SERIES, "value", f"{clock.epoch_micros('ts')} AS at")
        .selectExpr("*", f"{bucket('at')} AS home")
        .selectExpr("*", f"explode(sequence(home, {bucket(f'(at + {reach})')})) AS bucket")
        .selectExpr("*", f"xxhash64({labels}) AS group_hash")
        .selectExpr("*", f"value - CASE WHEN value < {before} THEN 0 ELSE {before} END AS step")
        .selectExpr(
            "*",
            f"coalesce(sum(step) OVER ({group} ORDER BY at ROWS UNBOUNDED PRECEDING), 0) AS gain",
        )
    )
    # The first sample of a window is the next one after the time the window opens. Sort these
    # opening times among the samples, latest first, and carry the last sample seen: unlike a
    # sliding frame, this costs the same however many samples a window has.
    opens = f"CASE WHEN bucket = home THEN struct(true AS opens, at - {reach + 1} AS place) END"
    seen = f"OVER ({group} ORDER BY place DESC, opens DESC ROWS UNBOUNDED PRECEDING)"
    return (
        gained.selectExpr(
            "ts",
            *SERIES,
            "bucket",
            "group_hash",
            "at",
            "gain",
            f"inline(array_compact(array(struct(false AS opens, at AS place), {opens})))",
        )
        .selectExpr(
            "*",
            f"last(CASE WHEN NOT opens THEN at END, true) {seen} AS first_at",
            f"last(CASE WHEN NOT opens THEN gain END, true) {seen} AS first_gain",
        )
        .filter("opens")
        .selectExpr(
            "ts",
            *SERIES,
            f"CASE WHEN at > first_at THEN (gain - first_gain) / ((at - first_at) / {MICROS}) END"
            " AS rate",
        )
    )


@dataclass(frozen=True)
class Panel:
    """One monitoring chart: a gauge as it is, or the rate of a counter times ``scale``."""

    metric: str
    legend: str
    rate: bool = True
    scale: float = 1.0
    id_regex: str | None = None
    by_name: bool = False


# Metrics, label patterns and legends of the monitoring charts.
PANELS: dict[str, Panel] = {
    "cpu_usage": Panel(
        "container_cpu_usage_seconds_total", "id", scale=100.0, id_regex="/docker/.+"
    ),
    "memory_usage": Panel(
        "container_memory_usage_bytes", "id", rate=False, id_regex="/docker/.+"
    ),
    "memory_cached": Panel("container_memory_cache", "id", rate=False, id_regex="/docker/.+"),
    "network_received": Panel("container_network_receive_bytes_total", "interface"),
    "network_sent": Panel("container_network_transmit_bytes_total", "interface"),
    "container_receive": Panel("container_network_receive_bytes_total", "name", by_name=True),
    "container_transmit": Panel("container_network_transmit_bytes_total", "name", by_name=True),
    "disk_reads": Panel("container_fs_reads_bytes_total", "name", by_name=True),
    "disk_writes": Panel("container_fs_writes_bytes_total", "name", by_name=True),
}


def panel(samples: DataFrame, title: str, names: list[str] | None = None) -> DataFrame:
    """Data of one monitoring chart: (ts, series labels, legend, value).

    ``names`` are the selected containers, for the charts that have the selector; None means all.
    """
    chart = PANELS[title]
    if names is not None and not chart.by_name:
        raise ValueError(f"panel {title!r} has no container selector")
    chosen = label_filter(samples, chart.metric, chart.id_regex, names)
    if chart.rate:
        points, value = counter_rate(chosen), f"rate * {chart.scale}D AS value"
    else:
        points, value = chosen, "value"
    return points.selectExpr("ts", *SERIES, f"{chart.legend} AS legend", value)
