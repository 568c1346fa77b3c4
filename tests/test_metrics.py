from datetime import datetime, timedelta

import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from kerbside.operators import metrics

SCHEMA = "ts timestamp_ntz, metric string, id string, name string, interface string, value double"
START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def samples(spark):
    def build(points, metric="m", id="/docker/a", name="a", interface=None):
        rows = [(START + timedelta(seconds=s), metric, id, name, interface, float(v)) for s, v in points]
        return spark.createDataFrame(rows, SCHEMA)

    return build


def rates(df) -> list:
    return [r.rate for r in df.orderBy("ts").collect()]


def brute_force(points, window=300):
    """Rate at each sample straight from the definition."""
    points = sorted(points)
    result = []
    for t, _ in points:
        inside = [(s, v) for s, v in points if t - window < s <= t]
        gain = sum(b - a if b >= a else b for (_, a), (_, b) in zip(inside, inside[1:]))
        result.append(gain / (t - inside[0][0]) if len(inside) > 1 else None)
    return result


def test_reset_counts_the_new_value(samples):
    got = rates(metrics.counter_rate(samples([(0, 10), (60, 20), (120, 5), (180, 8)])))
    assert got == [None, pytest.approx(10 / 60), pytest.approx(15 / 120), pytest.approx(0.1)]


def test_window_is_open_at_its_start(samples):
    got = rates(metrics.counter_rate(samples([(0, 1), (300, 7)])))
    assert got == [None, None]
    got = rates(metrics.counter_rate(samples([(0, 1), (299.999999, 7)])))
    assert got[1] == pytest.approx(6 / 299.999999)


def test_series_are_apart(samples):
    df = samples([(0, 1), (60, 2)]).union(samples([(30, 100), (90, 130)], interface="eth0"))
    assert rates(metrics.counter_rate(df)) == [None, None, pytest.approx(1 / 60), 0.5]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    points=st.dictionaries(st.integers(-4000, 8000), st.integers(0, 50), min_size=1, max_size=40),
    bucket=st.sampled_from([60, 300, 1000, 3600]),
)
def test_cutting_time_into_buckets_is_exact(samples, points, bucket):
    pairs = list(points.items())
    got = rates(metrics.counter_rate(samples(pairs), bucket_seconds=bucket))
    assert got == [pytest.approx(r) if r is not None else None for r in brute_force(pairs)]


def test_copies_of_a_sample_collapse(samples):
    df = samples([(0, 1), (60, 4), (60, 4), (60, 4)])
    assert rates(metrics.counter_rate(df)) == [None, pytest.approx(0.05)]


def test_no_task_holds_a_whole_series(samples):
    plan = plan_of(metrics.counter_rate(samples([(0, 1)])))
    window = next(line for line in plan.splitlines() if "Exchange" in line)
    assert "bucket" in window and "Join" not in plan and "Python" not in plan


def test_label_filter_matches_the_whole_id(samples):
    df = samples([(0, 1)]).union(samples([(0, 2)], id="/docker/")).union(samples([(0, 3)], id="x/docker/a"))
    assert [r.value for r in metrics.label_filter(df, "m", "/docker/.+").collect()] == [1.0]
    assert metrics.label_filter(df, "m", "/docker/a|/docker/").count() == 2
    assert metrics.label_filter(df, None, None, ["a"]).count() == 3
    assert metrics.label_filter(df, names=[]).count() == 0


def test_label_values_are_sorted_and_distinct(samples):
    df = samples([(0, 1)], name="b").union(samples([(0, 1), (1, 1)], name="a"))
    df = df.union(samples([(0, 1)], name=None)).union(samples([(0, 1)], metric="other", name="z"))
    assert [r.name for r in metrics.label_values(df, "m", "name").collect()] == ["a", "b"]


def test_panels(samples):
    cpu = metrics.PANELS["cpu_usage"].metric
    df = samples([(0, 1), (60, 4)], metric=cpu).union(samples([(0, 1), (60, 9)], cpu, "/system/x"))
    got = metrics.panel(df, "cpu_usage").orderBy("ts").collect()
    assert [(r.legend, r.value) for r in got] == [("/docker/a", None), ("/docker/a", pytest.approx(5.0))]
    memory = samples([(0, 7)], metrics.PANELS["memory_usage"].metric)
    assert [r.value for r in metrics.panel(memory, "memory_usage").collect()] == [7.0]
    reads = samples([(0, 0), (10, 50)], metrics.PANELS["disk_reads"].metric)
    assert metrics.panel(reads, "disk_reads", ["b"]).count() == 0
    assert [r.value for r in metrics.panel(reads, "disk_reads", ["a"]).orderBy("ts").collect()] == [None, 5.0]
    with pytest.raises(ValueError, match="selector"):
        metrics.panel(df, "cpu_usage", ["a"])
