from datetime import datetime

import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from kerbside.operators import rollup
from kerbside.spec import SPECS

YELLOW = {c: 1.0 for c in SPECS["yellow"].money.values()}
HVFHV = {c: 1.0 for c in SPECS["fhvhv"].money.values()}


def only(df) -> dict:
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_output_columns_and_types(trips):
    for service, count in (("fhvhv", 14), ("fhv", 3), ("yellow", 13), ("green", 12)):
        out = rollup.hourly_rollup(trips(service, []), SPECS[service])
        assert out.columns == ["service", *SPECS[service].rollup_columns]
        assert len(SPECS[service].rollup_columns) == count
        kinds = dict(out.dtypes)
        assert (kinds.pop("service"), kinds.pop("pickup_hour"), kinds.pop("num_trips")) == (
            "string", "timestamp_ntz", "bigint",
        )
        assert set(kinds.values()) <= {"double"}


def test_stored_seconds_become_whole_minutes(trips):
    rows = [{"pickup_datetime": "2024-01-01 10:00", "trip_time": s} for s in (59, 119, 121)]
    got = only(rollup.hourly_rollup(trips("fhvhv", rows), SPECS["fhvhv"]))
    assert got["avg_trip_time_min"] == 1.0
    floating = trips("fhvhv", rows)
    floating = floating.withColumn("trip_time", floating.trip_time.cast("double"))
    got = only(rollup.hourly_rollup(floating, SPECS["fhvhv"]))
    assert got["avg_trip_time_min"] == pytest.approx(299 / 180)


def test_missing_end_leaves_the_average_but_counts(trips):
    rows = [
        {"pickup_datetime": "2024-01-01 10:00", "dropoff_datetime": "2024-01-01 10:01:30"},
        {"pickup_datetime": "2024-01-01 10:59:59.5", "dropoff_datetime": None},
    ]
    got = only(rollup.hourly_rollup(trips("fhv", rows), SPECS["fhv"]))
    assert (got["num_trips"], got["avg_trip_time_min"]) == (2, 1.5)


def test_waiting_time(trips):
    rows = [
        {
            "pickup_datetime": "2024-01-01 10:00",
            "request_datetime": "2024-01-01 09:50",
            "on_scene_datetime": scene,
        }
        for scene in ("2024-01-01 09:53:30", None)
    ]
    got = only(rollup.hourly_rollup(trips("fhvhv", rows), SPECS["fhvhv"]))
    assert got["avg_request_to_on_scene_time_min"] == 3.5


def test_total_is_null_when_one_sum_is(trips):
    rows = [{"pickup_datetime": "2024-01-01 10:00", **YELLOW, "Airport_fee": None}]
    got = only(rollup.hourly_rollup(trips("yellow", rows), SPECS["yellow"]))
    assert got["total_airport_fees"] is None and got["total_amount_payed"] is None
    rows.append({"pickup_datetime": "2024-01-01 10:30", **YELLOW, "tip_amount": None})
    got = only(rollup.hourly_rollup(trips("yellow", rows), SPECS["yellow"]))
    assert got["total_amount_payed"] == 2 * 6 + 1 + 1


def test_driver_pay_is_outside_the_total(trips):
    rows = [{"pickup_datetime": "2024-01-01 10:00", **HVFHV, "driver_pay": 100.0}]
    got = only(rollup.hourly_rollup(trips("fhvhv", rows), SPECS["fhvhv"]))
    assert (got["total_driver_pay"], got["total_amount_payed"]) == (100.0, 7.0)


def test_spring_forward_hour_stays(trips, spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = [{"pickup_datetime": "2024-03-10 02:30"}]
        got = only(rollup.hourly_rollup(trips("fhv", rows), SPECS["fhv"]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got["pickup_hour"] == datetime(2024, 3, 10, 2)


def test_trips_without_pickup_are_one_null_hour(trips):
    df = trips("fhv", [{}, {}, {"pickup_datetime": "2024-01-01 10:00"}])
    got = {r.pickup_hour: r.num_trips for r in rollup.hourly_rollup(df, SPECS["fhv"]).collect()}
    assert got == {None: 2, datetime(2024, 1, 1, 10): 1}
    rollup.assert_unique_hours(rollup.hourly_rollup(df, SPECS["fhv"]))


def test_decimal_amounts_sum_exactly(trips):
    rows = [{"pickup_datetime": "2024-01-01 10:00", **YELLOW, "fare_amount": 0.1}] * 3
    df = trips("yellow", rows)
    df = df.withColumn("fare_amount", df.fare_amount.cast("decimal(18,2)"))
    got = only(rollup.hourly_rollup(df, SPECS["yellow"]))
    assert got["total_base_fare_amount"] == 0.3


def test_range_on_the_raw_column_equals_range_on_the_hour(trips):
    times = ["2024-01-31 23:59:59.999999", "2024-02-01", "2024-02-02 23:59:59", "2024-02-03"]
    df = trips("fhv", [{"pickup_datetime": t} for t in times])
    cut = rollup.hourly_rollup(df, SPECS["fhv"], "2024-02-01", "2024-02-03")
    whole = rollup.hourly_rollup(df, SPECS["fhv"]).filter(
        "pickup_hour >= '2024-02-01' AND pickup_hour < '2024-02-03'"
    )
    assert sorted(cut.collect()) == sorted(whole.collect()) and cut.count() == 2
    with pytest.raises(ValueError, match="whole hour"):
        rollup.hourly_rollup(df, SPECS["fhv"], "2024-02-01 00:30")


def test_key_check_finds_duplicates(trips):
    one = rollup.hourly_rollup(
        trips("fhv", [{"pickup_datetime": "2024-01-01 10:00"}]), SPECS["fhv"]
    )
    rollup.assert_unique_hours(one)
    assert [r.ok for r in rollup.key_check(one).collect()] == [True]
    twice = one.union(one)
    with pytest.raises(ValueError, match="more than once"):
        rollup.assert_unique_hours(twice)
    assert [(r.hours, r.distinct_hours, r.ok) for r in rollup.key_check(twice).collect()] == [
        (2, 1, False)
    ]


def test_union_fills_absent_columns(trips):
    df = rollup.all_services_hourly(
        {s: trips(s, [{"pickup_datetime": "2024-01-01 10:00"}]) for s in SPECS}
    )
    assert df.count() == 4 and "total_extra" in df.columns
    assert df.filter("service = 'fhv'").first().total_amount_payed is None


def test_aggregation_is_partial_before_one_shuffle(trips):
    df = trips("yellow", [{"pickup_datetime": "2024-01-01 10:00", **YELLOW}])
    plan = plan_of(rollup.hourly_rollup(df, SPECS["yellow"]))
    assert plan.count("Exchange") == 1 and "partial_sum" in plan and "Python" not in plan


trip = st.fixed_dictionaries(
    {
        "pickup_datetime": st.sampled_from([f"2024-01-0{d} 0{h}:15" for d in (1, 2) for h in (1, 2)]),
        "trip_time": st.none() | st.integers(0, 5000),
        "trip_miles": st.none() | st.floats(0, 50),
        "month": st.sampled_from(["2024-01", "2024-02", "2024-03"]),
        **{c: st.none() | st.integers(-50, 500).map(float) for c in HVFHV},
    }
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(trip, min_size=1, max_size=25))
def test_parts_merge_to_the_direct_rollup(trips, rows):
    spec = SPECS["fhvhv"]
    df = trips("fhvhv", rows)
    months = [trips("fhvhv", [r for r in rows if r["month"] == m]) for m in {r["month"] for r in rows}]
    parts = None
    for month in months:
        part = rollup.hourly_parts(month, spec)
        parts = part if parts is None else parts.union(part)
    direct = {r.pickup_hour: list(r[2:]) for r in rollup.hourly_rollup(df, spec).collect()}
    merged = {r.pickup_hour: list(r[2:]) for r in rollup.merge_parts(parts, spec).collect()}
    assert direct.keys() == merged.keys()
    for hour, row in direct.items():
        assert merged[hour] == pytest.approx(row)


def test_watermark_from_parts_equals_watermark(trips):
    df = trips("fhv", [{"pickup_datetime": t} for t in ("2024-01-01 10:20", "2024-01-02 01:05")])
    df = df.selectExpr("*", "'fhv' AS service")
    expected = [("fhv", datetime(2024, 1, 2, 1, 5))]
    assert [tuple(r) for r in rollup.watermark(df).collect()] == expected
    parts = rollup.hourly_parts(df.drop("service"), SPECS["fhv"])
    assert [tuple(r) for r in rollup.watermark_from_parts(parts).collect()] == expected
