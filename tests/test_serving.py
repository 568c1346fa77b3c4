from datetime import datetime

import pytest
from conftest import plan_of
from kerbside.operators import serving
from kerbside.sources.csv_export import export_name, export_range, export_rows
from kerbside.spec import SERVICES, SPECS

DAY = ("2024-02-01", "2024-02-02")


def values(hourly, xs, service="yellow", column="avg_trip_miles"):
    rows = [
        {"service": service, "pickup_hour": f"2024-02-01 {h % 24:02d}:00", column: x}
        for h, x in enumerate(xs)
    ]
    return hourly(rows, f"{column} double")


def test_end_of_range(hourly):
    hours = ["2024-01-31 23:00", "2024-02-01 00:00", "2024-02-01 23:00", "2024-02-02 00:00"]
    df = hourly([{"service": "fhv", "pickup_hour": h, "num_trips": 1} for h in hours], "num_trips long")
    assert serving.in_range(df, *DAY).count() == 2
    assert serving.in_range(df, *DAY, end_inclusive_midnight=True).count() == 3


def test_null_total_counts_as_zero_downstream(hourly):
    rows = [{"service": "green", "pickup_hour": "2024-02-01 05:00", "total_amount_payed": None}]
    df = hourly(rows, "total_amount_payed double")
    got = serving.trend(df, "total_amount_payed", "hour_of_day", *DAY).collect()
    assert [tuple(r) for r in got] == [("green", 5, 0.0)]
    assert serving.trend(df, "total_amount_payed", "month", *DAY, "avg").first()[2] is None
    cards = {r.service: r[1] for r in serving.card_total_payed(df, *DAY).collect()}
    assert cards == {"fhvhv": 0.0, "yellow": 0.0, "green": 0.0}


def test_cards_of_an_empty_range(hourly):
    df = hourly([{"service": "fhv", "pickup_hour": "2024-02-01", "num_trips": 7}], "num_trips long")
    cards = serving.card_num_trips(df, "2025-01-01", "2025-02-01").collect()
    assert [tuple(r) for r in cards] == [(s, 0) for s in SERVICES]
    cards = dict(tuple(r) for r in serving.card_num_trips(df, *DAY).collect())
    assert cards == {"fhvhv": 0, "fhv": 7, "yellow": 0, "green": 0}


def test_cards_round_half_to_even(hourly):
    rows = [{"service": "green", "pickup_hour": "2024-02-01", "total_amount_payed": 0.125}]
    got = serving.card_total_payed(hourly(rows, "total_amount_payed double"), *DAY)
    assert {r.service: r[1] for r in got.collect()}["green"] == 0.12


def test_trend_is_ordered_and_takes_labels(hourly):
    rows = [
        {"service": s, "pickup_hour": h, "num_trips": n}
        for s, h, n in [
            ("green", "2024-02-05 09:00", 1),
            ("green", "2024-02-03 09:00", 2),
            ("fhv", "2024-02-04 09:00", 4),
            ("fhv", "2024-02-04 10:00", 8),
            ("fhv", "2024-02-10 10:00", 16),
        ]
    ]
    df = hourly(rows, "num_trips long")
    got = serving.trend(df, "Total number of trips", "By day of week", "2024-02-01", "2024-03-01")
    assert [tuple(r) for r in got.collect()] == [
        ("fhv", 0, 12), ("fhv", 6, 16), ("green", 1, 1), ("green", 6, 2),
    ]
    assert got.columns == ["service", "day_of_week", "num_trips"]


@pytest.mark.parametrize(
    ("agg", "expected"),
    [("sum", 12), ("avg", 4.0), ("min", 1), ("max", 9), ("count", 3), ("median", 2.0)],
)
def test_trend_aggregates(hourly, agg, expected):
    rows = [
        {"service": "fhv", "pickup_hour": f"2024-02-01 0{h}:00", "num_trips": n}
        for h, n in enumerate((1, 2, 9))
    ]
    got = serving.trend(hourly(rows, "num_trips long"), "num_trips", "month", *DAY, agg).first()
    assert got.num_trips == expected


def test_unknown_names_are_refused(hourly):
    df = hourly([], "num_trips long")
    for metric, unit, agg in [
        ("tips", "month", "sum"), ("num_trips", "year", "sum"), ("num_trips", "month", "mode"),
    ]:
        with pytest.raises(ValueError, match="unknown"):
            serving.trend(df, metric, unit, *DAY, agg)


def test_unavailable_metric_is_empty_with_schema(hourly):
    df = hourly([{"service": "fhv", "pickup_hour": "2024-02-01", "num_trips": 1}], "num_trips long")
    trend = serving.trend(df, "total_amount_payed", "month", *DAY)
    assert trend.columns == ["service", "month", "total_amount_payed"] and trend.count() == 0
    hist = serving.histogram(df, "avg_trip_miles", *DAY)
    assert hist.columns == ["service", "bin", "bin_low", "bin_high", "num_hours"]
    assert hist.count() == 0


def test_contributions(hourly):
    money = SPECS["fhvhv"].money
    row = {"service": "fhvhv", "pickup_hour": "2024-02-01", **{c: i for i, c in enumerate(money)}}
    df = hourly([{k: float(v) if isinstance(v, int) else v for k, v in row.items()}],
                ", ".join(f"{c} double" for c in money))
    got = [tuple(r) for r in serving.contributions(df, "fhvhv", *DAY).collect()]
    assert got == [(c.replace("total_", ""), float(i)) for i, c in enumerate(money)]
    assert got[-1][0] == "driver_pay"
    empty = serving.contributions(df, "fhvhv", "2025-01-01", "2025-02-01").collect()
    assert {r.amount for r in empty} == {0.0} and len(empty) == 8
    with pytest.raises(ValueError, match="no amounts"):
        serving.contributions(df, "fhv", *DAY)


def test_quantile_interpolates_and_trims(hourly):
    rows = [
        {"service": "green", "pickup_hour": f"2024-02-0{1 + n // 24} {n % 24:02d}:00", "avg_trip_miles": float(n + 1)}
        for n in range(100)
    ]
    df = hourly([*rows, {"service": "green", "pickup_hour": "2024-02-01"}], "avg_trip_miles double")
    span = ("2024-02-01", "2024-03-01")
    assert serving.upper_quantile(df, "avg_trip_miles", *span).first().p99 == pytest.approx(99.01)
    kept = serving.trim_upper(df, "avg_trip_miles", *span)
    assert kept.count() == 99 and kept.agg({"avg_trip_miles": "max"}).first()[0] == 99.0
    hist = serving.histogram(df, "avg_trip_miles", *span, nbins=7).collect()
    assert sum(r.num_hours for r in hist) == 99 and [r.bin for r in hist] == list(range(7))
    assert (hist[0].bin_low, hist[-1].bin_high) == (1.0, pytest.approx(99.0))
    assert [r.num_hours for r in hist] == [14, 14, 14, 14, 14, 14, 15]


def test_histogram_lists_empty_bins(hourly):
    hist = serving.histogram(values(hourly, [0.0] * 10 + [10.0] * 10), "avg_trip_miles", *DAY, 5)
    assert [r.num_hours for r in hist.collect()] == [10, 0, 0, 0, 10]


def test_histogram_of_equal_values_has_one_bin(hourly):
    hist = serving.histogram(values(hourly, [3.5, 3.5, None]), "avg_trip_miles", *DAY).collect()
    assert [tuple(r) for r in hist] == [("yellow", 0, 3.5, 3.5, 2)]


def test_quantile_of_nothing_is_null(hourly):
    df = values(hourly, [None, None])
    assert serving.upper_quantile(df, "avg_trip_miles", *DAY).first().p99 is None
    assert serving.histogram(df, "avg_trip_miles", *DAY).count() == 0


def test_approximate_quantile_is_close(hourly):
    df = values(hourly, [float(x) for x in range(24)])
    assert serving.upper_quantile(df, "avg_trip_miles", *DAY, True).first().p99 in (22.0, 23.0)


def test_histogram_shuffles_by_service_only_and_joins_nothing(hourly):
    plan = plan_of(serving.histogram(values(hourly, [1.0, 2.0]), "avg_trip_miles", *DAY))
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_export(hourly, spark, tmp_path):
    columns = SPECS["fhv"].rollup_columns[1:]
    rows = [
        {"service": "fhv", "pickup_hour": h, "num_trips": n, "avg_trip_time_min": 1.5}
        for n, h in enumerate(["2024-01-31 23:00", "2024-02-01 00:00", "2024-02-01 05:00", "2024-02-02"])
    ]
    rows.append({"service": "green", "pickup_hour": "2024-02-01", "num_trips": 9})
    df = hourly(rows, f"{columns[0]} long, {columns[1]} double")
    path = export_range(df, "fhv", *DAY, str(tmp_path), with_index=True, single_file=True)
    assert path.endswith("/fhv_from_2024-02-01_to_2024-02-02.csv") == (
        export_name("fhv", *DAY) == "fhv_from_2024-02-01_to_2024-02-02.csv"
    )
    files = list((tmp_path / export_name("fhv", *DAY)).glob("*.csv"))
    assert len(files) == 1
    assert files[0].read_text().splitlines() == [
        "row_index,hour_of_day,day_of_week,day_of_month,month,pickup_hour,num_trips,avg_trip_time_min",
        "1,0,4,1,2,2024-02-01T00:00:00.000,1,1.5",
        "2,5,4,1,2,2024-02-01T05:00:00.000,2,1.5",
    ]
    assert "row_index" not in export_rows(df, "fhv", *DAY).columns


def test_calendar_view_puts_parts_first(hourly):
    df = hourly([{"service": "fhv", "pickup_hour": "2024-03-02 17:00", "num_trips": 1}], "num_trips long")
    got = serving.calendar_view(df)
    assert tuple(got.first()) == (17, 6, 2, 3, "fhv", datetime(2024, 3, 2, 17), 1)
