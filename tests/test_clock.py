from datetime import date, datetime

import pytest
from kerbside.functions import clock, names


def evaluate(spark, expression: str):
    return spark.sql(f"SELECT {expression} AS x").first().x


@pytest.mark.parametrize(
    ("time", "hour"),
    [
        ("2024-03-10 02:30:00", "2024-03-10 02:00:00"),
        ("2024-03-10 02:00:00", "2024-03-10 02:00:00"),
        ("2024-12-31 23:59:59.999999", "2024-12-31 23:00:00"),
        ("1969-12-31 22:59:59.75", "1969-12-31 22:00:00"),
        ("1969-12-31 23:00:00", "1969-12-31 23:00:00"),
        ("1969-12-31 23:59:59.999999", "1969-12-31 23:00:00"),
        ("1970-01-01 00:00:00", "1970-01-01 00:00:00"),
        ("1901-06-01 12:00:00.000001", "1901-06-01 12:00:00"),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_hour_ignores_the_session_zone(spark, time, hour, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        start = clock.hour_start(clock.hour_number(f"TIMESTAMP_NTZ '{time}'"))
        assert evaluate(spark, start) == datetime.fromisoformat(hour)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_null_time_has_no_hour(spark):
    assert evaluate(spark, clock.hour_number("CAST(NULL AS TIMESTAMP_NTZ)")) is None


def test_seconds_keep_fractions_and_sign(spark):
    a, b = "TIMESTAMP_NTZ '2024-01-01 00:00:00'", "TIMESTAMP_NTZ '2024-01-01 00:01:30.6'"
    assert evaluate(spark, clock.seconds_between(a, b)) == 90.6
    assert evaluate(spark, clock.seconds_between(b, a)) == -90.6
    assert evaluate(spark, clock.seconds_between(a, "CAST(NULL AS TIMESTAMP_NTZ)")) is None


@pytest.mark.parametrize(
    ("day", "number"), [("2024-03-03", 0), ("2024-03-04", 1), ("2024-03-09", 6)]
)
def test_week_starts_on_sunday(spark, day, number):
    part = clock.calendar_part("day_of_week", f"TIMESTAMP_NTZ '{day} 05:00:00'")
    assert spark.sql(f"SELECT {part}").first().day_of_week == number


def test_moments():
    assert clock.as_datetime("2024-02-01") == datetime(2024, 2, 1)
    assert clock.as_datetime(date(2024, 2, 1)) == datetime(2024, 2, 1)
    with pytest.raises(ValueError, match="zoned"):
        clock.as_datetime("2024-02-01T00:00:00+01:00")


def test_clock_moves_into_another_year():
    assert clock.clock_in_year("2026-03-15 10:00:01.5") == datetime(2024, 3, 15, 10, 0, 1, 500000)
    with pytest.raises(ValueError, match="day"):
        clock.clock_in_year("2024-02-29", 2023)


@pytest.mark.parametrize(
    ("path", "table", "month"),
    [
        ("green_tripdata_2024-01.parquet", "green_tripdata", "2024-01"),
        ("s3://b/x/fhv_tripdata_2023-11.parquet", "fhv_tripdata", "2023-11"),
        ("/d/file=yellow_tripdata_2024-06.parquet/part-0.parquet", "yellow_tripdata", "2024-06"),
        (".DS_Store", "", "-"),
        ("x_2023-01.parquet", "", "-"),
        ("/d/green_tripdata_2024-1.parquet", "", "-"),
    ],
)
def test_names_of_trip_files(spark, path, table, month):
    row = spark.createDataFrame([(path,)], ["p"]).select(
        names.table_of("p").alias("t"), names.file_month_of("p").alias("m")
    )
    assert tuple(row.first()) == (table, month)


def test_labels_resolve_and_others_are_refused():
    assert names.resolve("By month", names.CALENDAR_UNITS) == "month"
    assert names.resolve("num_trips", names.SUMMED_METRICS) == "num_trips"
    with pytest.raises(ValueError, match="unknown name"):
        names.resolve("num_trips; DROP", names.SUMMED_METRICS)


def test_expense_label_drops_every_total(spark):
    df = spark.createDataFrame([("total_sub_total_tax",), ("total_tips",)], ["e"])
    got = [r.x for r in df.select(names.expense_label(df.e).alias("x")).collect()]
    assert got == ["sub_tax", "tips"]
