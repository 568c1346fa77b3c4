from datetime import datetime

import pytest
from kerbside.operators import slices
from kerbside.sources import discovery

AS_OF = "2024-03-15 10:00:00"
MARCH_15 = datetime(2024, 3, 15, 10)


def day(month: int, number: int) -> datetime:
    return datetime(2024, month, number)


@pytest.fixture
def plan(spark):
    def build(watermark, mode, as_of=AS_OF, year=None):
        schema = "service string, watermark timestamp_ntz"
        starts = spark.createDataFrame([("fhv", watermark)], schema)
        rows = slices.slice_plan(starts, as_of, year, mode).orderBy("file_month").collect()
        return [(r.file_name[-15:-8], r.start_time, r.end_time) for r in rows]

    return build


@pytest.mark.parametrize(
    ("watermark", "append", "replace"),
    [
        (None, [("2024-01", None, None), ("2024-02", None, None), ("2024-03", day(1, 1), MARCH_15)],
         [("2024-01", None, None), ("2024-02", None, None), ("2024-03", None, MARCH_15)]),
        (day(3, 10), [("2024-03", day(3, 10), MARCH_15)], [("2024-03", None, MARCH_15)]),
        (day(2, 20), [("2024-02", None, None), ("2024-03", day(2, 20), MARCH_15)],
         [("2024-02", None, None), ("2024-03", None, MARCH_15)]),
        (day(12, 20), [("2024-03", MARCH_15, MARCH_15)], [("2024-03", None, MARCH_15)]),
    ],
)
def test_plan(plan, watermark, append, replace):
    assert plan(watermark, "append") == append
    assert plan(watermark, "replace") == replace


def test_plan_names_and_year(spark):
    starts = spark.createDataFrame([("fhv", None)], "service string, watermark timestamp_ntz")
    rows = slices.slice_plan(starts, "2026-01-05 08:00:00", year=2024).collect()
    assert [tuple(r) for r in rows] == [
        ("fhv", "2024-01", "fhv_tripdata_2024-01.parquet", "fhv_tripdata",
         day(1, 1), datetime(2024, 1, 5, 8)),
    ]
    with pytest.raises(ValueError, match="mode"):
        slices.slice_plan(starts, AS_OF, mode="upsert")


def test_plan_crosses_a_year(plan):
    got = plan(datetime(2023, 11, 30), "replace", "2024-01-02")
    assert [g[0] for g in got] == ["2023-11", "2023-12", "2024-01"]


def test_bounds_are_exclusive(trips):
    df = trips("fhv", [{"pickup_datetime": t} for t in ("2024-01-01", "2024-01-02", "2024-01-03")])
    got = slices.between(df, "2024-01-01", "2024-01-03").collect()
    assert [r.pickup_datetime for r in got] == [day(1, 2)]
    assert slices.between(df, None, None).count() == 3


def test_filter_and_count_of_many_slices(trips, spark):
    df = trips("fhv", [{"pickup_datetime": t} for t in ("2024-01-01", "2024-01-02", "2024-01-03")])
    df = df.selectExpr("*", "explode(array('fhv', 'green', 'yellow', 'fhvhv')) AS service")
    chosen = [("fhv", day(1, 1), day(1, 3)), ("green", None, None), ("yellow", day(1, 3), day(1, 9))]
    kept = slices.slice_filter(df, chosen)
    assert kept.columns == df.columns and kept.count() == 4
    counts = {r.service: (r.num_rows, r.skipped) for r in slices.slice_count(df, chosen).collect()}
    assert counts == {"fhv": (1, False), "green": (3, False), "yellow": (0, True)}


def test_start_times_keep_tables_without_files(spark):
    found = spark.createDataFrame([("fhv",), ("green",)], "service string")
    marks = spark.createDataFrame(
        [("fhv", day(1, 1)), ("yellow", day(2, 1))], "service string, watermark timestamp_ntz"
    )
    got = {r.service: r.watermark for r in slices.table_start_times(found, marks).collect()}
    assert got == {"fhv": day(1, 1), "green": None, "yellow": day(2, 1)}
    new = discovery.new_tables(found, marks.select("service")).collect()
    assert [r.service for r in new] == ["green"]


def test_only_trip_files_of_known_services(spark):
    names = ["green_tripdata_2024-01.parquet", ".DS_Store", "x_2023-01.parquet",
             "blue_tripdata_2024-01.parquet", "green_tripdata_2024-02.parquet"]
    files = discovery.trip_files(spark.createDataFrame([(n,) for n in names], ["f"]), "f")
    assert files.count() == 2
    assert [tuple(r) for r in discovery.discover_tables(files).collect()] == [
        ("green", "green_tripdata")
    ]
