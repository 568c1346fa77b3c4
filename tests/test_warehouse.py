"""Versions of the stores, restated files, late files in the hourly stream, streams beside batches, names."""

from datetime import datetime
from pathlib import Path

import pytest
from kerbside.operators import rollup
from kerbside.plans import tables
from kerbside.plans.cycle import run_cycle
from kerbside.plans.ingest import load_slices, plan_slices
from kerbside.plans.refresh import load_rollup
from kerbside.plans.warehouse import Warehouse
from kerbside.sources import store
from kerbside.sources.trips import load_trips
from kerbside.spec import SPECS
from kerbside.streaming.hourly import corrections, latest_hours, stream_hourly
from kerbside.streaming.ingest import compact, stream_ingest
from test_ingest import FHV, hours, land, same_as_recomputed, stored  # noqa: F401


def all_rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_month_that_is_rewritten_is_loaded_again_and_only_that(spark, land):
    for month in ("2024-01", "2024-02", "2024-03"):
        land(month, [f"{month}-05 10:00"])
    run_cycle(spark, land.folder, land.store, "2024-03-20")
    land("2024-01", ["2024-01-05 10:00", "2024-01-06 11:00", "2024-01-07 12:00"])
    report = run_cycle(spark, land.folder, land.store, "2024-03-20")
    assert report.restated == [("fhv", "2024-01")]
    # March is the watermark's month, which is always loaded again.
    assert sorted(report.loaded) == [("fhv", "2024-01"), ("fhv", "2024-03")]
    assert sum(hours(report.rollup).values()) == 5 and same_as_recomputed(spark, land, report.rollup)
    report = run_cycle(spark, land.folder, land.store, "2024-03-20")
    assert report.restated == [] and sorted(report.loaded) == [("fhv", "2024-03")]


def test_a_part_file_that_is_added_or_goes_restates_its_month(spark, land):
    land("2024-01", ["2024-01-05 10:00"])
    land("2024-02", ["2024-02-05 10:00"])
    run_cycle(spark, land.folder, land.store, "2024-03-01")
    path = land("2024-01", ["2024-01-06 10:00"], mode="append")
    report = run_cycle(spark, land.folder, land.store, "2024-03-01")
    assert report.restated == [("fhv", "2024-01")] and len(stored(spark, land.store)) == 3
    sorted(Path(path).glob("*.parquet"))[0].unlink()
    report = run_cycle(spark, land.folder, land.store, "2024-03-01")
    assert report.restated == [("fhv", "2024-01")] and len(stored(spark, land.store)) == 2


def test_an_empty_month_is_planned_again_when_its_file_changes(spark, land):
    land("2024-01", ["2024-03-05 10:00"])
    land("2024-02", ["2024-02-05 10:00"])
    path = land("2024-01", ["2024-01-05 10:00"])
    spark.read.parquet(path).filter("false").write.mode("overwrite").parquet(path + ".new")
    spark.read.parquet(path + ".new").write.mode("overwrite").parquet(path)
    assert run_cycle(spark, land.folder, land.store, "2024-03-01").empty == [("fhv", "2024-01")]
    assert ("fhv", "2024-01") not in run_cycle(spark, land.folder, land.store, "2024-03-01").loaded
    land("2024-01", ["2024-01-05 10:00"])
    report = run_cycle(spark, land.folder, land.store, "2024-03-01")
    assert report.loaded[("fhv", "2024-01")] == 1 and len(stored(spark, land.store)) == 2


def test_frames_answer_as_when_they_were_read(spark, land):
    land("2024-01", ["2024-01-05 10:00"])
    land("2024-02", ["2024-02-05 10:00"])
    first = run_cycle(spark, land.folder, land.store, "2024-03-01")
    trips = load_trips(spark, land.store.trips, FHV)
    before = all_rows(first.rollup), all_rows(trips)
    land("2024-01", ["2024-01-07 10:00", "2024-01-08 10:00"])
    second = run_cycle(spark, land.folder, land.store, "2024-03-01")
    assert (all_rows(first.rollup), all_rows(trips)) == before
    assert sum(hours(second.rollup).values()) == 3


def test_a_reader_sees_all_of_a_load_or_nothing(spark, land, monkeypatch):
    land("2024-01", ["2024-01-05 10:00"])
    run_cycle(spark, land.folder, land.store, "2024-02-01")
    land("2024-01", ["2024-01-05 10:00", "2024-01-06 10:00"])
    land("2024-02", ["2024-02-05 10:00"])
    planned = plan_slices(spark, land.folder, land.store.trips, "2024-03-01").slices
    seen = []
    publish = store.publish

    def look(*args):
        seen.append(len(stored(spark, land.store)))  # everything is written, nothing published
        return publish(*args)

    monkeypatch.setattr(store, "publish", look)
    load_slices(spark, planned, land.store.trips)
    assert seen == [1] and len(stored(spark, land.store)) == 3


def test_old_versions_go_and_live_files_stay(spark, land):
    small = Warehouse(land.store.root, retained=2)
    for day in range(1, 6):
        land("2024-01", [f"2024-01-{d:02d} 10:00" for d in range(1, day + 1)])
        report = run_cycle(spark, land.folder, small, "2024-02-01")
    assert sum(hours(report.rollup).values()) == 5 and len(stored(spark, small)) == 5
    loads = list(Path(f"{small.trips}/service=fhv").glob("load=*/file_month=2024-01"))
    assert len(loads) == 2 and len(store.versions(spark, small.trips)) == 2


def test_two_writers_lose_nothing(spark, tmp_path):
    root = f"{tmp_path}/store"
    a, b = store.claim(spark, root), store.claim(spark, root)
    assert a != b
    store.publish(spark, root, lambda p: False, [store.Piece("fhv", "2024-01", a, 1)])
    # The second writer finds the version of the first when it publishes its own.
    store.publish(spark, root, lambda p: False, [store.Piece("fhv", "2024-02", b, 1)])
    assert {p.load for p in store.pieces(spark, root)} == {a, b}
    (Path(root) / "_log" / "0000000003.json").write_text('{"half of a line')
    assert store.current(spark, root)[0] == 2
    store.publish(spark, root, lambda p: p.load == a, [])
    assert store.current(spark, root)[0] == 4 and [p.load for p in store.pieces(spark, root)] == [b]


def test_a_first_load_counts_all_months_in_one_job(spark, land):
    for month in range(1, 9):
        land(f"2023-{month:02d}", [f"2023-{month:02d}-05 10:00"])
    planned = plan_slices(spark, land.folder, land.store.trips, "2024-01-01").slices

    def jobs(slices, place):
        group = f"load-{place}"
        sc = spark.sparkContext
        sc.setJobGroup(group, group)
        try:
            load_slices(spark, slices, f"{land.store.root}/{place}")
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        return len(sc.statusTracker().getJobIdsForGroup(group))

    assert jobs(planned, "eight") <= jobs(planned[:2], "two") + 1


# The hourly stream


def hourly(spark, land, tmp_path):
    return stream_hourly(spark, land.folder, FHV, f"{tmp_path}/out", land.checkpoint)


def told(spark, tmp_path):
    return {r.pickup_hour: r.num_trips for r in latest_hours(spark, f"{tmp_path}/out").collect()}


def test_a_late_file_is_told(spark, land, tmp_path):
    land("2024-01", ["2024-01-05 10:00"])
    land("2024-03", ["2024-03-05 10:00"])
    assert hourly(spark, land, tmp_path) == 0
    assert told(spark, tmp_path) == {datetime(2024, 1, 5, 10): 1}
    land("2024-02", ["2024-02-05 10:00", "2024-02-06 11:00"])
    land("2024-04", ["2024-04-05 10:00"])
    assert hourly(spark, land, tmp_path) == 0
    assert told(spark, tmp_path) == {
        datetime(2024, 1, 5, 10): 1, datetime(2024, 2, 5, 10): 1, datetime(2024, 2, 6, 11): 1,
        datetime(2024, 3, 5, 10): 1,
    }
    assert corrections(spark, f"{tmp_path}/out").count() == 0


def test_a_late_part_of_a_month_corrects_its_hours(spark, land, tmp_path):
    land("2024-01", ["2024-01-05 10:00", "2024-01-06 10:00", "2024-01-20 10:00"])
    hourly(spark, land, tmp_path)
    land("2024-01", ["2024-01-05 10:30", "2024-01-07 10:00"], mode="append")
    hourly(spark, land, tmp_path)
    assert told(spark, tmp_path) == {
        datetime(2024, 1, 5, 10): 2, datetime(2024, 1, 6, 10): 1, datetime(2024, 1, 7, 10): 1,
    }
    fixed = corrections(spark, f"{tmp_path}/out").collect()
    assert [(r.pickup_hour, r.num_corrections) for r in fixed] == [(datetime(2024, 1, 5, 10), 1)]
    # What was told first is still there, under its revision.
    first = spark.read.parquet(f"{tmp_path}/out").filter("revision = 0").collect()
    assert {r.pickup_hour: r.num_trips for r in first} == {datetime(2024, 1, 5, 10): 1, datetime(2024, 1, 6, 10): 1}


def test_one_file_at_a_time_tells_the_same(spark, land, tmp_path):
    for month in ("2024-03", "2024-01", "2024-02"):
        land(month, [f"{month}-05 10:00", f"{month}-05 10:20", f"{month}-28 23:50"])
    for n in (1, 100):
        stream_hourly(spark, land.folder, FHV, f"{tmp_path}/{n}", f"{land.checkpoint}-{n}", files_per_batch=n)
    one, many = (
        {(r.pickup_hour, r.num_trips, r.avg_trip_time_min) for r in latest_hours(spark, f"{tmp_path}/{n}").collect()}
        for n in (1, 100)
    )
    assert one == many and len(one) == 5


def test_a_batch_that_is_run_again_tells_the_same(spark, land, tmp_path):
    land("2024-01", ["2024-01-05 10:00", "2024-01-20 10:00"])
    hourly(spark, land, tmp_path)
    land("2024-02", ["2024-02-05 10:00"])
    hourly(spark, land, tmp_path)
    before = told(spark, tmp_path)
    for commit in Path(land.checkpoint).glob("commits/*1*"):  # as if the run had ended before it
        commit.unlink()
    hourly(spark, land, tmp_path)
    assert told(spark, tmp_path) == before and corrections(spark, f"{tmp_path}/out").count() == 0


# Streams and batches in one warehouse


def test_streams_and_batches_load_every_trip_once(spark, land):
    land("2024-01", ["2024-01-05 10:00"])
    land("2024-02", ["2024-02-05 10:00", "2024-02-25 10:00"])
    run_cycle(spark, land.folder, land.store, "2024-02-10")  # February up to the tenth
    stream_ingest(spark, land.folder, land.store, land.checkpoint)
    assert len(stored(spark, land.store)) == 3
    land("2024-03", ["2024-03-05 10:00"])
    stream_ingest(spark, land.folder, land.store, land.checkpoint)
    report = run_cycle(spark, land.folder, land.store, "2024-04-10")
    # March is the watermark's month; the rest of what the stream loaded is not loaded again.
    assert sorted(report.loaded) == [("fhv", "2024-03")] and ("fhv", "2024-02") in report.taken_up
    assert len(stored(spark, land.store)) == 4 and same_as_recomputed(spark, land, report.rollup)
    stream_ingest(spark, land.folder, land.store, f"{land.checkpoint}-other")  # it sees all files anew
    assert len(stored(spark, land.store)) == 4


def test_a_stream_that_failed_before_its_parts_is_made_up_for(spark, land, monkeypatch):
    from kerbside.streaming import ingest

    land("2024-01", ["2024-01-05 10:00"])
    land("2024-02", ["2024-02-05 10:00"])
    with monkeypatch.context() as m, pytest.raises(Exception, match="lost"):
        m.setattr(ingest, "refresh_parts", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        stream_ingest(spark, land.folder, land.store, land.checkpoint)
    stream_ingest(spark, land.folder, land.store, land.checkpoint)
    assert len(stored(spark, land.store)) == 2
    report = run_cycle(spark, land.folder, land.store, "2024-03-01")
    assert same_as_recomputed(spark, land, report.rollup) and sum(hours(report.rollup).values()) == 2


def test_compaction_merges_pieces_and_changes_nothing(spark, land):
    for day in (5, 6, 7):
        land("2024-01", [f"2024-01-{day:02d} 10:00"], mode="append" if day > 5 else "overwrite")
        stream_ingest(spark, land.folder, land.store, land.checkpoint)
    held = load_trips(spark, land.store.trips, FHV)
    before = stored(spark, land.store)
    assert len(store.pieces(spark, land.store.trips)) == 3
    assert compact(spark, land.store) == [("fhv", "2024-01")] and compact(spark, land.store) == []
    assert stored(spark, land.store) == before and held.count() == 3
    assert len(store.pieces(spark, land.store.trips)) == len(store.pieces(spark, land.store.parts)) == 1
    report = run_cycle(spark, land.folder, land.store, "2024-02-10")
    assert report.restated == [] and same_as_recomputed(spark, land, report.rollup)
    loads = spark.read.parquet(store.piece_dir(land.store.trips, store.pieces(spark, land.store.trips)[0]))
    assert "base" in loads.columns


# Names


def test_names_follow_the_versions(spark, land):
    land("2024-01", ["2024-01-05 10:00"])
    db = "names_test"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    assert tables.existing_tables(spark, db) == []
    run_cycle(spark, land.folder, land.store, "2024-02-01", database=db)
    assert tables.existing_tables(spark, db) == tables.existing_rollups(spark, db) == ["fhv"]
    assert spark.sql(f"SELECT count(*) FROM {db}.fhv_tripdata").first()[0] == 1
    land("2024-01", ["2024-01-05 10:00", "2024-01-06 10:00"])
    land("2024-02", ["2024-02-05 10:00"])
    run_cycle(spark, land.folder, land.store, "2024-03-01", database=db)
    by_month = spark.sql(f"SELECT file_month, count(*) FROM {db}.fhv_tripdata GROUP BY 1 ORDER BY 1").collect()
    assert [tuple(r) for r in by_month] == [("2024-01", 2), ("2024-02", 1)]
    assert spark.sql(f"SELECT sum(num_trips) FROM {db}.fhv_hourly").first()[0] == 3
    assert all_rows(spark.table(f"{db}.hourly")) == all_rows(load_rollup(spark, land.store.rollup))
    # One partition per live piece; the view's condition prunes them.
    assert spark.sql(f"SHOW PARTITIONS {db}.fhv_loads").count() == 2
    land("2024-01", ["2024-01-05 10:00"])
    empty = spark.read.parquet(f"{land.folder}/fhv_tripdata_2024-02.parquet").filter("false")
    empty.write.parquet(f"{land.folder}/x")
    for month in ("2024-01", "2024-02"):
        spark.read.parquet(f"{land.folder}/x").write.mode("overwrite").parquet(
            f"{land.folder}/fhv_tripdata_{month}.parquet"
        )
    run_cycle(spark, land.folder, land.store, "2024-03-01", database=db)
    assert tables.existing_tables(spark, db) == tables.existing_rollups(spark, db) == []
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_trends_in_one_pass(spark, hourly):
    from kerbside.operators import serving

    rows = [
        {"service": s, "pickup_hour": f"2024-02-{d:02d} {h:02d}:00", "num_trips": d + h, "total_amount_payed": 1.5 * d}
        for s in SPECS for d in (1, 4, 11) for h in (0, 7)
    ]
    df = rollup.union_services([hourly(rows, "num_trips long, total_amount_payed double")])
    got = serving.trends(df, "2024-02-01", "2024-03-01").collect()
    for unit in ("hour_of_day", "day_of_week", "day_of_month", "month"):
        for metric in ("num_trips", "total_amount_payed"):
            one = serving.trend(df, metric, unit, "2024-02-01", "2024-03-01").collect()
            many = [(r.service, r.position, r[metric]) for r in got if r.calendar_unit == unit]
            assert [tuple(r) for r in one] == [x for x in many if x[2] is not None]
