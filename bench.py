"""Headline timings as one JSON line.

Reads ``$BENCH_SF_DIR`` (default sf 0.1) on ``local[$BENCH_CPUS]``. Each figure is the median of
three runs after one warm-up; a run builds the query, plans it and evaluates every output row.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from kerbside.operators import serving
from kerbside.plans import catalogue
from kerbside.plans.cycle import Warehouse, run_cycle
from kerbside.plans.ingest import load_slices, plan_slices
from kerbside.plans.refresh import load_rollup
from kerbside.session import local_session, scratch_dir
from kerbside.sources import driver_tables
from kerbside.sources.discovery import list_landing
from kerbside.sources.trips import scan_files
from kerbside.spec import SERVICES, SPECS
from pyspark.sql import functions as F

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
WARM_UP = 4
RANGE = (catalogue.START, catalogue.END)
FROM_RAW = [
    "all_services_hourly",
    *(f"hourly_{s}" for s in SERVICES),
    "hourly_from_parts",
    "watermark",
    "slice_count",
    "card_num_trips",
    "trend_payed_hour_of_day",
    "contrib_yellow",
    "trends_all",
    "hist_trip_time",
    "counter_rate_5m",
    "cpu_percent",
]


def median_seconds(run: Callable[[], object], runs: int = 3) -> float:
    times = []
    for _ in range(runs + 1):
        began = time.perf_counter()
        run()
        times.append(time.perf_counter() - began)
    return round(statistics.median(times[1:]), 4)


def write_many_months(spark, folder: str) -> None:
    """The yellow trips dealt over sixty months; in the first thirty fares are whole numbers."""
    trips = driver_tables.raw_trips(driver_tables.trips(spark, SF_DIR), "yellow")
    month = F.expr("pmod(xxhash64(tpep_pickup_datetime), 60)")
    label = "concat(lpad(2019 + n div 12, 4, '0'), '-', lpad(n % 12 + 1, 2, '0'))"
    dealt = trips.withColumn("n", month).withColumn(
        "file", F.expr(f"concat('yellow_tripdata_', {label}, '.parquet')")
    )
    old = dealt.filter("n < 30").withColumn("fare_amount", F.col("fare_amount").cast("long"))
    for part in (old, dealt.filter("n >= 30")):
        part.drop("n").write.partitionBy("file").mode("append").parquet(folder)


def main() -> None:
    spark = local_session("bench", cores=CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    def evaluate(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    found = catalogue.queries()
    # The first queries compile what all share; without these rounds the first entry would pay for it.
    for _ in range(WARM_UP):
        evaluate(found["all_services_hourly"](spark, SF_DIR))
    for name in FROM_RAW:
        timings[name] = median_seconds(lambda name=name: evaluate(found[name](spark, SF_DIR)))

    # From files: one month of all services loaded again, then the whole cycle, then the stored
    # rollup is served.
    root = scratch_dir(spark, "bench")
    landing, store = f"{root}/landing", Warehouse(f"{root}/warehouse")
    driver_tables.write_landing(spark, SF_DIR, landing, SERVICES)
    firsts = iter(range(100))
    timings["cycle_first_load"] = median_seconds(
        lambda: run_cycle(spark, landing, Warehouse(f"{root}/first-{next(firsts)}"), "2024-07-02")
    )
    run_cycle(spark, landing, store, "2024-07-02")
    planned = plan_slices(spark, landing, store.trips, "2024-06-30").slices
    timings["ingest_replace_month"] = median_seconds(
        lambda: load_slices(spark, planned, store.trips)
    )
    timings["cycle_again"] = median_seconds(
        lambda: run_cycle(spark, landing, store, "2024-06-30")
    )
    # Sixty monthly files of one service, the older ones with a column of another type.
    write_many_months(spark, f"{root}/many")
    paths = [f.path for f in list_landing(spark, f"{root}/many").files]
    timings["scan_60_months"] = median_seconds(
        lambda: evaluate(scan_files(spark, SPECS["yellow"], paths))
    )
    hourly = load_rollup(spark, store.rollup)
    stored = {
        "stored_card_total": lambda: serving.card_total_payed(hourly, *RANGE),
        "stored_trend": lambda: serving.trend(hourly, "total_amount_payed", "hour_of_day", *RANGE),
        "stored_contributions": lambda: serving.contributions(hourly, "yellow", *RANGE),
        "stored_histogram": lambda: serving.histogram(hourly, "avg_trip_time_min", *RANGE),
    }
    for name, build in stored.items():
        timings[name] = median_seconds(lambda build=build: evaluate(build()))

    rows = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
                "trips": rows,
                "trips_per_sec_rollup": round(rows / timings["all_services_hourly"]),
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
