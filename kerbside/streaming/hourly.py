"""Continuous hourly rollup that waits for late trips, and corrects itself for those that come later.

Each batch of new files is reduced to partial rollups by file month and hour, which are all the state
there is: a row per hour and file. An hour comes out once the latest pick-up is ``delay`` past its end.
When a late file reaches an hour that has come out, the hour comes out again, as a row of a higher
``revision``. So the wait decides when an hour is first told, and nothing is ever dropped for coming
after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions import clock
from kerbside.operators.rollup import hourly_parts, merge_parts, parts_schema
from kerbside.session import job_session
from kerbside.sources import paths
from kerbside.sources.trips import scan_files
from kerbside.spec import ServiceSpec
from kerbside.streaming.ingest import FILES_PER_BATCH, stream_files


def near_its_month(slack: str = "1 day") -> str:
    """SQL for trips whose pick-up lies in the file's month, give or take ``slack``."""
    start = "CAST(concat(file_month, '-01') AS TIMESTAMP_NTZ)"
    return (
        f"coalesce(pickup_datetime >= {start} - INTERVAL '{slack}' AND"
        f" pickup_datetime < {start} + INTERVAL '1' MONTH + INTERVAL '{slack}', false)"
    )


def told_hours(parts: DataFrame, spec: ServiceSpec, revision: int, delay: str = "1 hour") -> DataFrame:
    """What batch ``revision`` has to tell: hours that close with it, and closed ones it changes.

    ``parts`` has the partial rollups of all batches up to this one. The event time before and after
    the batch comes from the parts, so a batch that is run again tells the same.
    """
    latest = parts.agg(
        F.expr(f"max(max_pickup) FILTER (WHERE revision < {revision}) - INTERVAL '{delay}'").alias("before"),
        F.expr(f"max(max_pickup) - INTERVAL '{delay}'").alias("now"),
    )
    changed = parts.groupBy("hour_number").agg(F.max(F.col("revision") == revision).alias("changed"))
    hours = changed.selectExpr(f"{clock.hour_start('hour_number')} AS hour", "changed")
    end = "pickup_hour + INTERVAL '1' HOUR"
    # One row with two times, and at most a row per hour there is.
    return (
        merge_parts(parts, spec)
        .join(hours, F.col("pickup_hour") == F.col("hour"))
        .join(F.broadcast(latest))
        .filter(f"{end} <= now AND (changed OR before IS NULL OR {end} > before)")
        .drop("hour", "changed", "before", "now")
    )


def stream_hourly(
    spark: SparkSession,
    landing: str,
    spec: ServiceSpec,
    output: str,
    checkpoint: str,
    delay: str = "1 hour",
    slack: str = "1 day",
    files_per_batch: int = FILES_PER_BATCH,
) -> int:
    """Process the files that are there, write what they have to tell to ``output`` and stop.

    ``output`` has a folder per revision, which is the batch's number; :func:`latest_hours` reads it. A
    batch that is run again replaces its folder. Partial rollups are kept in ``output`` + ``_parts``.

    Pick-ups farther than ``slack`` from their file's month, or without a time, would move the event
    time and so end the wait of all other hours. They go to ``output`` + ``_stray`` instead, whole;
    the number of them so far is returned.
    """
    job = job_session(spark)
    base = output.rstrip("/")
    stray, state = f"{base}_stray", f"{base}_parts"
    state_schema = parts_schema().add("file_month", "string").add("service", "string").add("revision", "long")

    def write(batch: DataFrame, revision: int) -> None:
        files = [r.path for r in batch.collect()]  # files_per_batch at most
        if not files:
            return
        session = batch.sparkSession

        def put(df: DataFrame, folder: str) -> None:
            df.write.mode("overwrite").parquet(f"{folder}/revision={revision}")

        trips = scan_files(session, spec, files)
        put(trips.filter(f"NOT {near_its_month(slack)}"), stray)
        put(hourly_parts(trips.filter(near_its_month(slack)), spec, "file_month"), state)
        parts = session.read.schema(state_schema).parquet(state).filter(F.col("revision") <= revision)
        put(told_hours(parts, spec, revision, delay).coalesce(1), base)  # hours of the files' months

    query = (
        stream_files(job, landing, files_per_batch)
        .filter(F.col("service") == spec.name)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .queryName(f"hourly-{spec.name}")
        .start()
    )
    query.awaitTermination()
    return job.read.parquet(stray).count() if paths.exists(job, stray) else 0


def latest_hours(spark: SparkSession, output: str) -> DataFrame:
    """Each hour as last told, with ``revision``."""
    told = spark.read.parquet(output)
    return told.groupBy("pickup_hour").agg(F.max_by(F.struct("*"), "revision").alias("r")).select("r.*")


def corrections(spark: SparkSession, output: str) -> DataFrame:
    """(pickup_hour, num_corrections) of hours that late files changed after they had come out."""
    times = spark.read.parquet(output).groupBy("pickup_hour").agg((F.count(F.lit(1)) - 1).alias("num_corrections"))
    return times.filter("num_corrections > 0")
