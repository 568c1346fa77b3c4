"""Trips and rollups in a relational database, through Spark's JDBC source.

A task that is retried, or run twice by speculation, inserts its rows again: a database table has
no counterpart of Spark's file commit. Append to an empty staging table and move its rows in one
database transaction. The parquet store is the main sink and has no such gap.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcTarget:
    """Connection settings. ``options`` go to the source as they are."""

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str = "org.postgresql.Driver"
    options: dict[str, str] = field(default_factory=dict)

    def as_options(self, table: str) -> dict[str, str]:
        given = {
            "url": self.url,
            "dbtable": table,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
        }
        return {k: v for k, v in given.items() if v is not None} | self.options


def write_table(
    df: DataFrame,
    target: JdbcTarget,
    table: str,
    mode: str = "append",
    batch_rows: int = 10_000,
    connections: int = 16,
) -> None:
    """Insert ``df`` in batches. ``connections`` bounds the parallel ones, not the rows."""
    (
        df.write.format("jdbc")
        .options(**target.as_options(table))
        .option("batchsize", batch_rows)
        .option("numPartitions", connections)
        .mode(mode)
        .save()
    )


def read_table(
    spark: SparkSession,
    target: JdbcTarget,
    table: str,
    time_columns: tuple[str, ...] = (),
    split: tuple[str, str, str, int] | None = None,
) -> DataFrame:
    """Read a table; ``split`` is (column, lower, upper, parts) for parallel range queries.

    Databases hand wall-clock times back as zoned timestamps; ``time_columns`` are cast back.
    """
    reader = spark.read.format("jdbc").options(**target.as_options(table))
    if split:
        column, lower, upper, parts = split
        reader = reader.options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=str(parts)
        )
    return reader.load().withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in time_columns}
    )
