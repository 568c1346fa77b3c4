"""What each taxi service's files look like and what its hourly rollup holds.

One table drives ingest, rollups and serving, so a new service is a new entry here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

NTZ, LONG, DOUBLE = T.TimestampNTZType(), T.LongType(), T.DoubleType()


@dataclass(frozen=True)
class ServiceSpec:
    """Columns of one service.

    ``money`` maps each summed rollup column to the trip column it sums, in output order; it is
    also the list of price contributions. ``outside_total`` are the sums that do not count towards
    what passengers paid. ``seconds`` names a stored duration; without it a trip lasts from pick-up
    to drop-off. ``wait`` is the (from, to) pair of the waiting time.
    """

    name: str
    pickup: str
    dropoff: str
    money: dict[str, str] = field(default_factory=dict)
    outside_total: frozenset[str] = frozenset()
    distance: str | None = None
    seconds: str | None = None
    wait: tuple[str, str] | None = None

    @property
    def table(self) -> str:
        return f"{self.name}_tripdata"

    @property
    def averages(self) -> list[str]:
        wait = ["avg_request_to_on_scene_time_min"] if self.wait else []
        miles = ["avg_trip_miles"] if self.distance else []
        return [*wait, "avg_trip_time_min", *miles]

    @property
    def totalled(self) -> list[str]:
        """Rollup sums that make up the amount paid, in order."""
        return [out for out in self.money if out not in self.outside_total]

    @property
    def rollup_columns(self) -> list[str]:
        total = ["total_amount_payed"] if self.money else []
        return ["pickup_hour", "num_trips", *self.averages, *self.money, *total]

    @property
    def floating_seconds(self) -> str | None:
        """Where durations are kept that the files store as floating numbers.

        They count with their fraction of a minute, whole seconds as whole minutes, so the two are
        not mixed in one column.
        """
        return self.seconds and f"{self.seconds}_floating"

    @property
    def trip_columns(self) -> dict[str, T.DataType]:
        """Columns the rollup reads, by canonical name, with their declared types."""
        columns: dict[str, T.DataType] = dict.fromkeys(self.wait or (), NTZ)
        columns |= {"pickup_datetime": NTZ, "dropoff_datetime": NTZ}
        if self.seconds:
            columns[self.seconds] = LONG
            columns[self.floating_seconds] = DOUBLE
        if self.distance:
            columns[self.distance] = DOUBLE
        return columns | dict.fromkeys(self.money.values(), DOUBLE)

    @property
    def trip_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t) for c, t in self.trip_columns.items()])

    @property
    def raw_schema(self) -> T.StructType:
        """The same columns under the names used in the raw files."""
        raw = {"pickup_datetime": self.pickup, "dropoff_datetime": self.dropoff}
        return T.StructType(
            [
                T.StructField(raw.get(c, c), t)
                for c, t in self.trip_columns.items()
                if c != self.floating_seconds
            ]
        )


# Service names, raw column names and rollup column names. "payed" is spelled so.
SPECS: dict[str, ServiceSpec] = {
    "fhvhv": ServiceSpec(
        name="fhvhv",
        pickup="pickup_datetime",
        dropoff="dropoff_datetime",
        wait=("request_datetime", "on_scene_datetime"),
        seconds="trip_time",
        distance="trip_miles",
        money={
            "total_base_fare_amount": "base_passenger_fare",
            "total_tolls": "tolls",
            "total_black_car_fund": "bcf",
            "total_tax": "sales_tax",
            "total_congestion_surcharge": "congestion_surcharge",
            "total_airport_fees": "airport_fee",
            "total_tips": "tips",
            "total_driver_pay": "driver_pay",
        },
        outside_total=frozenset({"total_driver_pay"}),
    ),
    "fhv": ServiceSpec(name="fhv", pickup="pickup_datetime", dropoff="dropOff_datetime"),
    "yellow": ServiceSpec(
        name="yellow",
        pickup="tpep_pickup_datetime",
        dropoff="tpep_dropoff_datetime",
        distance="trip_distance",
        money={
            "total_base_fare_amount": "fare_amount",
            "total_extra": "extra",
            "total_tax": "mta_tax",
            "total_tips": "tip_amount",
            "total_tolls": "tolls_amount",
            "total_improvement_surcharge": "improvement_surcharge",
            "total_congestion_surcharge": "congestion_surcharge",
            "total_airport_fees": "Airport_fee",
        },
    ),
    "green": ServiceSpec(
        name="green",
        pickup="lpep_pickup_datetime",
        dropoff="lpep_dropoff_datetime",
        distance="trip_distance",
        money={
            "total_base_fare_amount": "fare_amount",
            "total_extra": "extra",
            "total_tax": "mta_tax",
            "total_tips": "tip_amount",
            "total_tolls": "tolls_amount",
            "total_improvement_surcharge": "improvement_surcharge",
            "total_congestion_surcharge": "congestion_surcharge",
        },
    ),
}
SERVICES: list[str] = list(SPECS)
PAYING_SERVICES: list[str] = [s for s, spec in SPECS.items() if spec.money]

# Every column any service's rollup has, each once.
HOURLY_COLUMNS: list[str] = list(
    dict.fromkeys(c for spec in SPECS.values() for c in spec.rollup_columns)
)


def services_with(column: str) -> list[str]:
    """Services whose rollup has ``column``."""
    return [s for s, spec in SPECS.items() if column in spec.rollup_columns]
