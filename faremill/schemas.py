"""Dataset contracts: column names, order, types and grain of every table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Columns of a raw monthly trip file that the pipeline reads, with their types.
TRIP_TYPES = {
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "bigint",
    "trip_distance": "double",
    "PULocationID": "int",
    "DOLocationID": "int",
    "payment_type": "bigint",
    "fare_amount": "double",
    "tip_amount": "double",
    "total_amount": "double",
}

PERIOD = ("year", "month")

ZONE_LOOKUP = T.StructType(
    [
        T.StructField("LocationID", T.StringType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

ZONE_CENTROIDS = T.StructType(
    [
        T.StructField("location_id", T.IntegerType()),
        T.StructField("borough", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class MartContract:
    """A mart's columns in order, its grain, and the stamp added on write."""

    name: str
    grain: tuple[str, ...]
    columns: tuple[tuple[str, str], ...]
    stamp: str = "gold_load_timestamp"

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def stored_names(self) -> list[str]:
        """Column order on disk: partition columns last, after the stamp."""
        body = [name for name in self.names if name not in PERIOD]
        return [*body, self.stamp, *PERIOD]

    @property
    def contract_names(self) -> list[str]:
        return [*self.names, self.stamp]

    @property
    def ddl(self) -> str:
        types = {**dict(self.columns), self.stamp: "timestamp"}
        return ", ".join(f"{name} {types[name]}" for name in self.stored_names)


_VOLUME = (
    ("trips_count", "bigint"),
    ("total_revenue", "double"),
    ("avg_check", "double"),
)
_TRAVEL = (("avg_trip_distance", "double"), ("avg_trip_duration_minutes", "double"))
_PERIOD = (("year", "string"), ("month", "string"))

DAILY = MartContract(
    "gold_daily_trips",
    ("pickup_date",),
    (
        ("pickup_date", "date"),
        *_VOLUME,
        *_TRAVEL,
        ("short_trips_count", "bigint"),
        ("medium_trips_count", "bigint"),
        ("long_trips_count", "bigint"),
        *_PERIOD,
    ),
)

HOURLY = MartContract(
    "gold_hourly_trips",
    ("pickup_date", "pickup_hour", "trip_type"),
    (
        ("pickup_date", "date"),
        ("pickup_hour", "int"),
        ("trip_type", "string"),
        *_VOLUME,
        *_TRAVEL,
        *_PERIOD,
    ),
)

ROUTE = MartContract(
    "gold_location_pair_stats",
    ("pickup_date", "trip_type", "pickup_location_id", "dropoff_location_id"),
    (
        ("pickup_date", "date"),
        ("trip_type", "string"),
        ("pickup_location_id", "int"),
        ("pickup_borough", "string"),
        ("pickup_zone", "string"),
        ("pickup_service_zone", "string"),
        ("dropoff_location_id", "int"),
        ("dropoff_borough", "string"),
        ("dropoff_zone", "string"),
        ("dropoff_service_zone", "string"),
        *_VOLUME,
        *_TRAVEL,
        *_PERIOD,
    ),
)

PAYMENT = MartContract(
    "gold_payment_type_stats",
    ("pickup_date", "trip_type", "payment_type"),
    (
        ("pickup_date", "date"),
        ("trip_type", "string"),
        ("payment_type", "bigint"),
        ("payment_type_name", "string"),
        *_VOLUME,
        ("total_tips", "double"),
        ("avg_tip", "double"),
        ("tips_share_from_revenue", "double"),
        *_PERIOD,
    ),
)

MARTS = {mart.name: mart for mart in (DAILY, HOURLY, ROUTE, PAYMENT)}
CENTROIDS_TABLE = "taxi_zone_centroids"
