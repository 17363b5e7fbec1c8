"""The four marts, all built from additive sums over clean trips.

A mart is an additive aggregate (exact whole-number sums and counts) followed by
a finishing projection. Because the sums are exact, a mart built from clean
trips equals the same mart rolled up from a finer aggregate, which lets the
pipeline build three marts from one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill import schemas
from faremill.functions.columns import (
    MINUTE_UNITS,
    TRIP_CLASSES,
    UNITS,
    exact_minutes,
    exact_sum,
    from_units,
    month_text,
    payment_name,
    rounded_ratio,
    summable,
    year_text,
)

CUBE_KEYS = ("pickup_date", "pickup_hour", "trip_type", "payment_type")

_MEASURE_UNITS = {
    "total_amount": UNITS,
    "tip_amount": UNITS,
    "trip_distance": UNITS,
    "trip_duration_minutes": MINUTE_UNITS,
}


def trip_sums(
    trips: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Additive counts and sums of clean trips at the grain of ``keys``.

    Partial aggregation combines rows on the map side, so a key that holds a
    large share of the trips sends one row per map task through the shuffle.
    """
    sums = [F.count("*").alias("trips")]
    for name in measures:
        add = exact_minutes if _MEASURE_UNITS[name] == MINUTE_UNITS else exact_sum
        sums.append(add(F.col(name)).alias(f"{name}_sum"))
        # the mean is over exactly the values in the sum
        sums.append(F.count_if(summable(F.col(name))).alias(f"{name}_rows"))
    return trips.groupBy(*keys).agg(*sums)


def trip_cube(trips: DataFrame) -> DataFrame:
    """Sums by date, hour, class and payment code.

    The grain is bounded by the calendar (24 hours, three classes and a handful
    of codes a day), so it stays small however many trips there are.
    """
    return trip_sums(trips, CUBE_KEYS, tuple(_MEASURE_UNITS))


def _roll_up(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    additive = [name for name in sums.columns if name.endswith(("_sum", "_rows"))]
    return sums.groupBy(*keys).agg(
        F.sum("trips").alias("trips"), *[F.sum(name).alias(name) for name in additive]
    )


def _total(measure: str) -> Column:
    return from_units(f"{measure}_sum", 2, _MEASURE_UNITS[measure])


def _mean(measure: str) -> Column:
    rows = f"{measure}_rows * {_MEASURE_UNITS[measure]}BD"
    return rounded_ratio(f"{measure}_sum", rows, 2)


def _finish(sums: DataFrame, contract: schemas.MartContract) -> DataFrame:
    """Compute the contract's derived columns and put them in contract order."""
    derived = {
        "trips_count": lambda: F.col("trips"),
        "total_revenue": lambda: _total("total_amount"),
        "avg_check": lambda: _mean("total_amount"),
        "avg_trip_distance": lambda: _mean("trip_distance"),
        "avg_trip_duration_minutes": lambda: _mean("trip_duration_minutes"),
        "total_tips": lambda: _total("tip_amount"),
        "avg_tip": lambda: _mean("tip_amount"),
        "tips_share_from_revenue": _tips_share,
        "payment_type_name": lambda: payment_name("payment_type"),
        "year": lambda: year_text("pickup_date"),
        "month": lambda: month_text("pickup_date"),
    }
    return sums.select(
        *[
            derived[name]().alias(name) if name in derived else F.col(name)
            for name in contract.names
        ]
    )


def _tips_share() -> Column:
    share = rounded_ratio("tip_amount_sum", "total_amount_sum", 4)
    return F.when(F.col("total_amount_sum") != 0, share).otherwise(F.lit(0.0))


_TRAVEL_MEASURES = ("total_amount", "trip_distance", "trip_duration_minutes")


def _class_counts(trips_of: Column) -> list[Column]:
    """Trips of each class; ``trips_of`` is how many trips a row stands for."""
    return [
        F.sum(F.when(F.col("trip_type") == name, trips_of).otherwise(0)).alias(
            f"{name}_trips_count"
        )
        for name in TRIP_CLASSES
    ]


def daily_mart(trips: DataFrame) -> DataFrame:
    by_class = trip_sums(trips, ("pickup_date", "trip_type"), _TRAVEL_MEASURES)
    return daily_mart_from(by_class)


def daily_mart_from(sums: DataFrame) -> DataFrame:
    """Daily mart from any additive aggregate that keeps date and class."""
    additive = [
        f"{name}_{part}" for name in _TRAVEL_MEASURES for part in ("sum", "rows")
    ]
    daily = sums.groupBy("pickup_date").agg(
        F.sum("trips").alias("trips"),
        *[F.sum(name).alias(name) for name in additive],
        *_class_counts(F.col("trips")),
    )
    return _finish(daily, schemas.DAILY)


def hourly_mart(trips: DataFrame) -> DataFrame:
    return _finish(
        trip_sums(trips, schemas.HOURLY.grain, _TRAVEL_MEASURES), schemas.HOURLY
    )


def hourly_mart_from(sums: DataFrame) -> DataFrame:
    return _finish(_roll_up(sums, schemas.HOURLY.grain), schemas.HOURLY)


def payment_mart(trips: DataFrame) -> DataFrame:
    sums = trip_sums(trips, schemas.PAYMENT.grain, ("total_amount", "tip_amount"))
    return _finish(sums, schemas.PAYMENT)


def payment_mart_from(sums: DataFrame) -> DataFrame:
    return _finish(_roll_up(sums, schemas.PAYMENT.grain), schemas.PAYMENT)


def zone_role(zones: DataFrame, role: str) -> DataFrame:
    """The zone lookup under pickup or dropoff names."""
    return zones.select(
        F.col("LocationID").try_cast("int").alias(f"{role}_location_id"),
        F.col("Borough").alias(f"{role}_borough"),
        F.col("Zone").alias(f"{role}_zone"),
        F.col("service_zone").alias(f"{role}_service_zone"),
    )


def route_mart(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Aggregate first, then attach zone attributes; unknown zones stay NULL.

    The joins carry no broadcast hint: Spark broadcasts the lookup while its
    measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and falls
    back to a sort-merge join, with adaptive skew splitting, beyond it.
    """
    keys = ("pickup_date", "trip_type", "PULocationID", "DOLocationID")
    routes = trip_sums(trips, keys, _TRAVEL_MEASURES).withColumnsRenamed(
        {"PULocationID": "pickup_location_id", "DOLocationID": "dropoff_location_id"}
    )
    named = routes.join(zone_role(zones, "pickup"), "pickup_location_id", "left").join(
        zone_role(zones, "dropoff"), "dropoff_location_id", "left"
    )
    return _finish(named, schemas.ROUTE)
