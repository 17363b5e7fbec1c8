"""Declarative column tests and the stand-alone assertions over the models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.functions.columns import TRIP_CLASSES


@dataclass(frozen=True)
class ColumnTest:
    column: str
    kind: str
    values: tuple = ()

    def failures(self) -> Column:
        """Aggregate that counts the rows which break this test."""
        col = F.col(self.column)
        if self.kind == "not_null":
            return F.count_if(col.isNull())
        if self.kind == "unique":
            return F.count(col) - F.count_distinct(col)
        if self.kind == "accepted_values":
            return F.count_if(~col.isin(list(self.values)))
        raise ValueError(f"unknown column test {self.kind!r}")


def not_null(*columns: str) -> list[ColumnTest]:
    return [ColumnTest(name, "not_null") for name in columns]


def unique(column: str) -> list[ColumnTest]:
    return [ColumnTest(column, "unique")]


def accepted(column: str, values: Sequence) -> list[ColumnTest]:
    return [ColumnTest(column, "accepted_values", tuple(values))]


_TYPED = (
    not_null("pickup_date", "trip_type", "trips_count", "total_revenue"),
    accepted("trip_type", TRIP_CLASSES),
)
_CALENDAR = (
    not_null(
        "pickup_date",
        "pickup_month",
        "pickup_year",
        "pickup_month_number",
        "day_of_week",
        "is_weekend",
        "trips_count",
        "total_revenue",
        "short_trips_share",
        "medium_trips_share",
        "long_trips_share",
    ),
    unique("pickup_date"),
    accepted("pickup_month_number", range(1, 13)),
    accepted("day_of_week", range(1, 8)),
)

# The declared tests of every model. Code 6 and its name are
# valid for trips but not accepted here.
MODEL_TESTS: dict[str, list[ColumnTest]] = {
    "stg_daily_trips": [
        *not_null("pickup_date", "trips_count", "total_revenue"),
        *unique("pickup_date"),
    ],
    "stg_hourly_trips": [*sum(_TYPED, []), *not_null("pickup_hour")],
    "stg_location_pair_stats": [
        *sum(_TYPED, []),
        *not_null("pickup_location_id", "dropoff_location_id"),
    ],
    "stg_payment_type_stats": [
        *sum(_TYPED, []),
        *not_null("payment_type", "payment_type_name", "total_tips"),
        *accepted("payment_type", range(0, 6)),
        *accepted(
            "payment_type_name",
            ("Unknown", "Credit card", "Cash", "No charge", "Dispute", "Other"),
        ),
    ],
    "stg_taxi_zone_centroids": not_null(
        "location_id", "borough", "zone", "longitude", "latitude"
    ),
    "int_daily_trip_metrics": sum(_CALENDAR, []),
    "mart_daily_trip_kpis": [
        *sum(_CALENDAR, []),
        *not_null(
            "pickup_month_label", "day_type", "total_revenue_mln", "dominant_trip_type"
        ),
        *accepted("day_type", ("Weekday", "Weekend")),
        *accepted("dominant_trip_type", TRIP_CLASSES),
    ],
}


def run_column_tests(model: DataFrame, name: str) -> DataFrame:
    """All of a model's column tests from one aggregate, one row per test."""
    tests = MODEL_TESTS[name]
    counts = model.agg(
        *[test.failures().alias(f"t{i}") for i, test in enumerate(tests)]
    )
    rows = [
        F.struct(
            F.lit(name).alias("model"),
            F.lit(test.column).alias("column_name"),
            F.lit(test.kind).alias("test"),
            F.col(f"t{i}").alias("failures"),
        )
        for i, test in enumerate(tests)
    ]
    return counts.select(F.inline(F.array(*rows)))


def duplicate_grain(model: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Grain values that occur more than once."""
    return (
        model.groupBy(*grain)
        .agg(F.count("*").alias("rows_per_grain"))
        .where("rows_per_grain > 1")
    )


def class_count_mismatches(daily: DataFrame) -> DataFrame:
    """Days whose class counts do not add up to the day's trips."""
    counts = [f"{name}_trips_count" for name in TRIP_CLASSES]
    classified = F.expr(" + ".join(counts))
    return daily.select(
        "pickup_date",
        "trips_count",
        *counts,
        classified.alias("classified_trips_count"),
    ).where("classified_trips_count <> trips_count")


def share_sum_mismatches(metrics: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Days with trips whose class shares are not one in total."""
    shares = [f"{name}_trips_share" for name in TRIP_CLASSES]
    total = F.expr(" + ".join(shares))
    return metrics.select(
        "pickup_date", "trips_count", *shares, total.alias("total_trip_type_share")
    ).where(
        (F.col("trips_count") > 0)
        & (F.abs(F.col("total_trip_type_share") - 1) > tolerance)
    )


def hours_out_of_range(hourly: DataFrame) -> DataFrame:
    return hourly.where("pickup_hour < 0 OR pickup_hour > 23").select(
        "pickup_date", "pickup_hour", "trip_type"
    )
