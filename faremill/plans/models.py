"""Staging projections, daily metrics and the daily KPI model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill import schemas
from faremill.functions.columns import TRIP_CLASSES, ratio_sql, rounded_ratio

# Staging model of each serving table.
STAGING = {
    schemas.DAILY.name: "stg_daily_trips",
    schemas.HOURLY.name: "stg_hourly_trips",
    schemas.ROUTE.name: "stg_location_pair_stats",
    schemas.PAYMENT.name: "stg_payment_type_stats",
    schemas.CENTROIDS_TABLE: "stg_taxi_zone_centroids",
}
METRICS = "int_daily_trip_metrics"
KPIS = "mart_daily_trip_kpis"


def stage_mart(table: DataFrame, contract: schemas.MartContract) -> DataFrame:
    """Contract columns in contract order, with the load stamp if present."""
    names = contract.contract_names if contract.stamp in table.columns else contract.names
    return table.select(*names)


def stage_centroids(table: DataFrame) -> DataFrame:
    return table.select(*schemas.ZONE_CENTROIDS.names)


def _metrics_sql() -> list[str]:
    """The daily metrics as SQL over the staged daily mart."""
    weekday = "weekday(pickup_date) + 1"  # Monday is 1
    counts = [f"{name}_trips_count" for name in TRIP_CLASSES]
    shares = [
        f"CASE WHEN trips_count = 0 THEN 0D ELSE {ratio_sql(count, 'trips_count', 4)} END"
        f" AS {name}_trips_share"
        for name, count in zip(TRIP_CLASSES, counts, strict=True)
    ]
    return [
        "pickup_date",
        "trunc(pickup_date, 'MM') AS pickup_month",
        "year(pickup_date) AS pickup_year",
        "month(pickup_date) AS pickup_month_number",
        f"{weekday} AS day_of_week",
        f"{weekday} IN (6, 7) AS is_weekend",
        *TOTALS,
        *counts,
        *shares,
    ]


TOTALS = (
    "trips_count", "total_revenue", "avg_check", "avg_trip_distance", "avg_trip_duration_minutes",
)


def daily_metrics(staged: DataFrame) -> DataFrame:
    """Calendar attributes and class shares, one row per day."""
    stamp = [name for name in (schemas.DAILY.stamp,) if name in staged.columns]
    return staged.selectExpr(*_metrics_sql(), *stamp)


def view_sql(names: dict[str, str]) -> dict[str, str]:
    """Queries of the models that are views, by model, in the order of their making.

    names: where each serving table and model is found in the catalog.
    """
    views = {
        STAGING[mart]: f"SELECT {', '.join(contract.contract_names)} FROM {names[mart]}"
        for mart, contract in schemas.MARTS.items()
    }
    if schemas.CENTROIDS_TABLE in names:
        points = ", ".join(schemas.ZONE_CENTROIDS.names)
        views[STAGING[schemas.CENTROIDS_TABLE]] = f"SELECT {points} FROM {names[schemas.CENTROIDS_TABLE]}"
    metrics = ", ".join([*_metrics_sql(), schemas.DAILY.stamp])
    views[METRICS] = f"SELECT {metrics} FROM {names[STAGING[schemas.DAILY.name]]}"
    return views


def dominant_class() -> Column:
    """Class with the largest share; ties go to the shorter class."""
    short, medium, long = [F.col(f"{name}_trips_share") for name in TRIP_CLASSES]
    return (
        F.when((short >= medium) & (short >= long), "short")
        .when((medium >= short) & (medium >= long), "medium")
        .otherwise("long")
    )


def daily_kpis(metrics: DataFrame) -> DataFrame:
    cents = "cast(rint(total_revenue * 100) AS bigint)"
    return metrics.select(
        "pickup_date",
        "pickup_month",
        F.date_format("pickup_date", "yyyy-MM").alias("pickup_month_label"),
        "pickup_year",
        "pickup_month_number",
        "day_of_week",
        "is_weekend",
        F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type"),
        "trips_count",
        "total_revenue",
        rounded_ratio(cents, "100000000L", 2).alias("total_revenue_mln"),
        "avg_check",
        "avg_trip_distance",
        "avg_trip_duration_minutes",
        *[f"{name}_trips_count" for name in TRIP_CLASSES],
        *[f"{name}_trips_share" for name in TRIP_CLASSES],
        dominant_class().alias("dominant_trip_type"),
    )
