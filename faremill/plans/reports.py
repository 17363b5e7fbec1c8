"""The analytical reports over the marts.

Marts hold rounded averages, so a report's average is the trips-weighted mean of
those rounded values. Every ordering ends in the grouping keys, which makes
ranks and limits repeatable when volumes tie.

Shares use window sums over rows that are already grouped. The grouped rows are
bounded by small domains (hours, trip classes, payment codes), so one window
partition never holds more than a few hundred rows, and the mart is read once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremill.functions.columns import (
    TRIP_CLASSES,
    UNITS,
    domain_order,
    exact_sum,
    from_units,
    is_filled,
    round_half_up,
    rounded_ratio,
    weighted_sum,
)

# Order of payment names in the monthly trend report.
PAYMENT_ORDER = ("Credit card", "Cash", "Other", "Dispute", "No charge")


def _volume(*extra: Column) -> list[Column]:
    return [
        F.sum("trips_count").alias("trips"),
        exact_sum(F.col("total_revenue")).alias("revenue"),
        *extra,
    ]


def _travel() -> list[Column]:
    return [
        weighted_sum("avg_trip_distance", "trips_count").alias("distance"),
        weighted_sum("avg_trip_duration_minutes", "trips_count").alias("duration"),
    ]


def _per_trip(total: str) -> Column:
    return rounded_ratio(total, f"trips * {UNITS}L", 2)


def _volume_columns(*share: Column) -> list[Column]:
    return [
        F.col("trips").alias("trips_count"),
        *share,
        from_units("revenue", 2).alias("total_revenue"),
        _per_trip("revenue").alias("avg_check"),
    ]


def _travel_columns() -> list[Column]:
    return [
        _per_trip("distance").alias("avg_trip_distance"),
        _per_trip("duration").alias("avg_trip_duration_minutes"),
    ]


def _tip_columns() -> list[Column]:
    return [
        from_units("tips", 2).alias("total_tips"),
        _per_trip("tips").alias("avg_tip"),
        rounded_ratio("tips", "revenue", 2, scale=100).alias(
            "tips_share_from_revenue_pct"
        ),
    ]


def _with_group_trips(grouped: DataFrame, *partition: str) -> DataFrame:
    """Add the trips of a row's group, or of all rows without one."""
    window = Window.partitionBy(*(partition or [F.lit(0)]))
    return grouped.withColumn("group_trips", F.sum("trips").over(window))


def _share_pct() -> Column:
    return rounded_ratio("trips", "group_trips", 2, scale=100)


def _rank(partition: list[str], ties: list[str]) -> Column:
    window = Window.partitionBy(*partition).orderBy(
        F.desc("trips"), *[F.asc_nulls_first(name) for name in ties]
    )
    return F.row_number().over(window)


def _top_zones(routes: DataFrame, role: str, limit: int) -> DataFrame:
    borough, zone = f"{role}_borough", f"{role}_zone"
    return (
        routes.where(is_filled(zone))
        .groupBy(borough, zone)
        .agg(*_volume())
        .select(borough, zone, *_volume_columns())
        .orderBy(F.desc("trips_count"), borough, zone)
        .limit(limit)
    )


def top_pickup_zones(routes: DataFrame, limit: int = 20) -> DataFrame:
    return _top_zones(routes, "pickup", limit)


def top_dropoff_zones(routes: DataFrame, limit: int = 20) -> DataFrame:
    return _top_zones(routes, "dropoff", limit)


def peak_hours(hourly: DataFrame, limit: int = 24) -> DataFrame:
    return (
        hourly.groupBy("pickup_hour")
        .agg(*_volume(*_travel()))
        .transform(_with_group_trips)
        .select(
            "pickup_hour",
            *_volume_columns(_share_pct().alias("trips_share_pct")),
            *_travel_columns(),
        )
        .orderBy(F.desc("trips_count"), "pickup_hour")
        .limit(limit)
    )


def trip_type_distribution(hourly: DataFrame) -> DataFrame:
    return (
        hourly.where(is_filled("trip_type"))
        .groupBy("trip_type")
        .agg(*_volume(*_travel()))
        .transform(_with_group_trips)
        .select(
            "trip_type",
            *_volume_columns(_share_pct().alias("trips_share_pct")),
            *_travel_columns(),
            rounded_ratio("revenue", "distance", 2).alias(
                "avg_cost_per_mile"
            ),
        )
        .orderBy(F.desc("trips_count"), "trip_type")
    )


def peak_hours_by_type(hourly: DataFrame, keep: int = 10) -> DataFrame:
    return (
        hourly.where(is_filled("trip_type"))
        .groupBy("trip_type", "pickup_hour")
        .agg(*_volume(*_travel()))
        .transform(_with_group_trips, "trip_type")
        .select(
            "trip_type",
            _rank(["trip_type"], ["pickup_hour"]).alias("hour_rank_within_type"),
            "pickup_hour",
            *_volume_columns(_share_pct().alias("trips_share_within_type_pct")),
            *_travel_columns(),
        )
        .where(F.col("hour_rank_within_type") <= keep)
        .orderBy(domain_order("trip_type", TRIP_CLASSES), "hour_rank_within_type")
    )


def _by_role(routes: DataFrame, *keep: str) -> DataFrame:
    """Each route row once for its pickup zone and once for its dropoff zone.

    The result is the union of both projections, but the mart is read once.
    """
    roles = ", ".join(
        f"named_struct('zone_role', '{role}', 'location_id', {role}_location_id,"
        f" 'borough', {role}_borough, 'zone', {role}_zone)"
        for role in ("pickup", "dropoff")
    )
    return routes.selectExpr(*keep, f"inline(array({roles}))")


def top_zones_by_type(routes: DataFrame, keep: int = 3) -> DataFrame:
    """Busiest zones per role and class.

    The rank filter lets Spark keep only ``keep`` rows per group in each map
    task before the shuffle, so a class with very many zones stays cheap.
    """
    measures = (
        "trips_count",
        "total_revenue",
        "avg_trip_distance",
        "avg_trip_duration_minutes",
    )
    both = (
        _by_role(routes.where(is_filled("trip_type")), "trip_type", *measures)
        .where(is_filled("zone"))
        .groupBy("zone_role", "trip_type", "borough", "zone")
        .agg(*_volume(*_travel()))
    )
    rank = _rank(["zone_role", "trip_type"], ["borough", "zone"])
    return (
        both.withColumn("zone_rank", rank)
        .where(F.col("zone_rank") <= keep)
        .select(
            "zone_role",
            "trip_type",
            "zone_rank",
            "borough",
            "zone",
            *_volume_columns(),
            *_travel_columns(),
        )
        .orderBy(
            domain_order("zone_role", ("pickup", "dropoff")),
            domain_order("trip_type", TRIP_CLASSES),
            "zone_rank",
        )
    )


def _payment_volume(payments: DataFrame, *keys: Column | str) -> DataFrame:
    return payments.groupBy(*keys, "payment_type", "payment_type_name").agg(
        *_volume(exact_sum(F.col("total_tips")).alias("tips"))
    )


def payment_by_type(payments: DataFrame) -> DataFrame:
    filled = is_filled("trip_type") & is_filled("payment_type_name")
    return (
        _payment_volume(payments.where(filled), "trip_type")
        .transform(_with_group_trips, "trip_type")
        .select(
            "trip_type",
            "payment_type",
            "payment_type_name",
            *_volume_columns(_share_pct().alias("trips_share_within_type_pct")),
            *_tip_columns(),
        )
        .orderBy(
            domain_order("trip_type", TRIP_CLASSES),
            F.desc("trips_count"),
            "payment_type",
        )
    )


def payment_trends(payments: DataFrame) -> DataFrame:
    month = F.trunc("pickup_date", "MM").alias("pickup_month")
    return (
        _payment_volume(payments.where(is_filled("payment_type_name")), month)
        .transform(_with_group_trips, "pickup_month")
        .select(
            "pickup_month",
            "payment_type",
            "payment_type_name",
            *_volume_columns(_share_pct().alias("trips_share_month_pct")),
            *_tip_columns(),
        )
        .orderBy(
            "pickup_month",
            domain_order("payment_type_name", PAYMENT_ORDER),
            "payment_type",
        )
    )


@dataclass(frozen=True)
class RideShareModel:
    """Assumptions of the shared-ride estimate.

    Shares are in percent and money in whole dollars, so every output is an
    exact fraction of the trip count.
    """

    groupable_pct: int = 5
    accepting_pct: int = 30
    discount: int = 5
    privacy_fee: int = 2


def _short_routes(routes: DataFrame) -> DataFrame:
    """Short routes that start and end in the same borough."""
    roles = [f"{role}_{part}" for role in ("pickup", "dropoff") for part in ("borough", "zone")]
    kept = routes.where("trip_type = 'short' AND pickup_borough = dropoff_borough")
    for name in roles:
        kept = kept.where(is_filled(name))
    return kept.groupBy(*roles).agg(*_volume(*_travel()))


def _trips_part(model: RideShareModel, places: int, *factors: int) -> Column:
    """``trips * groupable% * factors``, where a factor may be a percentage."""
    product = model.groupable_pct
    for factor in factors:
        product *= factor
    return rounded_ratio(f"trips * {product}L", "10000L", places)


def _share_columns(model: RideShareModel) -> dict[str, Column]:
    accept, refuse = model.accepting_pct, 100 - model.accepting_pct
    return {
        "potential_groupable_trips": _trips_part(model, 0, 100),
        "grouped_accepting_trips": _trips_part(model, 0, accept),
        "individual_privacy_trips": _trips_part(model, 0, refuse),
        "grouped_discount_cost": _trips_part(model, 2, accept, model.discount),
        "privacy_fee_revenue": _trips_part(model, 2, refuse, model.privacy_fee),
        "estimated_direct_fare_impact": _trips_part(
            model, 2, refuse * model.privacy_fee - accept * model.discount
        ),
    }


_ROUTE_KEYS = ("pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone")


def rideshare_candidates(
    routes: DataFrame, model: RideShareModel = RideShareModel(), limit: int = 30
) -> DataFrame:
    return (
        _short_routes(routes)
        .select(
            *_ROUTE_KEYS,
            *_volume_columns(),
            *_travel_columns(),
            *[col.alias(name) for name, col in _share_columns(model).items()],
        )
        .orderBy(F.desc("trips_count"), *_ROUTE_KEYS)
        .limit(limit)
    )


def rideshare_vehicle_model(
    routes: DataFrame, model: RideShareModel = RideShareModel(), limit: int = 30
) -> DataFrame:
    """Revenue of one vehicle trip when two passengers share it."""
    grouped = 2 * (F.col("avg_check") - model.discount)
    parts = _share_columns(model)
    return (
        _short_routes(routes)
        .select(
            *_ROUTE_KEYS,
            *_volume_columns(),
            parts["potential_groupable_trips"].alias("potential_groupable_passenger_trips"),
            parts["grouped_accepting_trips"].alias("grouped_accepting_passenger_trips"),
            rounded_ratio(
                f"trips * {model.groupable_pct * model.accepting_pct}L", "20000L", 0
            ).alias("grouped_vehicle_trips"),
            parts["individual_privacy_trips"].alias("individual_privacy_passenger_trips"),
            parts["grouped_discount_cost"].alias("grouped_discount_cost"),
            parts["privacy_fee_revenue"].alias("privacy_fee_revenue"),
            parts["estimated_direct_fare_impact"].alias("estimated_direct_fare_impact"),
        )
        .withColumns(
            {
                "baseline_revenue_per_vehicle_trip": F.col("avg_check"),
                "grouped_revenue_per_vehicle_trip": round_half_up(grouped, 2),
                "vehicle_trip_revenue_uplift": round_half_up(
                    grouped - F.col("avg_check"), 2
                ),
            }
        )
        .orderBy(F.desc("trips_count"), *_ROUTE_KEYS)
        .limit(limit)
    )


def unique_centroids(centroids: DataFrame) -> DataFrame:
    """One point per zone: the mean of its geometry points, in any order."""
    return centroids.groupBy("location_id").agg(
        F.avg("longitude").alias("longitude"), F.avg("latitude").alias("latitude")
    )


def zone_demand_map(routes: DataFrame, centroids: DataFrame) -> DataFrame:
    """Pickup and dropoff demand per zone with map coordinates.

    Demand and points are both grouped to one row per zone before they meet, so
    several points of a zone cannot multiply its trips. A zone without a point
    keeps its demand and has NULL coordinates.
    """

    both = (
        _by_role(routes, "trips_count", "total_revenue")
        .groupBy("zone_role", "location_id", "borough", "zone")
        .agg(*_volume())
        .select("zone_role", "location_id", "borough", "zone", *_volume_columns())
    )
    points = unique_centroids(centroids)
    return both.join(points, "location_id", "left").select(
        "zone_role",
        "location_id",
        "borough",
        "zone",
        F.round("longitude", 6).alias("longitude"),
        F.round("latitude", 6).alias("latitude"),
        "trips_count",
        "total_revenue",
        "avg_check",
    )


def table_coverage(marts: dict[str, DataFrame]) -> DataFrame:
    """Rows, date range and months of each mart."""
    parts = [
        table.agg(
            F.count("*").alias("rows_count"),
            F.min("pickup_date").alias("min_date"),
            F.max("pickup_date").alias("max_date"),
            F.count_distinct(F.trunc("pickup_date", "MM")).alias("periods_count"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, table in sorted(marts.items())
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.orderBy("table_name")
