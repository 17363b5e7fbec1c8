"""Reports on small marts worked out by hand."""

from datetime import date

import pytest

from faremill import schemas
from faremill.operators.data_tests import share_sum_mismatches
from faremill.plans import models, reports

DAY, NEXT = date(2024, 1, 6), date(2024, 2, 1)


def build(spark, contract, rows):
    """Rows give some columns by name; the others are NULL."""
    ddl = ", ".join(f"{name} {kind}" for name, kind in contract.columns)
    return spark.createDataFrame(
        [tuple(row.get(name) for name in contract.names) for row in rows], ddl
    )


def hour(hour, kind, trips, revenue, distance=1.0, duration=10.0, day=DAY):
    return {
        "pickup_date": day, "pickup_hour": hour, "trip_type": kind,
        "trips_count": trips, "total_revenue": revenue,
        "avg_trip_distance": distance, "avg_trip_duration_minutes": duration,
    }


def route(kind, pickup, dropoff, trips, revenue, boroughs=("Q", "Q"), ids=(1, 2)):
    return {
        "pickup_date": DAY, "trip_type": kind, "pickup_zone": pickup,
        "dropoff_zone": dropoff, "pickup_borough": boroughs[0],
        "dropoff_borough": boroughs[1], "trips_count": trips,
        "total_revenue": revenue, "avg_trip_distance": 1.0,
        "avg_trip_duration_minutes": 10.0,
        "pickup_location_id": ids[0], "dropoff_location_id": ids[1],
    }


def test_averages_are_weighted_by_trips(spark):
    mart = build(spark, schemas.HOURLY, [
        hour(8, "short", 1, 10.0, 1.0, 10.0),
        hour(8, "short", 3, 50.0, 2.0, 20.0, NEXT),
        hour(9, "long", 4, 100.0, 12.0, 40.0),
    ])
    rows = [r.asDict() for r in reports.peak_hours(mart).collect()]
    assert [r["pickup_hour"] for r in rows] == [8, 9]  # tie broken by the hour
    assert rows[0] == {
        "pickup_hour": 8, "trips_count": 4, "trips_share_pct": 50.0,
        "total_revenue": 60.0, "avg_check": 15.0, "avg_trip_distance": 1.75,
        "avg_trip_duration_minutes": 17.5,
    }


def test_distribution_guards_a_zero_distance(spark):
    mart = build(spark, schemas.HOURLY, [
        hour(8, "short", 2, 10.0, 0.0), hour(9, "long", 6, 90.0, 3.0),
        hour(9, "", 5, 1.0), hour(9, None, 5, 1.0),
    ])
    rows = {r["trip_type"]: r for r in reports.trip_type_distribution(mart).collect()}
    assert set(rows) == {"short", "long"}
    assert rows["short"]["avg_cost_per_mile"] is None
    assert rows["long"]["avg_cost_per_mile"] == 5.0
    assert rows["long"]["trips_share_pct"] == 75.0


def test_ranks_within_class_and_domain_order(spark):
    mart = build(spark, schemas.HOURLY, [
        hour(h, kind, 100 - h, 10.0) for h in range(12) for kind in ("long", "short")
    ] + [hour(20, "short", 100, 10.0)])
    rows = reports.peak_hours_by_type(mart).collect()
    assert [r["trip_type"] for r in rows] == ["short"] * 10 + ["long"] * 10
    assert [r["hour_rank_within_type"] for r in rows[:10]] == list(range(1, 11))
    assert [r["pickup_hour"] for r in rows[:3]] == [0, 20, 1]
    total = sum(100 - h for h in range(12))
    assert rows[10]["trips_share_within_type_pct"] == round(100 / total * 100, 2)


def test_top_zones_by_type(spark):
    mart = build(spark, schemas.ROUTE, [
        route("short", f"Z{n}", "Y", 10 - n, 10.0) for n in range(5)
    ] + [route("short", None, "", 99, 1.0)])
    rows = reports.top_zones_by_type(mart).collect()
    assert [(r["zone_role"], r["zone_rank"], r["zone"]) for r in rows] == [
        ("pickup", 1, "Z0"), ("pickup", 2, "Z1"), ("pickup", 3, "Z2"),
        ("dropoff", 1, "Y"),
    ]
    assert rows[3]["trips_count"] == 40


def test_top_pickup_zones_keeps_spaces_but_not_empty_names(spark):
    mart = build(spark, schemas.ROUTE, [
        route("short", "  ", "A", 5, 10.0), route("short", "", "A", 9, 10.0),
        route("long", "B", None, 7, 35.0),
    ])
    found = [(r["pickup_zone"], r["avg_check"]) for r in reports.top_pickup_zones(mart).collect()]
    assert found == [("B", 5.0), ("  ", 2.0)]
    assert [r["dropoff_zone"] for r in reports.top_dropoff_zones(mart).collect()] == ["A"]


def pay(name, code, trips, revenue, tips, kind="short", day=DAY):
    return {
        "pickup_date": day, "trip_type": kind, "payment_type": code,
        "payment_type_name": name, "trips_count": trips, "total_revenue": revenue,
        "total_tips": tips,
    }


def test_payment_reports(spark):
    mart = build(spark, schemas.PAYMENT, [
        pay("Cash", 2, 3, 30.0, 0.0), pay("Credit card", 1, 1, 20.0, 5.0),
        pay("Unknown", 5, 4, 0.0, 0.0, day=NEXT), pay("No charge", 3, 4, 1.0, 0.0, day=NEXT),
    ])
    by_type = reports.payment_by_type(mart).collect()
    assert by_type[0]["payment_type"] == 3
    cash = [r for r in by_type if r["payment_type"] == 2][0]
    assert (cash["trips_share_within_type_pct"], cash["tips_share_from_revenue_pct"]) == (25.0, 0.0)
    free = [r for r in by_type if r["payment_type"] == 5][0]
    assert free["tips_share_from_revenue_pct"] is None
    trends = reports.payment_trends(mart).collect()
    assert [(r["pickup_month"].month, r["payment_type_name"]) for r in trends] == [
        (1, "Credit card"), (1, "Cash"), (2, "No charge"), (2, "Unknown"),
    ]
    assert trends[0]["trips_share_month_pct"] == 25.0


def test_shared_rides(spark):
    mart = build(spark, schemas.ROUTE, [
        route("short", "A", "B", 270_199, 4_228_614.35),
        route("short", "A", "C", 10, 100.0, boroughs=("Q", "M")),
        route("long", "A", "B", 10, 100.0),
        route("short", "", "B", 10, 100.0),
    ])
    row = reports.rideshare_candidates(mart).collect()
    assert len(row) == 1
    assert {
        "potential_groupable_trips": 13510.0,
        "grouped_accepting_trips": 4053.0,
        "individual_privacy_trips": 9457.0,
        "grouped_discount_cost": 20264.93,
        "privacy_fee_revenue": 18913.93,
        "estimated_direct_fare_impact": -1351.0,
    }.items() <= row[0].asDict().items()
    vehicle = reports.rideshare_vehicle_model(mart).first().asDict()
    assert {
        "grouped_vehicle_trips": 2026.0,
        "baseline_revenue_per_vehicle_trip": 15.65,
        "grouped_revenue_per_vehicle_trip": 21.3,
        "vehicle_trip_revenue_uplift": 5.65,
    }.items() <= vehicle.items()


def test_several_points_do_not_multiply_demand(spark):
    mart = build(spark, schemas.ROUTE, [route("short", "A", "B", 5, 10.0, ids=(1, 2))])
    points = spark.createDataFrame(
        [(1, "Q", "A", -73.0, 40.0), (1, "Q", "A", -74.0, 41.0), (2, "Q", "B", -73.5, 40.5)],
        schemas.ZONE_CENTROIDS,
    )
    rows = {r["zone_role"]: r for r in reports.zone_demand_map(mart, points).collect()}
    assert (rows["pickup"]["trips_count"], rows["dropoff"]["trips_count"]) == (5, 5)
    assert (rows["pickup"]["longitude"], rows["pickup"]["latitude"]) == (-73.5, 40.5)


@pytest.mark.parametrize(
    "counts, dominant",
    [((4, 4, 2), "short"), ((2, 4, 4), "medium"), ((1, 2, 7), "long"), ((0, 0, 0), "short")],
)
def test_daily_models(spark, counts, dominant):
    mart = build(spark, schemas.DAILY, [{
        "pickup_date": DAY, "trips_count": sum(counts), "total_revenue": 2_345_000.0,
        **dict(zip(("short_trips_count", "medium_trips_count", "long_trips_count"), counts)),
    }])
    metrics = models.daily_metrics(models.stage_mart(mart, schemas.DAILY))
    row = models.daily_kpis(metrics).first()
    assert row["dominant_trip_type"] == dominant
    assert (row["day_of_week"], row["is_weekend"], row["day_type"]) == (6, True, "Weekend")
    assert (row["pickup_month"], row["pickup_month_label"]) == (date(2024, 1, 1), "2024-01")
    assert row["total_revenue_mln"] == 2.35
    if sum(counts) == 0:
        assert row["short_trips_share"] == 0.0
    assert share_sum_mismatches(metrics).isEmpty()


def test_coverage(spark):
    mart = build(spark, schemas.HOURLY, [hour(8, "short", 1, 1.0), hour(8, "short", 1, 1.0, day=NEXT)])
    row = reports.table_coverage({"gold_hourly_trips": mart}).first()
    assert tuple(row) == ("gold_hourly_trips", 2, DAY, NEXT, 2)
