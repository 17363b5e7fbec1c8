from datetime import date

import pytest

from checks import queries
from faremill import schemas
from faremill.operators import marts

SPRING = date(2019, 4, 30)
AUTUMN = date(2021, 10, 2)
NAN, INF = float("nan"), float("inf")


def test_daily_splits_days_and_classes(spark):
    trips = spark.createDataFrame(
        [
            (SPRING, 7.25, 0.9, 4.5, "short"),
            (SPRING, 8.26, 1.4, 6.0, "short"),
            (SPRING, 61.4, 17.3, 48.25, "long"),
            (AUTUMN, 13.1, 3.75, 11.0, "medium"),
        ],
        "pickup_date date, total_amount double, trip_distance double,"
        " trip_duration_minutes double, trip_type string",
    )
    mart = marts.daily_mart(trips)
    assert mart.columns == schemas.DAILY.names
    assert sorted(map(tuple, mart.collect())) == [
        (SPRING, 3, 76.91, 25.64, 6.53, 19.58, 2, 0, 1, "2019", "04"),
        (AUTUMN, 1, 13.1, 13.1, 3.75, 11.0, 0, 1, 0, "2021", "10"),
    ]


def test_hourly_keeps_hours_of_a_day_apart(spark):
    trips = spark.createDataFrame(
        [
            (AUTUMN, 0, "long", 44.0, 11.5, 31.0),
            (AUTUMN, 23, "long", 52.5, 14.25, 40.0),
            (AUTUMN, 23, "long", 47.0, 12.0, 33.5),
        ],
        "pickup_date date, pickup_hour int, trip_type string, total_amount double,"
        " trip_distance double, trip_duration_minutes double",
    )
    rows = {row["pickup_hour"]: tuple(row) for row in marts.hourly_mart(trips).collect()}
    assert rows[0][3:8] == (1, 44.0, 44.0, 11.5, 31.0)
    assert rows[23][3:8] == (2, 99.5, 49.75, 13.13, 36.75)


@pytest.mark.parametrize(
    "amounts, tips, expected",
    [
        ((18.4, 9.6, 12.0), (3.0, 0.0, 1.2), (40.0, 13.33, 4.2, 1.4, 0.105)),
        ((25.0, -25.0), (1.5, 0.5), (0.0, 0.0, 2.0, 1.0, 0.0)),
        ((7.0, 5.0), (None, None), (12.0, 6.0, None, None, None)),
        ((8.0, 12.0, 4.0), (None, 2.4, None), (24.0, 8.0, 2.4, 2.4, 0.1)),
        # a value that is not finite is in neither the sum nor the mean
        ((NAN, 11.0, 22.0, INF), (1.0, NAN, 2.0, 3.0), (33.0, 16.5, 6.0, 2.0, 0.1818)),
    ],
)
def test_payment(spark, amounts, tips, expected):
    trips = spark.createDataFrame(
        [(SPRING, "medium", 2, a, t) for a, t in zip(amounts, tips)],
        "pickup_date date, trip_type string, payment_type bigint,"
        " total_amount double, tip_amount double",
    )
    row = marts.payment_mart(trips).first()
    assert (row["payment_type_name"], row["trips_count"]) == ("Cash", len(amounts))
    assert (
        row["total_revenue"],
        row["avg_check"],
        row["total_tips"],
        row["avg_tip"],
        row["tips_share_from_revenue"],
    ) == expected


ROUTES = (
    "pickup_date date, trip_type string, PULocationID int, DOLocationID int,"
    " total_amount double, trip_distance double, trip_duration_minutes double"
)


@pytest.fixture
def zones(spark):
    return spark.createDataFrame(
        [
            ("31", "Riverside", "Mill Lane", "North"),
            ("47", "Harbour", "Old Quay", "South"),
            ("x1", "Unused", "No number", "South"),
        ],
        schemas.ZONE_LOOKUP,
    )


def test_route_names_both_ends(spark, zones):
    trips = spark.createDataFrame(
        [
            (AUTUMN, "medium", 47, 31, 16.2, 4.1, 13.0),
            (AUTUMN, "medium", 47, 31, 15.3, 3.8, 12.0),
            (AUTUMN, "medium", 47, 31, 18.0, 4.4, 17.0),
        ],
        ROUTES,
    )
    mart = marts.route_mart(trips, zones)
    assert mart.columns == schemas.ROUTE.names
    assert tuple(mart.first()) == (
        AUTUMN, "medium", 47, "Harbour", "Old Quay", "South",
        31, "Riverside", "Mill Lane", "North",
        3, 49.5, 16.5, 4.1, 14.0, "2021", "10",
    )


def test_zones_missing_from_the_lookup_have_no_names(spark, zones):
    trips = spark.createDataFrame(
        [(SPRING, "long", 31, 260, 38.0, 10.2, 27.0), (SPRING, "long", 5, 47, 41.0, 11.9, 30.0)],
        ROUTES,
    )
    rows = {row["pickup_location_id"]: row for row in marts.route_mart(trips, zones).collect()}
    parts = ("borough", "zone", "service_zone")
    assert [rows[31][f"dropoff_{p}"] for p in parts] == [None] * 3
    assert [rows[31][f"pickup_{p}"] for p in parts] == ["Riverside", "Mill Lane", "North"]
    assert [rows[5][f"pickup_{p}"] for p in parts] == [None] * 3


def test_marts_from_the_cube_equal_direct_marts(spark, small):
    trips = queries.silver(spark, small)
    cube = marts.trip_cube(trips)
    for direct, rolled in (
        (marts.daily_mart(trips), marts.daily_mart_from(cube)),
        (marts.hourly_mart(trips), marts.hourly_mart_from(cube)),
        (marts.payment_mart(trips), marts.payment_mart_from(cube)),
    ):
        assert direct.columns == rolled.columns
        first, second = direct.toArrow().to_pylist(), rolled.toArrow().to_pylist()
        assert sorted(map(repr, first)) == sorted(map(repr, second))
        assert first


def test_aggregation_comes_before_the_zone_join(spark, small):
    mart = queries.route(spark, small)
    plan = mart._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftOuter") < plan.index("Aggregate")


def test_a_hot_key_is_combined_before_the_shuffle(spark, small):
    plan = queries.daily(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "BroadcastNestedLoopJoin" not in plan
