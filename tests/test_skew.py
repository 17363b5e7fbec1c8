"""A third of all trips on one day, class and route, against brute force."""

from decimal import ROUND_HALF_UP, Decimal

import pytest

from faremill import schemas
from faremill.operators import marts
from faremill.plans import reports

ROWS = 30_000


@pytest.fixture(scope="module")
def trips(spark):
    return spark.range(ROWS).selectExpr(
        "date_add(DATE'2024-01-01', if(id % 3 = 0, 5, cast(id % 31 AS int))) AS pickup_date",
        "if(id % 3 = 0, 9, cast(id % 24 AS int)) AS pickup_hour",
        "CASE WHEN id % 3 = 0 OR id % 5 = 0 THEN 'short' WHEN id % 7 = 0 THEN 'long'"
        " ELSE 'medium' END AS trip_type",
        "if(id % 3 = 0, 1, cast(id % 40 AS int)) AS PULocationID",
        "if(id % 3 = 0, 2, cast(id % 37 AS int)) AS DOLocationID",
        "cast(id % 7 AS bigint) AS payment_type",
        "(id % 9973) / 100 AS total_amount",
        "if(id % 11 = 0, null, (id % 501) / 100) AS tip_amount",
        "(id % 1999 + 1) / 100 AS trip_distance",
        "(id % 5000 + 1) / 60 AS trip_duration_minutes",
    )


@pytest.fixture(scope="module")
def zones(spark):
    return spark.range(30).selectExpr(
        "cast(id AS string) AS LocationID", "'Queens' AS Borough",
        "concat('Zone ', id) AS Zone", "'Boro' AS service_zone",
    )


def half_up(value, places):
    return float(value.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


def brute_force_routes(trips):
    groups = {}
    for row in trips.collect():
        key = (row["pickup_date"], row["trip_type"], row["PULocationID"], row["DOLocationID"])
        cents = round(row["total_amount"] * 100)
        seconds = round(row["trip_duration_minutes"] * 60)
        sums = groups.setdefault(key, [0, 0, 0])
        sums[0] += 1
        sums[1] += cents
        sums[2] += seconds
    return {
        key: (
            n,
            half_up(Decimal(cents) / 100, 2),
            half_up(Decimal(cents) / (100 * n), 2),
            half_up(Decimal(seconds) / (60 * n), 2),
        )
        for key, (n, cents, seconds) in groups.items()
    }


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_hot_route_with_and_without_broadcast(spark, trips, zones, threshold):
    """The same result from a broadcast join and from a sort-merge join."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, threshold)
    try:
        mart = marts.route_mart(trips, zones)
        found = {
            tuple(row[name] for name in schemas.ROUTE.grain): row
            for row in mart.collect()
        }
        plan = mart._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert ("SortMergeJoin" in plan) == (threshold == "-1")
    expected = brute_force_routes(trips)
    assert len(found) == len(expected)
    for key, values in expected.items():
        row = found[key]
        assert values == (
            row["trips_count"],
            row["total_revenue"],
            row["avg_check"],
            row["avg_trip_duration_minutes"],
        )
        known = key[2] < 30
        assert row["pickup_zone"] == (f"Zone {key[2]}" if known else None)
    assert max(n for n, *_ in expected.values()) >= ROWS // 3


def test_partitioning_does_not_change_a_mart(trips):
    results = {
        tuple(sorted(map(repr, marts.payment_mart(trips.repartition(n)).collect())))
        for n in (1, 5, 16)
    }
    assert len(results) == 1


def test_ranks_are_cut_before_the_shuffle(trips, zones):
    top = reports.top_zones_by_type(marts.route_mart(trips, zones))
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # in the map task and after it
    rows = top.collect()
    assert all(row["zone_rank"] <= 3 for row in rows)
    first = [r for r in rows if (r["zone_role"], r["trip_type"]) == ("pickup", "short")][0]
    assert first["zone"] == "Zone 1" and first["trips_count"] >= ROWS // 3
