from datetime import date, datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from faremill import schemas
from faremill.operators import data_tests, gates
from faremill.operators.gates import GateError
from faremill.operators.quality import MonthBounds

JANUARY = MonthBounds.of(2024, 1)
SILVER = (
    "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp,"
    " pickup_date date, pickup_hour int, PULocationID int, DOLocationID int,"
    " payment_type bigint, trip_distance double, total_amount double"
)
GOOD = (
    datetime(2024, 1, 15, 10), datetime(2024, 1, 15, 10, 30), date(2024, 1, 15),
    10, 100, 200, 1, 3.5, 20.0,
)
BAD = (
    datetime(2024, 2, 1), datetime(2024, 2, 1, 0, 30), date(2024, 2, 1),
    24, 0, -1, 99, 0.0, 0.0,
)


def test_silver_metrics(spark):
    frame = spark.createDataFrame([GOOD, BAD, (None,) * 9], SILVER)
    row = gates.silver_gate(JANUARY).profile(frame).first().asDict()
    assert row.pop("silver_count") == 3
    expected = {f"null_{name}": 1 for name in gates.REQUIRED_TRIP_COLUMNS}
    expected |= {
        "outside_month_count": 1,  # a NULL date does not count here
        "invalid_payment_type_count": 2,
        "invalid_pickup_location_count": 2,
        "invalid_dropoff_location_count": 2,
        "invalid_pickup_hour_count": 2,
        "invalid_distance_count": 1,
        "invalid_amount_count": 1,
    }
    assert row == expected


def silver_counts(**changes):
    gate = gates.silver_gate(JANUARY)
    values = {rule.metric: 0 for rule in gate.rules}
    return Row(**{**values, "silver_count": 90, **changes})


@pytest.mark.parametrize(
    "metric, message",
    [
        ("outside_month_count", "pickups of another month"),
        ("null_pickup_date", "pickup_date is not filled"),
        ("invalid_payment_type_count", "unknown payment codes"),
        ("invalid_pickup_location_count", "no pickup zone"),
        ("invalid_dropoff_location_count", "no dropoff zone"),
        ("invalid_pickup_hour_count", "no hour of a day"),
        ("invalid_distance_count", "no distance"),
    ],
)
def test_silver_errors(metric, message):
    with pytest.raises(GateError, match=message):
        gates.silver_gate(JANUARY).judge(silver_counts(**{metric: 1}))


def test_silver_judgement():
    gate = gates.silver_gate(JANUARY)
    assert gate.judge(silver_counts()) == []
    assert "as after a refund" in gate.judge(silver_counts(invalid_amount_count=2))[0]
    with pytest.raises(GateError, match="silver is empty"):
        gate.judge(silver_counts(silver_count=0))
    with pytest.raises(GateError, match="another month"):  # order of rules
        gate.judge(silver_counts(outside_month_count=1, null_pickup_date=1))


def test_inline_gate(spark):
    frame = spark.createDataFrame([GOOD, BAD], SILVER)
    row = gates.silver_inline_gate(JANUARY).profile(frame).first()
    assert (row["outside_month_count"], row["invalid_pickup_hour_count"]) == (1, 1)


def test_retention():
    gates.check_retention(100, 70)
    for bronze, silver, message in (
        (0, 90, "bronze is empty"),
        (100, 0, "silver is empty"),
        (100, 60, "only 60 of 100"),
    ):
        with pytest.raises(GateError, match=message):
            gates.check_retention(bronze, silver)


def test_mart_gate_counts_null_dates_and_hours(spark):
    days = [date(2024, 1, 15), date(2024, 2, 1), None]
    daily = spark.createDataFrame([(day,) for day in days], "pickup_date date")
    row = gates.mart_gate(schemas.DAILY.name, JANUARY).profile(daily).first()
    assert (row["rows_count"], row["outside_month_count"]) == (3, 2)

    hourly = spark.createDataFrame(
        [(days[0], t, h, 1) for t, h in
         [("short", 10), ("", 24), ("   ", -1), (None, None)]],
        "pickup_date date, trip_type string, pickup_hour int, trips_count bigint",
    )
    before = gates.mart_gate(schemas.HOURLY.name, JANUARY).profile(hourly).first()
    assert before["empty_trip_type_count"] == 3
    assert before["invalid_pickup_hour_count"] == 3
    after = gates.serving_month_gate(schemas.HOURLY.name, JANUARY).profile(hourly)
    assert after.first()["invalid_pickup_hour_count"] == 2  # a NULL hour passes


def test_payment_and_route_gates(spark):
    day = date(2024, 1, 15)
    payment = spark.createDataFrame(
        [(day, "short", "Cash"), (day, "short", " "), (day, None, None)],
        "pickup_date date, trip_type string, payment_type_name string",
    )
    row = gates.mart_gate(schemas.PAYMENT.name, JANUARY).profile(payment).first()
    assert (row["empty_trip_type_count"], row["empty_payment_type_name_count"]) == (1, 2)
    route = spark.createDataFrame(
        [(day, "short", "A", "B"), (day, "short", None, ""), (day, "long", "C", None)],
        "pickup_date date, trip_type string, pickup_zone string, dropoff_zone string",
    )
    gate = gates.mart_gate(schemas.ROUTE.name, JANUARY)
    row = gate.profile(route).first()
    assert (row["empty_pickup_zone_count"], row["empty_dropoff_zone_count"]) == (1, 2)
    with pytest.raises(GateError, match="pickup_zone is blank"):
        gate.judge(row)


def test_enforce_per_month_names_the_month_and_absent_months(spark):
    daily = spark.createDataFrame(
        [(date(2024, 1, 5), 3, "2024", "01"), (date(2024, 3, 5), 0, "2024", "02")],
        "pickup_date date, trips_count bigint, year string, month string",
    )
    gate = gates.serving_month_gate(schemas.DAILY.name, MonthBounds.per_row())
    with pytest.raises(GateError, match="2024-02: pickup dates of another month"):
        gate.enforce(daily, ["year", "month"])
    with pytest.raises(GateError, match="no rows for .*'03'"):
        gate.enforce(daily, ["year", "month"], [("2024", "01"), ("2024", "03")])
    with pytest.raises(GateError, match="without trips"):
        fixed = daily.withColumn("pickup_date", F.make_date("year", "month", F.lit(5)))
        gate.enforce(fixed, ["year", "month"])


def test_full_range(spark):
    daily = spark.createDataFrame(
        [(date(2024, 1, 1),), (date(2024, 2, 29),)], "pickup_date date"
    )
    row = gates.full_range_gate(schemas.DAILY.name).profile(daily).first()
    gates.check_full_range(row, schemas.DAILY.name, date(2024, 1, 1), date(2024, 2, 29))
    with pytest.raises(GateError, match="instead of 2024-01-01 to 2024-03-31"):
        gates.check_full_range(
            row, schemas.DAILY.name, date(2024, 1, 1), date(2024, 3, 31)
        )
    empty = gates.full_range_gate(schemas.DAILY.name).profile(daily.limit(0)).first()
    with pytest.raises(GateError, match="is empty"):
        gates.check_full_range(empty, schemas.DAILY.name, None, None)


def test_contract(spark):
    names = ", ".join(f"{n} {t}" for n, t in schemas.DAILY.columns)
    full = spark.createDataFrame([], f"{names}, gold_load_timestamp timestamp, extra int")
    gates.check_contract(full, schemas.DAILY)
    with pytest.raises(GateError, match="lacks .*avg_check"):
        gates.check_contract(full.drop("avg_check"), schemas.DAILY)
    with pytest.raises(GateError, match="month is int"):
        gates.check_contract(
            full.withColumn("month", F.lit(1)), schemas.DAILY
        )


def centroids(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.ZONE_CENTROIDS)


def test_centroid_checks(spark):
    limits = gates.CentroidLimits(rows=3, duplicate_ids=1)
    good = [(1, "B", "Z", -73.9, 40.7), (1, "B", "Z", -73.8, 40.6), (2, "B", "Y", -74.0, 40.5)]

    def check(*rows):
        return gates.check_centroids(
            gates.centroid_profile(centroids(spark, *rows)).first(), limits
        )

    assert check(*good) == ["zone points: some zones have several"]
    for rows, message in (
        (good[:2], "2 rows instead of 3"),
        ([good[0]] * 3, "2 repeat a zone"),
        ([*good[:2], (2, " ", "Y", -74.0, 40.5)], "borough is empty"),
        ([*good[:2], (2, "B", "", -74.0, 40.5)], "zone is empty"),
        ([*good[:2], (2, "B", "Y", 40.5, -74.0)], "latitude reaches"),
        ([*good[:2], (2, "B", "Y", -76.0, 40.5)], "longitude reaches"),
    ):
        with pytest.raises(GateError, match=message):
            check(*rows)


def test_declared_model_tests():
    kinds = [t.kind for tests in data_tests.MODEL_TESTS.values() for t in tests]
    counts = {kind: kinds.count(kind) for kind in set(kinds)}
    assert counts == {"not_null": 52, "unique": 3, "accepted_values": 11}


def test_column_tests_find_failures(spark):
    day = date(2024, 1, 15)
    frame = spark.createDataFrame(
        [(day, 1, 2.0), (day, None, 2.0), (None, 3, None)],
        "pickup_date date, trips_count bigint, total_revenue double",
    )
    rows = data_tests.run_column_tests(frame, "stg_daily_trips").collect()
    assert {(r["column_name"], r["test"]): r["failures"] for r in rows} == {
        ("pickup_date", "not_null"): 1,
        ("trips_count", "not_null"): 1,
        ("total_revenue", "not_null"): 1,
        ("pickup_date", "unique"): 1,
    }


def test_accepted_values_ignore_null(spark):
    frame = spark.createDataFrame([(6,), (0,), (None,)], "payment_type bigint")
    test = data_tests.ColumnTest("payment_type", "accepted_values", tuple(range(6)))
    assert frame.agg(test.failures().alias("n")).first()["n"] == 1
    with pytest.raises(ValueError, match="unknown column test"):
        data_tests.ColumnTest("x", "other").failures()


def test_assertions_find_broken_rows(spark):
    day = date(2024, 1, 15)
    hourly = spark.createDataFrame(
        [(day, 10, "short"), (day, 10, "short"), (day, 24, "short"), (day, None, "long")],
        "pickup_date date, pickup_hour int, trip_type string",
    )
    grain = data_tests.duplicate_grain(hourly, schemas.HOURLY.grain)
    assert [tuple(r) for r in grain.collect()] == [(day, 10, "short", 2)]
    assert [r["pickup_hour"] for r in data_tests.hours_out_of_range(hourly).collect()] == [24]

    daily = spark.createDataFrame(
        [(day, 6, 1, 2, 3), (day, 7, 1, 2, 3)],
        "pickup_date date, trips_count bigint, short_trips_count bigint,"
        " medium_trips_count bigint, long_trips_count bigint",
    )
    broken = data_tests.class_count_mismatches(daily).collect()
    assert [r["classified_trips_count"] for r in broken] == [6]

    shares = spark.createDataFrame(
        [(day, 6, 0.3333, 0.3333, 0.3333), (day, 6, 0.5, 0.4, 0.0), (day, 0, 0.0, 0.0, 0.0)],
        "pickup_date date, trips_count bigint, short_trips_share double,"
        " medium_trips_share double, long_trips_share double",
    )
    off = data_tests.share_sum_mismatches(shares).collect()
    assert [r["short_trips_share"] for r in off] == [0.5]
