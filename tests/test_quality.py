from datetime import datetime

import pytest
from pyspark.sql import functions as F

from faremill.operators import quality
from faremill.operators.quality import MonthBounds

SCHEMA = (
    "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp,"
    " trip_distance double, fare_amount double, total_amount double,"
    " passenger_count bigint, payment_type bigint, PULocationID int, DOLocationID int"
)
JANUARY = MonthBounds.of("2024", "01")
START = datetime(2024, 1, 15, 10)
END = datetime(2024, 1, 15, 10, 30)
GOOD = (START, END, 3.5, 15.0, 20.0, 1, 1, 100, 200)


def with_changes(**changes):
    names = [part.split()[0] for part in SCHEMA.split(",")]
    return tuple(changes.get(name, value) for name, value in zip(names, GOOD))


@pytest.fixture
def flag(spark):
    def run(*rows):
        frame = spark.createDataFrame(list(rows), SCHEMA)
        return quality.add_quality_flags(frame, JANUARY)

    return run


def flags_of(flagged):
    names = quality.flag_columns(flagged)
    return [
        {name for name in names if row[name] is True} for row in flagged.collect()
    ]


def test_good_row(flag):
    flagged = flag(GOOD)
    assert len(quality.flag_columns(flagged)) == 13
    assert flagged.first()["trip_duration_minutes"] == 30.0
    assert flags_of(flagged) == [set()]
    assert all(flagged.first()[name] is False for name in quality.flag_columns(flagged))


def test_every_flag(flag):
    found = flags_of(
        flag(
            with_changes(tpep_pickup_datetime=None),
            with_changes(
                tpep_pickup_datetime=datetime(2024, 2, 1),
                tpep_dropoff_datetime=datetime(2024, 2, 1, 0, 30),
            ),
            with_changes(tpep_dropoff_datetime=None),
            with_changes(tpep_dropoff_datetime=datetime(2024, 1, 15, 9, 59)),
            with_changes(
                trip_distance=0.0,
                fare_amount=-1.0,
                total_amount=-5.0,
                passenger_count=0,
                payment_type=99,
                PULocationID=0,
                DOLocationID=-1,
            ),
            with_changes(
                tpep_dropoff_datetime=datetime(2024, 1, 16, 12, 1), trip_distance=101.0
            ),
            with_changes(payment_type=None, PULocationID=None, DOLocationID=None),
            with_changes(passenger_count=None, total_amount=0.0, fare_amount=0.0),
        )
    )
    assert found == [
        {"dq_null_pickup"},
        {"dq_outside_month"},
        {"dq_null_dropoff"},
        {"dq_wrong_time", "dq_bad_duration"},
        {
            "dq_bad_distance",
            "dq_bad_fare",
            "dq_bad_total",
            "dq_bad_passenger",
            "dq_bad_payment_type",
            "dq_bad_pickup_location",
            "dq_bad_dropoff_location",
        },
        {"dq_bad_duration", "dq_outlier_distance"},
        {"dq_bad_payment_type", "dq_bad_pickup_location", "dq_bad_dropoff_location"},
        set(),
    ]


def test_month_edges(flag):
    rows = [
        with_changes(
            tpep_pickup_datetime=start,
            tpep_dropoff_datetime=datetime(2024, 2, 1, 0, 10),
        )
        for start in (datetime(2024, 1, 31, 23, 59, 59), datetime(2024, 2, 1))
    ]
    december = with_changes(tpep_pickup_datetime=datetime(2023, 12, 31, 23, 59))
    outside = [row["dq_outside_month"] for row in flag(*rows, december).collect()]
    assert outside == [False, True, True]


def test_bounds_from_period_columns_match_fixed_bounds(spark):
    rows = [
        (*with_changes(tpep_pickup_datetime=datetime(y, m, d)), "2023", "12")
        for y, m, d in ((2023, 12, 1), (2023, 11, 30), (2023, 12, 31), (2024, 1, 1))
    ]
    frame = spark.createDataFrame(rows, f"{SCHEMA}, year string, month string")
    for bounds in (MonthBounds.per_row(), MonthBounds.of(2023, 12)):
        flagged = quality.add_quality_flags(frame, bounds)
        outside = [row["dq_outside_month"] for row in flagged.collect()]
        assert outside == [False, True, False, True]


def test_split_keeps_rows_that_flags_cannot_decide(flag):
    flagged = flag(
        GOOD,
        with_changes(trip_distance=0.0),
        with_changes(trip_distance=None),
        with_changes(fare_amount=None, payment_type=99),
        with_changes(total_amount=None),
    )
    parts = {
        "clean": quality.clean_trips(flagged),
        "bad": quality.bad_records(flagged),
        "undetermined": quality.undetermined_trips(flagged),
    }
    assert {name: part.count() for name, part in parts.items()} == {
        "clean": 1,
        "bad": 2,
        "undetermined": 2,
    }
    status = quality.row_status(quality.flag_columns(flagged))
    counts = flagged.groupBy(status.alias("s")).count().collect()
    assert {r["s"]: r["count"] for r in counts} == {
        name: part.count() for name, part in parts.items()
    }


def test_reason_names_the_true_flags(flag):
    bad = quality.bad_records(flag(with_changes(trip_distance=-1.0, payment_type=7)))
    assert bad.first()["dq_reason"] == "dq_bad_distance; dq_bad_payment_type"


def test_no_flags_is_an_error():
    with pytest.raises(ValueError, match="no data quality columns"):
        quality.bad_row([])


def test_silver_drops_flags_and_adds_attributes(flag):
    silver = quality.silver_trips(quality.clean_trips(flag(GOOD)))
    row = silver.first()
    assert not quality.flag_columns(silver)
    assert (str(row["pickup_date"]), row["pickup_hour"]) == ("2024-01-15", 10)
    assert (row["pickup_month"], row["trip_type"]) == ("2024-01", "medium")
    assert row["silver_load_timestamp"] is not None


def test_report(flag):
    report = quality.quality_report(
        flag(GOOD, with_changes(trip_distance=0.0), with_changes(trip_distance=None))
    )
    rows = {row["check"]: row for row in report.collect()}
    assert len(rows) == 15
    assert rows["dq_bad_distance"]["failed_rows"] == 1
    assert rows["total_bad"]["failed_rows"] == 1
    assert rows["total_bad"]["share"] == pytest.approx(1 / 3)
    assert rows["dq_bad_fare"]["share"] == 0.0


def test_report_of_nothing(flag):
    report = quality.quality_report(flag(GOOD).where(F.lit(False)))
    assert {row["share"] for row in report.collect()} == {0.0}


def test_retention(flag):
    kept = quality.row_retention(flag(GOOD, GOOD, with_changes(trip_distance=0.0)))
    assert tuple(kept.first()) == (3, 2, 2 / 3)


def test_ingest_metadata(spark):
    raw = spark.createDataFrame([(1, "2024", "05")], "x int, year string, month string")
    row = quality.add_ingest_metadata(raw).first()
    assert (row["source_year"], row["source_month"]) == ("2024", "05")
    assert row["source_system"] and row["load_timestamp"] is not None
