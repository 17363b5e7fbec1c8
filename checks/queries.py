"""Every implemented operator as a query over the shared test tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture
from faremill import schemas
from faremill.operators import data_tests, gates, marts, periods, quality
from faremill.operators.periods import in_periods
from faremill.operators.quality import MonthBounds
from faremill.plans import models, reports
from faremill.sources.layers import conform

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PERIOD = ["year", "month"]
PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"
# what every mart but the payments' reads
UNTIPPED = [name for name in fixture.TRIP if name != "tip_amount"]
PER_ROW = MonthBounds.per_row()


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.add_ingest_metadata(fixture.raw_trips(spark, sf_dir), stamp=False)


def flagged(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None
) -> DataFrame:
    trips = fixture.raw_trips(spark, sf_dir, columns)
    return quality.add_quality_flags(trips, PER_ROW)


def silver(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Clean trips for the marts, odd amounts among them."""
    trips = fixture.raw_trips(spark, sf_dir, columns, fixture.ODD)
    clean = quality.clean_trips(quality.add_quality_flags(trips, PER_ROW))
    return quality.silver_trips(clean, stamp=False)


def audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged trips from files whose columns have other types."""
    trips = conform(fixture.raw_trips(spark, sf_dir, values=fixture.DRIFTED))
    return quality.add_quality_flags(trips, PER_ROW)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_mart(silver(spark, sf_dir, UNTIPPED))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.hourly_mart(silver(spark, sf_dir, UNTIPPED))


def payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.payment_mart(silver(spark, sf_dir))


def route(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = silver(spark, sf_dir, UNTIPPED)
    return marts.route_mart(trips, fixture.zone_lookup(spark, sf_dir))


def all_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four marts as the pipeline builds them: three from one cube.

    Queries that need the same parts of the cube also share its shuffle.
    """
    trips = silver(spark, sf_dir)
    cube = marts.trip_cube(trips)
    return {
        schemas.DAILY.name: marts.daily_mart_from(cube),
        schemas.HOURLY.name: marts.hourly_mart_from(cube),
        schemas.ROUTE.name: marts.route_mart(trips, fixture.zone_lookup(spark, sf_dir)),
        schemas.PAYMENT.name: marts.payment_mart_from(cube),
    }


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.daily_metrics(models.stage_mart(daily(spark, sf_dir), schemas.DAILY))


def kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.daily_kpis(metrics(spark, sf_dir))


def raw_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.discover_periods(fixture.raw_file_keys(spark, sf_dir))


def order_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The confirmed range: first to last month with an order."""
    orders = fixture.table(spark, sf_dir, "orders")
    return orders.agg(
        F.min(F.to_date("o_orderdate")).alias("start"),
        F.max(F.to_date("o_orderdate")).alias("end"),
    )


# --- scans, ingest and row-level quality ---------------------------------------


@query
def scan_month(spark, sf_dir):
    """Rows of three raw months with the sums a month scan is checked by."""
    chosen = in_periods([("1995", "03"), ("1995", "11"), ("1997", "01")])
    trips = fixture.raw_trips(spark, sf_dir, [PICKUP, *PERIOD]).where(chosen)
    return trips.groupBy(*PERIOD).agg(
        F.count("*").alias("trips"),
        F.count("tpep_pickup_datetime").alias("with_pickup"),
        F.min("tpep_pickup_datetime").alias("first_pickup"),
        F.max("tpep_pickup_datetime").alias("last_pickup"),
    )


@query
def bronze_meta(spark, sf_dir):
    return bronze(spark, sf_dir)


@query
def trip_duration(spark, sf_dir):
    trips = fixture.raw_trips(spark, sf_dir, [PICKUP, DROPOFF])
    return quality.add_duration(trips)


@query
def dq_flags(spark, sf_dir):
    return flagged(spark, sf_dir)


@query
def bad_records(spark, sf_dir):
    return quality.bad_records(flagged(spark, sf_dir))


@query
def clean_trips(spark, sf_dir):
    return quality.clean_trips(flagged(spark, sf_dir))


@query
def undetermined_trips(spark, sf_dir):
    return quality.undetermined_trips(flagged(spark, sf_dir))


@query
def silver_trips(spark, sf_dir):
    clean = quality.clean_trips(flagged(spark, sf_dir))
    return quality.silver_trips(clean, stamp=False)


@query
def dq_report(spark, sf_dir):
    return quality.quality_report(audited(spark, sf_dir), PERIOD)


@query
def dq_drift(spark, sf_dir):
    return quality.bad_share_drift(
        quality.quality_report(audited(spark, sf_dir), PERIOD)
    )


@query
def row_retention(spark, sf_dir):
    kept = quality.row_retention(flagged(spark, sf_dir, UNTIPPED), PERIOD)
    return kept.withColumn(
        "passed", F.col("retained_share") >= gates.MIN_RETAINED_SHARE
    )


# --- marts ---------------------------------------------------------------------


@query
def daily_mart(spark, sf_dir):
    return daily(spark, sf_dir)


@query
def hourly_mart(spark, sf_dir):
    return hourly(spark, sf_dir)


@query
def payment_mart(spark, sf_dir):
    return payment(spark, sf_dir)


@query
def route_mart(spark, sf_dir):
    return route(spark, sf_dir)


@query
def loaded_month_count(spark, sf_dir):
    parts = [
        mart.groupBy(*PERIOD)
        .agg(F.count("*").alias("rows_count"))
        .select(F.lit(name).alias("table_name"), *PERIOD, "rows_count")
        for name, mart in all_marts(spark, sf_dir).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def table_coverage(spark, sf_dir):
    return reports.table_coverage(all_marts(spark, sf_dir))


# --- models --------------------------------------------------------------------


@query
def stg_daily(spark, sf_dir):
    return models.stage_mart(daily(spark, sf_dir), schemas.DAILY)


@query
def stg_hourly(spark, sf_dir):
    return models.stage_mart(hourly(spark, sf_dir), schemas.HOURLY)


@query
def stg_payment(spark, sf_dir):
    return models.stage_mart(payment(spark, sf_dir), schemas.PAYMENT)


@query
def stg_route(spark, sf_dir):
    return models.stage_mart(route(spark, sf_dir), schemas.ROUTE)


@query
def stg_centroids(spark, sf_dir):
    return models.stage_centroids(fixture.zone_centroids(spark, sf_dir))


@query
def daily_metrics(spark, sf_dir):
    return metrics(spark, sf_dir)


@query
def daily_kpis(spark, sf_dir):
    return kpis(spark, sf_dir)


# --- reports -------------------------------------------------------------------


@query
def top_pickup_zones(spark, sf_dir):
    return reports.top_pickup_zones(route(spark, sf_dir))


@query
def top_dropoff_zones(spark, sf_dir):
    return reports.top_dropoff_zones(route(spark, sf_dir))


@query
def peak_hours(spark, sf_dir):
    return reports.peak_hours(hourly(spark, sf_dir))


@query
def trip_type_distribution(spark, sf_dir):
    return reports.trip_type_distribution(hourly(spark, sf_dir))


@query
def peak_hours_by_type(spark, sf_dir):
    return reports.peak_hours_by_type(hourly(spark, sf_dir))


@query
def top_zones_by_type(spark, sf_dir):
    return reports.top_zones_by_type(route(spark, sf_dir))


@query
def payment_by_type(spark, sf_dir):
    return reports.payment_by_type(payment(spark, sf_dir))


@query
def payment_trends(spark, sf_dir):
    return reports.payment_trends(payment(spark, sf_dir))


@query
def rideshare_candidates(spark, sf_dir):
    return reports.rideshare_candidates(route(spark, sf_dir))


@query
def rideshare_vehicle_model(spark, sf_dir):
    return reports.rideshare_vehicle_model(route(spark, sf_dir))


@query
def zone_demand_map(spark, sf_dir):
    return reports.zone_demand_map(
        route(spark, sf_dir), fixture.zone_centroids(spark, sf_dir)
    )


# --- periods -------------------------------------------------------------------


@query
def discover_periods(spark, sf_dir):
    return raw_periods(spark, sf_dir)


@query
def table_periods(spark, sf_dir):
    return periods.table_periods(all_marts(spark, sf_dir))


@query
def processed_periods(spark, sf_dir):
    return periods.fully_processed(all_marts(spark, sf_dir))


@query
def new_periods(spark, sf_dir):
    done = periods.fully_processed(all_marts(spark, sf_dir))
    return periods.new_periods(raw_periods(spark, sf_dir), done)


@query
def month_sequence(spark, sf_dir):
    return periods.month_sequence(periods.period_bounds(raw_periods(spark, sf_dir)))


@query
def missing_periods(spark, sf_dir):
    raw = raw_periods(spark, sf_dir)
    expected = periods.month_sequence(periods.period_bounds(raw))
    return periods.missing_periods(raw, expected)


@query
def unexpected_periods(spark, sf_dir):
    expected = periods.month_sequence(order_range(spark, sf_dir))
    return periods.unexpected_periods(raw_periods(spark, sf_dir), expected)


@query
def rebuild_gate(spark, sf_dir):
    expected = periods.month_sequence(order_range(spark, sf_dir))
    return periods.compare_periods(raw_periods(spark, sf_dir), expected)


@query
def month_bounds(spark, sf_dir):
    return periods.month_bounds(raw_periods(spark, sf_dir))


@query
def expected_range(spark, sf_dir):
    return periods.expected_range(raw_periods(spark, sf_dir))


# --- gates and data tests ------------------------------------------------------


def _gate(gate: gates.Gate, table: DataFrame, by: list[str]) -> DataFrame:
    return gate.profile(table, by).withColumn("passed", gate.passed())


@query
def gate_silver(spark, sf_dir):
    return _gate(gates.silver_gate(PER_ROW), silver(spark, sf_dir, UNTIPPED), PERIOD)


@query
def gate_silver_inline(spark, sf_dir):
    return _gate(gates.silver_inline_gate(PER_ROW), silver(spark, sf_dir, UNTIPPED), PERIOD)


def _mart_gate(contract, build) -> None:
    def run(spark, sf_dir):
        gate = gates.mart_gate(contract.name, PER_ROW)
        return _gate(gate, build(spark, sf_dir), PERIOD)

    QUERIES[f"gate_{build.__name__}"] = run


_mart_gate(schemas.DAILY, daily)
_mart_gate(schemas.HOURLY, hourly)
_mart_gate(schemas.PAYMENT, payment)
_mart_gate(schemas.ROUTE, route)


def _gate_each(tables: dict[str, DataFrame], gate_of, by: list[str]) -> DataFrame:
    """Profiles of several tables; counts a table does not have are NULL."""
    profiles = [
        _gate(gate_of(name), table, by).select(F.lit(name).alias("table_name"), "*")
        for name, table in tables.items()
    ]
    union = profiles[0]
    for profile in profiles[1:]:
        union = union.unionByName(profile, allowMissingColumns=True)
    return union


@query
def gate_month(spark, sf_dir):
    return _gate_each(
        all_marts(spark, sf_dir),
        lambda name: gates.serving_month_gate(name, PER_ROW),
        PERIOD,
    )


@query
def gate_full_range(spark, sf_dir):
    """Whole-table gate; the expected range is that of the trips' raw files."""
    profiles = _gate_each(all_marts(spark, sf_dir), gates.full_range_gate, [])
    return gates.with_expected_range(
        profiles, periods.expected_range(fixture.raw_trips(spark, sf_dir, PERIOD))
    )


@query
def centroid_checks(spark, sf_dir):
    return gates.centroid_profile(fixture.zone_centroids(spark, sf_dir))


def _column_tests(key: str, model: str, build) -> None:
    def run(spark, sf_dir):
        return data_tests.run_column_tests(build(spark, sf_dir), model)

    QUERIES[key] = run


_column_tests("expectations_daily", "stg_daily_trips", daily)
_column_tests("expectations_hourly", "stg_hourly_trips", hourly)
_column_tests("expectations_payment", "stg_payment_type_stats", payment)
_column_tests("expectations_route", "stg_location_pair_stats", route)
_column_tests(
    "expectations_centroids", "stg_taxi_zone_centroids", fixture.zone_centroids
)
_column_tests("expectations_metrics", "int_daily_trip_metrics", metrics)
_column_tests("expectations_kpis", "mart_daily_trip_kpis", kpis)


# The marts keep these rules, so each check gets a mart with some rows that break its rule.


def doubled(mart: DataFrame) -> DataFrame:
    return mart.unionByName(mart.where("trips_count % 3 = 1"))


@query
def grain_hourly(spark, sf_dir):
    mart = doubled(hourly(spark, sf_dir))
    return data_tests.duplicate_grain(mart, schemas.HOURLY.grain)


@query
def grain_route(spark, sf_dir):
    return data_tests.duplicate_grain(doubled(route(spark, sf_dir)), schemas.ROUTE.grain)


@query
def grain_payment(spark, sf_dir):
    mart = doubled(payment(spark, sf_dir))
    return data_tests.duplicate_grain(mart, schemas.PAYMENT.grain)


@query
def class_counts_match(spark, sf_dir):
    extra = F.when(F.day("pickup_date") == 13, 1).otherwise(0)
    mart = daily(spark, sf_dir)
    broken = mart.withColumn("long_trips_count", F.col("long_trips_count") + extra)
    return data_tests.class_count_mismatches(broken)


@query
def shares_sum_to_one(spark, sf_dir):
    checked = {"metrics": metrics(spark, sf_dir), "kpis": kpis(spark, sf_dir)}
    extra = F.when(F.day("pickup_date") == 17, 0.5).otherwise(0.0)
    parts = [
        data_tests.share_sum_mismatches(
            model.withColumn("short_trips_share", F.col("short_trips_share") + extra)
        ).select(F.lit(name).alias("model"), "*")
        for name, model in checked.items()
    ]
    return parts[0].unionByName(parts[1])


@query
def hour_range(spark, sf_dir):
    late = F.when(F.col("trip_type") == "long", -1).otherwise(24)
    hour = F.when(F.col("pickup_hour") == 23, late).otherwise(F.col("pickup_hour"))
    return data_tests.hours_out_of_range(
        hourly(spark, sf_dir).withColumn("pickup_hour", hour)
    )
