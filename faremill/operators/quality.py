"""Row-level quality: flags, the three-way split, reasons and the report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremill.functions.columns import VALID_PAYMENT_TYPES, trip_class, unsummable
from faremill.operators.periods import first_of_month, last_of_month

FLAG_PREFIX = "dq_"

# Fixed value: the name written with every ingested row.
SOURCE_SYSTEM = "nyc_taxi_yellow"

# columns of audits that are not part of a clean trip
AUDIT_COLUMNS = ("cast_refused", "cast_changed")
AMOUNTS = ("trip_distance", "fare_amount", "tip_amount", "total_amount")

MAX_TRIP_MINUTES = 1440
MAX_TRIP_DISTANCE = 100


@dataclass(frozen=True)
class MonthBounds:
    """The month a trip's pickup must fall in.

    ``template`` is SQL that is true for a ``{day}`` outside the month and NULL
    for a NULL day. A frame that holds many months takes each row's month from
    its own period columns.
    """

    template: str

    @classmethod
    def of(cls, year: int | str, month: int | str) -> MonthBounds:
        start = first_of_month(year, month)
        end = last_of_month(year, month)
        return cls(f"({{day}} < DATE'{start}' OR {{day}} > DATE'{end}')")

    @classmethod
    def per_row(cls, year: str = "year", month: str = "month") -> MonthBounds:
        expected = f"cast({year} AS int) * 12 + cast({month} AS int)"
        return cls(f"(year({{day}}) * 12 + month({{day}}) <> {expected})")

    def outside(self, day: str) -> str:
        return self.template.format(day=day)


def flag_rules(bounds: MonthBounds) -> dict[str, str]:
    """Flag name to SQL predicate, in report order.

    Distance, fare, total and time flags are NULL when their input is NULL.
    """
    codes = ", ".join(str(code) for code in VALID_PAYMENT_TYPES)
    pickup_day = "to_date(tpep_pickup_datetime)"
    return {
        "dq_null_pickup": "tpep_pickup_datetime IS NULL",
        "dq_outside_month": (
            f"tpep_pickup_datetime IS NOT NULL AND {bounds.outside(pickup_day)}"
        ),
        "dq_null_dropoff": "tpep_dropoff_datetime IS NULL",
        "dq_wrong_time": "tpep_dropoff_datetime <= tpep_pickup_datetime",
        "dq_bad_distance": "trip_distance <= 0",
        "dq_bad_fare": "fare_amount < 0",
        "dq_bad_total": "total_amount < 0",
        "dq_bad_passenger": "passenger_count IS NOT NULL AND passenger_count <= 0",
        "dq_bad_payment_type": (
            f"payment_type IS NULL OR payment_type NOT IN ({codes})"
        ),
        "dq_bad_pickup_location": "PULocationID IS NULL OR PULocationID <= 0",
        "dq_bad_dropoff_location": "DOLocationID IS NULL OR DOLocationID <= 0",
        "dq_bad_duration": (
            "trip_duration_minutes <= 0 "
            f"OR trip_duration_minutes > {MAX_TRIP_MINUTES}"
        ),
        "dq_outlier_distance": f"trip_distance > {MAX_TRIP_DISTANCE}",
    }


def add_ingest_metadata(
    raw: DataFrame, source_system: str = SOURCE_SYSTEM, stamp: bool = True
) -> DataFrame:
    """Bronze columns; the source period comes from the partition columns."""
    columns = {
        "source_system": F.lit(source_system),
        "source_year": F.col("year"),
        "source_month": F.col("month"),
    }
    if stamp:
        columns["load_timestamp"] = F.current_timestamp()
    return raw.withColumns(columns)


def add_duration(trips: DataFrame) -> DataFrame:
    seconds = F.unix_timestamp("tpep_dropoff_datetime") - F.unix_timestamp(
        "tpep_pickup_datetime"
    )
    return trips.withColumn("trip_duration_minutes", seconds / 60)


def add_quality_flags(trips: DataFrame, bounds: MonthBounds) -> DataFrame:
    rules = flag_rules(bounds)
    return add_duration(trips).withColumns(
        {name: F.expr(predicate) for name, predicate in rules.items()}
    )


def flag_columns(flagged: DataFrame) -> list[str]:
    return [name for name in flagged.columns if name.startswith(FLAG_PREFIX)]


def bad_row(flags: Sequence[str]) -> Column:
    """TRUE if any flag is, FALSE if all are FALSE, otherwise NULL."""
    if not flags:
        raise ValueError("no data quality columns found")
    return reduce(Column.__or__, [F.col(name) for name in flags])


def row_status(flags: Sequence[str]) -> Column:
    """``bad``, ``clean`` or, where the flags decide neither, ``undetermined``."""
    return (
        F.when(bad_row(flags), "bad")
        .when(~bad_row(flags), "clean")
        .otherwise("undetermined")
    )


def failure_reason(flags: Sequence[str]) -> Column:
    return F.concat_ws("; ", *[F.when(F.col(name), F.lit(name)) for name in flags])


def bad_records(flagged: DataFrame) -> DataFrame:
    flags = flag_columns(flagged)
    return flagged.where(bad_row(flags)).withColumn("dq_reason", failure_reason(flags))


def clean_trips(flagged: DataFrame) -> DataFrame:
    return flagged.where(~bad_row(flag_columns(flagged)))


def undetermined_trips(flagged: DataFrame) -> DataFrame:
    """Rows that are in neither the bad nor the clean set."""
    return flagged.where(bad_row(flag_columns(flagged)).isNull())


def add_trip_attributes(trips: DataFrame) -> DataFrame:
    return trips.withColumns(
        {
            "pickup_date": F.to_date("tpep_pickup_datetime"),
            "pickup_hour": F.hour("tpep_pickup_datetime"),
            "pickup_month": F.date_format("tpep_pickup_datetime", "yyyy-MM"),
            "trip_type": trip_class("trip_distance"),
        }
    )


def silver_trips(clean: DataFrame, stamp: bool = True) -> DataFrame:
    trips = add_trip_attributes(clean).drop(*flag_columns(clean))
    if stamp:
        trips = trips.withColumn("silver_load_timestamp", F.current_timestamp())
    return trips


def audit_rules(columns: Sequence[str]) -> dict[str, str]:
    """Findings about a row's values that do not make it bad, as predicates.

    Refused and changed casts are counted when raw files are read. An amount that is not
    finite, or too large for the sums, counts as missing there.
    """
    rules = {
        f"dq_{name}": f"{name} > 0"
        for name in ("cast_refused", "cast_changed")
        if name in columns
    }
    amounts = [f"coalesce({unsummable(name)}, false)" for name in AMOUNTS if name in columns]
    if amounts:
        rules["dq_unsummable_amount"] = " OR ".join(amounts)
    return rules


def report_counts(flagged: DataFrame) -> dict[str, str]:
    """Every count that the report needs, as SQL predicates over flagged rows."""
    flags = flag_columns(flagged)
    bad = " OR ".join(flags)
    return {**{name: name for name in flags}, **audit_rules(flagged.columns), "total_bad": bad}


def quality_counts(flagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every check's count in one aggregate, whole or per period."""
    if not flag_columns(flagged):
        raise ValueError("no data quality columns found")
    return flagged.groupBy(*by).agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(F.expr(sql)).alias(name) for name, sql in report_counts(flagged).items()],
    )


def report_of(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts as one row per check, with their share of all rows."""
    checks = [name for name in counts.columns if name not in (*by, "total_rows")]
    report = counts.unpivot([*by, "total_rows"], checks, "check", "failed_rows")
    share = F.when(
        F.col("total_rows") > 0, F.col("failed_rows") / F.col("total_rows")
    ).otherwise(F.lit(0.0))
    return report.select(
        *by, "check", "failed_rows", "total_rows", share.alias("share")
    )


def quality_report(flagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per check with its failures and their share of all rows."""
    return report_of(quality_counts(flagged, by), by)


def row_retention(flagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows before and after cleaning, and the share that stayed."""
    flags = flag_columns(flagged)
    counts = flagged.groupBy(*by).agg(
        F.count("*").alias("bronze_rows"),
        F.count_if(~bad_row(flags)).alias("silver_rows"),
    )
    return counts.withColumn(
        "retained_share",
        F.when(
            F.col("bronze_rows") > 0, F.col("silver_rows") / F.col("bronze_rows")
        ).otherwise(F.lit(0.0)),
    )


def bad_share_drift(report: DataFrame) -> DataFrame:
    """Each check's failure share next to the month before it.

    Works on the written report, which has one row per check and month, so a
    window partition holds as many rows as there are months.
    """
    by_month = Window.partitionBy("check").orderBy("year", "month")
    before = F.lag("share").over(by_month)
    return report.select(
        "year",
        "month",
        "check",
        "share",
        before.alias("previous_share"),
        (F.col("share") - before).alias("share_change"),
    )
