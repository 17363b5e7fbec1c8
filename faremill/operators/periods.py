"""Month arithmetic: scalar validation, sequences and period set algebra.

A period is a ``(year, month)`` pair of zero-padded text, so text order is
calendar order.
"""

from __future__ import annotations

from calendar import monthrange
from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERIOD = ["year", "month"]
Period = tuple[str, str]


def _whole_number(value: int | str, field: str, kind: str) -> int:
    try:
        return int(value)
    except (TypeError, ValueError):
        raise ValueError(f"{field}: {value!r} is no {kind}") from None


def first_of_month(year: int | str, month: int | str, field: str = "period") -> date:
    """Check one year and month and return the month's first day."""
    y = _whole_number(year, f"{field} year", "year")
    m = _whole_number(month, f"{field} month", "month")
    if y < 1:
        raise ValueError(f"{field}: there is no year {year!r}")
    if not 1 <= m <= 12:
        raise ValueError(f"{field}: there is no month {month!r}")
    return date(y, m, 1)


def last_of_month(year: int | str, month: int | str) -> date:
    first = first_of_month(year, month)
    return first.replace(day=monthrange(first.year, first.month)[1])


def as_period(day: date) -> Period:
    return f"{day.year:04d}", f"{day.month:02d}"


def normalize_period(year: int | str, month: int | str) -> Period:
    return as_period(first_of_month(year, month))


def month_range(
    start_year: int | str,
    start_month: int | str,
    end_year: int | str,
    end_month: int | str,
) -> list[Period]:
    """Every month from start to end, both included."""
    start = first_of_month(start_year, start_month, "start")
    end = first_of_month(end_year, end_month, "end")
    if start > end:
        raise ValueError(
            f"the range from {start.isoformat()[:7]} to {end.isoformat()[:7]} runs backwards"
        )
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [as_period(date(n // 12, n % 12 + 1, 1)) for n in range(first, last + 1)]


def format_periods(periods: Iterable[Period]) -> str:
    return ", ".join(f"{year}-{month}" for year, month in periods) or "none"


def in_periods(periods: Iterable[Period]) -> Column:
    """Predicate on the partition columns only, so Spark prunes by it."""
    return F.concat("year", "month").isin([year + month for year, month in periods])


def to_periods(days: Column | str) -> list[Column]:
    day = F.col(days) if isinstance(days, str) else days
    return [
        F.date_format(day, "yyyy").alias("year"),
        F.date_format(day, "MM").alias("month"),
    ]


def month_start(year: str = "year", month: str = "month") -> Column:
    return F.make_date(F.col(year).cast("int"), F.col(month).cast("int"), F.lit(1))


def distinct_periods(table: DataFrame) -> DataFrame:
    """Periods present in a table; the distinct combines on the map side."""
    return table.select(*PERIOD).distinct()


def discover_periods(paths: DataFrame, taxi_type: str = "yellow") -> DataFrame:
    """Periods of raw monthly files among a frame of object paths.

    The directory and the file name must agree; other objects are ignored.
    """
    pattern = (
        rf"(?:^|/)raw/{taxi_type}/year=(?!0000)(\d{{4}})/month=(0[1-9]|1[0-2])/"
        rf"{taxi_type}_tripdata_\1-\2\.parquet$"
    )
    return (
        paths.where(F.col("path").rlike(pattern))
        .select(
            F.regexp_extract("path", pattern, 1).alias("year"),
            F.regexp_extract("path", pattern, 2).alias("month"),
        )
        .distinct()
        .orderBy("year", "month")
    )


def month_sequence(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Every month between two date columns, one output row per month."""
    months = F.sequence(
        F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month")
    )
    return bounds.select(F.explode(months).alias("month_start")).select(
        *to_periods("month_start")
    )


def period_bounds(periods: DataFrame) -> DataFrame:
    """First and last month start among periods, as one row."""
    return periods.agg(
        F.min(month_start()).alias("start"), F.max(month_start()).alias("end")
    )


def month_bounds(periods: DataFrame) -> DataFrame:
    """Half-open date range of each period."""
    start = month_start()
    return periods.select(
        *PERIOD,
        start.alias("month_start"),
        F.add_months(start, 1).alias("next_month_start"),
    )


def expected_range(periods: DataFrame) -> DataFrame:
    """First day of the first period and last day of the last, as one row."""
    return period_bounds(periods).select(
        F.col("start").alias("expected_min_date"),
        F.last_day("end").alias("expected_max_date"),
    )


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct periods of ``left`` that ``right`` lacks."""
    return distinct_periods(left).join(
        distinct_periods(right), PERIOD, "left_anti"
    )


def new_periods(raw: DataFrame, processed: DataFrame) -> DataFrame:
    return difference(raw, processed)


def missing_periods(discovered: DataFrame, expected: DataFrame) -> DataFrame:
    return difference(expected, discovered)


def unexpected_periods(discovered: DataFrame, expected: DataFrame) -> DataFrame:
    return difference(discovered, expected)


def table_periods(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct periods of each named table."""
    if not tables:
        raise ValueError("no tables given")
    parts = [
        distinct_periods(table).select(F.lit(name).alias("table_name"), *PERIOD)
        for name, table in tables.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def fully_processed(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Periods present in every table; a partly loaded month does not count."""
    return (
        table_periods(tables)
        .groupBy(*PERIOD)
        .agg(F.count("*").alias("tables"))
        .where(F.col("tables") == len(tables))
        .select(*PERIOD)
    )


def compare_periods(discovered: DataFrame, expected: DataFrame) -> DataFrame:
    """Every period of either side, marked matched, missing or unexpected."""
    sides = (
        distinct_periods(discovered)
        .withColumns({"found": F.lit(1), "wanted": F.lit(0)})
        .unionByName(
            distinct_periods(expected).withColumns(
                {"found": F.lit(0), "wanted": F.lit(1)}
            )
        )
    )
    status = (
        F.when((F.col("found") > 0) & (F.col("wanted") > 0), "matched")
        .when(F.col("wanted") > 0, "missing")
        .otherwise("unexpected")
    )
    return (
        sides.groupBy(*PERIOD)
        .agg(F.sum("found").alias("found"), F.sum("wanted").alias("wanted"))
        .select(*PERIOD, status.alias("status"))
    )


def collect_periods(periods: DataFrame) -> list[Period]:
    """Periods on the driver, in order; there is one row per month of data."""
    return sorted((row["year"], row["month"]) for row in periods.collect())


def check_rebuild_source(
    discovered: Sequence[Period], expected: Sequence[Period]
) -> list[Period]:
    """Discovered months must be exactly the confirmed range."""
    if not discovered:
        raise ValueError("nothing to rebuild from: there are no raw months")
    missing = sorted(set(expected) - set(discovered))
    unexpected = sorted(set(discovered) - set(expected))
    if missing or unexpected:
        raise ValueError(
            f"raw months differ from the confirmed ones. Missing periods: {format_periods(missing)}. "
            f"Unexpected periods: {format_periods(unexpected)}. "
            "Nothing was changed."
        )
    return sorted(set(expected))
