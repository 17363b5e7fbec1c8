"""Column expressions. Everything here stays inside Spark's generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole units per 1.0 of exact sums: millionths of amounts and distances; durations keep
# milliseconds of a minute, so n/60 is held exactly.
UNITS = 1_000_000
MINUTE_UNITS = 60_000

# Below, a sum adds whole numbers and millionths as longs; above, decimals. Beyond the
# largest, a value counts as missing, as one that is not finite does.
PLAIN = "1e9D"
LARGEST = "1e18D"

# Trip classes in their domain order.
TRIP_CLASSES = ("short", "medium", "long")

# Payment codes and names; any other code is "Other".
PAYMENT_NAMES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
VALID_PAYMENT_TYPES = (0, 1, 2, 3, 4, 5, 6)


def unsummable(name: str) -> str:
    """Whether a value is neither NULL nor a number that sums take in."""
    return f"NOT (abs({name}) < {LARGEST})"  # NaN is larger than any number


def summable(value: Column) -> Column:
    return F.abs(value.cast("double")) < F.expr(LARGEST)


def exact_sum(value: Column, weight: Column | None = None) -> Column:
    """Sum of a double column, or of its products with whole numbers, in millionths.

    A double of up to 10^9 is split into its whole part and its millionths, which is exact,
    and both are added up as longs; larger ones, up to 10^18, as decimals. So the sum does
    not depend on the order in which partitions arrive, a rerun after a lost executor gives
    the same mart, and common amounts cost two additions of longs. A value has the millionth
    that is nearest to it. NULL without a summable value.
    """
    number, times = value.cast("double"), F.lit(1) if weight is None else weight
    plain = F.abs(number) < F.expr(PLAIN)
    whole = F.when(plain, number.cast("bigint"))
    part = F.when(plain, F.rint((number - whole) * UNITS).cast("bigint"))
    large = F.when(~plain & summable(number), number.try_cast("decimal(24,6)") * UNITS)
    total = F.coalesce(F.sum(whole * times), F.lit(0)).cast("decimal(38,0)") * F.lit(UNITS)
    total = total.cast("decimal(38,0)") + F.coalesce(F.sum(part * times), F.lit(0))
    total = total + F.coalesce(F.sum((large * times).cast("decimal(38,0)")), F.lit(0))
    return F.when(F.count_if(summable(number)) > 0, total.cast("decimal(38,0)"))


def exact_minutes(value: Column) -> Column:
    """Sum of minutes in milliseconds; they come from timestamps, so longs hold them."""
    return F.sum(F.rint(value.cast("double") * MINUTE_UNITS).try_cast("bigint")).cast("decimal(38,0)")


def ratio_sql(numerator: str, denominator: str, places: int, scale: int = 1) -> str:
    """SQL of ``numerator * scale / denominator`` of whole numbers, rounded half up.

    Ties are decided on whole numbers of up to 38 digits, whatever the size, so they round
    the same way on every run. An undefined quotient is NULL.
    """
    top = f"(cast(({numerator}) AS decimal(38,0)) * {scale})"
    bottom, unit = f"cast(({denominator}) AS decimal(38,0))", 10**places
    # half up on the absolute values; the remainder goes first, so the division is exact
    doubled = f"(2 * abs({top}) * {unit} + abs({bottom}))"
    whole = f"(({doubled} - {doubled} % (2 * abs({bottom}))) / (2 * abs({bottom})))"
    # shifted as a decimal: the double next to the quotient, also beyond 2^53
    shift = f"{10**-places:.{places}f}BD" if places else "1"
    return (
        f"CASE WHEN {bottom} <> 0 THEN cast(sign({top}) * sign({bottom}) AS double)"
        f" * cast(cast({whole} AS decimal(38,0)) * {shift} AS double) END"
    )


def rounded_ratio(
    numerator: str, denominator: str, places: int, scale: int = 1
) -> Column:
    """The quotient of two SQL expressions of whole numbers, rounded half up."""
    return F.expr(ratio_sql(numerator, denominator, places, scale))


def round_half_up(value: Column, places: int) -> Column:
    """Round a double half up by its decimal digits, not its binary tail."""
    return F.round(value.cast("decimal(28,6)"), places).cast("double")


def from_units(total: str, places: int, units: int = UNITS) -> Column:
    """Turn a sum of units back into a rounded double."""
    return rounded_ratio(total, str(units), places)


def weighted_sum(value: str, weight: str) -> Column:
    """Sum of ``value * weight`` in units, for re-averaging a rounded mart."""
    return exact_sum(F.col(value), F.col(weight))


def is_blank(name: str) -> Column:
    """NULL, empty, or only spaces."""
    return F.col(name).isNull() | (F.trim(F.col(name)) == "")


def is_filled(name: str) -> Column:
    """Not NULL and not empty; spaces count as content."""
    return F.col(name).isNotNull() & (F.length(F.col(name)) > 0)


def trip_class(distance: str) -> Column:
    return (
        F.when(F.col(distance) < 2, "short")
        .when(F.col(distance) <= 10, "medium")
        .otherwise("long")
    )


def payment_name(code: str) -> Column:
    name = F.lit("Other")
    for value, label in reversed(PAYMENT_NAMES.items()):
        name = F.when(F.col(code) == value, label).otherwise(name)
    return name


def year_text(day: str) -> Column:
    return F.expr(f"substring(cast({day} AS string), 1, 4)")


def month_text(day: str) -> Column:
    return F.expr(f"substring(cast({day} AS string), 6, 2)")


def domain_order(name: str, values: tuple[str, ...]) -> Column:
    """Position of a value in a fixed domain; unknown values sort last."""
    rank = F.lit(len(values) + 1)
    for position, value in reversed(list(enumerate(values, start=1))):
        rank = F.when(F.col(name) == value, position).otherwise(rank)
    return rank
