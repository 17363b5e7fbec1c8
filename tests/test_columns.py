from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from faremill.functions import columns as c


def one(spark, expression, **values):
    row = {name: value for name, value in values.items()}
    schema = ", ".join(
        f"{name} {'string' if isinstance(value, str) else 'double'}"
        for name, value in row.items()
    )
    frame = spark.createDataFrame([tuple(row.values())], schema)
    return frame.select(expression.alias("v")).first()["v"]


def test_rounding_ties_go_up_by_decimal_digits(spark):
    for value, expected in ((1.005, 1.01), (2.675, 2.68), (-1.005, -1.01), (0.125, 0.13)):
        assert one(spark, c.round_half_up(F.col("x"), 2), x=value) == expected


@pytest.mark.parametrize(
    "numerator, denominator, places, scale, expected",
    [
        (1, 3, 2, 1, 0.33),
        (1001, 200, 2, 1, 5.01),  # exactly 5.005
        (-1001, 200, 2, 1, -5.01),
        (-1, 3, 2, 1, -0.33),
        (1, 8, 2, 100, 12.5),
        (1, 0, 2, 1, None),
        (None, 4, 2, 1, None),
        (4, None, 2, 1, None),
        (1001, -200, 2, 1, -5.01),
        (9 * 10**18, 200, 2, 1, 4.5e16),
        (9 * 10**18, 3, 2, 100, 3e20),  # beyond the longs on the way
        (40100000000000002, 20000000000000001, 2, 1, 2.0),  # 2.00499...
        (3 * 10**17 + 1, 2, 0, 1, 150000000000000001.0),
    ],
)
def test_rounded_ratio(spark, numerator, denominator, places, scale, expected):
    frame = spark.createDataFrame([(numerator, denominator)], "a long, b long")
    ratio = c.rounded_ratio("a", "b", places, scale)
    assert frame.select(ratio.alias("v")).first()["v"] == expected


def test_exact_sum_does_not_depend_on_partitions(spark):
    values = [(i % 97) / 100 + 0.01 for i in range(5000)]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    sums = {
        frame.repartition(n).agg(c.exact_sum(F.col("x")).alias("s")).first()["s"]
        for n in (1, 3, 7)
    }
    assert sums == {sum(round(v * 1_000_000) for v in values)}


def test_values_that_are_not_finite_count_as_missing(spark):
    frame = spark.createDataFrame(
        [(1.5,), (float("nan"),), (float("inf"),), (None,)], "x double"
    )
    assert frame.agg(c.exact_sum(F.col("x")).alias("s")).first()["s"] == 1_500_000


def test_amounts_of_any_size_add_up(spark):
    """Against decimals: tiny, large, negative and mixed amounts, in any partitions."""
    values = [4e-6, 0.1, 0.2, -0.3, 1e15, 1e15, -1e9, 999_999_999.999999, 1e9, 123_456_789_012.25, 1e17]
    values += [round(i * 0.000037 - 0.05, 6) for i in range(3000)]
    frame = spark.createDataFrame([(v, i % 4) for i, v in enumerate(values)], "x double, w long")
    plain = sum(Decimal(repr(v)) for v in values)
    weighted = sum(Decimal(repr(v)) * (i % 4) for i, v in enumerate(values))
    for n in (1, 5):
        row = frame.repartition(n).agg(
            c.exact_sum(F.col("x")).alias("s"), c.exact_sum(F.col("x"), F.col("w")).alias("t")
        ).first()
        assert row["s"] == plain * 1_000_000 and row["t"] == weighted * 1_000_000


def test_sums_without_a_number_are_null(spark):
    frame = spark.createDataFrame([(float("nan"),), (None,), (1e18,)], "x double")
    assert frame.agg(c.exact_sum(F.col("x")).alias("s")).first()["s"] is None


def test_minutes_of_whole_seconds_are_exact(spark):
    frame = spark.range(1, 1000).select((F.col("id") / 60).alias("m"))
    total = frame.agg(c.exact_minutes(F.col("m")).alias("s")).first()["s"]
    assert total == 1000 * sum(range(1, 1000))


@pytest.mark.parametrize(
    "distance, expected",
    [(1.5, "short"), (1.999, "short"), (2.0, "medium"), (5.0, "medium"),
     (10.0, "medium"), (10.01, "long"), (12.0, "long"), (None, "long")],
)
def test_trip_class_edges(spark, distance, expected):
    frame = spark.createDataFrame([(distance,)], "d double")
    assert frame.select(c.trip_class("d").alias("v")).first()["v"] == expected


def test_payment_names(spark):
    frame = spark.createDataFrame([(n,) for n in [0, 1, 2, 3, 4, 5, 6, 99, None]], "p long")
    names = [r["v"] for r in frame.select(c.payment_name("p").alias("v")).collect()]
    assert names == [
        "Other", "Credit card", "Cash", "No charge", "Dispute", "Unknown",
        "Voided trip", "Other", "Other",
    ]


def test_blank_and_filled(spark):
    frame = spark.createDataFrame([("short",), ("",), ("   ",), (None,)], "t string")
    found = frame.select(c.is_blank("t").alias("b"), c.is_filled("t").alias("f"))
    assert [tuple(r) for r in found.collect()] == [
        (False, True), (True, False), (True, True), (True, False),
    ]


def test_domain_order_puts_unknown_last(spark):
    frame = spark.createDataFrame([(t,) for t in ["x", "long", "short", "medium"]], "t string")
    ordered = frame.orderBy(c.domain_order("t", c.TRIP_CLASSES)).collect()
    assert [r["t"] for r in ordered] == ["short", "medium", "long", "x"]
