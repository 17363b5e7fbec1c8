"""Trip records, zones and zone points derived from the shared test tables.

The tables hold no trips, so line items play that role: the ship date gives the
pickup, the supplier's and customer's nations give the zones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Types of the shared test tables' columns that are read here.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz,"
        " o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_tax double,"
        " l_shipdate timestamp_ntz"
    ),
    "events": "ts timestamp_ntz",
}

# A trip's columns. Remainders of part and supplier numbers plant
# defects: nulls, out-of-month files, negative money, unknown codes and so on.
TRIP = {
    "tpep_pickup_datetime": (
        "if(l_partkey % 109 = 0, null, timestampadd(MINUTE, minute, l_shipdate))"
    ),
    "tpep_dropoff_datetime": (
        "if(l_partkey % 113 = 0, null,"
        " timestampadd(MINUTE, minute + length, l_shipdate))"
    ),
    "passenger_count": "cast(l_linenumber - 1 AS bigint)",
    "trip_distance": (
        "CASE WHEN l_partkey % 101 = 0 THEN null"
        " WHEN l_partkey % 103 = 0 THEN l_quantity * 5"
        " WHEN l_partkey % 167 = 0 THEN 0D ELSE l_quantity / 4 END"
    ),
    "PULocationID": "if(l_partkey % 151 = 0, null, s_nationkey + 1)",
    "DOLocationID": "if(l_partkey % 157 = 0, 0, c_nationkey + 1)",
    "payment_type": (
        "CASE WHEN l_partkey % 127 = 0 THEN null WHEN l_suppkey % 89 = 0 THEN 99"
        " WHEN l_partkey % 73 = 0 THEN 0 WHEN l_partkey % 79 = 0 THEN 6"
        " ELSE cast(substring(o_orderpriority, 1, 1) AS bigint) END"
    ),
    "fare_amount": (
        "CASE WHEN l_partkey % 137 = 0 THEN null"
        " WHEN l_partkey % 83 = 0 THEN -l_extendedprice ELSE l_extendedprice END"
    ),
    "tip_amount": "if(l_partkey % 163 = 0, null, l_extendedprice * l_tax)",
    "total_amount": (
        "CASE WHEN l_partkey % 139 = 0 THEN null"
        " WHEN l_partkey % 149 = 0 THEN -l_extendedprice ELSE l_extendedprice END"
    ),
    "year": "substring(cast(file_day AS string), 1, 4)",
    "month": "substring(cast(file_day AS string), 6, 2)",
}


# Columns as they come when amounts are odd. Remainders of the price in cents
# plant infinite, undefined and very large amounts and ones of six decimals.
ODD = {
    **TRIP,
    "trip_distance": (
        f"if(cents % 211 = 0, 0.000004D, 0D) + ({TRIP['trip_distance']})"
    ),
    "tip_amount": f"if(cents % 199 = 0, double('NaN'), {TRIP['tip_amount']})",
    "total_amount": (
        f"CASE WHEN l_partkey % 139 = 0 OR l_partkey % 149 = 0 THEN {TRIP['total_amount']}"
        f" WHEN cents % 181 = 0 THEN 1e15D WHEN cents % 191 = 0 THEN double('Infinity')"
        f" WHEN cents % 193 = 0 THEN double('NaN')"
        f" WHEN cents % 197 = 0 THEN l_extendedprice + 0.000004D ELSE l_extendedprice END"
    ),
}

# The same columns in files that hold them in other types, with values that
# the wanted types cannot take.
DRIFTED = {
    **ODD,
    "passenger_count": (
        f"CASE WHEN cents % 223 = 0 THEN 'two' WHEN cents % 227 = 0 THEN '1.7'"
        f" ELSE cast({TRIP['passenger_count']} AS string) END"
    ),
    "PULocationID": f"({TRIP['PULocationID']}) + if(cents % 229 = 0, 0.5D, 0D)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_trips(
    spark: SparkSession,
    sf_dir: str,
    columns: Sequence[str] | None = None,
    values: Mapping[str, str] = TRIP,
) -> DataFrame:
    """One trip per line item, with the year and month of its raw file.

    A generator row computes each trip's ``columns`` once, as a file would hold them;
    plain columns would be computed again in every quality rule that reads them. The
    optimizer does not prune inside the row, so a query names the columns it needs.

    Customers join the narrower orders first, so the wide line items are not
    shuffled once more on the customer key when customers are too many to
    broadcast.
    """
    buyers = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey")
    )
    joined = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(buyers, F.expr("l_orderkey = o_orderkey"))
    )
    timed = joined.selectExpr(
        "*",
        "cast((l_partkey * 7919 + l_suppkey * 104729 + l_linenumber * 613) % 1440"
        " AS int) AS minute",
        "CASE WHEN l_suppkey % 97 = 0 THEN -5 WHEN l_partkey % 131 = 0 THEN 2000"
        " ELSE cast(l_quantity * 2 + l_partkey % 7 AS int) END AS length",
        "if(l_partkey % 107 = 0, add_months(trunc(l_shipdate, 'MM'), 1),"
        " to_date(l_shipdate)) AS file_day",
        "cast(rint(l_extendedprice * 100) AS bigint) AS cents",
    )
    fields = ", ".join(f"'{name}', {values[name]}" for name in columns or values)
    return timed.selectExpr(f"inline(array(named_struct({fields})))")


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones in the lookup file's all-text shape.

    Nation 24 is missing, 23 has only spaces and 22 an empty name, so unmatched
    and blank zones occur.
    """
    zone = (
        F.when(F.col("n_nationkey") == 23, "   ")
        .when(F.col("n_nationkey") == 22, "")
        .otherwise(F.col("n_name"))
    )
    return (
        table(spark, sf_dir, "nation")
        .join(
            table(spark, sf_dir, "region"),
            F.col("n_regionkey") == F.col("r_regionkey"),
        )
        .where("n_nationkey <> 24")
        .select(
            (F.col("n_nationkey") + 1).cast("string").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            zone.alias("Zone"),
            F.concat(F.lit("Service "), F.col("r_name")).alias("service_zone"),
        )
    )


def zone_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One geometry point per supplier, so zones have several points each; the zone of
    nation 12 has none."""
    return (
        table(spark, sf_dir, "supplier")
        .join(
            table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
        )
        .join(
            table(spark, sf_dir, "region"),
            F.col("n_regionkey") == F.col("r_regionkey"),
        )
        .where("n_nationkey <> 12")
        .select(
            (F.col("n_nationkey") + 1).alias("location_id"),
            F.col("r_name").alias("borough"),
            F.col("n_name").alias("zone"),
            (F.lit(-74.0) + (F.col("s_suppkey") % 64) / 256).alias("longitude"),
            (F.lit(40.5) + (F.col("s_suppkey") % 32) / 128).alias("latitude"),
        )
    )


def raw_file_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object keys of raw files: trips, late events, junk and misplaced files.

    The keys of a month are the same for each of its rows, so they are made
    distinct first. The generator keeps filters on the path above that step.
    """
    items = table(spark, sf_dir, "lineitem").selectExpr(
        "trunc(l_shipdate, 'MM') AS day",
        "CASE WHEN l_partkey % 107 = 0 THEN 'misplaced' WHEN l_linenumber = 7"
        " THEN 'green' WHEN l_suppkey % 89 = 0 THEN 'lookup' ELSE 'yellow' END AS kind",
    )
    events = table(spark, sf_dir, "events").selectExpr(
        "trunc(ts, 'MM') AS day", "'yellow' AS kind"
    )
    folder = "'trips/raw/{0}/', date_format(day, \"'year='yyyy'/month='MM\")"
    file = "'/{0}_tripdata_', date_format({1}, 'yyyy-MM'), '.parquet'"
    yellow = f"concat({folder}, {file})".format("yellow", "day")
    misplaced = f"concat({folder}, {file})".format("yellow", "add_months(day, 1)")
    green = f"concat({folder}, {file})".format("green", "day")
    return (
        items.unionByName(events)
        .distinct()
        .selectExpr(
            f"explode(array(CASE kind WHEN 'yellow' THEN {yellow}"
            f" WHEN 'misplaced' THEN {misplaced} WHEN 'green' THEN {green}"
            " ELSE 'trips/raw/lookup/taxi_zone_lookup.csv' END)) AS path"
        )
    )
