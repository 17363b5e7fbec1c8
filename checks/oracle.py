"""SQL twins of the queries, each built from the raw test tables alone."""

from __future__ import annotations


def _half_up(num: str, den: str, places: int) -> str:
    """``num / den`` rounded half up, in whole numbers so that ties are exact."""
    top, bottom = f"({num})::hugeint", f"nullif({den}, 0)::hugeint"
    whole = f"cast(sign({top}) AS int) * ((2 * abs({top}) * {10**places} + {bottom}) // (2 * {bottom}))"
    return f"cast(cast({whole} AS varchar) || 'e-{places}' AS double)"


def _dec(name: str) -> str:
    """A value as a plain decimal of six places; NULL where it is not such a number."""
    return (
        f"CASE WHEN abs({name}) < 1e18 THEN cast(cast({name} AS varchar) AS decimal(24,6)) END"
    )


def _units(name: str) -> str:
    """Decimal sum in millionths, for ratios."""
    return f"cast(sum(cast(({_dec(name)}) * 1000000 AS hugeint)) AS hugeint)"


def _total(name: str) -> str:
    """Plain decimal sum, rounded by the engine's own decimal rounding."""
    return f"cast(cast(round(sum({_dec(name)}), 2) AS varchar) AS double)"


def _mean(name: str) -> str:
    return _half_up(_units(name), f"count({_dec(name)}) * 1000000", 2)


# minutes are n/60: whole milliseconds of a minute hold them
MILLIS = "cast(sum(cast(round(trip_duration_minutes * 60000) AS bigint)) AS hugeint)"

FLAGS = {
    "dq_null_pickup": "tpep_pickup_datetime IS NULL",
    "dq_outside_month": """tpep_pickup_datetime IS NOT NULL AND (
        cast(tpep_pickup_datetime AS date) < make_date(year::int, month::int, 1)
        OR cast(tpep_pickup_datetime AS date)
           >= make_date(year::int, month::int, 1) + INTERVAL 1 MONTH)""",
    "dq_null_dropoff": "tpep_dropoff_datetime IS NULL",
    "dq_wrong_time": "tpep_dropoff_datetime <= tpep_pickup_datetime",
    "dq_bad_distance": "trip_distance <= 0",
    "dq_bad_fare": "fare_amount < 0",
    "dq_bad_total": "total_amount < 0",
    "dq_bad_passenger": "passenger_count IS NOT NULL AND passenger_count <= 0",
    "dq_bad_payment_type": "payment_type IS NULL OR payment_type NOT BETWEEN 0 AND 6",
    "dq_bad_pickup_location": "PULocationID IS NULL OR PULocationID <= 0",
    "dq_bad_dropoff_location": "DOLocationID IS NULL OR DOLocationID <= 0",
    "dq_bad_duration": "trip_duration_minutes <= 0 OR trip_duration_minutes > 1440",
    "dq_outlier_distance": "trip_distance > 100",
}
BAD = " OR ".join(FLAGS)

TRIP_COLUMNS = """tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
    trip_distance, PULocationID, DOLocationID, payment_type, fare_amount,
    tip_amount, total_amount, year, month"""

TRAVEL = f"""count(*) AS trips_count,
    {_total('total_amount')} AS total_revenue,
    {_mean('total_amount')} AS avg_check,
    {_mean('trip_distance')} AS avg_trip_distance,
    {_half_up(MILLIS, 'count(trip_duration_minutes) * 60000', 2)} AS avg_trip_duration_minutes"""

KEY = (
    r"/raw/yellow/year=(\d{4})/month=(\d{2})/"
    r"yellow_tripdata_(\d{4})-(\d{2})\.parquet$"
)

CTES = {
    "raw": (
        (),
        """
  SELECT cast(round(l_extendedprice * 100) AS bigint) AS cents,
    CASE WHEN l_partkey % 109 <> 0 THEN started END AS tpep_pickup_datetime,
    CASE WHEN l_partkey % 113 <> 0 THEN started + to_minutes(
      CASE WHEN l_suppkey % 97 = 0 THEN -5
           WHEN l_partkey % 131 = 0 THEN 2000
           ELSE cast(trunc(l_quantity * 2 + l_partkey % 7) AS int) END)
      END AS tpep_dropoff_datetime,
    cast(l_linenumber - 1 AS bigint) AS passenger_count,
    CASE WHEN l_partkey % 101 = 0 THEN NULL
         WHEN l_partkey % 103 = 0 THEN l_quantity * 5
         WHEN l_partkey % 167 = 0 THEN 0
         ELSE l_quantity / 4 END AS trip_distance,
    CASE WHEN l_partkey % 151 <> 0 THEN s_nationkey + 1 END AS PULocationID,
    CASE WHEN l_partkey % 157 = 0 THEN 0 ELSE c_nationkey + 1 END AS DOLocationID,
    CASE WHEN l_partkey % 127 = 0 THEN NULL
         WHEN l_suppkey % 89 = 0 THEN 99
         WHEN l_partkey % 73 = 0 THEN 0
         WHEN l_partkey % 79 = 0 THEN 6
         ELSE cast(substr(o_orderpriority, 1, 1) AS bigint) END AS payment_type,
    CASE WHEN l_partkey % 137 = 0 THEN NULL
         WHEN l_partkey % 83 = 0 THEN -l_extendedprice
         ELSE l_extendedprice END AS fare_amount,
    CASE WHEN l_partkey % 163 <> 0 THEN l_extendedprice * l_tax END AS tip_amount,
    CASE WHEN l_partkey % 139 = 0 THEN NULL
         WHEN l_partkey % 149 = 0 THEN -l_extendedprice
         ELSE l_extendedprice END AS total_amount,
    strftime(file_day, '%Y') AS year,
    strftime(file_day, '%m') AS month
  FROM (
    SELECT *,
      l_shipdate + to_minutes(cast(
        (l_partkey * 7919 + l_suppkey * 104729 + l_linenumber * 613) % 1440 AS int)
      ) AS started,
      CASE WHEN l_partkey % 107 = 0
           THEN date_trunc('month', l_shipdate) + INTERVAL 1 MONTH
           ELSE l_shipdate END AS file_day
    FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey
    JOIN supplier ON s_suppkey = l_suppkey
  )""",
    ),
    "trips": (("raw",), f"SELECT {TRIP_COLUMNS} FROM raw"),
    "odd": (
        ("raw",),
        """
  SELECT * REPLACE (
    CASE WHEN cents % 211 = 0 THEN trip_distance + 0.000004 ELSE trip_distance END
      AS trip_distance,
    CASE WHEN cents % 199 = 0 THEN 'NaN'::double ELSE tip_amount END AS tip_amount,
    CASE WHEN total_amount IS NULL OR total_amount < 0 THEN total_amount
         WHEN cents % 181 = 0 THEN 1e15
         WHEN cents % 191 = 0 THEN 'Infinity'::double
         WHEN cents % 193 = 0 THEN 'NaN'::double
         WHEN cents % 197 = 0 THEN total_amount + 0.000004
         ELSE total_amount END AS total_amount)
  FROM raw""",
    ),
    "audited": (
        ("odd",),
        "SELECT *, "
        + ",\n".join(f"({sql}) AS {name}" for name, sql in FLAGS.items())
        + """ FROM (SELECT *,
    (epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) / 60 AS trip_duration_minutes
  FROM (SELECT * REPLACE (
      CASE WHEN cents % 223 <> 0 AND cents % 227 <> 0 THEN passenger_count END
        AS passenger_count),
    cents % 223 = 0 OR cents % 227 = 0 AS cast_refused,
    PULocationID IS NOT NULL AND cents % 229 = 0 AS cast_changed
  FROM odd))""",
    ),
    **{
        f"{kind}timed": (
            (source,),
            f"""
  SELECT *, (epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) / 60
    AS trip_duration_minutes
  FROM {source}""",
        )
        for kind, source in (("", "trips"), ("odd_", "odd"))
    },
    **{
        f"{kind}flagged": (
            (f"{kind}timed",),
            "SELECT *, "
            + ",\n".join(f"({sql}) AS {name}" for name, sql in FLAGS.items())
            + f" FROM {kind}timed",
        )
        for kind in ("", "odd_")
    },
    **{
        name: (
            (source,),
            f"""
  SELECT {TRIP_COLUMNS}, trip_duration_minutes,
    cast(tpep_pickup_datetime AS date) AS pickup_date,
    cast(hour(tpep_pickup_datetime) AS int) AS pickup_hour,
    strftime(tpep_pickup_datetime, '%Y-%m') AS pickup_month,
    CASE WHEN trip_distance < 2 THEN 'short' WHEN trip_distance <= 10 THEN 'medium'
         ELSE 'long' END AS trip_type
  FROM {source} WHERE NOT ({BAD})""",
        )
        for name, source in (("plain_silver", "flagged"), ("silver", "odd_flagged"))
    },
    "daily": (
        ("silver",),
        f"""
  SELECT pickup_date, {TRAVEL},
    count(*) FILTER (WHERE trip_type = 'short') AS short_trips_count,
    count(*) FILTER (WHERE trip_type = 'medium') AS medium_trips_count,
    count(*) FILTER (WHERE trip_type = 'long') AS long_trips_count,
    strftime(pickup_date, '%Y') AS year, strftime(pickup_date, '%m') AS month
  FROM silver GROUP BY pickup_date""",
    ),
    "hourly": (
        ("silver",),
        f"""
  SELECT pickup_date, pickup_hour, trip_type, {TRAVEL},
    strftime(pickup_date, '%Y') AS year, strftime(pickup_date, '%m') AS month
  FROM silver GROUP BY pickup_date, pickup_hour, trip_type""",
    ),
    "payment": (
        ("silver",),
        f"""
  SELECT pickup_date, trip_type, payment_type,
    CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash'
      WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown'
      WHEN 6 THEN 'Voided trip' ELSE 'Other' END AS payment_type_name,
    count(*) AS trips_count,
    {_total('total_amount')} AS total_revenue,
    {_mean('total_amount')} AS avg_check,
    {_total('tip_amount')} AS total_tips,
    {_mean('tip_amount')} AS avg_tip,
    CASE WHEN {_units('total_amount')} <> 0 THEN
      {_half_up(_units('tip_amount'), _units('total_amount'), 4)}
      ELSE 0.0 END AS tips_share_from_revenue,
    strftime(pickup_date, '%Y') AS year, strftime(pickup_date, '%m') AS month
  FROM silver GROUP BY pickup_date, trip_type, payment_type""",
    ),
    "zones": (
        (),
        """
  SELECT n_nationkey + 1 AS location_id, r_name AS borough,
    CASE n_nationkey WHEN 23 THEN '   ' WHEN 22 THEN '' ELSE n_name END AS zone,
    'Service ' || r_name AS service_zone
  FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey <> 24""",
    ),
    "route": (
        ("silver", "zones"),
        f"""
  SELECT pickup_date, trip_type,
    PULocationID AS pickup_location_id, p.borough AS pickup_borough,
    p.zone AS pickup_zone, p.service_zone AS pickup_service_zone,
    DOLocationID AS dropoff_location_id, d.borough AS dropoff_borough,
    d.zone AS dropoff_zone, d.service_zone AS dropoff_service_zone,
    {TRAVEL},
    strftime(pickup_date, '%Y') AS year, strftime(pickup_date, '%m') AS month
  FROM silver
  LEFT JOIN zones p ON p.location_id = PULocationID
  LEFT JOIN zones d ON d.location_id = DOLocationID
  GROUP BY ALL""",
    ),
    "centroids": (
        (),
        """
  SELECT n_nationkey + 1 AS location_id, r_name AS borough, n_name AS zone,
    -74.0::double + (s_suppkey % 64) / 256 AS longitude,
    40.5::double + (s_suppkey % 32) / 128 AS latitude
  FROM supplier JOIN nation ON n_nationkey = s_nationkey
  JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey <> 12""",
    ),
    "metrics": (
        ("daily",),
        f"""
  SELECT pickup_date, date_trunc('month', pickup_date)::date AS pickup_month,
    year(pickup_date)::int AS pickup_year,
    month(pickup_date)::int AS pickup_month_number,
    isodow(pickup_date)::int AS day_of_week,
    isodow(pickup_date) IN (6, 7) AS is_weekend,
    trips_count, total_revenue, avg_check, avg_trip_distance,
    avg_trip_duration_minutes, short_trips_count, medium_trips_count,
    long_trips_count,
    {_half_up('short_trips_count', 'trips_count', 4)} AS short_trips_share,
    {_half_up('medium_trips_count', 'trips_count', 4)} AS medium_trips_share,
    {_half_up('long_trips_count', 'trips_count', 4)} AS long_trips_share
  FROM daily""",
    ),
    "kpis": (
        ("metrics",),
        f"""
  SELECT *, strftime(pickup_date, '%Y-%m') AS pickup_month_label,
    CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type,
    {_half_up('round(total_revenue * 100)', '100000000', 2)}
      AS total_revenue_mln,
    CASE greatest(short_trips_share, medium_trips_share, long_trips_share)
      WHEN short_trips_share THEN 'short' WHEN medium_trips_share THEN 'medium'
      ELSE 'long' END AS dominant_trip_type
  FROM metrics""",
    ),
    "keys": (
        (),
        """
  SELECT CASE kind
    WHEN 'yellow' THEN yellow || strftime(day, '%Y-%m') || '.parquet'
    WHEN 'misplaced' THEN yellow || strftime(day + INTERVAL 1 MONTH, '%Y-%m')
      || '.parquet'
    WHEN 'green' THEN 'trips/raw/green/' || month_path || '/green_tripdata_'
      || strftime(day, '%Y-%m') || '.parquet'
    ELSE 'trips/raw/lookup/taxi_zone_lookup.csv' END AS path
  FROM (
    SELECT *, strftime(day, 'year=%Y/month=%m') AS month_path,
      'trips/raw/yellow/' || strftime(day, 'year=%Y/month=%m')
        || '/yellow_tripdata_' AS yellow
    FROM (
      SELECT l_shipdate AS day,
        CASE WHEN l_partkey % 107 = 0 THEN 'misplaced'
             WHEN l_linenumber = 7 THEN 'green'
             WHEN l_suppkey % 89 = 0 THEN 'lookup' ELSE 'yellow' END AS kind
      FROM lineitem
      UNION ALL SELECT ts, 'yellow' FROM events
    )
  )""",
    ),
    "raw_periods": (
        ("keys",),
        rf"""
  SELECT DISTINCT p[1] AS year, p[2] AS month
  FROM (SELECT [{', '.join(f"regexp_extract(path, '{KEY}', {n})" for n in range(1, 5))}]
    AS p FROM (SELECT DISTINCT path FROM keys))
  WHERE p[1] <> '' AND p[1] = p[3] AND p[2] = p[4]""",
    ),
    "raw_sequence": (
        ("raw_periods",),
        """
  SELECT strftime(m, '%Y') AS year, strftime(m, '%m') AS month
  FROM (SELECT unnest(generate_series(
      min(make_date(year::int, month::int, 1)),
      max(make_date(year::int, month::int, 1)), INTERVAL 1 MONTH)) AS m
    FROM raw_periods)""",
    ),
    "order_sequence": (
        (),
        """
  SELECT strftime(m, '%Y') AS year, strftime(m, '%m') AS month
  FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)),
      date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders)""",
    ),
    "processed": (
        ("daily", "hourly", "payment", "route"),
        """
  SELECT year, month FROM daily INTERSECT SELECT year, month FROM hourly
  INTERSECT SELECT year, month FROM payment INTERSECT SELECT year, month FROM route""",
    ),
}

MARTS = {
    "gold_daily_trips": "daily",
    "gold_hourly_trips": "hourly",
    "gold_location_pair_stats": "route",
    "gold_payment_type_stats": "payment",
}


def _closure(names: tuple[str, ...]) -> list[str]:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in CTES[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def _sql(body: str, *needs: str) -> str:
    ctes = ",\n".join(f"{name} AS ({CTES[name][1]}\n)" for name in _closure(needs))
    return f"WITH {ctes}\n{body}" if ctes else body


def _select(name: str) -> str:
    return _sql(f"SELECT * FROM {name}", name)


def _blank(name: str) -> str:
    return (
        f"count(*) FILTER (WHERE {name} IS NULL OR trim({name}) = '')"
        f" AS empty_{name}_count"
    )


def _failing(sql: str, name: str) -> str:
    return f"count(*) FILTER (WHERE {sql}) AS {name}"


_FIRST = "make_date(year::int, month::int, 1)"
_OUTSIDE = f"(pickup_date < {_FIRST} OR pickup_date >= {_FIRST} + INTERVAL 1 MONTH)"
_BAD_HOUR = "(pickup_hour < 0 OR pickup_hour > 23)"

_REQUIRED = (
    "tpep_pickup_datetime tpep_dropoff_datetime pickup_date pickup_hour PULocationID"
    " DOLocationID payment_type trip_distance total_amount"
).split()


def _gate_silver() -> str:
    errors = {
        "outside_month_count": _OUTSIDE,
        **{f"null_{name}": f"{name} IS NULL" for name in _REQUIRED},
        "invalid_payment_type_count": FLAGS["dq_bad_payment_type"],
        "invalid_pickup_location_count": FLAGS["dq_bad_pickup_location"],
        "invalid_dropoff_location_count": FLAGS["dq_bad_dropoff_location"],
        "invalid_pickup_hour_count": f"pickup_hour IS NULL OR {_BAD_HOUR}",
        "invalid_distance_count": "trip_distance <= 0",
    }
    counts = ", ".join(_failing(sql, name) for name, sql in errors.items())
    clear = " AND ".join(f"{name} = 0" for name in errors)
    return _sql(
        f"""SELECT *, silver_count > 0 AND {clear} AS passed FROM (
        SELECT year, month, count(*) AS silver_count, {counts},
        {_failing('total_amount <= 0', 'invalid_amount_count')}
        FROM silver GROUP BY year, month)""",
        "silver",
    )


_TEXT = {
    "daily": [],
    "hourly": ["trip_type"],
    "payment": ["trip_type", "payment_type_name"],
    "route": ["trip_type", "pickup_zone", "dropoff_zone"],
}


def _gate(mart: str) -> str:
    counts = {
        "outside_month_count": _failing(
            f"pickup_date IS NULL OR {_OUTSIDE}", "outside_month_count"
        ),
        **{f"empty_{name}_count": _blank(name) for name in _TEXT[mart]},
    }
    if mart == "hourly":
        counts["invalid_pickup_hour_count"] = _failing(
            f"pickup_hour IS NULL OR {_BAD_HOUR}", "invalid_pickup_hour_count"
        )
    clear = " AND ".join(f"{name} = 0" for name in counts)
    return _sql(
        f"""SELECT *, rows_count > 0 AND {clear} AS passed FROM (
        SELECT year, month, count(*) AS rows_count, {', '.join(counts.values())}
        FROM {mart} GROUP BY year, month)""",
        mart,
    )


_ALL_COUNTS = (
    "empty_trip_type_count",
    "empty_payment_type_name_count",
    "empty_pickup_zone_count",
    "empty_dropoff_zone_count",
)


def _serving_profile(table: str, mart: str, monthly: bool) -> str:
    counts = {
        **{name: f"NULL::bigint AS {name}" for name in _ALL_COUNTS},
        **{f"empty_{name}_count": _blank(name) for name in _TEXT[mart]},
    }
    used = [f"empty_{name}_count" for name in _TEXT[mart]]
    if monthly:
        counts["out_of_month_date_count"] = _failing(
            _OUTSIDE, "out_of_month_date_count"
        )
        counts["non_positive_trips_count"] = _failing(
            "trips_count <= 0", "non_positive_trips_count"
        )
        used += ["out_of_month_date_count", "non_positive_trips_count"]
        counts["invalid_pickup_hour_count"] = (
            _failing(_BAD_HOUR, "invalid_pickup_hour_count")
            if mart == "hourly"
            else "NULL::bigint AS invalid_pickup_hour_count"
        )
        used += ["invalid_pickup_hour_count"] if mart == "hourly" else []
    clear = "".join(f" AND {name} = 0" for name in used)
    period, group = ("year, month, ", " GROUP BY year, month") if monthly else ("", "")
    return f"""SELECT *, rows_count > 0{clear} AS passed FROM (
      SELECT '{table}' AS table_name, {period}count(*) AS rows_count,
        min(pickup_date) AS min_pickup_date, max(pickup_date) AS max_pickup_date,
        {', '.join(counts.values())}
      FROM {mart}{group})"""


def _union(parts) -> str:
    return "\nUNION ALL BY NAME\n".join(parts)


def _serving(monthly: bool) -> str:
    return _union(_serving_profile(t, m, monthly) for t, m in MARTS.items())


_NEED_MARTS = tuple(MARTS.values())


def _column_tests(model: str, source: str, tests: list[tuple[str, str, str]]) -> str:
    """One row per (column, kind, failure count) of a model."""
    return _sql(
        _union(
            f"SELECT '{model}' AS model, '{column}' AS column_name,"
            f" '{kind}' AS test, {failures} AS failures FROM {source}"
            for column, kind, failures in tests
        ),
        source,
    )


def _not_null(*columns: str) -> list[tuple[str, str, str]]:
    return [
        (name, "not_null", f"count(*) FILTER (WHERE {name} IS NULL)")
        for name in columns
    ]


def _unique(column: str) -> list[tuple[str, str, str]]:
    return [(column, "unique", f"count({column}) - count(DISTINCT {column})")]


def _accepted(column: str, values: str) -> list[tuple[str, str, str]]:
    failing = f"count(*) FILTER (WHERE {column} NOT IN ({values}))"
    return [(column, "accepted_values", failing)]


_CLASSES = "'short', 'medium', 'long'"
_TYPED = _not_null(
    "pickup_date", "trip_type", "trips_count", "total_revenue"
) + _accepted("trip_type", _CLASSES)
_CALENDAR = (
    _not_null(
        *(
            "pickup_date pickup_month pickup_year pickup_month_number day_of_week"
            " is_weekend trips_count total_revenue short_trips_share"
            " medium_trips_share long_trips_share"
        ).split()
    )
    + _unique("pickup_date")
    + _accepted("pickup_month_number", "1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12")
    + _accepted("day_of_week", "1, 2, 3, 4, 5, 6, 7")
)

# --- reports -------------------------------------------------------------------

_SUMS = f"""sum(trips_count)::bigint AS n,
    {_units('total_revenue')} AS rev"""
_WSUMS = (
    _SUMS
    + """, sum(round(avg_trip_distance * 100)::hugeint * trips_count * 10000) AS dist,
    sum(round(avg_trip_duration_minutes * 100)::hugeint * trips_count * 10000) AS dur"""
)
_TIPSUMS = _SUMS + f", {_units('total_tips')} AS tips"


def _per_trip(total: str) -> str:
    return _half_up(total, "n * 1000000", 2)


def _pct(total: str) -> str:
    return _half_up("n * 100", total, 2)


_VOLUME = f"""n AS trips_count, {_half_up('rev', '1000000', 2)} AS total_revenue,
    {_per_trip('rev')} AS avg_check"""
_MEANS = f"""{_per_trip('dist')} AS avg_trip_distance,
    {_per_trip('dur')} AS avg_trip_duration_minutes"""
_TIPS = f"""{_half_up('tips', '1000000', 2)} AS total_tips, {_per_trip('tips')} AS avg_tip,
    {_half_up('tips * 100', 'rev', 2)} AS tips_share_from_revenue_pct"""


def _top_zones(role: str) -> str:
    return _sql(
        f"""SELECT {role}_borough, {role}_zone, {_VOLUME} FROM (
        SELECT {role}_borough, {role}_zone, {_SUMS} FROM route
        WHERE {role}_zone IS NOT NULL AND {role}_zone <> ''
        GROUP BY {role}_borough, {role}_zone)
        ORDER BY n DESC, {role}_borough, {role}_zone LIMIT 20""",
        "route",
    )


def _zone_stats(role: str) -> str:
    return f"""SELECT '{role}' AS zone_role, trip_type, {role}_borough AS borough,
      {role}_zone AS zone, {_WSUMS} FROM route
      WHERE trip_type <> '' AND {role}_zone <> ''
      GROUP BY trip_type, {role}_borough, {role}_zone"""


_SHORT_ROUTES = f"""SELECT pickup_borough, pickup_zone, dropoff_borough, dropoff_zone,
    {_WSUMS} FROM route
    WHERE trip_type = 'short' AND pickup_borough = dropoff_borough
      AND pickup_borough <> '' AND pickup_zone <> '' AND dropoff_zone <> ''
    GROUP BY pickup_borough, pickup_zone, dropoff_borough, dropoff_zone"""
_ROUTE_ORDER = """ORDER BY n DESC, pickup_borough, pickup_zone, dropoff_borough,
    dropoff_zone LIMIT 30"""
_ROUTE_KEYS = "pickup_borough, pickup_zone, dropoff_borough, dropoff_zone"
_DISCOUNT = f"{_half_up('n * 5 * 30 * 5', '10000', 2)} AS grouped_discount_cost"
_FEE = f"{_half_up('n * 5 * 70 * 2', '10000', 2)} AS privacy_fee_revenue"
_IMPACT = _half_up("n * 5 * 70 * 2 - n * 5 * 30 * 5", "10000", 2)
_GROUPABLE = _half_up("n * 5", "100", 0)
_ACCEPTING = _half_up("n * 5 * 30", "10000", 0)
_REFUSING = _half_up("n * 5 * 70", "10000", 0)


def _demand(role: str) -> str:
    return f"""SELECT '{role}' AS zone_role, {role}_location_id AS location_id,
      {role}_borough AS borough, {role}_zone AS zone, {_SUMS}
      FROM route GROUP BY ALL"""


def _shares_off(model: str) -> str:
    total = "short_trips_share + medium_trips_share + long_trips_share"
    return f"""SELECT '{model}' AS model, pickup_date, trips_count, short_trips_share,
      medium_trips_share, long_trips_share, {total} AS total_trip_type_share
      FROM (SELECT * REPLACE (short_trips_share + 0.5 AS short_trips_share) FROM {model}
        WHERE day(pickup_date) = 17) WHERE trips_count > 0"""


def _grain(mart: str, keys: str) -> str:
    return _sql(
        f"SELECT {keys}, 2 AS rows_per_grain FROM {mart} WHERE trips_count % 3 = 1",
        mart,
    )


_REPORT = (
    'SELECT year, month, check_name AS "check", failed_rows, total_rows,'
    " failed_rows / total_rows AS share FROM ("
    + _union(
        f"SELECT year, month, '{name}' AS check_name,"
        f" count(*) FILTER (WHERE {sql}) AS failed_rows,"
        " count(*) AS total_rows FROM audited GROUP BY year, month"
        for name, sql in {
            **{f: f for f in FLAGS},
            "dq_cast_refused": "cast_refused",
            "dq_cast_changed": "cast_changed",
            "dq_unsummable_amount": " OR ".join(
                f"isnan({c}) OR isinf({c})" for c in ("trip_distance", "fare_amount", "tip_amount", "total_amount")
            ),
            "total_bad": BAD,
        }.items()
    )
    + ")"
)

ORACLE: dict[str, str] = {
    "scan_month": _sql(
        """SELECT year, month, count(*) AS trips,
        count(tpep_pickup_datetime) AS with_pickup,
        min(tpep_pickup_datetime) AS first_pickup,
        max(tpep_pickup_datetime) AS last_pickup
        FROM trips WHERE (year = '1995' AND month IN ('03', '11'))
          OR (year = '1997' AND month = '01') GROUP BY year, month""",
        "trips",
    ),
    "bronze_meta": _sql(
        """SELECT *, 'nyc_taxi_yellow' AS source_system, year AS source_year,
        month AS source_month FROM trips""",
        "trips",
    ),
    "trip_duration": _sql(
        """SELECT tpep_pickup_datetime, tpep_dropoff_datetime,
        trip_duration_minutes FROM timed""",
        "timed",
    ),
    "dq_flags": _select("flagged"),
    "bad_records": _sql(
        "SELECT *, concat_ws('; ', "
        + ", ".join(f"CASE WHEN {name} THEN '{name}' END" for name in FLAGS)
        + f") AS dq_reason FROM flagged WHERE {BAD}",
        "flagged",
    ),
    "clean_trips": _sql(f"SELECT * FROM flagged WHERE NOT ({BAD})", "flagged"),
    "undetermined_trips": _sql(
        f"SELECT * FROM flagged WHERE ({BAD}) IS NULL", "flagged"
    ),
    "silver_trips": _select("plain_silver"),
    "dq_report": _sql(_REPORT, "audited"),
    "dq_drift": _sql(
        f"""SELECT year, month, "check", share,
        lag(share) OVER w AS previous_share, share - lag(share) OVER w AS share_change
        FROM ({_REPORT}) WINDOW w AS (PARTITION BY "check" ORDER BY year, month)""",
        "audited",
    ),
    "row_retention": _sql(
        f"""SELECT *, silver_rows / bronze_rows AS retained_share,
        silver_rows / bronze_rows >= 0.7 AS passed FROM (
        SELECT year, month, count(*) AS bronze_rows,
        count(*) FILTER (WHERE NOT ({BAD})) AS silver_rows
        FROM flagged GROUP BY year, month)""",
        "flagged",
    ),
    "daily_mart": _select("daily"),
    "hourly_mart": _select("hourly"),
    "payment_mart": _select("payment"),
    "route_mart": _select("route"),
    "loaded_month_count": _sql(
        _union(
            f"SELECT '{table}' AS table_name, year, month, count(*) AS rows_count"
            f" FROM {mart} GROUP BY year, month"
            for table, mart in MARTS.items()
        ),
        *_NEED_MARTS,
    ),
    "table_coverage": _sql(
        _union(
            f"""SELECT '{table}' AS table_name, count(*) AS rows_count,
            min(pickup_date) AS min_date, max(pickup_date) AS max_date,
            count(DISTINCT date_trunc('month', pickup_date)) AS periods_count
            FROM {mart}"""
            for table, mart in MARTS.items()
        ),
        *_NEED_MARTS,
    ),
    "stg_daily": _select("daily"),
    "stg_hourly": _select("hourly"),
    "stg_payment": _select("payment"),
    "stg_route": _select("route"),
    "stg_centroids": _select("centroids"),
    "daily_metrics": _select("metrics"),
    "daily_kpis": _select("kpis"),
    "top_pickup_zones": _top_zones("pickup"),
    "top_dropoff_zones": _top_zones("dropoff"),
    "peak_hours": _sql(
        f"""SELECT * FROM (WITH g AS (SELECT pickup_hour, {_WSUMS} FROM hourly
          GROUP BY pickup_hour)
        SELECT pickup_hour, {_VOLUME}, {_pct('(SELECT sum(n) FROM g)')}
        AS trips_share_pct, {_MEANS} FROM g
        ORDER BY n DESC, pickup_hour LIMIT 24)""",
        "hourly",
    ),
    "trip_type_distribution": _sql(
        f"""SELECT * FROM (WITH g AS (SELECT trip_type, {_WSUMS} FROM hourly
          WHERE trip_type <> '' GROUP BY trip_type)
        SELECT trip_type, {_VOLUME}, {_pct('(SELECT sum(n) FROM g)')}
        AS trips_share_pct, {_MEANS},
        {_half_up('rev', 'dist', 2)} AS avg_cost_per_mile FROM g)""",
        "hourly",
    ),
    "peak_hours_by_type": _sql(
        f"""SELECT * FROM (WITH g AS (SELECT trip_type, pickup_hour, {_WSUMS}
          FROM hourly WHERE trip_type <> '' GROUP BY trip_type, pickup_hour),
        t AS (SELECT trip_type, sum(n) AS total FROM g GROUP BY trip_type)
        SELECT g.trip_type, row_number() OVER (PARTITION BY g.trip_type
          ORDER BY n DESC, pickup_hour)::int AS hour_rank_within_type, pickup_hour,
        {_VOLUME}, {_pct('total')} AS trips_share_within_type_pct, {_MEANS}
        FROM g JOIN t ON g.trip_type = t.trip_type)
        WHERE hour_rank_within_type <= 10""",
        "hourly",
    ),
    "top_zones_by_type": _sql(
        f"""SELECT * FROM (SELECT zone_role, trip_type, row_number() OVER (
          PARTITION BY zone_role, trip_type
          ORDER BY n DESC, borough NULLS FIRST, zone NULLS FIRST)::int AS zone_rank,
        borough, zone, {_VOLUME}, {_MEANS} FROM (
          {_zone_stats('pickup')} UNION ALL {_zone_stats('dropoff')}))
        WHERE zone_rank <= 3""",
        "route",
    ),
    "payment_by_type": _sql(
        f"""SELECT * FROM (WITH g AS (SELECT trip_type, payment_type,
          payment_type_name, {_TIPSUMS} FROM payment
          WHERE trip_type <> '' AND payment_type_name <> ''
          GROUP BY trip_type, payment_type, payment_type_name),
        t AS (SELECT trip_type, sum(n) AS total FROM g GROUP BY trip_type)
        SELECT g.trip_type, payment_type, payment_type_name, {_VOLUME},
        {_pct('total')} AS trips_share_within_type_pct, {_TIPS}
        FROM g JOIN t ON g.trip_type = t.trip_type)""",
        "payment",
    ),
    "payment_trends": _sql(
        f"""SELECT * FROM (WITH g AS (SELECT
          date_trunc('month', pickup_date)::date AS pickup_month, payment_type,
          payment_type_name, {_TIPSUMS} FROM payment WHERE payment_type_name <> ''
          GROUP BY ALL),
        t AS (SELECT pickup_month, sum(n) AS total FROM g GROUP BY pickup_month)
        SELECT g.pickup_month, payment_type, payment_type_name, {_VOLUME},
        {_pct('total')} AS trips_share_month_pct, {_TIPS}
        FROM g JOIN t ON g.pickup_month = t.pickup_month)""",
        "payment",
    ),
    "rideshare_candidates": _sql(
        f"""SELECT {_ROUTE_KEYS}, {_VOLUME}, {_MEANS},
        {_GROUPABLE} AS potential_groupable_trips,
        {_ACCEPTING} AS grouped_accepting_trips,
        {_REFUSING} AS individual_privacy_trips,
        {_DISCOUNT}, {_FEE}, {_IMPACT} AS estimated_direct_fare_impact
        FROM ({_SHORT_ROUTES}) {_ROUTE_ORDER}""",
        "route",
    ),
    "rideshare_vehicle_model": _sql(
        f"""SELECT {_ROUTE_KEYS}, {_VOLUME},
        {_GROUPABLE} AS potential_groupable_passenger_trips,
        {_ACCEPTING} AS grouped_accepting_passenger_trips,
        {_half_up('n * 5 * 30', '20000', 0)} AS grouped_vehicle_trips,
        {_REFUSING} AS individual_privacy_passenger_trips,
        {_DISCOUNT}, {_FEE}, {_IMPACT} AS estimated_direct_fare_impact,
        {_per_trip('rev')} AS baseline_revenue_per_vehicle_trip,
        round(2 * ({_per_trip('rev')} - 5), 2)
          AS grouped_revenue_per_vehicle_trip,
        round({_per_trip('rev')} - 10, 2) AS vehicle_trip_revenue_uplift
        FROM ({_SHORT_ROUTES}) {_ROUTE_ORDER}""",
        "route",
    ),
    "zone_demand_map": _sql(
        f"""SELECT zone_role, d.location_id, borough, zone,
        round(lon, 6) AS longitude, round(lat, 6) AS latitude, {_VOLUME}
        FROM ({_demand('pickup')} UNION ALL {_demand('dropoff')}) d
        LEFT JOIN (SELECT location_id, avg(longitude) AS lon, avg(latitude) AS lat
          FROM centroids GROUP BY location_id) c ON c.location_id = d.location_id""",
        "route",
        "centroids",
    ),
    "discover_periods": _select("raw_periods"),
    "table_periods": _sql(
        _union(
            f"SELECT DISTINCT '{table}' AS table_name, year, month FROM {mart}"
            for table, mart in MARTS.items()
        ),
        *_NEED_MARTS,
    ),
    "processed_periods": _select("processed"),
    "new_periods": _sql(
        "SELECT year, month FROM raw_periods EXCEPT SELECT year, month FROM processed",
        "raw_periods",
        "processed",
    ),
    "month_sequence": _select("raw_sequence"),
    "missing_periods": _sql(
        "SELECT * FROM raw_sequence EXCEPT SELECT * FROM raw_periods", "raw_sequence"
    ),
    "unexpected_periods": _sql(
        "SELECT * FROM raw_periods EXCEPT SELECT * FROM order_sequence",
        "raw_periods",
        "order_sequence",
    ),
    "rebuild_gate": _sql(
        """SELECT coalesce(r.year, o.year) AS year, coalesce(r.month, o.month) AS month,
        CASE WHEN r.year IS NULL THEN 'missing' WHEN o.year IS NULL THEN 'unexpected'
          ELSE 'matched' END AS status
        FROM raw_periods r FULL JOIN order_sequence o
          ON r.year = o.year AND r.month = o.month""",
        "raw_periods",
        "order_sequence",
    ),
    "month_bounds": _sql(
        f"""SELECT year, month, {_FIRST} AS month_start,
        ({_FIRST} + INTERVAL 1 MONTH)::date AS next_month_start FROM raw_periods""",
        "raw_periods",
    ),
    "expected_range": _sql(
        f"""SELECT min({_FIRST}) AS expected_min_date,
        last_day(max({_FIRST})) AS expected_max_date FROM raw_periods""",
        "raw_periods",
    ),
    "gate_silver": _gate_silver(),
    "gate_silver_inline": _sql(
        f"""SELECT *, silver_count > 0 AND outside_month_count = 0
          AND invalid_pickup_hour_count = 0 AS passed FROM (
        SELECT year, month, count(*) AS silver_count,
        {_failing(_OUTSIDE, 'outside_month_count')},
        {_failing(f'pickup_hour IS NULL OR {_BAD_HOUR}', 'invalid_pickup_hour_count')}
        FROM silver GROUP BY year, month)""",
        "silver",
    ),
    "gate_daily": _gate("daily"),
    "gate_hourly": _gate("hourly"),
    "gate_payment": _gate("payment"),
    "gate_route": _gate("route"),
    "gate_month": _sql(_serving(monthly=True), *_NEED_MARTS),
    "gate_full_range": _sql(
        f"""SELECT *, min_pickup_date = expected_min_date
          AND max_pickup_date = expected_max_date AS range_matches
        FROM ({_serving(monthly=False)}), (SELECT min({_FIRST}) AS expected_min_date,
          last_day(max({_FIRST})) AS expected_max_date FROM trips)""",
        *_NEED_MARTS,
        "trips",
    ),
    "centroid_checks": _sql(
        """SELECT count(*) AS rows_count,
        count(*) - count(DISTINCT location_id) AS duplicate_location_ids_count,
        count(*) FILTER (WHERE trim(borough) = '') AS empty_borough_count,
        count(*) FILTER (WHERE trim(zone) = '') AS empty_zone_count,
        min(latitude) AS min_latitude, max(latitude) AS max_latitude,
        min(longitude) AS min_longitude, max(longitude) AS max_longitude
        FROM centroids""",
        "centroids",
    ),
    "expectations_daily": _column_tests(
        "stg_daily_trips",
        "daily",
        _not_null("pickup_date", "trips_count", "total_revenue")
        + _unique("pickup_date"),
    ),
    "expectations_hourly": _column_tests(
        "stg_hourly_trips", "hourly", _TYPED + _not_null("pickup_hour")
    ),
    "expectations_payment": _column_tests(
        "stg_payment_type_stats",
        "payment",
        _TYPED
        + _not_null("payment_type", "payment_type_name", "total_tips")
        + _accepted("payment_type", "0, 1, 2, 3, 4, 5")
        + _accepted(
            "payment_type_name",
            "'Unknown', 'Credit card', 'Cash', 'No charge', 'Dispute', 'Other'",
        ),
    ),
    "expectations_route": _column_tests(
        "stg_location_pair_stats",
        "route",
        _TYPED + _not_null("pickup_location_id", "dropoff_location_id"),
    ),
    "expectations_centroids": _column_tests(
        "stg_taxi_zone_centroids",
        "centroids",
        _not_null("location_id", "borough", "zone", "longitude", "latitude"),
    ),
    "expectations_metrics": _column_tests(
        "int_daily_trip_metrics", "metrics", _CALENDAR
    ),
    "expectations_kpis": _column_tests(
        "mart_daily_trip_kpis",
        "kpis",
        _CALENDAR
        + _not_null(
            "pickup_month_label", "day_type", "total_revenue_mln", "dominant_trip_type"
        )
        + _accepted("day_type", "'Weekday', 'Weekend'")
        + _accepted("dominant_trip_type", _CLASSES),
    ),
    "grain_hourly": _grain("hourly", "pickup_date, pickup_hour, trip_type"),
    "grain_route": _grain(
        "route", "pickup_date, trip_type, pickup_location_id, dropoff_location_id"
    ),
    "grain_payment": _grain("payment", "pickup_date, trip_type, payment_type"),
    "class_counts_match": _sql(
        """SELECT pickup_date, trips_count, short_trips_count, medium_trips_count,
        long_trips_count + 1 AS long_trips_count,
        trips_count + 1 AS classified_trips_count
        FROM daily WHERE day(pickup_date) = 13""",
        "daily",
    ),
    "shares_sum_to_one": _sql(
        _shares_off("metrics") + " UNION ALL " + _shares_off("kpis"), "kpis"
    ),
    "hour_range": _sql(
        """SELECT pickup_date, if(trip_type = 'long', -1, 24) AS pickup_hour, trip_type
        FROM hourly WHERE pickup_hour = 23""",
        "hourly",
    ),
}
