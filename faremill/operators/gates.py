"""Quality gates: rule tables compiled into one aggregate per table.

A gate counts every rule's failing rows in a single pass, whole or per period,
and is then judged from the few rows of counts that come back.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from faremill import schemas
from faremill.functions.columns import VALID_PAYMENT_TYPES
from faremill.operators.quality import MonthBounds

MIN_RETAINED_SHARE = 0.7
MAX_REFUSED_SHARE = 0.05

# Columns that must be filled in every clean trip.
REQUIRED_TRIP_COLUMNS = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "pickup_date",
    "pickup_hour",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "trip_distance",
    "total_amount",
)


class GateError(ValueError):
    """A quality gate found rows that must not go further."""


@dataclass(frozen=True)
class Rule:
    """A metric that counts failing rows, and what a failure means."""

    metric: str
    predicate: str
    message: str
    severity: str = "error"


@dataclass(frozen=True)
class Gate:
    """Rules in the order in which they are judged."""

    name: str
    rules: tuple[Rule, ...]
    rows_metric: str = "rows_count"
    extra: tuple[tuple[str, str], ...] = field(default=())

    def profile(self, table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        counts = [
            F.count_if(F.expr(rule.predicate)).alias(rule.metric)
            for rule in self.rules
        ]
        extra = [F.expr(sql).alias(name) for name, sql in self.extra]
        return table.groupBy(*by).agg(
            F.count("*").alias(self.rows_metric), *extra, *counts
        )

    def passed(self) -> Column:
        """Whether a profile row has rows and no failure of error severity."""
        clear = [
            F.col(rule.metric) == 0
            for rule in self.rules
            if rule.severity == "error"
        ]
        return reduce(Column.__and__, clear, F.col(self.rows_metric) > 0)

    def judge(self, row: Row, scope: str = "") -> list[str]:
        """Raise on the first failing error rule; return the warnings."""
        where = f"{self.name}{scope}"
        if row[self.rows_metric] <= 0:
            raise GateError(f"{where} is empty")
        warnings = []
        for rule in self.rules:
            failures = row[rule.metric]
            if failures > 0:
                text = f"{where}: {rule.message} ({failures} rows)"
                if rule.severity == "error":
                    raise GateError(text)
                warnings.append(text)
        return warnings

    def enforce(
        self,
        table: DataFrame,
        by: Sequence[str] = (),
        required: Iterable[tuple[str, ...]] = (),
    ) -> list[str]:
        """Profile, collect one row per group, and judge each of them.

        ``required`` names groups that must be present, since a group without
        rows does not appear in the profile.
        """
        rows = sorted(self.profile(table, by).collect(), key=lambda r: [r[c] or "" for c in by])
        found = {tuple(row[name] for name in by) for row in rows}
        absent = sorted(set(required) - found)
        if absent:
            raise GateError(f"{self.name} has no rows for {absent}")
        warnings = []
        for row in rows:
            scope = " " + "-".join(str(row[name]) for name in by) if by else ""
            warnings += self.judge(row, scope)
        return warnings


@dataclass(frozen=True)
class Fused:
    """Several gates over one frame, profiled by one aggregate.

    Each gate may look at a part of the rows only. A count that several gates ask for is
    made once. ``counts`` are further predicates to count over all rows.
    """

    gates: tuple[Gate, ...]
    where: tuple[str | None, ...] = ()
    counts: tuple[tuple[str, str], ...] = ()

    def _scope(self, position: int) -> str | None:
        return self.where[position] if self.where else None

    def _plan(self, position: int) -> dict[str, str]:
        """SQL of each metric of a gate."""
        gate, scope = self.gates[position], self._scope(position)
        within = f"({scope}) AND " if scope else ""
        filtered = f" FILTER (WHERE {scope})" if scope else ""
        return {
            gate.rows_metric: f"count_if({scope})" if scope else "count(*)",
            **{name: f"{sql}{filtered}" for name, sql in gate.extra},
            **{rule.metric: f"count_if({within}({rule.predicate}))" for rule in gate.rules},
        }

    def _all(self) -> dict[str, str]:
        """Name of each distinct aggregate by its SQL."""
        wanted = [sql for i in range(len(self.gates)) for sql in self._plan(i).values()]
        wanted += ["count(*)", *[f"count_if({sql})" for _, sql in self.counts]]
        return {sql: f"m{i}" for i, sql in enumerate(dict.fromkeys(wanted))}

    def profile(self, table: DataFrame, by: Sequence[str] = (), prefix: str = "") -> DataFrame:
        return table.groupBy(*by).agg(
            *[F.expr(sql).alias(prefix + name) for sql, name in self._all().items()]
        )

    def split(self, row: Row, prefix: str = "") -> tuple[list[dict], dict[str, int]]:
        """Each gate's metrics, and the further counts with all rows under ``total_rows``."""
        names = self._all()

        def of(plan: dict[str, str]) -> dict:
            return {metric: row[prefix + names[sql]] for metric, sql in plan.items()}

        further = {name: f"count_if({sql})" for name, sql in self.counts}
        return (
            [of(self._plan(i)) for i in range(len(self.gates))],
            of({"total_rows": "count(*)", **further}),
        )

    def judge(
        self, found: dict[tuple, list[dict]], required: Iterable[tuple[str, ...]] = ()
    ) -> list[str]:
        """Judge every gate for every group, in the gates' order."""
        warnings = []
        for position, gate in enumerate(self.gates):
            # a group without a row in the gate's part does not count as found
            metrics = {key: each[position] for key, each in found.items() if each[position][gate.rows_metric]}
            absent = sorted(set(required) - set(metrics))
            if absent:
                raise GateError(f"{gate.name} has no rows for {absent}")
            for key, values in sorted(metrics.items(), key=lambda x: [v or "" for v in x[0]]):
                scope = " " + "-".join(map(str, key)) if key else ""
                warnings += gate.judge(values, scope)
        return warnings


def profile_each(
    tables: Mapping[str, tuple[DataFrame, Fused]], by: Sequence[str] = ()
) -> dict[str, dict[tuple, tuple[list[dict], dict[str, int]]]]:
    """Profiles of several tables from one job, by table and group.

    One row per table and group comes back.
    """
    parts = [
        fused.profile(table, by, f"{position}_").withColumn("_table", F.lit(name))
        for position, (name, (table, fused)) in enumerate(tables.items())
    ]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    found: dict[str, dict] = {name: {} for name in tables}
    positions = {name: position for position, name in enumerate(tables)}
    for row in union.collect():
        name = row["_table"]
        key = tuple(row[column] for column in by)
        found[name][key] = tables[name][1].split(row, f"{positions[name]}_")
    return found


def enforce_each(
    tables: Mapping[str, tuple[DataFrame, Fused]],
    by: Sequence[str] = (),
    required: Iterable[tuple[str, ...]] = (),
) -> tuple[list[str], dict[str, dict[tuple, int]]]:
    """Judge several tables from one job; warnings, and each table's rows by group."""
    warnings, rows = [], {}
    required = list(required)
    for name, found in profile_each(tables, by).items():
        warnings += tables[name][1].judge({key: gates for key, (gates, _) in found.items()}, required)
        rows[name] = {key: counts["total_rows"] for key, (_, counts) in found.items()}
    return warnings, rows


def _blank(name: str) -> str:
    return f"{name} IS NULL OR trim({name}) = ''"


def _hour_outside(name: str) -> str:
    return f"{name} < 0 OR {name} > 23"


def silver_inline_gate(bounds: MonthBounds) -> Gate:
    """The short check made on clean trips before they are written."""
    return Gate(
        "silver",
        (
            Rule(
                "outside_month_count",
                bounds.outside("pickup_date"),
                "pickups of another month",
            ),
            Rule(
                "invalid_pickup_hour_count",
                f"pickup_hour IS NULL OR {_hour_outside('pickup_hour')}",
                "no hour of a day",
            ),
        ),
        rows_metric="silver_count",
    )


def silver_gate(bounds: MonthBounds) -> Gate:
    """Seventeen metrics over clean trips; NULL dates are not out of month."""
    codes = ", ".join(str(code) for code in VALID_PAYMENT_TYPES)
    return Gate(
        "silver",
        (
            Rule(
                "outside_month_count",
                bounds.outside("pickup_date"),
                "pickups of another month",
            ),
            *[
                Rule(
                    f"null_{name}",
                    f"{name} IS NULL",
                    f"{name} is not filled",
                )
                for name in REQUIRED_TRIP_COLUMNS
            ],
            Rule(
                "invalid_payment_type_count",
                f"payment_type IS NULL OR payment_type NOT IN ({codes})",
                "unknown payment codes",
            ),
            Rule(
                "invalid_pickup_location_count",
                "PULocationID IS NULL OR PULocationID <= 0",
                "no pickup zone",
            ),
            Rule(
                "invalid_dropoff_location_count",
                "DOLocationID IS NULL OR DOLocationID <= 0",
                "no dropoff zone",
            ),
            Rule(
                "invalid_pickup_hour_count",
                f"pickup_hour IS NULL OR {_hour_outside('pickup_hour')}",
                "no hour of a day",
            ),
            Rule("invalid_distance_count", "trip_distance <= 0", "no distance"),
            Rule(
                "invalid_amount_count",
                "total_amount <= 0",
                "nothing was paid, as after a refund",
                severity="warn",
            ),
        ),
        rows_metric="silver_count",
    )


def check_retention(bronze_rows: int, silver_rows: int, scope: str = "") -> None:
    if bronze_rows == 0:
        raise GateError(f"bronze{scope} is empty")
    if silver_rows == 0:
        raise GateError(f"silver{scope} is empty")
    if silver_rows < bronze_rows * MIN_RETAINED_SHARE:
        raise GateError(
            f"silver{scope}: only {silver_rows} of {bronze_rows} rows are clean"
        )


def check_casts(rows: int, refused: int, scope: str = "") -> None:
    """A month whose values often have no form in the wanted type is broken, not clean."""
    if refused > rows * MAX_REFUSED_SHARE:
        raise GateError(f"bronze{scope}: values of {refused} of {rows} rows could not be read")


def check_contract(table: DataFrame, contract: schemas.MartContract) -> None:
    """Every contract column must be there; extra columns are allowed.

    Only the schema is read. Types are compared too, because a column of the
    wrong type would fail later, in the middle of a load.
    """
    actual = dict(table.dtypes)
    missing = [name for name in contract.contract_names if name not in actual]
    if missing:
        raise GateError(
            f"{contract.name} lacks {missing}; it has {table.columns}"
        )
    wrong = [
        f"{name} is {actual[name]}, expected {kind}"
        for name, kind in contract.columns
        if actual[name] != kind
    ]
    if wrong:
        raise GateError(f"{contract.name} has wrong column types: {wrong}")


def _text_rules(mart: str) -> list[Rule]:
    names = {
        schemas.HOURLY.name: ["trip_type"],
        schemas.PAYMENT.name: ["trip_type", "payment_type_name"],
        schemas.ROUTE.name: ["trip_type", "pickup_zone", "dropoff_zone"],
    }.get(mart, [])
    return [
        Rule(f"empty_{name}_count", _blank(name), f"{name} is blank")
        for name in names
    ]


def mart_gate(mart: str, bounds: MonthBounds) -> Gate:
    """Gate of a mart file before it is loaded; NULL dates and hours fail."""
    text = _text_rules(mart)
    hour = [
        Rule(
            "invalid_pickup_hour_count",
            f"pickup_hour IS NULL OR {_hour_outside('pickup_hour')}",
            "no hour of a day",
        )
    ]
    return Gate(
        mart,
        (
            Rule(
                "outside_month_count",
                f"pickup_date IS NULL OR {bounds.outside('pickup_date')}",
                "rows of another month",
            ),
            *text,
            *(hour if mart == schemas.HOURLY.name else []),
        ),
    )


def serving_month_gate(mart: str, bounds: MonthBounds) -> Gate:
    """Gate of a loaded month; unlike the mart gate, a NULL hour passes."""
    hour = [
        Rule(
            "invalid_pickup_hour_count",
            _hour_outside("pickup_hour"),
            "no hour of a day",
        )
    ]
    return Gate(
        mart,
        (
            Rule(
                "out_of_month_date_count",
                bounds.outside("pickup_date"),
                "pickup dates of another month",
            ),
            Rule(
                "non_positive_trips_count",
                "trips_count <= 0",
                "rows without trips",
            ),
            *_text_rules(mart),
            *(hour if mart == schemas.HOURLY.name else []),
        ),
        extra=(
            ("min_pickup_date", "min(pickup_date)"),
            ("max_pickup_date", "max(pickup_date)"),
        ),
    )


def full_range_gate(mart: str) -> Gate:
    """Gate of a whole serving table; the date range is judged separately."""
    return Gate(
        mart,
        tuple(_text_rules(mart)),
        extra=(
            ("min_pickup_date", "min(pickup_date)"),
            ("max_pickup_date", "max(pickup_date)"),
        ),
    )


def check_full_range(row: Row, mart: str, expected_min, expected_max) -> None:
    gate = full_range_gate(mart)
    if row[gate.rows_metric] <= 0:
        raise GateError(f"{mart} is empty")
    if (row["min_pickup_date"], row["max_pickup_date"]) != (expected_min, expected_max):
        raise GateError(
            f"{mart} spans {row['min_pickup_date']} to {row['max_pickup_date']} instead of "
            f"{expected_min} to {expected_max}"
        )
    gate.judge(row)


def with_expected_range(profiles: DataFrame, expected: DataFrame) -> DataFrame:
    """Put the one expected range beside each table's profile row.

    The range joins as one more row of the union, and a window over these few
    rows (one per table and one for the range) spreads it.
    """
    rows = profiles.unionByName(expected, allowMissingColumns=True)
    everything = Window.partitionBy(F.lit(0))
    spread = rows.withColumns(
        {
            name: F.max(name).over(everything)
            for name in ("expected_min_date", "expected_max_date")
        }
    )
    return spread.where("table_name IS NOT NULL").withColumn(
        "range_matches",
        F.expr(
            "min_pickup_date = expected_min_date"
            " AND max_pickup_date = expected_max_date"
        ),
    )


@dataclass(frozen=True)
class CentroidLimits:
    """What a good zone point file looks like."""

    rows: int = 263
    duplicate_ids: int = 3
    latitude: tuple[float, float] = (40.0, 41.0)
    longitude: tuple[float, float] = (-75.0, -72.0)


def centroid_profile(centroids: DataFrame) -> DataFrame:
    return centroids.agg(
        F.count("*").alias("rows_count"),
        (F.count("*") - F.count_distinct("location_id")).alias(
            "duplicate_location_ids_count"
        ),
        F.count_if(F.trim("borough") == "").alias("empty_borough_count"),
        F.count_if(F.trim("zone") == "").alias("empty_zone_count"),
        F.min("latitude").alias("min_latitude"),
        F.max("latitude").alias("max_latitude"),
        F.min("longitude").alias("min_longitude"),
        F.max("longitude").alias("max_longitude"),
    )


def check_centroids(row: Row, limits: CentroidLimits = CentroidLimits()) -> list[str]:
    if row["rows_count"] != limits.rows:
        raise GateError(
            f"zone points: {row['rows_count']} rows instead of {limits.rows}"
        )
    duplicates = row["duplicate_location_ids_count"]
    if duplicates > limits.duplicate_ids:
        raise GateError(
            f"zone points: {duplicates} repeat a zone, {limits.duplicate_ids} may"
        )
    for name in ("borough", "zone"):
        if row[f"empty_{name}_count"] > 0:
            raise GateError(f"zone points: {name} is empty in some rows")
    for name, (low, high) in (
        ("latitude", limits.latitude),
        ("longitude", limits.longitude),
    ):
        if row[f"min_{name}"] < low or row[f"max_{name}"] > high:
            raise GateError(
                f"zone points: {name} reaches from {row[f'min_{name}']} to {row[f'max_{name}']}"
            )
    if duplicates > 0:
        return ["zone points: some zones have several"]
    return []
