"""The month pipeline: raw files to checked trips, marts, gates and serving.

A run takes any number of months through each step in one plan. Every step
starts from a written layer, so a lost executor costs one step's tasks at most,
and serving tables change only after every gate has passed, all at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill import schemas
from faremill.operators import data_tests, gates, marts, periods, quality
from faremill.operators.gates import CentroidLimits, Fused
from faremill.operators.periods import PERIOD, Period
from faremill.operators.quality import MonthBounds
from faremill.plans import models, requests
from faremill.sources import layers as files
from faremill.sources.layers import Layers, Loads
from faremill.sources.ledger import Entry, new_load
from faremill.sources.serving import ServingTables

_BOUNDS = MonthBounds.per_row()
STATUS = ("row_status",)


@dataclass
class Pipeline:
    spark: SparkSession
    layers: Layers
    serving: ServingTables
    max_refresh_months: int = requests.MAX_REFRESH_MONTHS
    warnings: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.loads = Loads(self.spark, self.layers)

    # --- layers ----------------------------------------------------------------

    def ingest(self, months: Sequence[Period]) -> None:
        """Raw files to bronze. Each task reads one file's split, so the months
        come out partitioned without a shuffle."""
        raw = files.read_raw(self.spark, self.layers, months)
        bronze = quality.add_ingest_metadata(raw)
        entries = self.loads.write("bronze", bronze, new_load(), months)
        # a month without rows would leave its former rows in every layer
        empty = sorted(set(months) - {month for _, month in entries})
        if empty:
            raise gates.GateError(f"raw files without rows: {empty}")
        self.loads.ledger.commit(entries)

    def check_trips(self, months: Sequence[Period]) -> None:
        """Bronze to clean, bad and undetermined trips.

        Flags are computed in one pass that writes every row where its split is, so clean
        rows, nearly all, are not shuffled. The few others are read again and packed into
        few files. The months change when the ledger names both.
        """
        bronze = self.loads.read("bronze", months)
        flagged = quality.add_quality_flags(bronze, _BOUNDS)
        flags = quality.flag_columns(flagged)
        rows = quality.add_trip_attributes(flagged).withColumns(
            {
                "row_status": quality.row_status(flags),
                "dq_reason": quality.failure_reason(flags),
                "silver_load_timestamp": F.current_timestamp(),
            }
        )
        load = new_load()
        split = self.loads.write("checked", rows, load, months, STATUS)
        every = {month: entry for (_, month), entry in split.items()}
        others = self.loads.scan("checked", every, STATUS).where("row_status <> 'clean'")
        rest = self.loads.write(
            "rejected", others.hint("rebalance", *STATUS, *PERIOD), load, months, STATUS
        )
        # a month that has no bad rows now must not keep the last run's
        cleared = [("rejected", month) for month in months if ("rejected", month) not in rest]
        self.loads.ledger.commit({**split, **rest}, drop=cleared)
        files.remove_folders(
            self.spark,
            [
                f"{self.loads.folder('checked', load)}/year={year}/month={month}/row_status={status}"
                for year, month in months
                for status in ("bad", "undetermined")
            ],
        )
        self.loads.expire()

    def checked(self, months: Sequence[Period]) -> DataFrame:
        """Flags and status of every row of the months."""
        clean = self.loads.read("checked", months, STATUS).where("row_status = 'clean'")
        live = self.loads.ledger.live("rejected")
        rest = {month: live[month] for month in months if month in live}
        if not rest:
            return clean
        return clean.unionByName(self.loads.scan("rejected", rest, STATUS), allowMissingColumns=True)

    def silver(self, months: Sequence[Period]) -> DataFrame:
        clean = self.loads.read("checked", months, STATUS).where("row_status = 'clean'")
        gone = [*quality.flag_columns(clean), *quality.AUDIT_COLUMNS, "row_status"]
        return clean.drop(*gone)

    def bad_records(self, months: Sequence[Period]) -> DataFrame:
        return self.checked(months).where("row_status = 'bad'").drop("row_status")

    def assess_trips(self, months: Sequence[Period]) -> None:
        """Quality report, cast audit, retention and the clean trips' gate from one pass."""
        rows = self.checked(months).drop("dq_reason")
        counts = {**quality.report_counts(rows), "clean_rows": "row_status = 'clean'"}
        fused = Fused(
            (gates.silver_gate(_BOUNDS),), ("row_status = 'clean'",), tuple(counts.items())
        )
        found = gates.profile_each({"silver": (rows, fused)}, PERIOD)["silver"]
        self._write_report({month: further for month, (_, further) in found.items()})
        for year, month in months:
            further = found[year, month][1] if (year, month) in found else {}
            total, scope = further.get("total_rows", 0), f" {year}-{month}"
            gates.check_casts(total, further.get("dq_cast_refused", 0), scope)
            gates.check_retention(total, further.get("clean_rows", 0), scope)
        self.warnings += fused.judge({key: each for key, (each, _) in found.items()}, months)

    def _write_report(self, counts: Mapping[tuple, Mapping[str, int]]) -> None:
        """The report from the counts, one row per month, that are here already."""
        rows = [
            {**dict(zip(PERIOD, month, strict=True)), **{k: v for k, v in found.items() if k != "clean_rows"}}
            for month, found in sorted(counts.items())
        ]
        names = list(rows[0])
        kinds = [f"{name} {'string' if name in PERIOD else 'bigint'}" for name in names]
        frame = self.spark.createDataFrame([tuple(row[n] for n in names) for row in rows], ", ".join(kinds))
        report = quality.report_of(frame, PERIOD).withColumn("created_at", F.current_timestamp())
        files.write_months(report.coalesce(1), self.layers.quality)

    # --- marts -----------------------------------------------------------------

    def build_marts(self, months: Sequence[Period]) -> None:
        """Four marts from two scans of clean trips.

        Date, hour and payment marts roll up from one small cube. It is kept on
        the executors only while the three writes run; a lost block is rebuilt
        from the silver files.
        """
        trips = self.silver(months)
        zones = files.read_zone_lookup(self.spark, self.layers.zone_lookup)
        cube = marts.trip_cube(trips).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            built = {
                schemas.DAILY: marts.daily_mart_from(cube),
                schemas.HOURLY: marts.hourly_mart_from(cube),
                schemas.PAYMENT: marts.payment_mart_from(cube),
                schemas.ROUTE: marts.route_mart(trips, zones),
            }
            for contract, mart in built.items():
                stamped = mart.withColumn(contract.stamp, F.current_timestamp())
                path = self.layers.gold(contract.name)
                files.write_months(stamped.hint("rebalance", *PERIOD), path)
        finally:
            cube.unpersist()

    def mart(self, name: str, months: Sequence[Period]) -> DataFrame:
        schema = T._parse_datatype_string(schemas.MARTS[name].ddl)
        return files.read_months(self.spark, self.layers.gold(name), schema, months)

    def gate_marts(self, months: Sequence[Period]) -> dict[str, dict[Period, int]]:
        """Contract, mart rules and serving rules of all marts in one job, before anything
        is loaded; each mart's rows by month."""
        tables = {}
        for name, contract in schemas.MARTS.items():
            year, month = months[-1]
            folder = f"{self.layers.gold(name)}/year={year}/month={month}"
            stored = files.text_periods(files.footers(self.spark, [folder])[0])
            gates.check_contract(self.spark.createDataFrame([], stored), contract)
            tables[name] = (
                self.mart(name, months),
                Fused((gates.mart_gate(name, _BOUNDS), gates.serving_month_gate(name, _BOUNDS))),
            )
        warnings, rows = gates.enforce_each(tables, PERIOD, months)
        self.warnings += warnings
        return rows

    # --- runs ------------------------------------------------------------------

    def prepare(self, months: Sequence[Period]) -> dict[str, dict[Period, int]]:
        """Everything up to gated marts; serving tables stay as they are."""
        self.ingest(months)
        self.check_trips(months)
        self.assess_trips(months)
        self.build_marts(months)
        return self.gate_marts(months)

    def publish(
        self,
        months: Sequence[Period],
        expected: Mapping[str, Mapping[Period, int]] | None = None,
        whole: bool = False,
    ) -> None:
        """Load the months into every serving table, gate the loads, then make them live.

        Nothing that readers see changes before the ledger's new version, which changes all
        tables at once. ``expected``: rows of each mart by month, from its gate. ``whole``:
        other months go, and the tables' range is gated as well.
        """
        self.serving.create()
        load = new_load()
        entries: dict[Any, Entry] = {}
        for name in schemas.MARTS:
            entries |= self.serving.load(name, self.mart(name, months), months, load)
        tables = {name: self.serving.loaded(name, load, months) for name in schemas.MARTS}
        rows = self.gate_serving(tables, months)
        for (name, month), entry in entries.items():
            found = rows[name].get(month, 0)
            if not found == entry.rows == (expected or rows)[name].get(month):
                raise gates.GateError(f"{name}: loaded {found} rows for {month}, wrote {entry.rows}")
        if whole:
            self.gate_range(tables, months)
        self.serving.ledger.commit(entries, keep=not whole)
        self.serving.expire()

    def process(self, months: Sequence[Period]) -> list[Period]:
        """Take months from raw files to the serving tables."""
        chosen = sorted({periods.normalize_period(*month) for month in months})
        if chosen:
            self.publish(chosen, self.prepare(chosen))
        return chosen

    def raw_periods(self) -> list[Period]:
        paths = files.raw_file_paths(self.spark, self.layers)
        return periods.collect_periods(
            periods.discover_periods(paths, self.layers.taxi_type)
        )

    def new_periods(self) -> list[Period]:
        """Raw months that are not yet in every serving table."""
        self.serving.create()
        return sorted(set(self.raw_periods()) - set(self.serving.processed_periods()))

    def process_new(self) -> list[Period]:
        """Process new and partly loaded months, then the models; none is a success."""
        done = self.process(self.new_periods())
        if done:
            self.build_models()
        return done

    def refresh(self, config: Mapping[str, Any] | None = None) -> list[Period]:
        """Replace the requested months and leave the others alone."""
        return self.process(requests.refresh_periods(config, self.max_refresh_months))

    def rebuild(self, config: Mapping[str, Any]) -> list[Period]:
        """Rebuild every month beside the live ones, gate, then make the new ones live.

        The former state stays as a ledger version that ``restore`` brings back.
        """
        request = requests.rebuild_request(config)
        months = periods.check_rebuild_source(self.raw_periods(), request.expected)
        self.publish(months, self.prepare(months), whole=True)
        return months

    def gate_range(self, tables: Mapping[str, DataFrame], months: Sequence[Period]) -> None:
        """First and last date of each table must be those of the months."""
        first = periods.first_of_month(*months[0])
        last = periods.last_of_month(*months[-1])
        fused = {name: (table, Fused((gates.full_range_gate(name),))) for name, table in tables.items()}
        for name, found in gates.profile_each(fused).items():
            gates.check_full_range(found[()][0][0], name, first, last)

    def gate_full_range(self, months: Sequence[Period]) -> None:
        self.serving.check_exist()
        self.gate_range({name: self.serving.table(name) for name in schemas.MARTS}, months)

    def gate_serving(
        self, tables: Mapping[str, DataFrame], months: Sequence[Period]
    ) -> dict[str, dict[tuple, int]]:
        """Serving rules for months of all tables in one job; each table's rows by month."""
        fused = {
            name: (table, Fused((gates.serving_month_gate(name, _BOUNDS),)))
            for name, table in tables.items()
        }
        warnings, rows = gates.enforce_each(fused, PERIOD, months)
        self.warnings += warnings
        return rows

    def gate_serving_months(self, months: Sequence[Period]) -> None:
        self.serving.check_exist()
        live = {
            name: self.serving.table(name).where(periods.in_periods(months))
            for name in schemas.MARTS
        }
        self.gate_serving(live, months)

    def load_centroids(self, path: str, limits: CentroidLimits = CentroidLimits()) -> list[str]:
        """Replace the zone points with a snapshot that passes its checks."""
        centroids = files.read_zone_centroids(self.spark, path)
        profile = gates.centroid_profile(centroids).first()
        warnings = gates.check_centroids(profile, limits)
        table = self.serving.name(schemas.CENTROIDS_TABLE)
        centroids.write.mode("overwrite").saveAsTable(table)
        return warnings

    # --- models ----------------------------------------------------------------

    def build_models(self) -> DataFrame:
        """Staging and metric views in the catalog, the KPI table, and their tests in order.

        The views show what is live in the serving tables. KPI rows are kept by month under
        the load of the daily mart that they come from, so only months whose load has
        changed are computed and written; they become live when their tests have passed.
        """
        found = {name: self.serving.name(name) for name in schemas.MARTS}
        if self.spark.catalog.tableExists(self.serving.name(schemas.CENTROIDS_TABLE)):
            found[schemas.CENTROIDS_TABLE] = self.serving.name(schemas.CENTROIDS_TABLE)
        for model in (*models.STAGING.values(), models.METRICS):
            found[model] = self.serving.name(model)
        staged = {}
        for name, sql in models.view_sql(found).items():
            self._test_model(name, self.spark.sql(sql))
            self.spark.sql(f"CREATE OR REPLACE VIEW {found[name]} AS {sql}")
            staged[name] = self.spark.table(found[name])
        self._assert_none(staged, staged[models.METRICS])
        return self._build_kpis()

    def _build_kpis(self) -> DataFrame:
        daily, table = schemas.DAILY, models.KPIS
        state = self.serving.ledger.state()
        source = {month: e for (name, month), e in state.items() if name == daily.name}
        built = {month: e for (name, month), e in state.items() if name == table}
        stale = sorted(m for m, e in source.items() if m not in built or built[m].load != e.load)
        gone = [(table, month) for month in built if month not in source]
        rows = self.spark.table(self.serving.name(daily.name, "__loads"))
        chosen = [source[month].load + "".join(month) for month in stale]
        rows = rows.where(F.concat("load", *PERIOD).isin(chosen))
        whole = models.daily_kpis(models.daily_metrics(rows.select(*daily.stored_names)))
        places = rows.select("pickup_date", "load", *PERIOD)
        kpis = whole.join(places, "pickup_date").select(*whole.columns, "load", *PERIOD)
        ddl = ", ".join(f"{name} {kind}" for name, kind in kpis.dtypes if name != "load")
        self.serving.define(table, ddl, whole.columns)
        if stale:
            ready = kpis.hint("rebalance", *PERIOD).sortWithinPartitions(*PERIOD, "pickup_date")
            counts = self.serving.insert(table, ready, stale)
            entries = {(table, m): Entry(source[m].load, n) for m, n in counts.items()}
            written = self.spark.table(self.serving.name(table, "__loads"))
            written = written.where(F.concat("load", *PERIOD).isin(chosen)).select(*whole.columns)
            self._test_model(table, written)
            self._must_be_empty(
                "KPI class shares sum to one", data_tests.share_sum_mismatches(written)
            )
            self.serving.ledger.commit(entries, drop=gone)
        elif gone:
            self.serving.ledger.commit({}, drop=gone)
        return self.spark.table(self.serving.name(table))

    @staticmethod
    def _test_model(name: str, model: DataFrame) -> None:
        failed = [
            f"{row['test']} on {row['column_name']} ({row['failures']} rows)"
            for row in data_tests.run_column_tests(model, name).collect()
            if row["failures"] > 0
        ]
        if failed:
            raise gates.GateError(f"{name} fails {failed}")

    @staticmethod
    def _must_be_empty(what: str, rows: DataFrame) -> None:
        if not rows.isEmpty():
            raise gates.GateError(f"data test failed: {what}")

    def _assert_none(self, staged: dict[str, DataFrame], metrics: DataFrame) -> None:
        for contract in (schemas.HOURLY, schemas.ROUTE, schemas.PAYMENT):
            model = staged[models.STAGING[contract.name]]
            self._must_be_empty(
                f"{contract.name} grain is unique",
                data_tests.duplicate_grain(model, contract.grain),
            )
        self._must_be_empty(
            "class counts match the total",
            data_tests.class_count_mismatches(staged["stg_daily_trips"]),
        )
        self._must_be_empty(
            "hours are valid",
            data_tests.hours_out_of_range(staged["stg_hourly_trips"]),
        )
        self._must_be_empty(
            "class shares sum to one", data_tests.share_sum_mismatches(metrics)
        )
