"""The month pipeline end to end over raw files made from the test tables."""

from collections import Counter
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks import fixture
from faremill import schemas
from faremill.operators import marts
from faremill.operators.gates import GateError
from faremill.operators.periods import first_of_month, in_periods, last_of_month
from faremill.plans.pipeline import Pipeline
from faremill.sources import layers as files
from faremill.sources.layers import Layers
from faremill.sources.ledger import TableLedger
from faremill.sources.serving import ServingTables

MONTHS = [("1998", "05"), ("1998", "06"), ("1998", "07")]
REBUILD = {
    "rebuild_mode": "full_raw_rebuild",
    "confirm_full_rebuild": True,
    "confirm_serving_replacement": "true",
    "expected_start_year": "1998",
    "expected_start_month": "05",
    "expected_end_year": "1998",
    "expected_end_month": "07",
}


@pytest.fixture(scope="module")
def trips(spark, small):
    """Three months of trips, mended where gates and model tests would fail.

    Each month gets a clean trip on its first and on its last day.
    """
    source = fixture.raw_trips(spark, small).where(in_periods(MONTHS))
    mended = source.withColumns(
        {
            "passenger_count": F.greatest("passenger_count", F.lit(1)),
            "tip_amount": F.coalesce("tip_amount", F.lit(0.0)),
            "payment_type": F.when(F.col("payment_type") == 6, 5).otherwise(
                F.col("payment_type")
            ),
        }
    )
    frame = mended.toArrow().to_pandas()
    edges = []
    for year, month in MONTHS:
        for day in (first_of_month(year, month), last_of_month(year, month)):
            start = pd.Timestamp(day) + pd.Timedelta(hours=9)
            edges.append(
                {
                    "tpep_pickup_datetime": start,
                    "tpep_dropoff_datetime": start + pd.Timedelta(minutes=30),
                    "passenger_count": 1,
                    "trip_distance": 3.5,
                    "PULocationID": 1,
                    "DOLocationID": 2,
                    "payment_type": 1,
                    "fare_amount": 15.0,
                    "tip_amount": 2.0,
                    "total_amount": 20.0,
                    "year": year,
                    "month": month,
                }
            )
    return pd.concat([frame, pd.DataFrame(edges)], ignore_index=True)


def write_raw(trips, root, months=MONTHS, change=None):
    for year, month in months:
        frame = trips[(trips.year == year) & (trips.month == month)]
        frame = frame.drop(columns=["year", "month"])
        if change is not None:
            frame = change(frame.copy(), (year, month))
        path = Path(Layers(str(root)).raw_file((year, month)))
        path.parent.mkdir(parents=True, exist_ok=True)
        frame.to_parquet(path, index=False, coerce_timestamps="us")


def write_zones(root, count=25):
    path = Path(Layers(str(root)).zone_lookup)
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = ["LocationID,Borough,Zone,service_zone"]
    lines += [f'{n},Borough {n % 3},"Zone, {n}",Service' for n in range(1, count + 1)]
    path.write_text("\n".join(lines) + "\n")


def make_pipeline(spark, root):
    write_zones(root)
    database = "t" + root.name.replace("-", "_")
    serving = ServingTables(spark, database, str(root / "serving"))
    return Pipeline(spark, Layers(str(root)), serving)


@pytest.fixture
def pipeline(spark, tmp_path):
    return make_pipeline(spark, tmp_path)


@pytest.fixture(scope="module")
def loaded(spark, trips, tmp_path_factory):
    """Three loaded months; tests that change them put them back."""
    root = tmp_path_factory.mktemp("loaded")
    pipeline = make_pipeline(spark, root)
    write_raw(trips, root)
    assert pipeline.process_new() == MONTHS
    return pipeline


def rows(df):
    names = [n for n in df.columns if not n.endswith("timestamp")]
    return sorted(map(repr, df.select(*sorted(names)).collect()))


def snapshot(pipeline):
    return {mart: rows(pipeline.serving.table(mart)) for mart in schemas.MARTS}


def root_of(pipeline):
    return pipeline.layers.root


def test_serving_equals_direct_marts(loaded, trips):
    assert loaded.raw_periods() == MONTHS
    silver = loaded.silver(MONTHS)
    zones = files.read_zone_lookup(loaded.spark, loaded.layers.zone_lookup)
    direct = {
        schemas.DAILY.name: marts.daily_mart(silver),
        schemas.HOURLY.name: marts.hourly_mart(silver),
        schemas.PAYMENT.name: marts.payment_mart(silver),
        schemas.ROUTE.name: marts.route_mart(silver, zones),
    }
    assert snapshot(loaded) == {name: rows(mart) for name, mart in direct.items()}
    loaded.gate_serving_months(MONTHS)
    loaded.gate_full_range(MONTHS)


def test_layers_hold_every_row(loaded, trips):
    counts = loaded.checked(MONTHS).groupBy("row_status").count().collect()
    by_status = {row["row_status"]: row["count"] for row in counts}
    assert set(by_status) == {"clean", "bad", "undetermined"}
    assert sum(by_status.values()) == len(trips)
    assert loaded.bad_records(MONTHS).where("dq_reason = ''").isEmpty()
    fresh = Pipeline(loaded.spark, loaded.layers, loaded.serving)
    assert rows(fresh.checked(MONTHS)) == rows(loaded.checked(MONTHS))
    assert rows(fresh.silver(MONTHS)) == rows(loaded.silver(MONTHS))
    report = loaded.spark.read.parquet(loaded.layers.quality)
    assert report.count() == 17 * len(MONTHS)


def test_no_new_months_is_a_success(loaded):
    assert loaded.process_new() == []


def test_month_scan_prunes_partitions(loaded):
    scan = files.scan_month(loaded.spark, loaded.layers, "bronze", MONTHS[1])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryFileIndex(1 paths)") == 1 and "month=06" in "".join(scan.inputFiles())
    months = scan.select("source_year", "source_month").distinct().collect()
    assert [tuple(row) for row in months] == [MONTHS[1]]


def test_refresh_replaces_only_its_month_and_is_idempotent(loaded, trips):
    before = snapshot(loaded)

    def dearer(frame, period):
        frame["total_amount"] = frame["total_amount"] + 1
        return frame

    request = {"start_year": 1998, "start_month": 6, "end_year": "1998", "end_month": "6"}
    write_raw(trips, root_of(loaded), MONTHS[1:2], dearer)
    assert loaded.refresh(request) == [MONTHS[1]]
    after = snapshot(loaded)
    for mart in schemas.MARTS:
        kept = [r for r in before[mart] if "month='06'" not in r]
        assert kept == [r for r in after[mart] if "month='06'" not in r]
        assert before[mart] != after[mart]
    write_raw(trips, root_of(loaded), MONTHS[1:2])
    loaded.refresh(request)
    assert snapshot(loaded) == before


def test_partly_loaded_month_is_picked_up_again(loaded):
    full = snapshot(loaded)
    loaded.serving.delete_months(schemas.ROUTE.name, MONTHS[2:])
    assert loaded.serving.processed_periods() == MONTHS[:2]
    assert loaded.process_new() == MONTHS[2:]
    assert snapshot(loaded) == full
    # the models follow a run that processed something
    kpis = loaded.spark.table(loaded.serving.name("mart_daily_trip_kpis"))
    daily = loaded.serving.table(schemas.DAILY.name)
    assert rows(kpis.select("pickup_date", "trips_count")) == rows(daily.select("pickup_date", "trips_count"))


def test_failed_gate_leaves_serving_untouched(loaded, trips):
    before = snapshot(loaded)
    root = Path(root_of(loaded))
    write_zones(root, count=10)  # unmatched zones must stop the load
    with pytest.raises(GateError, match="pickup_zone is blank"):
        loaded.process(MONTHS[:1])
    write_zones(root)

    def all_bad(frame, period):
        frame["trip_distance"] = -1.0
        return frame

    write_raw(trips, root, MONTHS[:1], all_bad)
    with pytest.raises(GateError, match="silver 1998-05 is empty"):
        loaded.process(MONTHS[:1])
    assert snapshot(loaded) == before
    write_raw(trips, root, MONTHS[:1])
    loaded.prepare(MONTHS[:1])


def test_months_without_new_rows_are_refused(loaded):
    before = snapshot(loaded)
    may = loaded.mart(schemas.DAILY.name, MONTHS[:1])
    with pytest.raises(GateError, match="no rows to load"):
        loaded.serving.replace_months(schemas.DAILY.name, may, MONTHS[:2], "half")
    assert snapshot(loaded) == before


def test_build_models(loaded):
    kpis = loaded.build_models()
    assert kpis.count() == loaded.serving.table(schemas.DAILY.name).count()
    # another session finds the models in the catalog
    other = loaded.spark.newSession()
    staged = other.table(loaded.serving.name("stg_hourly_trips"))
    assert staged.columns[-1] == "gold_load_timestamp"
    assert staged.count() == loaded.serving.table(schemas.HOURLY.name).count()
    assert other.table(loaded.serving.name("int_daily_trip_metrics")).count() == kpis.count()
    voided = loaded.serving.table(schemas.PAYMENT.name).withColumn(
        "payment_type", F.lit(6).cast("bigint")
    )
    with pytest.raises(GateError, match="accepted_values on payment_type"):
        loaded._test_model("stg_payment_type_stats", voided)


def test_rebuild_changes_only_after_gates(loaded):
    loaded.serving.delete_month(MONTHS[2])
    old = snapshot(loaded)
    with pytest.raises(ValueError, match="Missing periods: 1998-08"):
        loaded.rebuild({**REBUILD, "expected_end_month": "08"})
    assert snapshot(loaded) == old
    before = loaded.serving.ledger.version()
    assert loaded.rebuild(REBUILD) == MONTHS
    assert loaded.serving.processed_periods() == MONTHS
    whole = snapshot(loaded)
    assert rows(loaded.serving.table(schemas.DAILY.name, before)) == old[schemas.DAILY.name]
    loaded.serving.ledger.restore(before)
    assert snapshot(loaded) == old
    loaded.serving.ledger.restore(before + 1)
    assert snapshot(loaded) == whole
    with pytest.raises(ValueError, match="no version 0"):
        loaded.serving.ledger.restore(0)


def test_models_rewrite_only_changed_months(loaded, trips):
    """A one-month run computes one month of KPIs; the other months' files stay."""
    loaded.build_models()

    def kpi_files():
        return set(loaded.spark.table(loaded.serving.name("mart_daily_trip_kpis__loads")).inputFiles())

    before, live = kpi_files(), loaded.serving.ledger.live("mart_daily_trip_kpis")
    assert sorted(live) == MONTHS
    loaded.process(MONTHS[1:2])
    kpis = loaded.build_models()
    now = loaded.serving.ledger.live("mart_daily_trip_kpis")
    assert [month for month in MONTHS if now[month] != live[month]] == MONTHS[1:2]
    fresh = kpi_files() - before
    assert fresh and all(f"load={now[MONTHS[1]].load}/year=1998/month=06/" in f for f in fresh)
    assert kpis.count() == loaded.serving.table(schemas.DAILY.name).count()
    loaded.serving.delete_month(MONTHS[0])
    assert loaded.build_models().where("pickup_month_number = 5").isEmpty()
    loaded.process(MONTHS[:1])


def test_views_prune_to_live_loads(loaded):
    view = loaded.serving.table(schemas.DAILY.name).where("year = '1998' AND month = '06'")
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_delete_and_truncate(loaded):
    loaded.serving.delete_month(("1998", 5))
    assert loaded.serving.processed_periods() == MONTHS[1:]
    daily = loaded.serving.table(schemas.DAILY.name)
    assert daily.where(in_periods(MONTHS[:1])).isEmpty()
    loaded.serving.truncate()
    assert loaded.serving.table(schemas.DAILY.name).isEmpty()
    assert loaded.serving.processed_periods() == []


def test_month_without_bad_rows_drops_the_former_bad_rows(pipeline, trips, tmp_path):
    def split():
        pipeline.ingest(MONTHS[:1])
        pipeline.check_trips(MONTHS[:1])
        counts = pipeline.checked(MONTHS[:1]).groupBy("row_status").count().collect()
        return {row["row_status"]: row["count"] for row in counts}

    write_raw(trips, tmp_path, MONTHS[:1])
    assert split()["bad"] > 0

    def only_edges(frame, period):
        return frame.tail(2)

    write_raw(trips, tmp_path, MONTHS[:1], only_edges)
    assert split() == {"clean": 2}


def test_drifting_raw_columns_are_read_together(pipeline, trips, tmp_path):
    def drift(frame, period):
        if period == MONTHS[0]:
            frame["passenger_count"] = frame["passenger_count"].astype("float64")
            frame["airport_fee"] = 1.25
        return frame

    write_raw(trips, tmp_path, change=drift)
    pipeline.ingest(MONTHS)
    pipeline.check_trips(MONTHS)
    fresh = Pipeline(pipeline.spark, pipeline.layers, pipeline.serving)
    for reader in (pipeline, fresh):
        silver = reader.silver(MONTHS)
        assert dict(silver.dtypes)["passenger_count"] == "bigint"
        fees = silver.groupBy("month").agg(F.count("airport_fee").alias("n")).collect()
        assert {r["month"]: r["n"] > 0 for r in fees} == {
            "05": True,
            "06": False,
            "07": False,
        }


def test_missing_raw_column_is_refused(pipeline, trips, tmp_path):
    write_raw(trips, tmp_path, MONTHS[:1], lambda f, p: f.drop(columns="tip_amount"))
    with pytest.raises(ValueError, match="tip_amount"):
        pipeline.ingest(MONTHS[:1])


def test_zone_points_are_checked_before_they_replace(pipeline, tmp_path):
    path = tmp_path / "points.csv"
    header = "location_id,borough,zone,longitude,latitude"
    good = [f'{n},B,"Zone, {n}",-73.9,40.7' for n in range(1, 262)]
    path.write_text("\n".join([header, *good, "1,B,Z,-73.8,40.6", "2,B,Z,-73.8,40.6"]))
    warnings = pipeline.load_centroids(str(path))
    assert warnings == ["zone points: some zones have several"]
    table = pipeline.spark.table(pipeline.serving.name(schemas.CENTROIDS_TABLE))
    assert table.count() == 263
    path.write_text("\n".join([header, *good]))
    with pytest.raises(GateError, match="261 rows instead of 263"):
        pipeline.load_centroids(str(path))
    assert table.count() == 263


def test_a_raw_month_that_lost_its_rows_is_refused(pipeline, trips, tmp_path):
    write_raw(trips, tmp_path, MONTHS[:2])
    assert pipeline.process(MONTHS[:2]) == MONTHS[:2]
    before = snapshot(pipeline)
    write_raw(trips, tmp_path, MONTHS[1:2], lambda frame, period: frame.head(0))
    fresh = Pipeline(pipeline.spark, pipeline.layers, pipeline.serving)
    with pytest.raises(GateError, match="without rows.*'06'"):
        fresh.process(MONTHS[:2])
    assert snapshot(pipeline) == before


STEPS = (
    [("load", k) for k in range(4)]
    + [("gate_serving", 0), ("append", 0), ("expire", 0)]
)


@pytest.mark.parametrize("late", [False, True])
@pytest.mark.parametrize(("step", "call"), STEPS)
def test_a_killed_run_leaves_all_tables_old_or_all_new(
    half, trips, monkeypatch, step, call, late
):
    """Killed before or after each step of publishing: no table differs from the others."""
    pipeline, old, new = half
    owner = {"load": ServingTables, "expire": ServingTables, "gate_serving": Pipeline, "append": TableLedger}[step]
    real, calls = getattr(owner, step), []

    def dying(self, *args, **named):
        calls.append(step)
        if len(calls) - 1 != call:
            return real(self, *args, **named)
        if late:
            real(self, *args, **named)
        raise OSError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(owner, step, dying)
        with pytest.raises(OSError):
            pipeline.publish(MONTHS[:1])
    published = step == "expire" or (step == "append" and late)
    assert snapshot(pipeline) == (new if published else old)
    if published:
        pipeline.serving.ledger.restore(pipeline.serving.ledger.version() - 1)
    assert snapshot(pipeline) == old


@pytest.fixture(scope="module")
def half(spark, trips, tmp_path_factory):
    """A published month whose next version is prepared: (pipeline, old rows, new rows)."""
    root = tmp_path_factory.mktemp("half")
    pipeline = make_pipeline(spark, root)
    write_raw(trips, root, MONTHS[:1], lambda frame, period: frame.tail(2))
    pipeline.process(MONTHS[:1])
    old = snapshot(pipeline)
    write_raw(trips, root, MONTHS[:1])
    pipeline.publish(MONTHS[:1], pipeline.prepare(MONTHS[:1]))
    new = snapshot(pipeline)
    assert all(old[mart] != new[mart] for mart in old)
    pipeline.serving.ledger.restore(pipeline.serving.ledger.version() - 1)
    return pipeline, old, new


def test_a_version_that_was_cut_off_is_not_seen(half, spark):
    """A version's file that the catalog does not know yet changes nothing."""
    pipeline, old, _ = half
    ledger = pipeline.serving.ledger
    number = ledger.version()
    folder = Path(ledger.rows().inputFiles()[0].removeprefix("file://")).parent.parent
    cut = folder / f"version={number + 1}"
    cut.mkdir()
    (cut / "part-0.parquet").write_bytes(b"cut off")
    assert ledger.version() == number and snapshot(pipeline) == old
    (cut / "part-0.parquet").unlink()
    cut.rmdir()


def test_rows_that_got_lost_on_the_way_are_noticed(half, monkeypatch):
    pipeline, old, _ = half
    real = ServingTables.loaded

    def lossy(self, mart, load, months):
        frame = real(self, mart, load, months)
        return frame.where("pickup_hour <> 9") if mart == schemas.HOURLY.name else frame

    with monkeypatch.context() as patch:
        patch.setattr(ServingTables, "loaded", lossy)
        with pytest.raises(GateError, match="gold_hourly_trips: loaded"):
            pipeline.publish(MONTHS[:1])
    assert snapshot(pipeline) == old


def test_former_loads_expire(pipeline, trips, tmp_path):
    write_raw(trips, tmp_path, MONTHS[:1])
    for _ in range(3):
        pipeline.process(MONTHS[:1])
    table = pipeline.spark.table(pipeline.serving.name(schemas.DAILY.name, "__loads"))
    assert table.select("load").distinct().count() == 2  # the live one and one before it
    assert len(pipeline.serving.ledger.versions()) == 2
    assert len(list((tmp_path / "checked" / "yellow").glob("load=*/year=*/month=*"))) <= 2


def test_a_failed_write_leaves_checked_rows_as_they_were(pipeline, trips, tmp_path, monkeypatch):
    write_raw(trips, tmp_path, MONTHS[:1])
    pipeline.ingest(MONTHS[:1])
    pipeline.check_trips(MONTHS[:1])
    before = rows(pipeline.checked(MONTHS[:1]))
    write_raw(trips, tmp_path, MONTHS[:1], lambda frame, period: frame.tail(2))
    pipeline.ingest(MONTHS[:1])
    real = files.Loads.write

    def failing(self, dataset, *rest):
        if dataset == "rejected":
            raise OSError("disk full")
        return real(self, dataset, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(files.Loads, "write", failing)
        with pytest.raises(OSError):
            pipeline.check_trips(MONTHS[:1])
    assert rows(pipeline.checked(MONTHS[:1])) == before
    pipeline.check_trips(MONTHS[:1])
    assert pipeline.checked(MONTHS[:1]).count() == 2


def test_rejected_rows_are_packed(pipeline, trips, tmp_path):
    """Clean rows stay where their split is; the few others of a month share a file."""
    write_raw(trips, tmp_path)
    pipeline.ingest(MONTHS)
    spread = pipeline.loads.read("bronze", MONTHS).repartition(6)
    entries = pipeline.loads.write("bronze", spread, "spread", MONTHS)
    pipeline.loads.ledger.commit(entries)
    pipeline.check_trips(MONTHS)
    for status in ("bad", "undetermined"):
        found = (tmp_path / "rejected").rglob(f"month=*/row_status={status}/*.parquet")
        per_month = Counter(str(f.parent) for f in found)
        assert len(per_month) >= 2 and set(per_month.values()) == {1}
        assert not list((tmp_path / "checked").rglob(f"row_status={status}"))


def test_names_and_types_may_drift_between_runs(pipeline, trips, tmp_path):
    """A fee column changes its case, its type and its place; an int column becomes text."""

    def first(frame, period):
        return frame.assign(airport_fee=2, note=7)

    def second(frame, period):
        frame = frame.assign(Airport_fee=1.25, note="seven")
        return frame[["Airport_fee", *[c for c in frame.columns if c != "Airport_fee"]]]

    write_raw(trips, tmp_path, MONTHS[:1], first)
    pipeline.process(MONTHS[:1])
    write_raw(trips, tmp_path, MONTHS[1:2], second)
    fresh = Pipeline(pipeline.spark, pipeline.layers, pipeline.serving)
    fresh.process(MONTHS[1:2])
    for frame in (fresh.loads.read("bronze", MONTHS[:2]), fresh.silver(MONTHS[:2])):
        kinds = dict(frame.dtypes)
        assert kinds["airport_fee"] == "double" and kinds["note"] == "string"
        assert "Airport_fee" not in kinds
        found = frame.groupBy("month").agg(
            F.min("airport_fee").alias("low"), F.max("airport_fee").alias("high"), F.max("note").alias("note")
        )
        assert {tuple(row) for row in found.collect()} == {
            ("05", 2.0, 2.0, "7"),
            ("06", 1.25, 1.25, "seven"),
        }


def test_reading_layers_runs_no_footer_jobs(loaded, monkeypatch):
    """Schemas of bronze and checked months come from the ledger."""

    def none(*args):
        raise AssertionError("a footer was read")

    monkeypatch.setattr(files, "footers", none)
    assert loaded.checked(MONTHS).count() > 0
    plan = loaded.silver(MONTHS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1  # months of one schema are one scan


def test_casts_are_counted_and_broken_months_refused(pipeline, trips, tmp_path):
    def some(frame, period):
        frame["passenger_count"] = frame["passenger_count"].astype("float64")
        frame.loc[frame.index[:3], "passenger_count"] = [1.7, 2.5, float("nan")]
        frame["PULocationID"] = frame["PULocationID"].astype("Int64").astype("string")
        frame.loc[frame.index[3], "PULocationID"] = "12a"
        return frame

    write_raw(trips, tmp_path, MONTHS[:1], some)
    pipeline.process(MONTHS[:1])
    report = pipeline.spark.read.parquet(pipeline.layers.quality)
    failed = {row["check"]: row["failed_rows"] for row in report.collect()}
    assert failed["dq_cast_changed"] == 2 and failed["dq_cast_refused"] >= 1
    before = snapshot(pipeline)

    def broken(frame, period):
        return frame.assign(fare_amount="abc")

    write_raw(trips, tmp_path, MONTHS[:1], broken)
    with pytest.raises(GateError, match="could not be read"):
        pipeline.process(MONTHS[:1])
    assert snapshot(pipeline) == before
