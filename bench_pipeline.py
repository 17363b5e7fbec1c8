"""Time the whole month pipeline and print one JSON line.

Raw month files are written first, from the shared test tables; the timed part
runs from raw files to gated serving tables and models. BENCH_SF_DIR picks the
tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from checks import fixture
from faremill.operators.gates import GateError
from faremill.plans.pipeline import Pipeline
from faremill.session import local_session
from faremill.sources.layers import Layers
from faremill.sources.serving import ServingTables


def shared_folder(spark) -> str:
    """A new folder under the cluster's shared folder; where none is set, in the warehouse,
    which must be shared, too."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/bench-{int(time.time())}"


def write_raw_files(spark, sf_dir: str, layers: Layers) -> int:
    """One raw file per month, mended where a strict gate would refuse it."""
    trips = fixture.raw_trips(spark, sf_dir).withColumns(
        {
            "passenger_count": F.greatest("passenger_count", F.lit(1)),
            "tip_amount": F.coalesce("tip_amount", F.lit(0.0)),
            "payment_type": F.when(F.col("payment_type") == 6, 5).otherwise(
                F.col("payment_type")
            ),
        }
    )
    staged = f"{layers.root}/raw_months"
    by_month = trips.repartition("year", "month")  # one file for each month
    by_month.write.partitionBy("year", "month").parquet(staged)
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.globStatus(hadoop.Path(f"{staged}/year=*/month=*/*.parquet"))
    for status in found:
        source = status.getPath()
        month = source.getParent().getName().removeprefix("month=")
        year = source.getParent().getParent().getName().removeprefix("year=")
        target = hadoop.Path(layers.raw_file((year, month)))
        system.mkdirs(target.getParent())
        system.rename(source, target)
    zones = fixture.table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey + 1 AS string) AS LocationID", "'Borough' AS Borough",
        "n_name AS Zone", "'Service' AS service_zone",
    )
    zones.coalesce(1).write.option("header", True).csv(layers.zone_lookup)
    return len(found)


def refused(pipeline: Pipeline, month) -> None:
    try:
        pipeline.process([month])
    except GateError:
        return
    raise RuntimeError(f"{month} has no clean trips and was loaded")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench_pipeline", cpus=cpus, partitions=int(cpus))
    layers = Layers(shared_folder(spark))
    months = write_raw_files(spark, sf_dir, layers)
    serving = ServingTables(spark, "bench", f"{layers.root}/serving")
    pipeline = Pipeline(spark, layers, serving)
    seconds = {}

    def timed(name, step, *args):
        started = time.perf_counter()
        result = step(*args)
        seconds[name] = round(time.perf_counter() - started, 3)
        return result

    found = timed("new_periods", pipeline.new_periods)
    # a month after the last pickup has only strays, so its gate must refuse it
    last = fixture.raw_trips(spark, sf_dir, ["tpep_pickup_datetime"]).agg(
        F.max(F.date_format("tpep_pickup_datetime", "yyyyMM"))
    ).first()[0]
    todo = [month for month in found if "".join(month) <= last]
    for month in found[len(todo):]:
        timed("refused_month", refused, pipeline, month)
    for name in ("ingest", "check_trips", "assess_trips",
                 "build_marts", "gate_marts", "publish"):
        timed(name, getattr(pipeline, name), todo)
    timed("build_models", pipeline.build_models)
    total = round(sum(seconds.values()), 3)
    trips = pipeline.checked(todo).count()
    print(
        json.dumps(
            {
                "metric": "pipeline_total",
                "value": total,
                "unit": "sec",
                "months": months,
                "trips": trips,
                "trips_per_sec": round(trips / total),
                "steps": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
