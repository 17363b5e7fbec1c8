"""Layer addressing, raw month reads, lookup reads and partitioned writes."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill import schemas
from faremill.operators.periods import Period, in_periods
from faremill.sources.columns import registry, unite
from faremill.sources.ledger import Entry, FolderLedger, Key, remove_folders

# casts that lose nothing, by wanted type
_SAFE_CASTS = {
    "bigint": ("bigint", "int", "smallint", "tinyint"),
    "int": ("int", "smallint", "tinyint"),
    "double": ("double", "float", "int", "smallint", "tinyint"),
    "timestamp_ntz": ("timestamp_ntz", "timestamp", "date"),
}
_NUMBERS = ("bigint", "int", "double")


@dataclass(frozen=True)
class Layers:
    """Where each dataset lives under one root folder.

    Bronze and checked trips are kept by loads (see Loads); clean ones are one dataset, bad
    and undetermined ones another, split by a ``row_status`` partition.
    """

    root: str
    taxi_type: str = "yellow"

    @property
    def raw(self) -> str:
        return f"{self.root}/raw/{self.taxi_type}"

    def raw_file(self, period: Period) -> str:
        year, month = period
        name = f"{self.taxi_type}_tripdata_{year}-{month}.parquet"
        return f"{self.raw}/year={year}/month={month}/{name}"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger/{self.taxi_type}"

    @property
    def quality(self) -> str:
        return f"{self.root}/quality/{self.taxi_type}"

    def gold(self, mart: str) -> str:
        return f"{self.root}/gold/{self.taxi_type}/{mart}"

    @property
    def zone_lookup(self) -> str:
        return f"{self.root}/raw/lookup/taxi_zone_lookup.csv"


def text_periods(fields: Iterable[T.StructField]) -> T.StructType:
    """Partition values as text, so that month ``01`` does not become 1."""
    kept = [field for field in fields if field.name not in schemas.PERIOD]
    text = [T.StructField(name, T.StringType()) for name in schemas.PERIOD]
    return T.StructType(kept + text)


def read_months(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    periods: Sequence[Period] | None = None,
) -> DataFrame:
    """A layer of one schema, all of it or only the given months' folders."""
    folders = (
        [path]
        if periods is None
        else [f"{path}/year={year}/month={month}" for year, month in periods]
    )
    reader = spark.read.option("basePath", path).schema(text_periods(schema))
    return reader.parquet(*folders)


def write_months(df: DataFrame, path: str, keys: Sequence[str] = schemas.PERIOD) -> None:
    """Replace exactly the partitions that ``df`` has rows for."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def counted_months(periods: Sequence[Period]) -> list[Column]:
    """Rows of each month, for an observation of a frame that is being written."""
    return [F.count_if(in_periods([month])).alias("".join(month)) for month in periods]


class Loads:
    """Month folders of datasets whose files drift, under the loads that wrote them.

    A write fills new folders and leaves the live ones as they are; the ledger then names
    the new ones. It keeps each month's schema, so that reads need no footers and months of
    different schemas are read together.
    """

    def __init__(self, spark: SparkSession, layers: Layers):
        self.spark = spark
        self.layers = layers
        self.ledger = FolderLedger(spark, layers.ledger)

    def folder(self, dataset: str, load: str) -> str:
        return f"{self.layers.root}/{dataset}/{self.layers.taxi_type}/load={load}"

    def write(
        self,
        dataset: str,
        rows: DataFrame,
        load: str,
        periods: Sequence[Period],
        keys: Sequence[str] = (),
    ) -> dict[Key, Entry]:
        """Write a load's months; entries for the ledger, counted while writing.

        keys: partition columns below the month.
        """
        seen = Observation()
        (
            rows.observe(seen, *counted_months(periods))
            .write.mode("overwrite")
            .partitionBy(*schemas.PERIOD, *keys)
            .parquet(self.folder(dataset, load))
        )
        below = {*schemas.PERIOD, *keys}
        kept = T.StructType([field for field in rows.schema if field.name not in below])
        counts = seen.get
        return {
            (dataset, month): Entry(load, counts["".join(month)], kept.json())
            for month in periods
            if counts["".join(month)]
        }

    def read(
        self, dataset: str, periods: Sequence[Period], keys: Sequence[str] = ()
    ) -> DataFrame:
        """Live months as one frame: one scan for each schema, united by the registry."""
        live = self.ledger.live(dataset)
        return self.scan(dataset, {month: live[month] for month in periods if month in live}, keys)

    def scan(
        self, dataset: str, entries: Mapping[Period, Entry], keys: Sequence[str] = ()
    ) -> DataFrame:
        if not entries:
            raise ValueError(f"no months of {dataset} to read")
        by_schema: dict[str, list[str]] = {}
        for (year, month), entry in sorted(entries.items()):
            folder = f"{self.folder(dataset, entry.load)}/year={year}/month={month}"
            by_schema.setdefault(entry.schema, []).append(folder)
        found = {text: T.StructType.fromJson(json.loads(text)) for text in by_schema}
        below = [T.StructField(name, T.StringType()) for name in keys]
        whole = T.StructType([*text_periods(registry(found.values())), *below])
        base = f"{self.layers.root}/{dataset}/{self.layers.taxi_type}"
        scans = []
        for text, folders in by_schema.items():
            schema = T.StructType([*text_periods(found[text]), *below])
            part = self.spark.read.option("basePath", base).schema(schema).parquet(*folders)
            scans.append(unite(part, whole))
        return reduce(DataFrame.unionByName, scans)

    def expire(self, keep: int = 2) -> None:
        """Remove month folders that none of the newest versions names."""
        gone = self.ledger.retire(keep)
        remove_folders(
            self.spark,
            [
                f"{self.folder(dataset, load)}/year={year}/month={month}"
                for dataset, (year, month), load in sorted(gone)
            ],
        )


def scan_month(spark: SparkSession, layers: Layers, dataset: str, period: Period) -> DataFrame:
    """One month of a layer; only its folder is listed and only its files are read."""
    return Loads(spark, layers).read(dataset, [period]).where(in_periods([period]))


def raw_file_paths(spark: SparkSession, layers: Layers) -> DataFrame:
    """Paths under the raw folder; only the listing is read, no file content."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(f"{layers.root}/raw")
        .select("path")
    )


def conform(raw: DataFrame) -> DataFrame:
    """Give the pipeline's columns one type and count what that cost.

    ``cast_refused`` counts a row's values that have no form in the wanted type and become
    NULL; ``cast_changed`` those that come out different, such as 1.7 as a whole number.
    Other columns stay as they are.
    """
    present = {field.name.lower(): field for field in raw.schema}
    lacking = [name for name in schemas.TRIP_TYPES if name.lower() not in present]
    if lacking:
        raise ValueError(f"raw files lack columns {lacking}")
    refused, changed = [], []
    for name, kind in schemas.TRIP_TYPES.items():
        found = present[name.lower()].dataType
        if found.simpleString() in _SAFE_CASTS.get(kind, (kind,)):
            continue
        cast = F.col(name).try_cast(kind)
        refused.append((F.col(name).isNotNull() & cast.isNull()).cast("int"))
        if found == T.StringType():  # text says a number in many ways: compare the numbers
            back, was = cast.try_cast("double"), F.col(name).try_cast("double")
            lost = back != was if kind in _NUMBERS else F.lit(False)
        else:
            lost = cast.try_cast(found) != F.col(name)
        changed.append(F.coalesce(lost, F.lit(False)).cast("int"))
    total = {"cast_refused": refused, "cast_changed": changed}
    sums = {name: reduce(Column.__add__, parts, F.lit(0)) for name, parts in total.items()}
    typed = {name: F.col(name).try_cast(kind) for name, kind in schemas.TRIP_TYPES.items()}
    return raw.withColumns({**sums, **typed})


def footers(spark: SparkSession, paths: Sequence[str]) -> list[T.StructType]:
    """Schemas of raw files, each from its footer; many are asked for at a time."""
    with ThreadPoolExecutor(max_workers=16) as pool:
        return list(pool.map(lambda path: spark.read.parquet(path).schema, paths))


def read_raw(
    spark: SparkSession, layers: Layers, periods: Sequence[Period]
) -> DataFrame:
    """Raw months as one frame.

    Monthly files drift: a column may be a double in one year and a whole number in the
    next, or change the case of its name. Files with the same footer schema are read
    together, so years of months become a handful of scans, and the scans are united under
    one registry of columns.
    """
    if not periods:
        raise ValueError("no periods to read")
    paths = [layers.raw_file(period) for period in periods]
    by_footer: dict[str, tuple[T.StructType, list[str]]] = {}
    for path, footer in zip(paths, footers(spark, paths), strict=True):
        by_footer.setdefault(footer.json(), (footer, []))[1].append(path)
    scans = [
        conform(
            spark.read.option("basePath", layers.raw)
            .schema(text_periods(footer))
            .parquet(*paths)
        )
        for footer, paths in by_footer.values()
    ]
    whole = registry(scan.schema for scan in scans)
    return reduce(DataFrame.unionByName, [unite(scan, whole) for scan in scans])


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup with all-text columns; the header must match the schema."""
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .schema(schemas.ZONE_LOOKUP)
        .csv(path)
    )


def read_zone_centroids(spark: SparkSession, path: str) -> DataFrame:
    """Zone points; a malformed line fails the read."""
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .schema(schemas.ZONE_CENTROIDS)
        .csv(path)
    )
