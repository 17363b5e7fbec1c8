"""Which load of each dataset's month is live.

Rows are written under the id of the load that made them and are not seen until a ledger
version names that load. A version is the whole state, one row per dataset and month, and is
appended as one file: it is there as a whole or not at all. Versions are never changed, so a
reader sees one state of all datasets, and a former state can be put back. One writer at a
time is assumed, as for any monthly run.
"""

from __future__ import annotations

import uuid
from abc import ABC, abstractmethod
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.operators.periods import Period

ROWS = (
    "dataset string, year string, month string, load string, row_count bigint,"
    " schema string, version bigint"
)

Key = tuple[str, Period]


@dataclass(frozen=True)
class Entry:
    """A live month: the load that holds it, its rows and, for files, their schema."""

    load: str
    rows: int
    schema: str = ""


def new_load() -> str:
    return uuid.uuid4().hex


def file_system(spark: SparkSession, path: str):
    """Spark's own client for a path, and the path as that client takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    for folder in folders:
        system, place = file_system(spark, folder)
        system.delete(place, True)


class Ledger(ABC):
    def __init__(self, spark: SparkSession):
        self.spark = spark

    @abstractmethod
    def rows(self) -> DataFrame:
        """Every row of every version."""

    @abstractmethod
    def append(self, rows: DataFrame, version: int) -> None:
        """Add a version by a single file."""

    @abstractmethod
    def forget(self, versions: Iterable[int]) -> None:
        """Remove versions."""

    def versions(self) -> list[int]:
        return sorted(row["version"] for row in self.rows().select("version").distinct().collect())

    def version(self) -> int:
        """The newest version; 0 before the first."""
        return self.rows().agg(F.coalesce(F.max("version"), F.lit(0)).alias("version")).first()[0]

    def state(self, version: int | None = None) -> dict[Key, Entry]:
        """Live months of all datasets: one collected row per dataset and month."""
        number = self.version() if version is None else version
        found = self.rows().where(F.col("version") == number).where("dataset <> ''")
        return {
            (row["dataset"], (row["year"], row["month"])): Entry(
                row["load"], row["row_count"], row["schema"]
            )
            for row in found.collect()
        }

    def live(self, dataset: str, version: int | None = None) -> dict[Period, Entry]:
        return {month: entry for (name, month), entry in self.state(version).items() if name == dataset}

    def commit(
        self,
        put: Mapping[Key, Entry],
        drop: Iterable[Key] = (),
        keep: bool = True,
    ) -> int:
        """Append the version in which ``put`` is live, ``drop`` is not, and the rest is as
        before (``keep``) or gone."""
        now = self.version()
        state = self.state(now) if keep else {}
        for key in drop:
            state.pop(key, None)
        state.update(put)
        rows = [
            (dataset, year, month, entry.load, entry.rows, entry.schema, now + 1)
            for (dataset, (year, month)), entry in sorted(state.items())
        ]
        # the row of no dataset makes an empty state a version, too
        rows.append(("", "", "", "", 0, "", now + 1))
        self.append(self.spark.createDataFrame(rows, ROWS).coalesce(1), now + 1)
        return now + 1

    def restore(self, version: int) -> int:
        """Make a former state the newest version."""
        if version not in self.versions():
            raise ValueError(f"there is no version {version}")
        return self.commit(self.state(version), keep=False)

    def retire(self, keep: int = 2) -> set[tuple[str, Period, str]]:
        """Forget all but the newest versions; (dataset, month, load) that none names now."""
        versions = self.versions()
        old, kept = versions[:-keep], versions[-keep:]
        if not old:
            return set()
        named = self.rows().where("dataset <> ''")

        def loads(chosen: list[int]) -> set[tuple[str, Period, str]]:
            rows = named.where(F.col("version").isin(chosen)).select("dataset", "year", "month", "load")
            return {(r["dataset"], (r["year"], r["month"]), r["load"]) for r in rows.distinct().collect()}

        gone = loads(old) - loads(kept)
        self.forget(old)
        return gone


class FolderLedger(Ledger):
    """A ledger in a folder, for datasets that are read by path."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark)
        self.path = path

    def rows(self) -> DataFrame:
        system, place = file_system(self.spark, self.path)
        if not system.exists(place):
            return self.spark.createDataFrame([], ROWS)
        return self.spark.read.schema(ROWS).parquet(self.path)

    def append(self, rows: DataFrame, version: int) -> None:
        # fails if another run has taken the number
        rows.drop("version").write.mode("errorifexists").parquet(f"{self.path}/version={version}")

    def forget(self, versions: Iterable[int]) -> None:
        remove_folders(self.spark, [f"{self.path}/version={n}" for n in versions])


class TableLedger(Ledger):
    """A ledger as a catalog table, so that views can read it."""

    def __init__(self, spark: SparkSession, name: str):
        super().__init__(spark)
        self.name = name

    def create(self) -> None:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({ROWS}) USING parquet PARTITIONED BY (version)"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, rows: DataFrame, version: int) -> None:
        rows.write.insertInto(self.name)

    def forget(self, versions: Iterable[int]) -> None:
        for number in versions:
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (version={number})")
