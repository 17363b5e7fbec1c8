"""Serving tables: months under loads, one ledger version that all readers resolve.

Rows of a table live under the load that wrote them. Views with the tables' plain names show
the loads that the newest ledger version names, so all tables change together, when that
version is added, and a run that ends before has changed nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from faremill import schemas
from faremill.operators.gates import GateError
from faremill.operators.periods import PERIOD, Period, in_periods, normalize_period
from faremill.sources.layers import counted_months
from faremill.sources.ledger import Entry, Key, TableLedger

LOADS = "__loads"
LEDGER = "live_months"


@contextmanager
def replacing_partitions(spark: SparkSession) -> Iterator[None]:
    """Make table overwrites replace only the partitions being written.

    Table inserts take this from the session, not from a writer option.
    """
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, "static")
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class ServingTables:
    """Managed tables of one database, partitioned by load, year and month."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None):
        self.spark = spark
        self.database = database
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
        self.ledger = TableLedger(spark, self.name(LEDGER))

    def name(self, table: str, suffix: str = "") -> str:
        return f"{self.database}.{table}{suffix}"

    def create(self) -> None:
        self.ledger.create()
        for mart in schemas.MARTS.values():
            self.define(mart.name, mart.ddl, mart.stored_names)

    def define(self, table: str, ddl: str, columns: Sequence[str]) -> None:
        """A table of loads, and the view of its live months."""
        loads = self.name(table, LOADS)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {loads} ({ddl}, load string) USING parquet "
            "PARTITIONED BY (load, year, month)"
        )
        if self.spark.catalog.tableExists(self.name(table)):
            return
        ledger = self.name(LEDGER)
        # the live months are a few rows, so they prune the partitions of the loads
        self.spark.sql(
            f"CREATE VIEW {self.name(table)} AS "
            f"SELECT {', '.join('rows.' + name for name in columns)} FROM {loads} rows "
            f"JOIN (SELECT load, year, month FROM {ledger} WHERE dataset = '{table}' "
            f"AND version = (SELECT max(version) FROM {ledger})) live "
            "ON rows.load = live.load AND rows.year = live.year AND rows.month = live.month"
        )

    def check_exist(self) -> None:
        missing = [
            mart
            for mart in schemas.MARTS
            if not self.spark.catalog.tableExists(self.name(mart))
        ]
        if missing:
            raise GateError(f"missing serving tables in {self.database}: {missing}")

    def table(self, mart: str, version: int | None = None) -> DataFrame:
        """The live months, or those of a former version that is still kept."""
        if version is None:
            return self.spark.table(self.name(mart))
        live = self.ledger.live(mart, version)
        chosen = [entry.load + "".join(month) for month, entry in live.items()]
        rows = self.spark.table(self.name(mart, LOADS))
        return rows.where(F.concat("load", *PERIOD).isin(chosen)).drop("load")

    def loaded(self, mart: str, load: str, periods: Sequence[Period]) -> DataFrame:
        """Months of one load, live or not."""
        rows = self.spark.table(self.name(mart, LOADS))
        return rows.where((F.col("load") == load) & in_periods(periods)).drop("load")

    def load(
        self, mart: str, rows: DataFrame, periods: Sequence[Period], load: str
    ) -> dict[Key, Entry]:
        """Write months under a load; entries for the ledger, counted while writing.

        Nothing is live yet. A month without rows is refused: its former rows would stay.
        """
        contract = schemas.MARTS[mart]
        body = [name for name in contract.stored_names if name not in PERIOD]
        ready = rows.where(in_periods(periods)).select(*body, F.lit(load).alias("load"), *PERIOD)
        ready = ready.hint("rebalance", *PERIOD).sortWithinPartitions(*PERIOD, *contract.grain)
        counts = self.insert(mart, ready, periods)
        empty = sorted(month for month, n in counts.items() if not n)
        if empty:
            raise GateError(f"no rows to load into {mart} for {empty}")
        return {(mart, month): Entry(load, n) for month, n in counts.items()}

    def insert(self, table: str, ready: DataFrame, periods: Sequence[Period]) -> dict[Period, int]:
        """Write rows of loads into a table; each month's rows, counted while writing.

        The observation is the plan's last step, in the tasks that write, so a task that is
        run again counts once. A load's partitions are replaced, so a step can be repeated.
        """
        seen = Observation()
        with replacing_partitions(self.spark):
            observed = ready.observe(seen, *counted_months(periods))
            observed.write.insertInto(self.name(table, LOADS), overwrite=True)
        return {month: seen.get["".join(month)] for month in periods}

    def replace_months(self, mart: str, rows: DataFrame, periods: Sequence[Period], load: str) -> None:
        """Replace the given months of one table, or nothing at all."""
        self.ledger.commit(self.load(mart, rows, periods, load))

    def month_counts(self, mart: str) -> dict[Period, int]:
        """Rows of each live month, from the ledger."""
        return {month: entry.rows for month, entry in self.ledger.live(mart).items()}

    def processed_periods(self) -> list[Period]:
        """Months with rows in every serving table, from the ledger alone."""
        state = self.ledger.state()
        months = [
            {month for (name, month), entry in state.items() if name == mart and entry.rows}
            for mart in schemas.MARTS
        ]
        return sorted(set.intersection(*months))

    def delete_months(self, mart: str, periods: Sequence[Period]) -> None:
        """Take months out of one table."""
        chosen = sorted({normalize_period(*period) for period in periods})
        if chosen:
            self.ledger.commit({}, drop=[(mart, month) for month in chosen])

    def delete_month(self, period: Period) -> None:
        """Take a month out of all tables at once."""
        month = normalize_period(*period)
        self.ledger.commit({}, drop=[(mart, month) for mart in schemas.MARTS])

    def truncate(self) -> None:
        """Empty all tables at once; former versions can be restored until they expire."""
        self.ledger.commit({}, keep=False)

    def expire(self, keep: int = 2) -> None:
        """Drop the partitions that none of the newest versions names."""
        for table, (year, month), load in sorted(self.ledger.retire(keep)):
            self.spark.sql(
                f"ALTER TABLE {self.name(table, LOADS)} DROP IF EXISTS "
                f"PARTITION (load='{load}', year='{year}', month='{month}')"
            )


def jdbc_options(
    url: str, table: str, user: str, driver: str, password: str | None = None
) -> dict[str, str]:
    options = {"url": url, "driver": driver, "dbtable": table, "user": user}
    if password:
        options["password"] = password
    return options


def jdbc_month_count(spark: SparkSession, options: dict[str, str], period: Period) -> int:
    """Rows of one month, counted inside the database."""
    year, month = normalize_period(*period)
    table = options["dbtable"]
    query = (
        f"(SELECT count(*) AS rows_count FROM {table} "
        f"WHERE year = '{year}' AND month = '{month}') AS loaded_month"
    )
    row = spark.read.format("jdbc").options(**{**options, "dbtable": query}).load()
    return int(row.first()["rows_count"])


def append_month_jdbc(
    mart: str, rows: DataFrame, options: dict[str, str], period: Period
) -> int:
    """Append one month to a database table that does not have it yet.

    A JDBC append cannot replace rows, so a month that is already loaded is
    refused instead of being doubled.
    """
    ready = rows.where(in_periods([period])).select(
        *schemas.MARTS[mart].contract_names
    )
    if ready.isEmpty():
        raise GateError(f"no rows to load into {mart} for {period}")
    spark = rows.sparkSession
    if jdbc_month_count(spark, options, period) > 0:
        raise GateError(f"{mart} already has rows for {period}; delete the month first")
    ready.write.format("jdbc").mode("append").options(**options).save()
    loaded = jdbc_month_count(spark, options, period)
    if loaded <= 0:
        raise GateError(f"no rows found in {mart} after loading {period}")
    return loaded
