"""Session settings for local runs and the settings that matter on a cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes shuffles, splits skewed joins and rebalanced writes.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # A task that writes a few partitions keeps a file open for each instead of
    # sorting all of its rows by partition first.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


def local_session(
    app: str, cpus: int | str = 8, partitions: int = 8, **extra: str
) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
