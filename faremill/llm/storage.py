"""Tables written on the way, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Spark's setting: what a query has shuffled is removed when it ends, not at some collection of garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; where it is unset, a folder in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return folder.rstrip("/")


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame, computed once, written to the shared folder and read back.

    It cuts the lineage: a lost executor costs a read, not the steps before. What was
    shuffled for it is removed once it is written.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    out = spark.read.schema(frame.schema).parquet(path)
    out._written_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Remove tables that written() gave, after their last reader has been written."""
    for frame in frames:
        spark, path = frame.sparkSession, vars(frame).pop("_written_at")
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
