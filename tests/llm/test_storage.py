import time
from pathlib import Path

from pyspark.sql import functions as F

from faremill.llm import storage


def shuffled(spark):
    places = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for place in places for f in Path(place.getPath()).glob("*/shuffle_*")}


def test_what_was_shuffled_for_a_written_table_is_removed(spark):
    before, setting = shuffled(spark), spark.conf.get(storage.CLEANUP, None)
    counts = spark.range(20_000).groupBy((F.col("id") % 999).alias("k")).agg(F.collect_list("id").alias("ids"))
    out = storage.written(counts, "counts")
    end = time.monotonic() + 10
    while (left := shuffled(spark) - before) and time.monotonic() < end:
        time.sleep(0.1)
    assert not left
    assert out.count() == 999 and spark.conf.get(storage.CLEANUP, None) == setting
    storage.discard(out)
