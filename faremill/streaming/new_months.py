"""Raw months as they arrive: a file stream that hands each new file to the pipeline once.

The stream's checkpoint remembers which files were taken, so a run asks only for files that
are new since. A micro-batch is a set of months; it counts as done when the pipeline has
published them. A batch that fails is offered again, with the same files, by the next run,
and publishing a month twice gives the same tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from faremill.operators import periods
from faremill.operators.periods import Period
from faremill.plans.pipeline import Pipeline


@dataclass
class NewMonths:
    """checkpoint: the stream's folder, shared by all runs; batch: files of one micro-batch."""

    pipeline: Pipeline
    checkpoint: str
    batch: int = 12

    def files(self) -> DataFrame:
        """The stream of raw file paths; contents are not read."""
        layers = self.pipeline.layers
        return (
            self.pipeline.spark.readStream.format("binaryFile")
            .schema("path string, modificationTime timestamp, length bigint, content binary")
            .option("maxFilesPerTrigger", self.batch)
            .option("pathGlobFilter", "*.parquet")
            .load(f"{layers.raw}/*/*")
            .select("path")
        )

    def take(self, paths: DataFrame) -> list[Period]:
        """Process the months of one micro-batch: one row per file comes to the driver."""
        found = periods.discover_periods(paths, self.pipeline.layers.taxi_type)
        return self.pipeline.process(periods.collect_periods(found))

    def run(self) -> list[Period]:
        """Process all files that are there and not yet taken, then the models; no new file
        is a success. The months that were processed, in the order of batches."""
        done: list[Period] = []

        def each(batch: DataFrame, number: int) -> None:
            done.extend(self.take(batch))

        query = (
            self.files()
            .writeStream.foreachBatch(each)
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        if done:
            self.pipeline.build_models()
        return done
