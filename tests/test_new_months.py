"""The stream of raw months: each file once, failed batches again."""

import pytest

from faremill import schemas
from faremill.streaming.new_months import NewMonths
from tests.test_pipeline import MONTHS, make_pipeline, snapshot, trips, write_raw  # noqa: F401


def watched(pipeline):
    """Months of each call of the pipeline."""
    calls, real = [], pipeline.process

    def process(months):
        calls.append(sorted(months))
        return real(months)

    pipeline.process = process
    return calls


def test_files_are_processed_once_and_failed_batches_again(spark, trips, tmp_path):  # noqa: F811
    pipeline = make_pipeline(spark, tmp_path)
    calls = watched(pipeline)
    (tmp_path / "raw" / "yellow" / "year=1998" / "month=05").mkdir(parents=True)
    new = NewMonths(pipeline, str(tmp_path / "stream"))
    assert new.run() == [] and calls == []  # an empty run is a no-op
    write_raw(trips, tmp_path, MONTHS[:1])
    assert new.run() == MONTHS[:1]
    assert new.run() == [] and calls == [MONTHS[:1]]
    before = snapshot(pipeline)

    write_raw(trips, tmp_path, MONTHS[1:2], lambda frame, period: frame.assign(trip_distance=-1.0))
    with pytest.raises(Exception, match="silver 1998-06"):
        new.run()
    assert snapshot(pipeline) == before
    write_raw(trips, tmp_path, MONTHS[1:])  # mended, and another month has come
    again = NewMonths(make_pipeline(spark, tmp_path), str(tmp_path / "stream"), batch=1)
    calls = watched(again.pipeline)
    assert again.run() == MONTHS[1:]
    assert calls == [MONTHS[1:2], MONTHS[2:]]  # the failed batch as it was, then the rest
    assert again.run() == []
    assert again.pipeline.serving.processed_periods() == MONTHS
    kpis = spark.table(pipeline.serving.name("mart_daily_trip_kpis"))
    assert kpis.count() == pipeline.serving.table(schemas.DAILY.name).count()
