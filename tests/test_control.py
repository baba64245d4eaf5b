import time

import pytest
from test_ingest import Pipeline, ids

from tillroll.streaming.control import Progress, run_until_stopped, stop_between_batches
from tillroll.streaming.ingest import TRIGGER_INTERVAL, Ingest, start_ingest


def wait_for(what, seconds=60):
    end = time.monotonic() + seconds
    while not what():
        assert time.monotonic() < end, "took too long"
        time.sleep(0.1)


def stored(pipeline):
    return sorted(r.customer_id for r in pipeline.rows().collect())


@pytest.fixture
def pipeline(spark, tmp_path):
    return Pipeline(spark, tmp_path)


@pytest.fixture
def progress(spark):
    listener = Progress()
    spark.streams.addListener(listener)
    yield listener
    spark.streams.removeListener(listener)


def test_timed_batches_stopped_between_them(spark, pipeline, progress):
    pipeline.deliver("first", *ids(1, 2, 3))
    query = start_ingest(
        spark, pipeline.inbox, pipeline.checkpoint, pipeline.ingest, interval="1 second"
    )
    wait_for(lambda: len(progress.batches()) == 1)
    pipeline.deliver("second", *ids(3, 4))
    wait_for(lambda: len(progress.batches()) == 2)
    assert stop_between_batches(query) and not query.isActive
    assert stored(pipeline) == [1, 2, 3, 4]
    pipeline.deliver("third", *ids(4, 5))
    # It starts where it was stopped: nothing is lost, nothing comes twice.
    pipeline.drain()
    assert stored(pipeline) == [1, 2, 3, 4, 5]
    assert pipeline.totals() == [(3, 3, 0), (2, 1, 1), (2, 1, 1)]
    assert [rows for _, rows in progress.batches()] == [3, 2, 2]
    assert set(progress.ended.values()) == {None}


def test_the_reference_interval_is_the_default(spark, pipeline):
    query = start_ingest(spark, pipeline.inbox, pipeline.checkpoint, pipeline.ingest)
    try:
        assert TRIGGER_INTERVAL == "15 seconds"
        assert query._jsq.getClass() and query.isActive
        assert "ProcessingTime" in str(spark._jvm.org.apache.spark.sql.streaming.Trigger.ProcessingTime(TRIGGER_INTERVAL))
    finally:
        stop_between_batches(query)


def test_a_file_stops_the_job(spark, pipeline):
    pipeline.deliver("first", *ids(1, 2))
    query = start_ingest(
        spark, pipeline.inbox, pipeline.checkpoint, pipeline.ingest, interval="1 second"
    )
    (pipeline.base / "STOP").write_text("")
    run_until_stopped(spark, query, str(pipeline.base / "STOP"), poll_seconds=0.5)
    assert not query.isActive
    pipeline.drain()
    assert stored(pipeline) == [1, 2]


class Slow(Ingest):
    def handle(self, batch, batch_id):
        super().handle(batch, batch_id)
        time.sleep(20)


def test_a_batch_that_is_cut_off_comes_again(spark, pipeline):
    pipeline.deliver("first", *ids(1, 1, 2))
    slow = Slow(pipeline.ingest.table)
    query = start_ingest(spark, pipeline.inbox, pipeline.checkpoint, slow, interval="1 second")
    wait_for(lambda: pipeline.base.joinpath("orders").exists() and stored(pipeline) == [1, 1, 2])
    assert not stop_between_batches(query, seconds=0.2)
    pipeline.drain()
    assert stored(pipeline) == [1, 1, 2]
    assert pipeline.totals() == [(3, 3, 0)]


def test_a_failure_ends_the_wait(spark, pipeline, progress):
    pipeline.deliver("first", *ids(1))

    class Broken(Ingest):
        def handle(self, batch, batch_id):
            raise OSError("storage is away")

    query = start_ingest(
        spark, pipeline.inbox, pipeline.checkpoint, Broken(pipeline.ingest.table), interval="1 second"
    )
    with pytest.raises(Exception, match="storage is away"):
        run_until_stopped(spark, query, poll_seconds=0.5)
    wait_for(lambda: progress.ended)
    assert "storage is away" in next(iter(progress.ended.values()))
