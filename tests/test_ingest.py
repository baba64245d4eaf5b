import pytest
from helpers import bag, orders

from tillroll.schema import BUSINESS_COLUMNS, RAW_COLUMNS, RAW_SCHEMA
from tillroll.sources.orders_csv import split_to_csv
from tillroll.sources.orders_table import OrdersTable
from tillroll.streaming.ingest import (
    BatchMetrics,
    Ingest,
    prepare_orders,
    read_metrics,
    start_ingest,
)
from tillroll.streaming.job import main
from tillroll.streaming.settings import SETTINGS, job_settings, setting


class Pipeline:
    def __init__(self, spark, base, **options):
        self.spark, self.base = spark, base
        self.inbox, self.checkpoint = f"{base}/inbox", f"{base}/checkpoint"
        self.metrics = f"{base}/metrics"
        table = OrdersTable(f"{base}/orders", store_hash=options.pop("store_hash", False))
        self.ingest = Ingest(table, metrics_path=self.metrics, **options)

    def deliver(self, name, *changes, rows_per_file=25):
        raw = orders(self.spark, *changes).drop("processed_time").toDF(*RAW_COLUMNS).coalesce(1)
        split_to_csv(raw, f"{self.base}/{name}", rows_per_file)
        inbox = self.base / "inbox"
        inbox.mkdir(exist_ok=True)
        for file in (self.base / name).glob("*.csv"):
            (inbox / f"{name}-{file.name}").write_bytes(file.read_bytes())

    def drain(self, checkpoint=None, ingest=None):
        start_ingest(
            self.spark, self.inbox, checkpoint or self.checkpoint, ingest or self.ingest, drain=True
        ).awaitTermination()

    def rows(self):
        return self.ingest.table.read(self.spark)

    def totals(self):
        found = read_metrics(self.spark, self.metrics).orderBy("batch_id").collect()
        assert all(r.stream_id for r in found)
        return [(r.received, r.new_rows, r.duplicates) for r in found]


@pytest.fixture
def pipeline(spark, tmp_path):
    return Pipeline(spark, tmp_path)


def ids(*numbers):
    return [{"customer_id": n} for n in numbers]


def test_rows_arrive_enriched_once(pipeline):
    pipeline.deliver("first", *ids(*range(60)))
    pipeline.drain()
    stored = pipeline.rows()
    assert stored.count() == 60
    assert stored.select("loyalty_score", "estimated_clv").distinct().count() == 1
    assert stored.filter("processed_time is null").count() == 0
    pipeline.drain()
    assert pipeline.rows().count() == 60
    assert pipeline.totals() == [(60, 60, 0)]


@pytest.mark.parametrize("options", [{}, {"store_hash": True}, {"broadcast_limit": 0}])
def test_second_delivery_adds_only_new_rows(spark, tmp_path, options):
    pipeline = Pipeline(spark, tmp_path, **options)
    pipeline.deliver("first", *ids(1, 2, 3))
    pipeline.drain()
    pipeline.deliver("second", *ids(2, 3, 4))
    pipeline.drain()
    assert sorted(r.customer_id for r in pipeline.rows().collect()) == [1, 2, 3, 4]
    assert pipeline.totals() == [(3, 3, 0), (3, 1, 2)]


def test_known_rows_are_dropped_from_a_new_checkpoint(pipeline):
    pipeline.deliver("first", *ids(1, 2, 3))
    pipeline.drain()
    pipeline.drain(checkpoint=f"{pipeline.base}/other")
    assert pipeline.rows().count() == 3
    # Nothing new, so nothing is written: one file from the first run.
    assert len(list(pipeline.base.glob("orders/**/*.parquet"))) == 1


def test_copies_inside_a_batch_are_kept_by_default(pipeline):
    pipeline.deliver("first", *ids(1, 1, 1))
    pipeline.drain()
    assert pipeline.rows().count() == 3


def test_copies_inside_a_batch_can_be_dropped(spark, tmp_path):
    pipeline = Pipeline(spark, tmp_path, drop_batch_copies=True)
    pipeline.deliver("first", *ids(1, 1, 1, 2))
    pipeline.drain()
    assert pipeline.rows().count() == 2
    assert pipeline.totals() == [(4, 2, 2)]


def test_files_are_taken_ten_at_a_time(pipeline):
    pipeline.deliver("first", *ids(*range(24)), rows_per_file=2)
    pipeline.drain()
    assert [t[0] for t in pipeline.totals()] == [20, 4]
    assert pipeline.rows().count() == 24


class Crash(Exception):
    pass


class CrashAfterAppend(Ingest):
    def handle(self, batch, batch_id):
        super().handle(batch, batch_id)
        raise Crash


def test_a_batch_replayed_after_its_append_is_not_written_twice(pipeline):
    pipeline.deliver("first", *ids(*range(60)))
    crashing = CrashAfterAppend(pipeline.ingest.table)
    with pytest.raises(Exception, match="Crash"):
        pipeline.drain(ingest=crashing)
    assert pipeline.rows().count() == 60
    first = bag(pipeline.rows())
    pipeline.drain()
    # Even the ingest time is that of the batch, not that of its second attempt.
    assert bag(pipeline.rows()) == first
    assert pipeline.totals() == [(60, 60, 0)]


def test_a_replayed_batch_keeps_its_copies(pipeline):
    pipeline.deliver("first", *ids(1, 1, 1, 2))
    with pytest.raises(Exception, match="Crash"):
        pipeline.drain(ingest=CrashAfterAppend(pipeline.ingest.table))
    pipeline.drain()
    assert sorted(r.customer_id for r in pipeline.rows().collect()) == [1, 1, 1, 2]
    assert pipeline.totals() == [(4, 4, 0)]


def test_a_half_written_batch_is_completed(pipeline):
    pipeline.deliver("first", *ids(1, 1, *range(2, 40)), rows_per_file=5)
    with pytest.raises(Exception, match="Crash"):
        pipeline.drain(ingest=CrashAfterAppend(pipeline.ingest.table))
    files = sorted(pipeline.base.glob("orders/**/*.parquet"))
    files[0].unlink()
    assert len(files) > 1 and pipeline.rows().count() < 40
    pipeline.drain()
    assert sorted(r.customer_id for r in pipeline.rows().collect()) == [1, 1, *range(2, 40)]


def test_a_replay_leaves_out_what_another_stream_wrote_meanwhile(pipeline):
    pipeline.deliver("first", *ids(1, 2))
    with pytest.raises(Exception, match="Crash"):
        pipeline.drain(ingest=CrashAfterAppend(pipeline.ingest.table))
    # As if the other stream had checked before the first one wrote.
    pipeline.ingest.table.append(pipeline.rows())
    pipeline.drain()
    assert sorted(r.customer_id for r in pipeline.rows().collect()) == [1, 2]
    assert pipeline.totals() == [(2, 0, 2)]


def test_streams_share_a_table_and_metrics(pipeline):
    pipeline.deliver("first", *ids(1, 2, 3))
    pipeline.drain()
    pipeline.deliver("second", *ids(3, 4))
    pipeline.drain(checkpoint=f"{pipeline.base}/other")
    assert sorted(r.customer_id for r in pipeline.rows().collect()) == [1, 2, 3, 4]
    # Both streams have a batch 0.
    assert sorted(pipeline.totals()) == [(3, 3, 0), (5, 1, 4)]


class BrokenTable(OrdersTable):
    def snapshot(self, spark):
        raise OSError("storage is away")


def test_an_unreadable_table_fails_the_batch(pipeline):
    pipeline.deliver("first", *ids(1, 2))
    broken = Ingest(BrokenTable(pipeline.ingest.table.location))
    with pytest.raises(Exception, match="storage is away"):
        pipeline.drain(ingest=broken)
    # The batch was not committed, so its rows come again.
    pipeline.drain()
    assert pipeline.rows().count() == 2


def test_empty_and_missing_inbox(pipeline):
    pipeline.drain()
    assert pipeline.ingest.table.snapshot(pipeline.spark) is None


def test_empty_batch_is_skipped(pipeline, spark):
    nothing = prepare_orders(spark.createDataFrame([], RAW_SCHEMA))
    assert pipeline.ingest.handle(nothing, 3) == BatchMetrics(3, 0, 0)
    assert pipeline.ingest.table.snapshot(spark) is None
    assert pipeline.totals() == [(0, 0, 0)]


def test_subfolders_of_the_inbox_are_left_out(pipeline):
    pipeline.deliver("first", *ids(1, 2))
    deeper = pipeline.base / "inbox" / "deeper"
    deeper.mkdir()
    for file in list((pipeline.base / "inbox").glob("*.csv")):
        (deeper / "copy.csv").write_bytes(file.read_bytes().replace(b"\n1,", b"\n9,"))
    pipeline.drain()
    assert sorted(r.customer_id for r in pipeline.rows().collect()) == [1, 2]


def test_stored_rows_equal_the_delivered_ones(pipeline, spark):
    changes = [{"age": None, "item_purchased": 'a "quoted", item'}, {"review_rating": None}]
    pipeline.deliver("first", *changes)
    pipeline.drain()
    delivered = orders(spark, *changes).select(*BUSINESS_COLUMNS)
    assert bag(pipeline.rows().select(*BUSINESS_COLUMNS)) == bag(delivered)


@pytest.mark.parametrize("flags", [[], ["--store-hash", "--bytes-per-trigger", "1000000"]])
def test_job_runs_from_its_arguments(pipeline, flags):
    pipeline.deliver("first", *ids(1, 2, 2))
    table = pipeline.ingest.table.location
    main(["project", pipeline.inbox, table, pipeline.checkpoint, "--drain", *flags])
    assert sorted(r.customer_id for r in pipeline.rows().collect()) == [1, 2, 2]
    assert (pipeline.base / "checkpoint" / "streaming" / "commits").is_dir()


def test_job_switches(pipeline):
    pipeline.deliver("first", *ids(1, 2, 2))
    table, index = pipeline.ingest.table.location, pipeline.base / "hashes"
    switches = ["--cluster", "--drop-batch-copies", "--index", str(index), "--metrics", pipeline.metrics]
    main(["project", pipeline.inbox, table, pipeline.checkpoint, "--drain", *switches])
    assert sorted(r.customer_id for r in pipeline.rows().collect()) == [1, 2]
    assert pipeline.totals() == [(3, 2, 1)]
    assert list(index.glob("recent/*/batch_id=0/*.parquet"))


def test_settings_fall_back_in_order(spark, monkeypatch):
    for name in SETTINGS:
        monkeypatch.delenv(name, raising=False)
    with pytest.raises(ValueError, match="INPUT_PATH"):
        setting(spark, "INPUT_PATH")
    system = spark._jvm.java.lang.System
    system.setProperty("INPUT_PATH", "property")
    try:
        assert setting(spark, "INPUT_PATH") == "property"
        spark.conf.set("spark.yarn.appMasterEnv.INPUT_PATH", "driver")
        assert setting(spark, "INPUT_PATH") == "driver"
        spark.conf.set("spark.executorEnv.INPUT_PATH", "executor")
        assert setting(spark, "INPUT_PATH") == "executor"
        monkeypatch.setenv("INPUT_PATH", "environment")
        assert setting(spark, "INPUT_PATH") == "environment"
        assert setting(spark, "INPUT_PATH", "given") == "given"
        assert setting(spark, "INPUT_PATH", "") == "environment"
    finally:
        system.clearProperty("INPUT_PATH")
        spark.conf.unset("spark.yarn.appMasterEnv.INPUT_PATH")
        spark.conf.unset("spark.executorEnv.INPUT_PATH")
    assert job_settings(spark, ["p", "i", "t", "c"]) == dict(zip(SETTINGS, "pitc", strict=True))
    with pytest.raises(ValueError, match="CHECKPOINT_PATH"):
        job_settings(spark, ["p", "i", "t"])
