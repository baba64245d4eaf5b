"""The target table behind a connector, one written here with Spark's data source API."""

import pickle
import sys
import uuid
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from test_ingest import CrashAfterAppend, Pipeline, ids

from tillroll.schema import TABLE_SCHEMA
from tillroll.sources.orders_table import OrdersTable, staged_connector_options
from tillroll.streaming.ingest import Ingest


class Warehouse(DataSource):
    """Tables as folders of pickled rows; like others it has its own "not found"."""

    @classmethod
    def name(cls):
        return "warehouse"

    def _folder(self):
        return Path(self.options["root"]) / self.options["table"]

    def schema(self):
        if (Path(self.options["root"]) / "down").exists():
            raise RuntimeError("warehouse is down")
        if not self._folder().exists():
            raise RuntimeError(f"Not found: Table {self.options['table']}")
        return TABLE_SCHEMA

    def reader(self, schema):
        return Reader(str(self._folder()))

    def writer(self, schema, overwrite):
        return Writer(str(self._folder()), dict(self.options), schema.names, overwrite)


class Reader(DataSourceReader):
    def __init__(self, folder):
        self.folder = folder

    def partitions(self):
        return [InputPartition(str(f)) for f in Path(self.folder).glob("*.rows")] or [InputPartition(None)]

    def read(self, partition):
        if partition.value:
            for row in pickle.loads(Path(partition.value).read_bytes()):
                yield tuple(row.get(name) for name in TABLE_SCHEMA.names)


class Writer(DataSourceWriter):
    def __init__(self, folder, options, names, overwrite):
        self.folder, self.options, self.names, self.overwrite = folder, options, names, overwrite

    def write(self, iterator):
        rows = [dict(zip(self.names, row, strict=True)) for row in iterator]
        folder = Path(self.folder)
        folder.mkdir(parents=True, exist_ok=True)
        if rows:
            (folder / f"{uuid.uuid4().hex}.rows").write_bytes(pickle.dumps(rows))
        (folder / "options").write_bytes(pickle.dumps((self.options, self.overwrite)))
        return WriterCommitMessage()

    def commit(self, messages):
        pass


STAGING = staged_connector_options("gs://bucket/checkpoints/consumer")


@pytest.fixture
def pipeline(spark, tmp_path):
    # Python workers cannot import this module, so its classes travel with their code.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(Warehouse)
    made = Pipeline(spark, tmp_path)
    options = {"root": str(tmp_path / "warehouse"), **STAGING}
    (tmp_path / "warehouse").mkdir()
    table = OrdersTable("shop.orders", "warehouse", options, absent_texts=("Not found: Table",))
    made.ingest = Ingest(table, metrics_path=made.metrics)
    return made


def stored(pipeline):
    return sorted(r.customer_id for r in pipeline.rows().collect())


def test_first_batch_makes_the_table(pipeline):
    assert pipeline.ingest.table.snapshot(pipeline.spark) is None
    assert pipeline.rows().collect() == []
    pipeline.deliver("first", *ids(1, 2, 2))
    pipeline.drain()
    pipeline.deliver("second", *ids(2, 3))
    pipeline.drain()
    assert stored(pipeline) == [1, 2, 2, 3]
    assert pipeline.totals() == [(3, 3, 0), (2, 1, 1)]
    options, overwrite = pickle.loads((pipeline.base / "warehouse/shop.orders/options").read_bytes())
    assert not overwrite and options["table"] == "shop.orders"
    kept = {name.lower(): value for name, value in options.items()}
    assert {name: kept[name.lower()] for name in STAGING} == STAGING


def test_columns_are_those_of_the_table(pipeline):
    pipeline.deliver("first", *ids(1))
    pipeline.drain()
    (file,) = (pipeline.base / "warehouse/shop.orders").glob("*.rows")
    assert list(pickle.loads(file.read_bytes())[0]) == TABLE_SCHEMA.names


def test_any_other_error_fails_the_batch(pipeline):
    pipeline.deliver("first", *ids(1))
    down = pipeline.base / "warehouse" / "down"
    down.write_text("")
    with pytest.raises(Exception, match="warehouse is down"):
        pipeline.drain()
    assert not (pipeline.base / "warehouse" / "shop.orders").exists()
    down.unlink()
    pipeline.drain()
    assert stored(pipeline) == [1]


def test_without_the_text_a_missing_table_is_an_error(pipeline):
    table = OrdersTable("shop.orders", "warehouse", pipeline.ingest.table.options)
    with pytest.raises(Exception, match="Not found: Table"):
        table.snapshot(pipeline.spark)


def test_a_replayed_batch_is_not_appended_twice(pipeline):
    pipeline.deliver("first", *ids(1, 2))
    with pytest.raises(Exception, match="Crash"):
        pipeline.drain(ingest=CrashAfterAppend(pipeline.ingest.table))
    pipeline.drain()
    assert stored(pipeline) == [1, 2]
