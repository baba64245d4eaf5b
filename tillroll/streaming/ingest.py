"""Micro-batch ingest: stamp, align, enrich, drop known rows, append.

A batch that fails stays uncommitted and is delivered again. It is then checked against the
rows of all other batches and replaces what its earlier attempt wrote, copies included, so a
table of files and the metrics come out as from one delivery. In a connector's table its
rows are found by their hash and are not written twice. An equal row in a later batch is
dropped even if it is a real repeat purchase: the hash holds no order number and no time.
Copies inside one batch are all kept unless ``drop_batch_copies`` is set.

A batch is kept in memory, counted, checked and written. Large ones of a drained backlog are
read once instead: they are counted in the tasks that write them, and enriched only there.
"""

import logging
from dataclasses import dataclass, replace
from math import ceil

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tillroll.operators.align import align_orders
from tillroll.operators.dedup import (
    BROADCAST_LIMIT,
    drop_copies,
    drop_known_rows,
    hashes_of,
    least_rows,
    mark_known_rows,
    packed,
    unpacked,
    with_row_hash,
)
from tillroll.operators.enrich import enrich_orders
from tillroll.schema import BATCH_ID, COMPUTED_COLUMNS, PROCESSED_TIME, REJECTED, ROW_HASH, STREAM_ID
from tillroll.sources.hash_index import HashIndex
from tillroll.sources.orders_csv import FILES_PER_TRIGGER, stream_orders_csv
from tillroll.sources.orders_table import OrdersTable
from tillroll.sources.paths import ensure_folder, files_and_bytes

log = logging.getLogger(__name__)

#: Fixed value: pause between micro-batches.
TRIGGER_INTERVAL = "15 seconds"

#: Spark's own name for the id that a query keeps in its checkpoint.
QUERY_ID = "sql.streaming.queryId"

#: Bytes of an order in a file, compressed or not, at least: how many rows a batch may have.
ROW_BYTES = 20

METRICS_SCHEMA = StructType(
    [StructField(STREAM_ID, StringType())]
    + [StructField(n, LongType()) for n in (BATCH_ID, "received", "new_rows", "duplicates", "rejected")]
)


@dataclass(frozen=True)
class BatchMetrics:
    """Rows of a batch, how many of them the table did not have, and how many had a cell
    that did not convert, or too many or few cells."""

    batch_id: int
    received: int
    new_rows: int
    rejected: int = 0

    @property
    def duplicates(self) -> int:
        return self.received - self.new_rows


@dataclass(frozen=True)
class Ingest:
    """How a batch is checked and where it goes.

    ``metrics_path`` collects one row per stream and batch; a batch delivered again replaces
    its row. ``stream_id`` tells streams apart; left out, it is the id that the stream keeps
    in its checkpoint, which stays the same over restarts. With an ``index`` a batch is
    checked against that, and not against the table; it must hold the table's hashes
    (``HashIndex.rebuild``) if rows were written without it. With ``one_pass`` a batch for an
    unclustered table of files is shuffled to the check, whatever its size, and not kept; the
    counts come out the same.
    """

    table: OrdersTable
    metrics_path: str | None = None
    drop_batch_copies: bool = False
    broadcast_limit: int = BROADCAST_LIMIT
    stream_id: str | None = None
    index: HashIndex | None = None
    one_pass: bool = False

    @property
    def reads_once(self) -> bool:
        return self.one_pass and self.table.is_files and not (self.table.cluster or self.index)

    def handle(self, batch: DataFrame, batch_id: int) -> BatchMetrics:
        """Append the rows of an aligned or enriched batch that the table does not have yet."""
        spark = batch.sparkSession
        stream = self.stream_id or spark.sparkContext.getLocalProperty(QUERY_ID) or "direct"
        write = self._write_once_read if self.reads_once else self._write_kept
        metrics = BatchMetrics(batch_id, *write(batch, stream, batch_id))
        log.info("%s, %s duplicates", metrics, metrics.duplicates)
        if self.metrics_path:
            self._record(spark, stream, metrics)
        return metrics

    def _write_kept(self, batch: DataFrame, stream: str, batch_id: int) -> tuple[int, int, int]:
        """Rows received, new and rejected of a batch that is kept until it is written."""
        hashed = with_row_hash(_enriched(batch)).persist()
        try:
            received, rejected = hashed.agg(F.count(F.lit(1)), _rejected(batch)).first()
            rows = hashed.drop(REJECTED)
            new_rows = self._write_new(rows, received, stream, batch_id) if received else 0
        finally:
            hashed.unpersist()
        return received, new_rows, rejected

    def _write_once_read(
        self, batch: DataFrame, stream: str, batch_id: int
    ) -> tuple[int, int, int]:
        """The same numbers; the rows are counted behind the shuffle.

        Before it a task that runs again, after its executor was lost, would count again.
        """
        rows = packed(with_row_hash(batch))
        known, counted = F.lit(False), Observation()
        if (stored := self._stored_by_others(batch.sparkSession, stream, batch_id)) is not None:
            rows, known = mark_known_rows(rows, packed(hashes_of(stored)), "_known"), F.col("_known")
        elif self.drop_batch_copies:
            rows = rows.repartition(ROW_HASH)
        counts = F.count(F.lit(1)).alias("received"), _rejected(batch).alias("rejected")
        rows = rows.observe(counted, *counts).where(~known).drop("_known", REJECTED)
        if self.drop_batch_copies:
            rows = least_rows(rows)
        new_rows = self.table.write_batch(_enriched(unpacked(rows)), stream, batch_id)
        return counted.get["received"], new_rows, counted.get["rejected"]

    def _stored_by_others(
        self, spark: SparkSession, stream: str, batch_id: int
    ) -> DataFrame | None:
        """The table without rows that this batch left in it, where that can be told."""
        stored = self.table.snapshot(spark)
        if stored is not None and self.table.is_files:
            # A partition filter: folders of this batch are not read.
            own = (F.col(STREAM_ID) == stream) & (F.col(BATCH_ID) == batch_id)
            stored = stored.where(~own)
        return stored

    def _write_new(self, hashed: DataFrame, received: int, stream: str, batch_id: int) -> int:
        rows, spark = hashed, hashed.sparkSession
        if self.index:
            known = self.index.candidates(hashed, received, stream, batch_id)
            rows = drop_known_rows(rows, known, received, self.broadcast_limit)
        elif (stored := self._stored_by_others(spark, stream, batch_id)) is not None:
            rows = drop_known_rows(rows, hashes_of(stored), received, self.broadcast_limit)
        if self.drop_batch_copies:
            rows = drop_copies(rows)
        new_rows = self.table.write_batch(rows, stream, batch_id)
        if self.index:
            self.index.put_batch(self.table.batch_hashes(spark, stream, batch_id), stream, batch_id)
        return new_rows

    def _record(self, spark: SparkSession, stream: str, metrics: BatchMetrics) -> None:
        row = spark.range(1).select(
            F.lit(metrics.received).cast("long").alias("received"),
            F.lit(metrics.new_rows).cast("long").alias("new_rows"),
            F.lit(metrics.duplicates).cast("long").alias("duplicates"),
            F.lit(metrics.rejected).cast("long").alias("rejected"),
        )
        own = f"{STREAM_ID}={stream}/{BATCH_ID}={metrics.batch_id}"
        row.write.mode("overwrite").parquet(f"{self.metrics_path}/{own}")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).parquet(path).select(*METRICS_SCHEMA.names)


def _rejected(batch: DataFrame) -> Column:
    return F.count(REJECTED) if REJECTED in batch.columns else F.lit(0)


def _enriched(rows: DataFrame) -> DataFrame:
    return rows if set(COMPUTED_COLUMNS) <= set(rows.columns) else enrich_orders(rows)


def stamp_orders(raw: DataFrame) -> DataFrame:
    """Raw rows, batch or stream, to aligned rows stamped with one time per batch.

    A column of rejected records stays beside them.
    """
    stamped = raw.withColumn(PROCESSED_TIME, F.current_timestamp())
    kept = (REJECTED,) if REJECTED in raw.columns else ()
    return stamped.transform(align_orders, keep=kept)


def prepare_orders(raw: DataFrame) -> DataFrame:
    """As ``stamp_orders``, enriched to table rows."""
    return stamp_orders(raw).transform(enrich_orders)


def start_ingest(
    spark: SparkSession,
    inbox: str,
    checkpoint: str,
    ingest: Ingest,
    files_per_trigger: int | None = FILES_PER_TRIGGER,
    bytes_per_trigger: int | None = None,
    drain: bool = False,
    interval: str = TRIGGER_INTERVAL,
    backlog_batches: int | None = None,
    **csv_options: str,
) -> StreamingQuery:
    """Start the stream; it looks for files every ``interval`` until stopped or, with
    ``drain``, until the inbox is used up. Progress is kept in a folder of the checkpoint
    path. ``csv_options`` are those of Spark's CSV reader, say ``ANY_TEXT``.

    Every batch is checked against the whole history, so a backlog in batches of a fixed size
    costs the square of its size. With ``drain`` and ``backlog_batches`` batches grow with the
    inbox instead, so that about so many use it up, or fewer of the size given. If they may
    have more rows than are broadcast, they are taken in one pass each.
    """
    ensure_folder(spark, inbox)
    if drain and backlog_batches:
        files, size = files_and_bytes(spark, inbox)
        if files_per_trigger is not None:
            files_per_trigger = max(files_per_trigger, ceil(files / backlog_batches))
        if bytes_per_trigger is not None:
            bytes_per_trigger = max(bytes_per_trigger, ceil(size / backlog_batches))
        if size > backlog_batches * ingest.broadcast_limit * ROW_BYTES:
            ingest = replace(ingest, one_pass=True)
    trigger = {"availableNow": True} if drain else {"processingTime": interval}
    rows = stream_orders_csv(
        spark, inbox, files_per_trigger, bytes_per_trigger, rejected=True, **csv_options
    )
    prepare = stamp_orders if ingest.reads_once else prepare_orders
    return (
        prepare(rows)
        .writeStream.foreachBatch(ingest.handle)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/streaming")
        .trigger(**trigger)
        .start()
    )
