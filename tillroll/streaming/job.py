"""The ingest job for spark-submit: ``job.py [project] [inbox] [table] [checkpoint]``."""

import argparse

from pyspark.sql import SparkSession

from tillroll.sources.hash_index import HashIndex
from tillroll.sources.orders_csv import ANY_TEXT, FILES_PER_TRIGGER
from tillroll.sources.orders_table import FILE_FORMATS, OrdersTable, staged_connector_options
from tillroll.streaming.control import run_until_stopped
from tillroll.streaming.ingest import TRIGGER_INTERVAL, Ingest, start_ingest
from tillroll.streaming.settings import job_settings


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("settings", nargs="*", help="project, inbox, table, checkpoint")
    parser.add_argument("--format", default="parquet", help="format of the target table")
    parser.add_argument("--absent-text", action="append", default=[], metavar="TEXT",
                        help="part of the connector's message for a missing table")
    parser.add_argument("--any-text", action="store_true", help="cells may hold line breaks")
    parser.add_argument("--interval", default=TRIGGER_INTERVAL, help="pause between batches")
    parser.add_argument("--stop-file", help="stop between batches once this path exists")
    parser.add_argument("--store-hash", action="store_true", help="keep the row hash as a column")
    parser.add_argument("--index", help="folder of an index of the table's row hashes")
    parser.add_argument("--cluster", action="store_true", help="sort files by category, location")
    parser.add_argument("--drop-batch-copies", action="store_true", help="keep one of equal rows")
    parser.add_argument("--metrics", help="folder for one metrics row per batch")
    parser.add_argument("--bytes-per-trigger", type=int, help="bound batches by size, not files")
    parser.add_argument("--drain", action="store_true", help="stop when the inbox is used up")
    parser.add_argument("--backlog-batches", type=int,
                        help="with --drain: batches may grow so that these suffice")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("orders-ingest").getOrCreate()
    _project, inbox, location, checkpoint = job_settings(spark, args.settings).values()
    options = {} if args.format in FILE_FORMATS else staged_connector_options(checkpoint)
    table = OrdersTable(
        location, args.format, options, args.store_hash, args.cluster, tuple(args.absent_text)
    )
    index = HashIndex(args.index) if args.index else None
    ingest = Ingest(table, args.metrics, args.drop_batch_copies, index=index)
    files = None if args.bytes_per_trigger else FILES_PER_TRIGGER
    text = ANY_TEXT if args.any_text else {}
    query = start_ingest(
        spark, inbox, checkpoint, ingest, files, args.bytes_per_trigger, args.drain,
        args.interval, args.backlog_batches, **text
    )
    run_until_stopped(spark, query, args.stop_file)


if __name__ == "__main__":
    main()
