"""Every operator and composite query over the driver tables.

Each callable takes (spark, sf_dir) and works on the whole tables.
"""

from collections.abc import Callable
from functools import partial
from uuid import uuid4

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import orders as columns
from tillroll.operators.align import align_orders, clean_columns
from tillroll.operators.dedup import (
    BROADCAST_LIMIT,
    drop_copies,
    drop_known_rows,
    hashes_of,
    with_row_hash,
)
from tillroll.operators.enrich import enrich_orders
from tillroll.operators.ranking import attach_to_groups, rank_items, top_items
from tillroll.plans import reports, views
from tillroll.plans.stored_views import create_views, refresh, register_table
from tillroll.registry.adapter import number_of_parts, row_bound, shop_orders, stored_orders
from tillroll.schema import (
    ALIGNED_COLUMNS,
    ALIGNED_SCHEMA,
    BUSINESS_COLUMNS,
    PROCESSED_TIME,
    RAW_COLUMNS,
    ROW_HASH,
)
from tillroll.sources.hash_index import HashIndex
from tillroll.sources.orders_csv import (
    ANY_TEXT,
    read_orders_csv,
    split_report,
    split_to_csv,
    split_totals,
)
from tillroll.sources.orders_table import OPEN_FOLDERS_SETTING, OrdersTable
from tillroll.sources.paths import (
    DROP_SHUFFLES,
    delete_folder,
    folder_exists,
    new_shared_folder,
    set_for_now,
)
from tillroll.streaming.ingest import Ingest, read_metrics, start_ingest

Query = Callable[[SparkSession, str], DataFrame]

#: Purchases below which a row belongs to the table that batches are checked against.
PRELOADED_BELOW = 8
#: Rows of the files in the inboxes of the stream queries, even so that a pair of copies
#: written next to each other shares a file and thus a batch.
INBOX_ROWS_PER_FILE = 5_000
#: Batches in which the stream queries drain an inbox of more than ten files each.
BACKLOG_BATCHES = 8
#: Of the tables written here; the hashes of the rows take half as much as by default.
SMALL_FILES = {"compression": "zstd"}
#: For a stream that is the last to read its inbox: files of committed batches go.
USED_UP = {"cleanSource": "delete"}
#: Rows of the files of the split query.
SPLIT_ROWS_PER_FILE = 500

#: What each computed column depends on, shown next to it.
COLUMN_INPUTS = {
    "final_amount_usd": ["purchase_amount_usd", "discount_applied"],
    "amount_category": ["final_amount_usd"],
    "customer_segment": ["previous_purchases"],
    "satisfaction_level": ["review_rating"],
    "is_anomaly": ["final_amount_usd"],
    "estimated_clv": ["previous_purchases", "final_amount_usd"],
    "frequency_category": ["frequency_of_purchases"],
    "estimated_profit_usd": ["final_amount_usd"],
    "season_type": ["season"],
    "loyalty_score": ["subscription_status", "previous_purchases"],
}


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_orders(shop_orders(spark, sf_dir))


def _over_orders(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(shop_orders(spark, sf_dir))


def _over_enriched(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(enriched(spark, sf_dir))


def _computed(name: str) -> Query:
    return _over_enriched(lambda df: df.select(*COLUMN_INPUTS[name], name))


# --- sources and alignment -------------------------------------------------------


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders under the CSV headers."""
    return raw_names(shop_orders(spark, sf_dir))


def raw_names(orders: DataFrame) -> DataFrame:
    return orders.drop(PROCESSED_TIME).toDF(*RAW_COLUMNS)


def csv_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{new_shared_folder(spark, 'csv')}/orders"
    raw_orders(spark, sf_dir).write.option("header", True).csv(folder)
    return clean_columns(read_orders_csv(spark, folder))


def align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns in another order, one missing, one unknown, as an input may come."""
    raw = raw_orders(spark, sf_dir).drop("Size")
    text = raw.select(*(F.col(f"`{name}`").cast("string") for name in reversed(raw.columns)))
    return align_orders(text.withColumn("Gift Wrap", F.lit("no")))


def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{new_shared_folder(spark, 'split')}/inbox"
    split_to_csv(raw_orders(spark, sf_dir), folder, SPLIT_ROWS_PER_FILE)
    totals = split_totals(split_report(read_orders_csv(spark, folder)))
    return totals.select(
        "total_rows",
        (F.col("largest_file") <= SPLIT_ROWS_PER_FILE).alias("within_limit"),
        (F.col("files") * SPLIT_ROWS_PER_FILE >= F.col("total_rows")).alias("enough_files"),
    )


def schema_evolution_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders stored before the computed columns existed, then all with them."""
    table = OrdersTable(f"{new_shared_folder(spark, 'evolution')}/orders", options=SMALL_FILES)
    orders, folder = stored_orders(spark, sf_dir)
    aligned = orders.withColumn(PROCESSED_TIME, F.current_timestamp())
    table.append(aligned)
    table.append(enrich_orders(aligned))
    delete_folder(spark, folder)
    return (
        table.read(spark)
        .groupBy("location", "category", "amount_category", "customer_segment")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("purchase_amount_usd").alias("spend"),
            F.count("estimated_clv").alias("known_clv"),
        )
    )


# --- hash and de-duplication -----------------------------------------------------


def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_row_hash(shop_orders(spark, sf_dir)).select("row_hash", *BUSINESS_COLUMNS)


def with_copies(orders: DataFrame, copied: str) -> DataFrame:
    """The orders, each that fulfils ``copied`` twice; the two are neighbours."""
    times = F.when(F.expr(copied), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return orders.withColumn("_copy", F.explode(times)).drop("_copy")


def _against_table(spark: SparkSession, sf_dir: str, broadcast_limit: int) -> DataFrame:
    """New rows, copies kept, of a batch that holds some orders twice."""
    orders = shop_orders(spark, sf_dir)
    batch = with_row_hash(with_copies(orders, "age < 30"))
    stored = orders.filter(F.col("previous_purchases") < PRELOADED_BELOW)
    bound = 2 * row_bound(spark, sf_dir)
    fresh = drop_known_rows(batch, hashes_of(stored), bound, broadcast_limit)
    return fresh.select(*ALIGNED_COLUMNS)


def dedup_against_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, against an index of the stored hashes: a settled part and a recent batch.

    The orders are read four times, so their joins are worked out once and written.
    """
    folder = f"{new_shared_folder(spark, 'index-orders')}/orders"
    shop_orders(spark, sf_dir).write.parquet(folder)
    orders = spark.read.schema(ALIGNED_SCHEMA).parquet(folder)
    batch = with_row_hash(with_copies(orders, "age < 30"))
    stored = with_row_hash(orders.filter(F.col("previous_purchases") < PRELOADED_BELOW))
    settled = F.col("customer_id") % 5 > 0
    index = HashIndex(f"{new_shared_folder(spark, 'hashes')}/index")
    index.rebuild(stored.filter(settled))
    index.put_batch(stored.filter(~settled), "other", 0)
    bound = 2 * row_bound(spark, sf_dir)
    known = index.candidates(batch, bound, "own", 0)
    return drop_known_rows(batch, known, bound).select(*ALIGNED_COLUMNS)


def dedup_within_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which some came twice, some of those at another time."""
    orders, folder = stored_orders(spark, sf_dir)
    later = F.col(PROCESSED_TIME) + F.expr("INTERVAL 1 HOUR")
    again = orders.filter("age < 30").withColumn(PROCESSED_TIME, later)
    batch = with_row_hash(with_copies(orders, "customer_id % 3 = 0").unionAll(again))
    parts = number_of_parts(spark, sf_dir)
    if parts == 1:
        return drop_copies(batch).select(*ALIGNED_COLUMNS)
    # What is shuffled is several times the bytes of the files. Equal hashes are in one part.
    base = new_shared_folder(spark, "dedup")
    part = F.pmod(F.xxhash64(ROW_HASH), F.lit(parts)).alias("part")
    dealt = batch.select(*ALIGNED_COLUMNS, part).write.options(**SMALL_FILES).partitionBy("part")
    with set_for_now(spark, {OPEN_FOLDERS_SETTING: parts + 1}):
        dealt.parquet(f"{base}/batch")
    delete_folder(spark, folder)
    for part in range(parts):
        own = f"{base}/batch/part={part}"
        if not folder_exists(spark, own):
            continue
        rows = drop_copies(with_row_hash(spark.read.schema(ALIGNED_SCHEMA).parquet(own)))
        with set_for_now(spark, DROP_SHUFFLES):
            rows.select(*ALIGNED_COLUMNS).write.mode("append").options(**SMALL_FILES).parquet(f"{base}/rows")
        delete_folder(spark, own)
    return spark.read.schema(ALIGNED_SCHEMA).parquet(f"{base}/rows")


# --- streaming -------------------------------------------------------------------


class Interrupted(Exception):
    pass


class FailsAfterWriting(Ingest):
    """An ingest that breaks off once its first batch is written but not yet committed."""

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        super().handle(batch, batch_id)
        raise Interrupted(f"batch {batch_id}")


def _inbox(spark: SparkSession, sf_dir: str, copied: str = "false") -> tuple[str, str]:
    """A fresh folder, and an inbox in it with all orders, some of them twice."""
    base = new_shared_folder(spark, "ingest")
    orders, folder = stored_orders(spark, sf_dir)
    rows = with_copies(raw_names(orders), copied)
    split_to_csv(rows, f"{base}/inbox", INBOX_ROWS_PER_FILE, compression="gzip")
    delete_folder(spark, folder)
    return base, f"{base}/inbox"


def _drain(spark: SparkSession, inbox: str, checkpoint: str, ingest: Ingest, **options: str) -> None:
    """Take all there is in the inbox, ten files at a time or more if there are many."""
    query = start_ingest(
        spark, inbox, checkpoint, ingest, drain=True, backlog_batches=BACKLOG_BATCHES, **options
    )
    query.awaitTermination()


def _run_stream(spark: SparkSession, sf_dir: str, deliveries: int = 1) -> tuple[OrdersTable, str]:
    """Write all orders to an inbox and drain it into a fresh table.

    A second delivery reads the same inbox from a checkpoint of its own, so as another
    stream. The metrics are those of the last one.
    """
    base, inbox = _inbox(spark, sf_dir)
    table = OrdersTable(f"{base}/orders", options=SMALL_FILES, store_hash=True)
    for delivery in range(deliveries):
        metrics, checkpoint = f"{base}/metrics-{delivery}", f"{base}/checkpoint-{delivery}"
        # Which copies share a batch depends on the files, so copies go in each batch too.
        ingest = Ingest(table, metrics_path=metrics, drop_batch_copies=True)
        used_up = delivery == deliveries - 1
        _drain(spark, inbox, checkpoint, ingest, **(USED_UP if used_up else {}))
    return table, metrics


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = _run_stream(spark, sf_dir)
    return table.read(spark).drop(PROCESSED_TIME)


def ingest_metrics(spark: SparkSession, sf_dir: str, deliveries: int = 1) -> DataFrame:
    _, metrics = _run_stream(spark, sf_dir, deliveries)
    return _totals(read_metrics(spark, metrics))


def _totals(metrics: DataFrame, *more: str) -> DataFrame:
    names = ("received", "new_rows", "duplicates", *more)
    return metrics.agg(*(F.sum(name).alias(name) for name in names))


def _run_with_replay(spark: SparkSession, sf_dir: str) -> tuple[OrdersTable, str]:
    """Every order twice in its batch; the first batch breaks off after its write.

    The restarted stream delivers it again, then the others. Copies in a batch are kept.
    """
    base, inbox = _inbox(spark, sf_dir, copied="true")
    table = OrdersTable(f"{base}/orders", options=SMALL_FILES, store_hash=True)
    metrics, checkpoint = f"{base}/metrics", f"{base}/checkpoint"
    failing = FailsAfterWriting(table, metrics_path=metrics)
    try:
        _drain(spark, inbox, checkpoint, failing)
    except StreamingQueryException as failure:
        if "Interrupted" not in str(failure):
            raise
    ingest = Ingest(table, metrics_path=metrics)
    _drain(spark, inbox, checkpoint, ingest, **USED_UP)
    return table, metrics


def replayed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = _run_with_replay(spark, sf_dir)
    return table.read(spark).select(*BUSINESS_COLUMNS)


def replay_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, metrics = _run_with_replay(spark, sf_dir)
    return _totals(read_metrics(spark, metrics))


def any_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with padding, quotes, backslashes and line breaks, split and streamed."""
    base = new_shared_folder(spark, "any-text")
    odd = {
        name: F.concat(F.lit(f'  "{i}" \\, \\"\n'), F.col(name), F.lit("\\ "))
        for i, name in enumerate(("item_purchased", "category", "color"))
    }
    orders = shop_orders(spark, sf_dir).withColumns(odd).drop(PROCESSED_TIME).toDF(*RAW_COLUMNS)
    split_to_csv(orders, f"{base}/inbox", INBOX_ROWS_PER_FILE, escape=ANY_TEXT["escape"])
    table = OrdersTable(f"{base}/orders", store_hash=True)
    _drain(spark, f"{base}/inbox", f"{base}/checkpoint", Ingest(table), **ANY_TEXT)
    return table.read(spark).select(*BUSINESS_COLUMNS)


def rejected_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a stream of which some records have a cell that is no number, or one more."""
    base = new_shared_folder(spark, "rejected")
    raw = raw_orders(spark, sf_dir)
    text = raw.select(*(F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")) for n in raw.columns))
    cells = text.toDF(*BUSINESS_COLUMNS)
    no_number = F.when(F.col("age") == "20", F.lit("young")).otherwise(F.col("age"))
    one_more = F.when(F.col("age") == "21", F.lit(",more")).otherwise(F.lit(""))
    quoted = [
        F.concat(F.lit('"'), F.regexp_replace(c, '"', '""'), F.lit('"'))
        for c in (no_number if c == "age" else F.col(c) for c in BUSINESS_COLUMNS)
    ]
    record = F.concat(F.concat_ws(",", *quoted), one_more)
    cells.select(record.alias("value")).write.option("maxRecordsPerFile", INBOX_ROWS_PER_FILE).text(
        f"{base}/inbox"
    )
    ingest = Ingest(OrdersTable(f"{base}/orders"), metrics_path=f"{base}/metrics")
    _drain(spark, f"{base}/inbox", f"{base}/checkpoint", ingest, header="false", **ANY_TEXT)
    known = ingest.table.read(spark).agg(F.count("age").alias("known_ages"))
    metrics = read_metrics(spark, f"{base}/metrics")
    return _totals(metrics.unionByName(known, True), "rejected", "known_ages")


def stored_view(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """A view created over a part of the orders, read after the others were appended."""
    table = OrdersTable(f"{new_shared_folder(spark, 'views')}/orders")
    name = f"orders_{uuid4().hex}"
    rows = enriched(spark, sf_dir).withColumn(PROCESSED_TIME, F.current_timestamp())
    early = F.col("previous_purchases") < PRELOADED_BELOW
    table.append(rows.filter(early))
    register_table(spark, table, name)
    create_views(spark, name, prefix=f"{name}_")
    spark.table(f"{name}_{view}").count()
    table.append(rows.filter(~early | early.isNull()))
    refresh(spark, name)
    found = spark.table(f"{name}_{view}")
    if "top_categories" in found.columns:
        return found.withColumn("top_categories", F.array_join("top_categories", ","))
    return found


def layout_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One category on some days, from a table laid out by day and sorted by category."""
    table = OrdersTable(f"{new_shared_folder(spark, 'layout')}/orders", cluster=True)
    quarter = F.date_trunc("quarter", PROCESSED_TIME)
    table.append(enriched(spark, sf_dir).withColumn(PROCESSED_TIME, quarter))
    days = table.between(spark, "1995-01-01", "1996-12-31")
    return (
        days.filter(F.col("category").startswith("PROMO"))
        .groupBy("category", "location")
        .agg(F.count(F.lit(1)).alias("orders"), F.max("final_amount_usd").alias("largest"))
    )


# --- ranking ---------------------------------------------------------------------


def gender_top_join(orders: DataFrame) -> DataFrame:
    counts = orders.groupBy("gender", "category").agg(F.count(F.lit(1)).alias("n"))
    stats = counts.groupBy("gender").agg(F.sum("n").alias("orders"))
    top = rank_items(counts, "gender", "category", "n", 1)
    named = top.select("gender", F.col("category").alias("top_category"))
    return attach_to_groups(stats, named, "gender", "top_category")


def location_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = views.location_preferences(shop_orders(spark, sf_dir))
    return view.withColumn("top_categories", F.array_join("top_categories", ","))


QUERIES: dict[str, Query] = {
    "v_age_preferences": _over_orders(views.age_preferences),
    "v_gender_preferences": _over_orders(views.gender_preferences),
    "v_location_preferences": location_view,
    "v_age_gender_category": _over_orders(views.age_gender_category),
    "vip_premium": _over_enriched(reports.vip_premium),
    "anomalies": _over_enriched(reports.anomalies),
    "satisfaction_by_segment": _over_enriched(reports.satisfaction_by_segment),
    "high_clv": _over_enriched(reports.high_clv),
    "clv_by_segment": _over_enriched(reports.clv_by_segment),
    "high_potential": _over_enriched(reports.high_potential),
    "clv_trend": _over_enriched(reports.clv_trend),
    "enrich_orders": enriched,
    **{f"enrich_{name}": _computed(name) for name in COLUMN_INPUTS},
    "clv_extended": _over_enriched(
        lambda df: df.select(
            "previous_purchases",
            "final_amount_usd",
            "frequency_of_purchases",
            "subscription_status",
            columns.extended_clv().alias("extended_clv"),
        )
    ),
    "clv_band": _over_enriched(
        lambda df: df.select("estimated_clv", columns.clv_band().alias("clv_band"))
    ),
    "clv_marketing_tier": _over_enriched(
        lambda df: df.select("estimated_clv", columns.clv_marketing_tier().alias("tier"))
    ),
    "age_bucket": _over_orders(
        lambda df: df.select("age", columns.age_bucket().alias("age_bucket"))
    ),
    "top1_category_per_key": _over_orders(lambda df: top_items(df, "gender", "category", 1)),
    "top3_category_per_location": _over_orders(
        lambda df: top_items(df, "location", "category", views.TOP_CATEGORIES)
    ),
    "gender_top_join": _over_orders(gender_top_join),
    "csv_read": csv_read,
    "align_schema": align_schema,
    "split_files": split_files,
    "schema_evolution_append": schema_evolution_append,
    "row_hash": row_hash,
    "dedup_against_table": partial(_against_table, broadcast_limit=BROADCAST_LIMIT),
    "dedup_by_shuffle": partial(_against_table, broadcast_limit=0),
    "dedup_against_index": dedup_against_index,
    "dedup_within_batch": dedup_within_batch,
    "stream_ingest": stream_ingest,
    "ingest_metrics": ingest_metrics,
    "redelivery_metrics": partial(ingest_metrics, deliveries=2),
    "replayed_batch": replayed_batch,
    "replay_metrics": replay_metrics,
    "any_text": any_text,
    "rejected_cells": rejected_cells,
    **{f"stored_{view}": partial(stored_view, view=view) for view in views.VIEWS},
    "layout_pruning": layout_pruning,
}
