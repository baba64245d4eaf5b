import datetime

import pytest
from helpers import bag, orders

from tillroll.operators.enrich import enrich_orders
from tillroll.operators.dedup import hashes_of, with_row_hash
from tillroll.schema import BUSINESS_COLUMNS, RAW_COLUMNS, RAW_SCHEMA, TABLE_SCHEMA
from tillroll.sources import paths
from tillroll.sources.orders_csv import (
    ANY_TEXT,
    read_orders_csv,
    split_report,
    split_to_csv,
    split_totals,
    stream_orders_csv,
)
from tillroll.sources.orders_table import OrdersTable, staged_connector_options

LINE = "1,{age},F,Coat,Outer,12.5,Maine,M,Blue,Fall,4.5,Yes,Air,No,No,3,Cash,Weekly"


def test_csv_binds_by_position_and_nulls_bad_cells(spark, tmp_path):
    header = ",".join(f"wrong {i}" for i in range(18))
    (tmp_path / "a.csv").write_text("\n".join([header, LINE.format(age=30), LINE.format(age="x")]))
    df = read_orders_csv(spark, str(tmp_path))
    assert df.columns == list(RAW_COLUMNS)
    assert df.schema.simpleString() == RAW_SCHEMA.simpleString()
    rows = df.collect()
    assert [r["Age"] for r in rows] == [30, None]
    assert rows[1]["Purchase Amount (USD)"] == 12.5


def test_stream_needs_one_bound(spark, tmp_path):
    for bounds in ((None, None), (10, 1000)):
        with pytest.raises(ValueError, match="files_per_trigger"):
            stream_orders_csv(spark, str(tmp_path), *bounds)
    assert stream_orders_csv(spark, str(tmp_path), None, 1000).isStreaming


def test_split_bounds_every_file(spark, tmp_path):
    raw = orders(spark, *({"customer_id": i} for i in range(110))).drop("processed_time")
    raw = raw.toDF(*RAW_COLUMNS).coalesce(1)
    folder = str(tmp_path / "split")
    split_to_csv(raw, folder)
    back = read_orders_csv(spark, folder)
    assert bag(back) == bag(raw)
    report = split_report(back)
    assert sorted(r.rows for r in report.collect()) == [10, 25, 25, 25, 25]
    assert tuple(split_totals(report).first()) == (5, 110, 25)
    for file in (tmp_path / "split").glob("*.csv"):
        assert file.read_text().startswith("Customer ID,Age,")


def test_split_keeps_line_breaks_inside_cells(spark, tmp_path):
    raw = orders(spark, {"item_purchased": "two\nlines"}, {"item_purchased": 'a "b", c'})
    raw = raw.drop("processed_time").toDF(*RAW_COLUMNS)
    split_to_csv(raw, str(tmp_path / "split"), 1)
    assert bag(read_orders_csv(spark, str(tmp_path / "split"), multiLine="true")) == bag(raw)


def test_folders(spark, tmp_path):
    inbox = tmp_path / "a" / "inbox"
    paths.ensure_folder(spark, str(inbox))
    paths.ensure_folder(spark, str(inbox))
    assert inbox.is_dir() and paths.folder_exists(spark, str(inbox))
    assert [p.split("/")[-1] for p in paths.matching_folders(spark, f"{tmp_path}/a/in*")] == ["inbox"]
    assert paths.matching_folders(spark, f"{tmp_path}/b/*") == []
    paths.delete_folder(spark, str(inbox))
    paths.delete_folder(spark, str(inbox))
    assert not inbox.exists()
    paths.ensure_folder(spark, "nosuchscheme://bucket/inbox")


def test_shared_folder_follows_the_cluster_setting(spark, tmp_path, monkeypatch):
    assert paths.new_shared_folder(spark, "a") != paths.new_shared_folder(spark, "a")
    monkeypatch.setattr(paths, "SHARED_DIR_SETTING", "spark.tests.shared")
    spark.conf.set("spark.tests.shared", str(tmp_path))
    try:
        folder = paths.new_shared_folder(spark, "b")
    finally:
        spark.conf.unset("spark.tests.shared")
    assert folder.startswith(f"{tmp_path}/b-") and paths.folder_exists(spark, folder)


@pytest.mark.parametrize("store_hash", [False, True])
@pytest.mark.parametrize("cluster", [False, True])
def test_table_round_trip(spark, tmp_path, store_hash, cluster):
    table = OrdersTable(str(tmp_path / "t"), store_hash=store_hash, cluster=cluster)
    assert table.snapshot(spark) is None
    assert table.read(spark).collect() == []
    rows = enrich_orders(
        orders(spark, *({"processed_time": datetime.datetime(2024, 1, d)} for d in (1, 2, 2)))
    )
    assert table.append(with_row_hash(rows)) == 3
    assert table.append(rows.limit(0)) == 0
    assert table.read(spark).schema.simpleString() == TABLE_SCHEMA.simpleString()
    assert bag(table.read(spark)) == bag(rows)
    days = sorted(p.name for p in (tmp_path / "t").glob("processed_date=*"))
    assert days == ["processed_date=2024-01-01", "processed_date=2024-01-02"]
    assert ("row_hash" in table.snapshot(spark).columns) == store_hash
    assert bag(hashes_of(table.snapshot(spark))) == bag(with_row_hash(rows).select("row_hash"))


def test_a_batch_replaces_only_itself(spark, tmp_path):
    table = OrdersTable(str(tmp_path / "t"))
    day = lambda d, i: {"processed_time": datetime.datetime(2024, 1, d), "customer_id": i}

    def write(stream, batch, *changes):
        return table.write_batch(enrich_orders(orders(spark, *changes)), stream, batch)

    assert write("a", 0, day(1, 1), day(1, 1), day(2, 2)) == 3
    assert write("a", 1, day(1, 3)) == 1
    assert write("b", 0, day(1, 4)) == 1
    assert table.append(enrich_orders(orders(spark, day(1, 5)))) == 1
    # Fewer rows, on another day; then none.
    assert write("a", 0, day(3, 6)) == 1
    assert sorted(r.customer_id for r in table.read(spark).collect()) == [3, 4, 5, 6]
    assert table.write_batch(table.read(spark).limit(0), "a", 0) == 0
    assert sorted(r.customer_id for r in table.read(spark).collect()) == [3, 4, 5]
    assert table.batch_rows(spark, "b", 0) == 1 and table.batch_rows(spark, "b", 7) == 0


def test_hash_check_reads_one_column(spark, tmp_path):
    table = OrdersTable(str(tmp_path / "t"), store_hash=True)
    table.append(enrich_orders(orders(spark, {})))
    plan = hashes_of(table.snapshot(spark))._jdf.queryExecution().executedPlan().toString()
    stored, missing = plan.split("FileScan parquet [")[1:]
    assert stored.startswith("row_hash#") and "PushedFilters: [IsNotNull(row_hash)]" in stored
    assert "PushedFilters: [IsNull(row_hash)]" in missing


def test_older_rows_gain_new_columns(spark, tmp_path):
    old = OrdersTable(str(tmp_path / "t"))
    old.append(orders(spark, {"age": 1}))
    table = OrdersTable(str(tmp_path / "t"), store_hash=True)
    table.append(enrich_orders(orders(spark, {"age": 2})))
    found = {r.age: r.customer_segment for r in table.read(spark).collect()}
    assert found == {1: None, 2: "Regular"}
    everything = orders(spark, {"age": 1}, {"age": 2})
    assert bag(hashes_of(table.snapshot(spark))) == bag(
        with_row_hash(everything).select("row_hash")
    )


def test_clustered_files_are_sorted(spark, tmp_path):
    table = OrdersTable(str(tmp_path / "t"), cluster=True)
    table.append(
        orders(
            spark, *({"category": c, "location": p} for c in "cab" for p in "zxy")
        ).repartition(4)
    )
    for file in (tmp_path / "t").rglob("*.parquet"):
        found = [(r.category, r.location) for r in spark.read.parquet(str(file)).collect()]
        assert found == sorted(found)


def test_only_a_missing_table_counts_as_empty(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)nosuchformat"):
        OrdersTable("x", format="nosuchformat").snapshot(spark)
    (tmp_path / "broken.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        OrdersTable(str(tmp_path)).read(spark).collect()


def test_connector_options(spark):
    options = staged_connector_options("gs://bucket/checkpoints/consumer")
    assert options["temporaryGcsBucket"] == "bucket"
    assert options["intermediateFormat"] == "parquet"
    for path in ("/local/path", "gs:///nothing"):
        with pytest.raises(ValueError, match="bucket"):
            staged_connector_options(path)


def test_schemas_line_up():
    assert TABLE_SCHEMA.names[:18] == list(BUSINESS_COLUMNS)
    assert len(TABLE_SCHEMA) == 29 and all(f.nullable for f in TABLE_SCHEMA)


def test_any_text_survives_the_split_and_the_stream(spark, tmp_path):
    odd = ['"', '\\', '\\"', 'a "b", c\\', "two\nlines", "\r\nx", "  padded\t", '"\n"', "é\u2028", ","]
    raw = orders(spark, *({"item_purchased": text} for text in odd)).drop("processed_time")
    raw = raw.toDF(*RAW_COLUMNS)
    folder = str(tmp_path / "split")
    split_to_csv(raw, folder, 2, escape=ANY_TEXT["escape"])
    assert bag(read_orders_csv(spark, folder, **ANY_TEXT)) == bag(raw)
    stream = stream_orders_csv(spark, folder, **ANY_TEXT)
    query = stream.writeStream.format("memory").queryName("any_text").trigger(availableNow=True).start()
    query.awaitTermination()
    assert bag(spark.table("any_text")) == bag(raw)


def test_rejected_records_are_kept_beside_the_others(spark, tmp_path):
    good, bad = LINE.format(age=30), LINE.format(age="x")
    (tmp_path / "a.csv").write_text("\n".join(["header", good, bad, good + ",more", good[:-7]]))
    rows = read_orders_csv(spark, str(tmp_path), rejected=True).cache().collect()
    assert [r["_rejected"] for r in rows] == [None, bad, good + ",more", good[:-7]]
    assert [r["Age"] for r in rows] == [30, None, 30, 30]


def scans(df):
    """(files, rows) that the file scans of a frame's plan have read."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "FileSourceScanExec":
            metrics = node.metrics()
            found.append(tuple(metrics.apply(m).value() for m in ("numFiles", "numOutputRows")))
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return found


def test_layout_shows_in_reads(spark, tmp_path):
    days = [datetime.datetime(2024, 1, d) for d in range(1, 9)]
    rows = orders(
        spark,
        *(
            {"processed_time": day, "category": c, "location": str(i)}
            for day in days for c in "abcdefgh" for i in range(400)
        ),
    ).repartition(8)
    small = {"parquet.block.size": "1024", "parquet.block.size.row.check.min": "20",
             "parquet.page.size.row.check.min": "20", "parquet.page.row.count.limit": "50"}
    laid = OrdersTable(str(tmp_path / "laid"), options=small, cluster=True)
    plain = OrdersTable(str(tmp_path / "plain"), options=small)
    for table in (laid, plain):
        table.append(rows)

    def asked(table):
        return table.between(spark, "2024-01-03", "2024-01-04").where("category = 'c'")

    assert bag(asked(laid)) == bag(asked(plain)) and asked(laid).count() == 800
    (laid_files, laid_rows), (plain_files, plain_rows) = *scans(asked(laid)), *scans(asked(plain))
    everything = len(list((tmp_path / "laid").rglob("*.parquet")))
    # Two of eight days, and in their files the pages of one of eight categories.
    assert 0 < laid_files <= everything / 4
    assert 800 <= laid_rows <= 1600 and plain_rows > 3 * laid_rows
    assert plain_files >= laid_files
    nothing = OrdersTable(str(tmp_path / "none")).between(spark, "2024-01-03", "2024-01-04")
    assert nothing.collect() == []


def test_split_keeps_white_space(spark, tmp_path):
    from tillroll.sources.orders_csv import split_to_csv

    folder = str(tmp_path / "split")
    split_to_csv(spark.createDataFrame([("  padded ",)], "size string"), folder)
    assert [r[0] for r in spark.read.csv(folder, header=True).collect()] == ["  padded "]
