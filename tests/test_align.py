import datetime

from tillroll.operators.align import align_orders, clean_columns
from tillroll.schema import ALIGNED_COLUMNS, ALIGNED_SCHEMA


def test_clashing_headers_stay_apart(spark):
    assert clean_columns(spark.createDataFrame([(1, 2)], ["A b", "a_b"])).columns == [
        "a_b",
        "a_b_2",
    ]


def test_align_fits_any_input(spark):
    text = spark.createDataFrame(
        [
            ("9.5", "no", " 41 ", "2024-05-06 07:08:09", "x"),
            ("abc", None, "4.7", "never", "y"),
            (None, None, "old", None, "z"),
        ],
        ["Purchase Amount (USD)", "Gift", "AGE", "processed time", "size"],
    ).coalesce(1)
    aligned = align_orders(text)
    assert aligned.schema.simpleString() == ALIGNED_SCHEMA.simpleString()
    rows = aligned.collect()
    assert [r.purchase_amount_usd for r in rows] == [9.5, None, None]
    assert [r.age for r in rows] == [41, 4, None]
    assert [r["size"] for r in rows] == ["x", "y", "z"]
    assert rows[0].processed_time == datetime.datetime(2024, 5, 6, 7, 8, 9)
    assert rows[1].processed_time is rows[0].customer_id is rows[0].gender is None


def test_align_of_aligned_changes_nothing(spark):
    empty = spark.createDataFrame([], ALIGNED_SCHEMA)
    assert align_orders(empty).columns == list(ALIGNED_COLUMNS)
