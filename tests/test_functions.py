import hashlib

import pytest
from helpers import SAMPLE, orders
from pyspark.sql import functions as F

from tillroll.functions import orders as columns
from tillroll.functions.names import clean_name, clean_names
from tillroll.operators.enrich import enrich_orders
from tillroll.schema import BUSINESS_COLUMNS, RAW_COLUMNS, TABLE_SCHEMA


@pytest.mark.parametrize(
    ("header", "position", "name"),
    [
        ("Purchase Amount (USD)", 5, "purchase_amount_usd"),
        ("2nd", 0, "col_2nd"),
        ("--", 3, "col_3"),
        ("", 0, "col_0"),
        ("__A  b__", 0, "a_b"),
        ("Prénom", 0, "pr_nom"),
    ],
)
def test_clean_name(header, position, name):
    assert clean_name(header, position) == name


def test_clean_names_are_unique():
    assert clean_names(["A b", "a_b", "A-B", "a_b_2"]) == ["a_b", "a_b_2", "a_b_3", "a_b_2_2"]
    assert list(BUSINESS_COLUMNS)[5] == "purchase_amount_usd"
    assert len(RAW_COLUMNS) == len(BUSINESS_COLUMNS) == 18


AMOUNT, PRIOR, RATING = "purchase_amount_usd", "previous_purchases", "review_rating"
DISCOUNT, SUBSCRIBED, OFTEN = "discount_applied", "subscription_status", "frequency_of_purchases"

GOLDEN = [
    ("final_amount_usd", {AMOUNT: 100.0, DISCOUNT: "Yes"}, 90.0),
    ("final_amount_usd", {AMOUNT: 100.0, DISCOUNT: "No"}, 100.0),
    ("final_amount_usd", {AMOUNT: 100.0, DISCOUNT: "yes"}, 100.0),
    ("final_amount_usd", {AMOUNT: 100.0, DISCOUNT: None}, 100.0),
    ("final_amount_usd", {AMOUNT: None, DISCOUNT: "Yes"}, None),
    ("amount_category", {AMOUNT: 30.0}, "Small"),
    ("amount_category", {AMOUNT: 50.0}, "Medium"),
    ("amount_category", {AMOUNT: 150.0}, "Large"),
    ("amount_category", {AMOUNT: 200.0}, "Large"),
    ("amount_category", {AMOUNT: 300.0}, "Premium"),
    ("amount_category", {AMOUNT: None}, "Premium"),
    ("customer_segment", {PRIOR: 12}, "VIP"),
    ("customer_segment", {PRIOR: 10}, "VIP"),
    ("customer_segment", {PRIOR: 5}, "Regular"),
    ("customer_segment", {PRIOR: 2}, "Occasional"),
    ("customer_segment", {PRIOR: 1}, "New"),
    ("customer_segment", {PRIOR: None}, "New"),
    ("satisfaction_level", {RATING: 4.8}, "Very Satisfied"),
    ("satisfaction_level", {RATING: 4.5}, "Very Satisfied"),
    ("satisfaction_level", {RATING: 4.0}, "Satisfied"),
    ("satisfaction_level", {RATING: 3.0}, "Neutral"),
    ("satisfaction_level", {RATING: 2.5}, "Dissatisfied"),
    ("satisfaction_level", {RATING: 2.0}, "Dissatisfied"),
    ("satisfaction_level", {RATING: 1.9}, "Very Dissatisfied"),
    ("satisfaction_level", {RATING: None}, "Very Dissatisfied"),
    ("is_anomaly", {AMOUNT: 600.0}, True),
    ("is_anomaly", {AMOUNT: 500.0}, False),
    ("is_anomaly", {AMOUNT: 100.0}, False),
    ("is_anomaly", {AMOUNT: None}, False),
    ("is_anomaly", {AMOUNT: float("nan")}, True),
    ("estimated_clv", {PRIOR: 5, AMOUNT: 100.0}, 150.0),
    ("estimated_clv", {PRIOR: 0, AMOUNT: 50.0}, 0.0),
    ("estimated_clv", {PRIOR: 2, AMOUNT: 80.0}, 48.0),
    ("estimated_clv", {PRIOR: 5, AMOUNT: 120.0}, 180.0),
    ("estimated_clv", {PRIOR: 15, AMOUNT: 250.0}, 1125.0),
    ("estimated_clv", {PRIOR: None, AMOUNT: 250.0}, None),
    ("frequency_category", {OFTEN: "Weekly"}, "High Frequency"),
    ("frequency_category", {OFTEN: "Monthly"}, "Medium Frequency"),
    ("frequency_category", {OFTEN: "Annually"}, "Low Frequency"),
    ("frequency_category", {OFTEN: "Quarterly"}, "Unknown"),
    ("frequency_category", {OFTEN: "weekly"}, "Unknown"),
    ("frequency_category", {OFTEN: None}, "Unknown"),
    ("estimated_profit_usd", {AMOUNT: 100.0}, 40.0),
    ("season_type", {"season": "Spring"}, "High Season"),
    ("season_type", {"season": "Summer"}, "High Season"),
    ("season_type", {"season": "Winter"}, "Low Season"),
    ("season_type", {"season": None}, "Low Season"),
    ("loyalty_score", {SUBSCRIBED: "Yes", PRIOR: 8}, "High"),
    ("loyalty_score", {SUBSCRIBED: "Yes", PRIOR: 1}, "Medium"),
    ("loyalty_score", {SUBSCRIBED: "No", PRIOR: 1}, "Low"),
    ("loyalty_score", {SUBSCRIBED: "Yes", PRIOR: None}, "Medium"),
    ("loyalty_score", {SUBSCRIBED: None, PRIOR: 3}, "Medium"),
    ("loyalty_score", {SUBSCRIBED: None, PRIOR: None}, "Low"),
]


@pytest.fixture(scope="module")
def golden_rows(spark):
    rows = orders(spark, *(changes for _, changes, _ in GOLDEN)).coalesce(1)
    return enrich_orders(rows).collect()


@pytest.mark.parametrize("i", range(len(GOLDEN)), ids=[f"{n}-{c}" for n, c, _ in GOLDEN])
def test_enrichment(i, golden_rows):
    name, _, expected = GOLDEN[i]
    found = golden_rows[i][name]
    assert found == (pytest.approx(expected, abs=1e-9) if type(expected) is float else expected)


def test_enriched_schema_is_the_table_schema(spark):
    assert enrich_orders(orders(spark, {})).schema.simpleString() == TABLE_SCHEMA.simpleString()


def test_extended_clv(spark):
    rows = orders(
        spark,
        {AMOUNT: 100.0, PRIOR: 5},
        {AMOUNT: 100.0, PRIOR: 5, OFTEN: None, SUBSCRIBED: None},
        {AMOUNT: None},
    ).coalesce(1)
    values = [r[0] for r in enrich_orders(rows).select(columns.extended_clv()).collect()]
    assert values[:2] == pytest.approx([150 + 30 + 20, 150 + 20 + 10], abs=1e-9)
    assert values[2] is None


def test_clv_bands_and_tiers(spark):
    cases = [
        (-5.0, "0-50", "standard"),
        (0.0, "0-50", "standard"),
        (50.0, "50-200", "standard"),
        (200.0, "200-500", "standard"),
        (200.5, "200-500", "benefits"),
        (500.0, "500-1000", "benefits"),
        (500.5, "500-1000", "premium offer"),
        (1000.0, "500-1000", "premium offer"),
        (1000.5, ">1000", "premium offer"),
        (None, None, "standard"),
    ]
    values = spark.createDataFrame([(c[0],) for c in cases], "estimated_clv double").coalesce(1)
    found = values.select("*", columns.clv_band(), columns.clv_marketing_tier()).collect()
    assert [tuple(r) for r in found] == cases


def test_age_buckets(spark):
    ages = [12, 24, 25, 34, 35, 44, 45, 54, 55, 64, 65, None]
    rows = orders(spark, *({"age": a} for a in ages)).coalesce(1)
    found = [r[0] for r in rows.select(columns.age_bucket()).collect()]
    assert found == [
        *("18-24", "18-24", "25-34", "25-34", "35-44", "35-44"),
        *("45-54", "45-54", "55-64", "55-64", "65+", "65+"),
    ]


def test_row_hash(spark):
    nothing = dict.fromkeys(BUSINESS_COLUMNS)
    rows = orders(spark, {}, {"processed_time": None}, nothing, {"age": None, "size": "L"})
    found = [r[0] for r in rows.coalesce(1).select(columns.row_hash()).collect()]
    text = "|".join(str(SAMPLE[name]) for name in BUSINESS_COLUMNS)
    assert found[0] == found[1] == hashlib.md5(text.encode()).hexdigest()
    assert found[2] == hashlib.md5(b"").hexdigest()
    assert found[3] not in found[:3]


def test_enrichment_is_narrow(spark):
    plan = enrich_orders(orders(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert "is_anomaly" in enrich_orders(spark.range(0).select(
        *(F.lit(None).cast(t).alias(n) for n, t in BUSINESS_COLUMNS.items())
    )).columns
