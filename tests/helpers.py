"""Small hand-made order frames."""

from collections import Counter
from datetime import datetime

from tillroll.schema import ALIGNED_COLUMNS, ALIGNED_SCHEMA

SAMPLE = {
    "customer_id": 7,
    "age": 30,
    "gender": "Female",
    "item_purchased": "Coat",
    "category": "Outerwear",
    "purchase_amount_usd": 100.0,
    "location": "Maine",
    "size": "M",
    "color": "Blue",
    "season": "Winter",
    "review_rating": 4.0,
    "subscription_status": "Yes",
    "shipping_type": "Express",
    "discount_applied": "No",
    "promo_code_used": "No",
    "previous_purchases": 5,
    "payment_method": "Cash",
    "frequency_of_purchases": "Weekly",
    "processed_time": datetime(2024, 1, 2, 3, 4, 5),
}


def orders(spark, *changes):
    """One aligned row per dict of changes to the sample row."""
    rows = [tuple({**SAMPLE, **change}[name] for name in ALIGNED_COLUMNS) for change in changes]
    return spark.createDataFrame(rows, ALIGNED_SCHEMA)


def bag(df):
    return Counter(map(tuple, df.collect()))


def final_plan(df):
    """The executed plan after adaptive changes; runs the query."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]
