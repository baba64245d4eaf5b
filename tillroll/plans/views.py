"""Preference views over an orders table.

Amounts are the listed ones, before any discount. Each view reads the orders once: they
are first counted per (key, category), and everything else derives from those counts.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.orders import age_bucket
from tillroll.operators.ranking import attach_to_groups, items_by_rank, rank_items

TOP_CATEGORIES = 3


def _category_counts(orders: DataFrame, key: str) -> DataFrame:
    """Per (key, category): orders, and sum and count of the averaged columns."""
    return orders.groupBy(key, "category").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("purchase_amount_usd").alias("spend"),
        F.count("purchase_amount_usd").alias("spend_n"),
        F.sum("review_rating").alias("rating"),
        F.count("review_rating").alias("rating_n"),
    )


def _average(total: str, count: str) -> Column:
    """Average from partial sums; null where no value was known."""
    return F.try_divide(F.sum(total), F.sum(count))


def _preferences(orders: DataFrame, key: str) -> DataFrame:
    """Statistics and most ordered category of each key, ties to the smaller name.

    A group without a key matches nothing, so it has statistics but no category.
    """
    most_ordered = F.min_by("category", F.struct(-F.col("n"), F.col("category")))
    return (
        _category_counts(orders, key)
        .groupBy(key)
        .agg(
            F.sum("n").alias("orders"),
            _average("spend", "spend_n").alias("avg_spend"),
            _average("rating", "rating_n").alias("avg_rating"),
            most_ordered.alias("top_category"),
        )
        .withColumn("top_category", F.when(F.col(key).isNotNull(), F.col("top_category")))
    )


def age_preferences(orders: DataFrame) -> DataFrame:
    return _preferences(orders.withColumn("age_bucket", age_bucket()), "age_bucket")


def gender_preferences(orders: DataFrame) -> DataFrame:
    return _preferences(orders, "gender")


def location_preferences(orders: DataFrame) -> DataFrame:
    """Statistics of each location with its most ordered categories as an array."""
    counts = orders.groupBy("location", "category").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("purchase_amount_usd").alias("spend"),
        F.count("purchase_amount_usd").alias("spend_n"),
    )
    stats = counts.groupBy("location").agg(
        F.sum("n").alias("orders"), _average("spend", "spend_n").alias("avg_spend")
    )
    ranked = rank_items(
        counts, "location", "category", "n", TOP_CATEGORIES, carry=("spend", "spend_n")
    )
    top = items_by_rank(ranked, "location", "category", "top_categories")
    listed = F.coalesce("top_categories", F.array().cast("array<string>"))
    return attach_to_groups(stats, top, "location", "top_categories").withColumn(
        "top_categories", listed
    )


def age_gender_category(orders: DataFrame) -> DataFrame:
    return (
        orders.withColumn("age_bucket", age_bucket())
        .groupBy("age_bucket", "gender", "category")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.avg("purchase_amount_usd").alias("avg_spend"),
        )
    )


VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "v_age_preferences": age_preferences,
    "v_gender_preferences": gender_preferences,
    "v_location_preferences": location_preferences,
    "v_age_gender_category": age_gender_category,
}


def register_views(orders: DataFrame) -> None:
    """Make the four views available to ``spark.sql``."""
    for name, view in VIEWS.items():
        view(orders).createOrReplaceTempView(name)
