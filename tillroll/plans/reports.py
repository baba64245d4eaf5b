"""Customer-value and satisfaction reports over an enriched orders table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.averages import averages

# What the reports look for.
HIGH_CLV_ABOVE = 500
POTENTIAL_BELOW_PURCHASES = 3
POTENTIAL_ABOVE_AMOUNT = 200


def _highest_first(rows: DataFrame, column: str) -> DataFrame:
    """Sort downwards by one column, unknown values last.

    Equal values sort by the number of their input partition. Without it all rows that
    share a value would be sorted by one task, however many they are. The number stays
    the same when a lost task runs again, so no row changes its place between attempts.
    """
    return (
        rows.withColumn("_spread", F.spark_partition_id())
        .orderBy(F.desc(column), "_spread")
        .drop("_spread")
    )


def vip_premium(orders: DataFrame) -> DataFrame:
    """Premium purchases of VIP customers, by customer value."""
    rows = orders.filter(
        (F.col("customer_segment") == "VIP") & (F.col("amount_category") == "Premium")
    ).select(
        "customer_id",
        "customer_segment",
        "amount_category",
        "final_amount_usd",
        "estimated_clv",
        "loyalty_score",
    )
    return _highest_first(rows, "estimated_clv")


def anomalies(orders: DataFrame) -> DataFrame:
    """Unusually high orders, all columns, largest first."""
    return _highest_first(orders.filter("is_anomaly"), "final_amount_usd")


def satisfaction_by_segment(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("customer_segment", "satisfaction_level")
        .agg(F.count(F.lit(1)).alias("count"), F.avg("review_rating").alias("avg_rating"))
        .orderBy("customer_segment", F.desc("avg_rating"))
    )


def high_clv(orders: DataFrame) -> DataFrame:
    """Orders of high-value customers."""
    rows = orders.filter(F.col("estimated_clv") > HIGH_CLV_ABOVE).select(
        "customer_id", "customer_segment", "estimated_clv", "final_amount_usd"
    )
    return _highest_first(rows, "estimated_clv")


def clv_by_segment(orders: DataFrame) -> DataFrame:
    others = {
        "max_clv": (F.max, F.max, "estimated_clv"),
        "min_clv": (F.min, F.min, "estimated_clv"),
        "count": (lambda _: F.count(F.lit(1)), F.sum, "*"),
    }
    found = averages(orders, ["customer_segment"], "estimated_clv", "avg_clv", others)
    return found.orderBy(F.desc("avg_clv"))


def high_potential(orders: DataFrame) -> DataFrame:
    """Large orders of customers with few purchases so far."""
    rows = orders.filter(
        (F.col("previous_purchases") < POTENTIAL_BELOW_PURCHASES)
        & (F.col("final_amount_usd") > POTENTIAL_ABOVE_AMOUNT)
    ).select("customer_id", "previous_purchases", "final_amount_usd", "estimated_clv")
    return _highest_first(rows, "estimated_clv")


def clv_trend(orders: DataFrame) -> DataFrame:
    """Average customer value of each segment, day by day."""
    return averages(
        orders.withColumn("day", F.to_date("processed_time")),
        ["day", "customer_segment"],
        "estimated_clv",
        "avg_clv",
        {"orders": (lambda _: F.count(F.lit(1)), F.sum, "*")},
    )
