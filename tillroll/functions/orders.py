"""Business columns of an order, as expressions over the aligned column names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.functions.bands import above, at_least, below, matching
from tillroll.schema import BUSINESS_COLUMNS

# Rates, thresholds and labels of the business rules.
DISCOUNTED_SHARE = 0.9
PROFIT_SHARE = 0.4
CLV_FACTOR = 0.3
ANOMALY_ABOVE = 500
AMOUNT_LIMITS = {"Small": 50, "Medium": 150, "Large": 300}
AMOUNT_REST = "Premium"
SEGMENT_FLOORS = {"VIP": 10, "Regular": 5, "Occasional": 2}
SEGMENT_REST = "New"
SATISFACTION_FLOORS = {
    "Very Satisfied": 4.5,
    "Satisfied": 4.0,
    "Neutral": 3.0,
    "Dissatisfied": 2.0,
}
SATISFACTION_REST = "Very Dissatisfied"
FREQUENCY_LABELS = {
    "Weekly": "High Frequency",
    "Monthly": "Medium Frequency",
    "Annually": "Low Frequency",
}
FREQUENCY_REST = "Unknown"
HIGH_SEASONS = ("Spring", "Summer")
SEASON_LABEL, SEASON_REST = "High Season", "Low Season"
LOYAL_HIGH_FROM = 5
LOYAL_MEDIUM_FROM = 3
LOYAL_HIGH, LOYAL_MEDIUM, LOYAL_REST = "High", "Medium", "Low"
AGE_LIMITS = {"18-24": 25, "25-34": 35, "35-44": 45, "45-54": 55, "55-64": 65}
AGE_REST = "65+"
CLV_LIMITS = {"0-50": 50, "50-200": 200, "200-500": 500}
CLV_UPPER_BAND = "500-1000"
CLV_TOP_ABOVE, CLV_TOP_BAND = 1000, ">1000"
TIER_FLOORS = {"premium offer": 500, "benefits": 200}
TIER_REST = "standard"
EXTENDED_WEEKLY, EXTENDED_FREQUENCY_SHARE = 1.5, 0.2
EXTENDED_SUBSCRIBED, EXTENDED_SUBSCRIPTION_SHARE = 2.0, 0.1
YES, WEEKLY = "Yes", "Weekly"


def final_amount_usd() -> Column:
    """Amount paid, after the discount where one applied."""
    price = F.col("purchase_amount_usd")
    return F.when(F.col("discount_applied") == YES, price * DISCOUNTED_SHARE).otherwise(price)


def amount_category() -> Column:
    return below(F.col("final_amount_usd"), AMOUNT_LIMITS, AMOUNT_REST)


def customer_segment() -> Column:
    return at_least(F.col("previous_purchases"), SEGMENT_FLOORS, SEGMENT_REST)


def satisfaction_level() -> Column:
    return at_least(F.col("review_rating"), SATISFACTION_FLOORS, SATISFACTION_REST)


def is_anomaly() -> Column:
    """True for an unusually high amount; false, not null, when it is unknown."""
    return F.coalesce(F.col("final_amount_usd") > ANOMALY_ABOVE, F.lit(False))


def estimated_clv() -> Column:
    return F.col("previous_purchases") * F.col("final_amount_usd") * CLV_FACTOR


def frequency_category() -> Column:
    return matching(F.col("frequency_of_purchases"), FREQUENCY_LABELS, FREQUENCY_REST)


def estimated_profit_usd() -> Column:
    return F.col("final_amount_usd") * PROFIT_SHARE


def season_type() -> Column:
    return F.when(F.col("season").isin(*HIGH_SEASONS), SEASON_LABEL).otherwise(SEASON_REST)


def loyalty_score() -> Column:
    """Three-valued: an unknown side counts as "no" unless the other side decides."""
    subscribed = F.col("subscription_status") == YES
    purchases = F.col("previous_purchases")
    high = subscribed & (purchases >= LOYAL_HIGH_FROM)
    medium = subscribed | (purchases >= LOYAL_MEDIUM_FROM)
    return F.when(high, LOYAL_HIGH).when(medium, LOYAL_MEDIUM).otherwise(LOYAL_REST)


def extended_clv() -> Column:
    """Customer value that also weighs weekly buyers and subscribers."""
    amount = F.col("final_amount_usd")
    weekly = F.col("frequency_of_purchases") == WEEKLY
    subscribed = F.col("subscription_status") == YES
    history = F.col("previous_purchases") * amount * CLV_FACTOR
    frequency = F.when(weekly, EXTENDED_WEEKLY).otherwise(1.0)
    subscription = F.when(subscribed, EXTENDED_SUBSCRIBED).otherwise(1.0)
    return (
        history
        + frequency * amount * EXTENDED_FREQUENCY_SHARE
        + subscription * amount * EXTENDED_SUBSCRIPTION_SHARE
    )


def clv_band(clv: str = "estimated_clv") -> Column:
    """Interpretation band; lower bounds belong to the band, unknown stays null."""
    value = F.col(clv)
    known = below(value, CLV_LIMITS, CLV_UPPER_BAND)
    return F.when(value > CLV_TOP_ABOVE, CLV_TOP_BAND).when(value.isNotNull(), known)


def clv_marketing_tier(clv: str = "estimated_clv") -> Column:
    return above(F.col(clv), TIER_FLOORS, TIER_REST)


def age_bucket(age: str = "age") -> Column:
    """Age class; anyone under 25 is in the first, an unknown age in the last."""
    return below(F.col(age), AGE_LIMITS, AGE_REST)


def row_hash() -> Column:
    """Content hash of an order over its business columns, in table order.

    Nulls are skipped, as the stored hashes expect; the ingest time is left out, so a
    row keeps its hash when it is delivered again.
    """
    return F.md5(F.concat_ws("|", *(F.col(name).cast("string") for name in BUSINESS_COLUMNS)))
