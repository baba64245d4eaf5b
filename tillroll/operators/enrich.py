"""Adding the business columns to aligned orders."""

from pyspark.sql import DataFrame

from tillroll.functions import orders
from tillroll.schema import COMPUTED_COLUMNS


def enrich_orders(df: DataFrame) -> DataFrame:
    """Append the ten computed columns. Narrow: no shuffle, batch or stream.

    The amount comes first since others build on it; the rest is one projection.
    """
    paid = df.withColumn("final_amount_usd", orders.final_amount_usd())
    rest = [name for name in COMPUTED_COLUMNS if name != "final_amount_usd"]
    return paid.withColumns({name: getattr(orders, name)() for name in rest})
