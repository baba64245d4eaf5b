"""Orders in the aligned schema, derived from the driver tables.

Each expression is valid in Spark and in the oracle's dialect, so both engines start
from the same rows. Amounts are multiples of 1/4 and ratings of 1/2: their sums are
exact in any order.
"""

from math import ceil

from pyspark.sql import DataFrame, SparkSession

from tillroll.schema import ALIGNED_SCHEMA
from tillroll.sources.paths import DROP_SHUFFLES, new_shared_folder, set_for_now

#: Line items for each part in which the orders are worked off, and the most parts: each has its
#: share of the shuffled rows on disk, and each reads the tables joined to them anew.
ROWS_PER_PART = 1_000_000
MOST_PARTS = 8

# The derivation of every aligned column.
EXPRESSIONS = {
    "customer_id": "CAST(o_custkey AS INT)",
    "age": "CAST(CASE WHEN o_custkey % 61 = 0 THEN NULL ELSE 18 + o_custkey % 53 END AS INT)",
    "gender": "CASE WHEN o_custkey % 7 = 0 THEN NULL WHEN o_custkey % 2 = 0 THEN 'Male' "
    "ELSE 'Female' END",
    "item_purchased": "p_name",
    "category": "p_type",
    "purchase_amount_usd": "CASE WHEN l_suppkey % 37 = 0 THEN NULL "
    "ELSE l_quantity * 11 + CAST(l_linenumber AS DOUBLE) / 4 END",
    "location": "n_name",
    "size": "CASE WHEN p_size <= 12 THEN 'S' WHEN p_size <= 25 THEN 'M' "
    "WHEN p_size <= 38 THEN 'L' ELSE 'XL' END",
    "color": "p_brand",
    "season": "CASE WHEN EXTRACT(MONTH FROM o_orderdate) IN (3, 4, 5) THEN 'Spring' "
    "WHEN EXTRACT(MONTH FROM o_orderdate) IN (6, 7, 8) THEN 'Summer' "
    "WHEN EXTRACT(MONTH FROM o_orderdate) IN (9, 10, 11) THEN 'Fall' ELSE 'Winter' END",
    "review_rating": "CASE WHEN l_partkey % 41 = 0 THEN NULL "
    "ELSE CAST(l_partkey % 9 AS DOUBLE) / 2 + 1 END",
    "subscription_status": "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') "
    "THEN 'Yes' ELSE 'No' END",
    "shipping_type": "o_orderpriority",
    "discount_applied": "CASE WHEN l_discount > CAST(0.05 AS DOUBLE) THEN 'Yes' ELSE 'No' END",
    "promo_code_used": "CASE WHEN l_tax > CAST(0.04 AS DOUBLE) THEN 'Yes' ELSE 'No' END",
    "previous_purchases": "CAST(CASE WHEN o_orderkey % 29 = 0 THEN NULL "
    "ELSE o_orderkey % 16 END AS INT)",
    "payment_method": "l_returnflag",
    "frequency_of_purchases": "CASE o_custkey % 5 WHEN 0 THEN 'Weekly' WHEN 1 THEN 'Monthly' "
    "WHEN 2 THEN 'Annually' WHEN 3 THEN 'Quarterly' ELSE NULL END",
    "processed_time": "CAST(o_orderdate AS TIMESTAMP)",
}


def shop_orders(spark: SparkSession, sf_dir: str, part: int = 0, parts: int = 1) -> DataFrame:
    """One order row per line item. No join is hinted: Spark sizes the sides itself.

    With ``parts`` the rows of one of so many parts, dealt by a hash of the order's key.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def dealt(rows: DataFrame, key: str) -> DataFrame:
        return rows.where(f"pmod(xxhash64(CAST({key} AS BIGINT)), {parts}) = {part}") if parts > 1 else rows

    lines, orders = dealt(table("lineitem"), "l_orderkey"), dealt(table("orders"), "o_orderkey")
    customers, items, nations = table("customer"), table("part"), table("nation")
    joined = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(items, lines.l_partkey == items.p_partkey)
        .join(customers, orders.o_custkey == customers.c_custkey)
        .join(nations, customers.c_nationkey == nations.n_nationkey)
    )
    return joined.selectExpr(*(f"{sql} AS {name}" for name, sql in EXPRESSIONS.items()))


def number_of_parts(spark: SparkSession, sf_dir: str) -> int:
    """In how many parts to work off the orders."""
    return min(MOST_PARTS, ceil(row_bound(spark, sf_dir) / ROWS_PER_PART)) or 1


def stored_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """All of ``shop_orders``, written once and read back, and the folder they lie in.

    The joins shuffle several times the bytes of the tables. They are worked out in parts, and
    what a part shuffled is dropped when it is written.
    """
    folder, parts = f"{new_shared_folder(spark, 'orders')}/orders", number_of_parts(spark, sf_dir)
    with set_for_now(spark, DROP_SHUFFLES):
        for part in range(parts):
            rows = shop_orders(spark, sf_dir, part, parts)
            rows.write.mode("append").option("compression", "zstd").parquet(folder)
    return spark.read.schema(ALIGNED_SCHEMA).parquet(folder), folder


def row_bound(spark: SparkSession, sf_dir: str) -> int:
    """No fewer rows than ``shop_orders`` has; read from the file footers alone."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()


def _oracle_sql() -> str:
    columns = ",\n    ".join(f"{sql} AS {name}" for name, sql in EXPRESSIONS.items())
    return (
        f"SELECT\n    {columns}\n  FROM lineitem\n"
        "  JOIN orders ON l_orderkey = o_orderkey\n"
        "  JOIN customer ON o_custkey = c_custkey\n"
        "  JOIN part ON l_partkey = p_partkey\n"
        "  JOIN nation ON c_nationkey = n_nationkey"
    )


SHOP_ORDERS_SQL = _oracle_sql()
