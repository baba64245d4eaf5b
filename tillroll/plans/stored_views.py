"""The preference views as SQL text in the catalog, over a stored orders table.

Unlike a temporary view of a frame, these stay in the catalog as text: any session with that
catalog can query them, and they show what the table holds at the time of the query.
"""

from pyspark.sql import SparkSession

from tillroll.functions.orders import AGE_LIMITS, AGE_REST
from tillroll.plans.views import TOP_CATEGORIES
from tillroll.sources.orders_table import PARTITIONS, OrdersTable
from tillroll.sources.paths import ensure_folder

#: Where Spark keeps the partitions of a new table: off, it lists the folders when it reads.
_PARTITIONS_IN_CATALOG = "spark.sql.hive.manageFilesourcePartitions"


def _age_bucket() -> str:
    limits = " ".join(f"WHEN age < {limit} THEN '{label}'" for label, limit in AGE_LIMITS.items())
    return f"CASE {limits} ELSE '{AGE_REST}' END"


def _counts(source: str, key: str) -> str:
    return f"""SELECT {key}, category, count(*) AS n,
    sum(purchase_amount_usd) AS spend, count(purchase_amount_usd) AS spend_n,
    sum(review_rating) AS rating, count(review_rating) AS rating_n
  FROM {source} GROUP BY ALL"""


def _preferences(source: str, key: str, name: str) -> str:
    return f"""WITH counts AS (
  {_counts(source, f"{key} AS {name}" if key != name else name)}
)
SELECT {name}, sum(n) AS orders, try_divide(sum(spend), sum(spend_n)) AS avg_spend,
  try_divide(sum(rating), sum(rating_n)) AS avg_rating,
  CASE WHEN {name} IS NOT NULL THEN min_by(category, struct(-n, category)) END AS top_category
FROM counts GROUP BY {name}"""


def _locations(source: str) -> str:
    return f"""WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY location ORDER BY n DESC, category) AS place
  FROM (
  {_counts(source, "location")}
  )
), listed AS (
  SELECT location, sum(n) AS orders, try_divide(sum(spend), sum(spend_n)) AS avg_spend,
    array_sort(collect_list(CASE WHEN place <= {TOP_CATEGORIES} AND category IS NOT NULL
      THEN struct(place, category) END)) AS top
  FROM ranked GROUP BY location
)
SELECT location, orders, avg_spend,
  CASE WHEN location IS NULL THEN CAST(array() AS ARRAY<STRING>)
    ELSE transform(top, item -> item.category) END AS top_categories
FROM listed"""


def view_texts(source: str) -> dict[str, str]:
    """The SQL of each view over a table name."""
    bucket = _age_bucket()
    return {
        "v_age_preferences": _preferences(source, bucket, "age_bucket"),
        "v_gender_preferences": _preferences(source, "gender", "gender"),
        "v_location_preferences": _locations(source),
        "v_age_gender_category": f"""SELECT {bucket} AS age_bucket, gender, category,
  count(*) AS orders, avg(purchase_amount_usd) AS avg_spend
FROM {source} GROUP BY ALL""",
    }


def register_table(spark: SparkSession, table: OrdersTable, name: str) -> None:
    """Make a file table known to the catalog, under its declared columns."""
    if not table.is_files:
        raise ValueError("a connector registers its own tables")
    ensure_folder(spark, table.location)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.file_schema())
    before = spark.conf.get(_PARTITIONS_IN_CATALOG)
    spark.conf.set(_PARTITIONS_IN_CATALOG, "false")
    try:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {table.format} "
            f"PARTITIONED BY ({', '.join(PARTITIONS)}) LOCATION '{table.location}'"
        )
    finally:
        spark.conf.set(_PARTITIONS_IN_CATALOG, before)


def create_views(spark: SparkSession, name: str, prefix: str = "") -> list[str]:
    """Create or replace the four views over a catalog table; their names."""
    texts = {f"{prefix}{view}": text for view, text in view_texts(name).items()}
    for view, text in texts.items():
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS\n{text}")
    return list(texts)


def refresh(spark: SparkSession, name: str) -> None:
    """Let this session see files that others added since it last read the table."""
    spark.sql(f"REFRESH TABLE {name}")
