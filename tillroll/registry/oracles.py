"""The same queries as SQL over the driver tables, written apart from the Spark code."""

from tillroll.registry.adapter import SHOP_ORDERS_SQL

_BUSINESS = """customer_id, age, gender, item_purchased, category, purchase_amount_usd,
    location, size, color, season, review_rating, subscription_status, shipping_type,
    discount_applied, promo_code_used, previous_purchases, payment_method,
    frequency_of_purchases"""

_COMPUTED = """final_amount_usd, amount_category, customer_segment, satisfaction_level,
    is_anomaly, estimated_clv, frequency_category, estimated_profit_usd, season_type,
    loyalty_score"""

_HASH = (
    "md5(concat_ws('|', "
    + ", ".join(f"CAST({c.strip()} AS VARCHAR)" for c in _BUSINESS.split(","))
    + "))"
)

_WITH_ORDERS = f"WITH shop_orders AS (\n  {SHOP_ORDERS_SQL}\n)"

_WITH_ENRICHED = f"""{_WITH_ORDERS},
paid AS (
  SELECT *,
    CASE WHEN discount_applied = 'Yes' THEN purchase_amount_usd * CAST(0.9 AS DOUBLE)
      ELSE purchase_amount_usd END AS final_amount_usd
  FROM shop_orders
),
enriched AS (
  SELECT *,
    CASE WHEN final_amount_usd < 50 THEN 'Small' WHEN final_amount_usd < 150 THEN 'Medium'
      WHEN final_amount_usd < 300 THEN 'Large' ELSE 'Premium' END AS amount_category,
    CASE WHEN previous_purchases >= 10 THEN 'VIP' WHEN previous_purchases >= 5 THEN 'Regular'
      WHEN previous_purchases >= 2 THEN 'Occasional' ELSE 'New' END AS customer_segment,
    CASE WHEN review_rating >= 4.5 THEN 'Very Satisfied'
      WHEN review_rating >= 4.0 THEN 'Satisfied' WHEN review_rating >= 3.0 THEN 'Neutral'
      WHEN review_rating >= 2.0 THEN 'Dissatisfied'
      ELSE 'Very Dissatisfied' END AS satisfaction_level,
    CASE WHEN final_amount_usd > 500 THEN TRUE ELSE FALSE END AS is_anomaly,
    CAST(previous_purchases AS DOUBLE) * final_amount_usd * CAST(0.3 AS DOUBLE)
      AS estimated_clv,
    CASE frequency_of_purchases WHEN 'Weekly' THEN 'High Frequency'
      WHEN 'Monthly' THEN 'Medium Frequency' WHEN 'Annually' THEN 'Low Frequency'
      ELSE 'Unknown' END AS frequency_category,
    final_amount_usd * CAST(0.4 AS DOUBLE) AS estimated_profit_usd,
    CASE WHEN season IN ('Spring', 'Summer') THEN 'High Season' ELSE 'Low Season' END
      AS season_type,
    CASE WHEN subscription_status = 'Yes' AND previous_purchases >= 5 THEN 'High'
      WHEN subscription_status = 'Yes' OR previous_purchases >= 3 THEN 'Medium'
      ELSE 'Low' END AS loyalty_score
  FROM paid
)"""

_AGE_BUCKET = """CASE WHEN age < 25 THEN '18-24' WHEN age BETWEEN 25 AND 34 THEN '25-34'
      WHEN age BETWEEN 35 AND 44 THEN '35-44' WHEN age BETWEEN 45 AND 54 THEN '45-54'
      WHEN age BETWEEN 55 AND 64 THEN '55-64' ELSE '65+' END"""


def _orders(select: str) -> str:
    return f"{_WITH_ORDERS}\n{select}"


def _enriched(select: str) -> str:
    return f"{_WITH_ENRICHED}\n{select}"


def _preferences(key: str, expression: str) -> str:
    return _orders(f"""SELECT s.{key}, s.orders, s.avg_spend, s.avg_rating,
  t.category AS top_category
FROM (
  SELECT {expression} AS {key}, count(*) AS orders, avg(purchase_amount_usd) AS avg_spend,
    avg(review_rating) AS avg_rating
  FROM shop_orders GROUP BY 1
) s LEFT JOIN (
  SELECT {key}, category FROM (
    SELECT {key}, category,
      row_number() OVER (PARTITION BY {key} ORDER BY n DESC, category) AS r
    FROM (SELECT {expression} AS {key}, category, count(*) AS n FROM shop_orders GROUP BY 1, 2)
  ) WHERE r = 1
) t ON s.{key} = t.{key}""")


def _top(key: str, k: int) -> str:
    return _orders(f"""SELECT * FROM (
  SELECT {key}, category, item_count,
    CAST(row_number() OVER (PARTITION BY {key} ORDER BY item_count DESC, category) AS INT) AS rank
  FROM (SELECT {key}, category, count(*) AS item_count FROM shop_orders GROUP BY 1, 2)
) WHERE rank <= {k}""")


_NEW_ROWS = _orders(f"""SELECT o.{_BUSINESS.replace(", ", ", o.").replace("    ", "    o.")},
  o.processed_time
FROM (
  SELECT *, {_HASH} AS h, unnest(range(CASE WHEN age < 30 THEN 2 ELSE 1 END)) AS copy
  FROM shop_orders
) o
WHERE NOT EXISTS (
  SELECT 1 FROM (
    SELECT {_HASH} AS h FROM shop_orders WHERE previous_purchases < 8
  ) k WHERE k.h = o.h
)""")

_COLUMN_SQL = {
    "final_amount_usd": "purchase_amount_usd, discount_applied, final_amount_usd",
    "amount_category": "final_amount_usd, amount_category",
    "customer_segment": "previous_purchases, customer_segment",
    "satisfaction_level": "review_rating, satisfaction_level",
    "is_anomaly": "final_amount_usd, is_anomaly",
    "estimated_clv": "previous_purchases, final_amount_usd, estimated_clv",
    "frequency_category": "frequency_of_purchases, frequency_category",
    "estimated_profit_usd": "final_amount_usd, estimated_profit_usd",
    "season_type": "season, season_type",
    "loyalty_score": "subscription_status, previous_purchases, loyalty_score",
}



def _clv_averages(keys: str, names: str, others: str) -> str:
    """Averages by exact sums: whole mantissas of each power of two, added from the least up."""
    return f"""{_WITH_ENRICHED},
guessed AS (
  SELECT *, floor(log2(nullif(abs(estimated_clv), 0))) - 52 AS guess FROM enriched
),
scaled AS (SELECT *, estimated_clv * pow(CAST(2 AS DOUBLE), -guess) AS m FROM guessed),
units AS (
  SELECT *,
    CASE WHEN abs(m) >= 9007199254740992 THEN guess + 1
      WHEN abs(m) < 4503599627370496 THEN guess - 1 ELSE coalesce(guess, 0) END AS power,
    CAST(CASE WHEN abs(m) >= 9007199254740992 THEN m / 2 WHEN abs(m) < 4503599627370496 THEN m * 2
      WHEN estimated_clv = 0 THEN 0 ELSE m END AS HUGEINT) AS mantissa
  FROM scaled
),
parts AS (
  SELECT {keys}, power, sum(mantissa) AS s, count(estimated_clv) AS n, count(*) AS orders,
    max(estimated_clv) AS high, min(estimated_clv) AS low
  FROM units GROUP BY ALL
)
SELECT {names}, {others}, list_reduce(
    list(CAST(s AS DOUBLE) * pow(CAST(2 AS DOUBLE), power) ORDER BY power) FILTER (s IS NOT NULL),
    lambda a, b: a + b) / nullif(sum(n), 0) AS avg_clv
FROM parts GROUP BY {names}"""


_EVOLUTION_GROUP = """location, category, amount_category, customer_segment,
  count(*) AS orders, sum(purchase_amount_usd) AS spend, count(estimated_clv) AS known_clv"""

#: Columns whose texts the query of odd texts changes, with their numbers.
_ODD = {"item_purchased": 0, "category": 1, "color": 2}

ORACLES: dict[str, str] = {
    "v_age_preferences": _preferences("age_bucket", _AGE_BUCKET),
    "v_gender_preferences": _preferences("gender", "gender"),
    "v_location_preferences": _orders("""SELECT s.location, s.orders, s.avg_spend,
  array_to_string(array_agg(t.category ORDER BY t.n DESC, t.category), ',') AS top_categories
FROM (
  SELECT location, count(*) AS orders, avg(purchase_amount_usd) AS avg_spend
  FROM shop_orders GROUP BY location
) s LEFT JOIN (
  SELECT location, category, count(*) AS n FROM shop_orders GROUP BY location, category
  QUALIFY row_number() OVER (PARTITION BY location ORDER BY count(*) DESC, category) <= 3
) t ON s.location = t.location
GROUP BY s.location, s.orders, s.avg_spend"""),
    "v_age_gender_category": _orders(f"""SELECT {_AGE_BUCKET} AS age_bucket, gender, category,
  count(*) AS orders, avg(purchase_amount_usd) AS avg_spend
FROM shop_orders GROUP BY 1, 2, 3"""),
    "vip_premium": _enriched("""SELECT customer_id, customer_segment, amount_category,
  final_amount_usd, estimated_clv, loyalty_score
FROM enriched WHERE customer_segment = 'VIP' AND amount_category = 'Premium'
ORDER BY estimated_clv DESC"""),
    "anomalies": _enriched(f"""SELECT {_BUSINESS}, processed_time, {_COMPUTED}
FROM enriched WHERE is_anomaly ORDER BY final_amount_usd DESC"""),
    "satisfaction_by_segment": _enriched("""SELECT customer_segment, satisfaction_level,
  count(*) AS count, avg(review_rating) AS avg_rating
FROM enriched GROUP BY 1, 2 ORDER BY customer_segment, avg_rating DESC"""),
    "high_clv": _enriched("""SELECT customer_id, customer_segment, estimated_clv,
  final_amount_usd
FROM enriched WHERE estimated_clv > 500 ORDER BY estimated_clv DESC"""),
    "clv_by_segment": _clv_averages(
        "customer_segment",
        "customer_segment",
        "max(high) AS max_clv, min(low) AS min_clv, CAST(sum(orders) AS BIGINT) AS count",
    ),
    "high_potential": _enriched("""SELECT customer_id, previous_purchases, final_amount_usd,
  estimated_clv
FROM enriched WHERE previous_purchases < 3 AND final_amount_usd > 200
ORDER BY estimated_clv DESC"""),
    "clv_trend": _clv_averages(
        "CAST(processed_time AS DATE) AS day, customer_segment",
        "day, customer_segment",
        "CAST(sum(orders) AS BIGINT) AS orders",
    ),
    "enrich_orders": _enriched(
        f"SELECT {_BUSINESS}, processed_time, {_COMPUTED} FROM enriched"
    ),
    **{
        f"enrich_{name}": _enriched(f"SELECT {columns} FROM enriched")
        for name, columns in _COLUMN_SQL.items()
    },
    "clv_extended": _enriched("""SELECT previous_purchases, final_amount_usd,
  frequency_of_purchases, subscription_status,
  CAST(previous_purchases AS DOUBLE) * final_amount_usd * CAST(0.3 AS DOUBLE)
  + CASE WHEN frequency_of_purchases = 'Weekly' THEN CAST(1.5 AS DOUBLE)
      ELSE CAST(1 AS DOUBLE) END * final_amount_usd * CAST(0.2 AS DOUBLE)
  + CASE WHEN subscription_status = 'Yes' THEN CAST(2 AS DOUBLE)
      ELSE CAST(1 AS DOUBLE) END * final_amount_usd * CAST(0.1 AS DOUBLE) AS extended_clv
FROM enriched"""),
    "clv_band": _enriched("""SELECT estimated_clv,
  CASE WHEN estimated_clv < 50 THEN '0-50' WHEN estimated_clv < 200 THEN '50-200'
    WHEN estimated_clv < 500 THEN '200-500' WHEN estimated_clv <= 1000 THEN '500-1000'
    WHEN estimated_clv > 1000 THEN '>1000' END AS clv_band
FROM enriched"""),
    "clv_marketing_tier": _enriched("""SELECT estimated_clv,
  CASE WHEN estimated_clv > 500 THEN 'premium offer' WHEN estimated_clv > 200 THEN 'benefits'
    ELSE 'standard' END AS tier
FROM enriched"""),
    "age_bucket": _orders(f"SELECT age, {_AGE_BUCKET} AS age_bucket FROM shop_orders"),
    "top1_category_per_key": _top("gender", 1),
    "top3_category_per_location": _top("location", 3),
    "gender_top_join": _orders("""SELECT s.gender, s.orders, t.category AS top_category
FROM (SELECT gender, count(*) AS orders FROM shop_orders GROUP BY gender) s
LEFT JOIN (
  SELECT gender, category FROM shop_orders GROUP BY gender, category
  QUALIFY row_number() OVER (PARTITION BY gender ORDER BY count(*) DESC, category) = 1
) t ON s.gender = t.gender"""),
    "csv_read": _orders(f"SELECT {_BUSINESS} FROM shop_orders"),
    "align_schema": _orders(
        f"SELECT {_BUSINESS.replace('size', 'CAST(NULL AS VARCHAR) AS size')},\n"
        "  CAST(NULL AS TIMESTAMP) AS processed_time FROM shop_orders"
    ),
    "split_files": _orders(
        "SELECT count(*) AS total_rows, TRUE AS within_limit, TRUE AS enough_files\n"
        "FROM shop_orders"
    ),
    "schema_evolution_append": _enriched(f"""SELECT {_EVOLUTION_GROUP}
FROM (
  SELECT location, category, NULL AS amount_category, NULL AS customer_segment,
    purchase_amount_usd, CAST(NULL AS DOUBLE) AS estimated_clv
  FROM shop_orders
  UNION ALL
  SELECT location, category, amount_category, customer_segment, purchase_amount_usd,
    estimated_clv
  FROM enriched
) GROUP BY location, category, amount_category, customer_segment"""),
    "row_hash": _orders(f"SELECT {_HASH} AS row_hash, {_BUSINESS} FROM shop_orders"),
    "dedup_against_table": _NEW_ROWS,
    "dedup_by_shuffle": _NEW_ROWS,
    "dedup_against_index": _NEW_ROWS,
    "dedup_within_batch": _orders(f"""SELECT {_BUSINESS}, processed_time
FROM (
  SELECT *, unnest(range(CASE WHEN customer_id % 3 = 0 THEN 2 ELSE 1 END)) AS copy
  FROM shop_orders
  UNION ALL
  SELECT * REPLACE (processed_time + INTERVAL 1 HOUR AS processed_time), 2 FROM shop_orders
  WHERE age < 30
)
QUALIFY row_number() OVER (PARTITION BY {_HASH} ORDER BY processed_time, copy) = 1"""),
    "stream_ingest": _enriched(f"SELECT DISTINCT {_BUSINESS}, {_COMPUTED} FROM enriched"),
    "ingest_metrics": _orders(f"""SELECT CAST(sum(n) AS BIGINT) AS received, count(*) AS new_rows,
  CAST(sum(n) - count(*) AS BIGINT) AS duplicates
FROM (SELECT {_HASH} AS h, count(*) AS n FROM shop_orders GROUP BY 1)"""),
    "redelivery_metrics": _orders(
        "SELECT count(*) AS received, CAST(0 AS BIGINT) AS new_rows, count(*) AS duplicates\n"
        "FROM shop_orders"
    ),
    "replayed_batch": _orders(
        f"SELECT {_BUSINESS} FROM shop_orders\nUNION ALL SELECT {_BUSINESS} FROM shop_orders"
    ),
    "replay_metrics": _orders(
        "SELECT 2 * count(*) AS received, 2 * count(*) AS new_rows, CAST(0 AS BIGINT) AS duplicates\n"
        "FROM shop_orders"
    ),
    "any_text": _orders(f"""SELECT {", ".join(
        f"""'  "{_ODD[c]}" \\, \\"' || chr(10) || {c} || '\\ ' AS {c}""" if c in _ODD else c
        for c in (x.strip() for x in _BUSINESS.split(",")))}
FROM shop_orders"""),
    "rejected_cells": _orders("""SELECT count(*) AS received, count(*) AS new_rows,
  CAST(0 AS BIGINT) AS duplicates, count(*) FILTER (age IN (20, 21)) AS rejected,
  count(age) - count(*) FILTER (age = 20) AS known_ages
FROM shop_orders"""),
    "layout_pruning": _enriched("""SELECT category, location, count(*) AS orders,
  max(final_amount_usd) AS largest
FROM enriched WHERE category LIKE 'PROMO%'
  AND processed_time >= TIMESTAMP '1995-01-01' AND processed_time < TIMESTAMP '1997-01-01'
GROUP BY 1, 2"""),
}
ORACLES |= {f"stored_{view}": ORACLES[view] for view in (
    "v_age_preferences", "v_gender_preferences", "v_location_preferences", "v_age_gender_category"
)}
