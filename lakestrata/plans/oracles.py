"""The same results as SQL for DuckDB, over the same input tables.

Money is added as decimals here, so that the totals are exact on both sides.
"""

from __future__ import annotations

from .queries import (
    FILTER_REGION,
    FORMATS,
    LATE_DISCOUNT,
    LATE_PRICE_FACTOR,
    LATE_ROWS,
    NEW_ID_OFFSET,
    REGION_WEIGHTS,
    SAMPLE_ROWS,
)

_SALES = """
sales AS (
  SELECT l_orderkey AS order_id, o_custkey AS user_id, l_shipdate AS event_timestamp,
         l_returnflag AS event_type, l_partkey AS product_id,
         l_extendedprice AS price, l_quantity AS quantity, r_name AS region
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

_DIRTY = f"""{_SALES},
dirty AS (
  SELECT order_id,
         CASE WHEN order_id % 79 = 0 THEN NULL ELSE user_id END AS user_id,
         event_timestamp,
         CASE WHEN order_id % 97 = 0 THEN NULL ELSE event_type END AS event_type,
         product_id,
         CASE WHEN order_id % 89 = 0 THEN 0.0 ELSE price END AS price,
         CASE WHEN order_id % 83 = 0 THEN -1.0 ELSE quantity END AS quantity,
         region
  FROM sales
)"""

_EVT = """
evt AS (
  SELECT event_id, user_id, ts AS event_timestamp, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
         value AS price, CAST(1 + event_id % 9 AS INTEGER) AS quantity, r_name AS region
  FROM events
  JOIN customer ON user_id = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

_PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id, p_type AS category, p_retailprice AS base_price
  FROM part
)"""

_PRICE = "CAST(price AS DECIMAL(18,2))"
_AMOUNT = f"{_PRICE} * CAST(quantity AS DECIMAL(9,0))"
_REVENUE = f"CAST(SUM({_AMOUNT}) AS DOUBLE)"

_DAILY = f"""{_SALES},
daily AS (
  SELECT region, CAST(event_timestamp AS DATE) AS date, SUM({_AMOUNT}) AS amount
  FROM sales GROUP BY 1, 2
)"""

_WEIGHTS = "weights(region, w_price, w_quantity, bias) AS (VALUES " + ", ".join(
    f"('{region}', CAST({p} AS DOUBLE), CAST({q} AS DOUBLE), CAST({b} AS DOUBLE))"
    for region, (p, q, b) in REGION_WEIGHTS.items()
) + ")"

_SCORED = f"""{_EVT}, {_WEIGHTS},
scored AS (
  SELECT event_id, region, w_price * price + w_quantity * quantity + bias AS score
  FROM evt JOIN weights USING (region)
)"""

_PATHS = f"""{_EVT},
moves AS (
  SELECT product_id, event_id,
         SUM(CAST(price AS DECIMAL(18,2)) - 50) OVER (
           PARTITION BY product_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS moved
  FROM evt
),
prices AS (
  SELECT product_id, event_id, p_retailprice AS base_price,
         p_retailprice * EXP(CAST(moved AS DOUBLE) / 10000) AS price
  FROM moves JOIN part ON product_id = p_partkey
),
paths AS (
  SELECT product_id, base_price,
         ARG_MAX(price, event_id) AS final_price, MAX(price) AS max_price,
         MIN(price) AS min_price, STDDEV_POP(price) AS volatility
  FROM prices GROUP BY product_id, base_price
)"""

_CATEGORY = f"""WITH {_SALES}, {_PRODUCTS}
SELECT category, {_REVENUE} AS revenue
FROM sales LEFT JOIN products USING (product_id) GROUP BY category"""

_EVT_COLUMNS = (
    "event_id, user_id, event_timestamp, event_type, product_id, price, quantity, region"
)
_COLUMN_LIST = _EVT_COLUMNS.replace(" ", "")
_FACTOR = f"CAST({LATE_PRICE_FACTOR} AS DOUBLE)"
_DISCOUNT = f"CAST({LATE_DISCOUNT} AS DOUBLE)"
_N_MERGED = "(SELECT COUNT(*) + COUNT(*) FILTER (WHERE event_type = 'signup') FROM evt)"


def _stored_values(names: tuple[str, ...], condition: str = "") -> str:
    return f"WITH {_SALES}\n" + "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS format, COUNT(*) AS n_rows, {_REVENUE} AS total_revenue,
  CAST(SUM({_PRICE}) AS DOUBLE) AS total_price, MIN(event_timestamp) AS first_time,
  MAX(event_timestamp) AS last_time,
  COUNT(DISTINCT (order_id, product_id, user_id)) AS n_keys,
  COUNT(DISTINCT (region, event_type)) AS n_groups
FROM sales {condition}"""
        for name in names
    )


# The pipeline: sound events, of which late rows correct every sign-up.
_SILVER = f"""{_EVT},
silver AS (
  SELECT event_id, event_timestamp, region, event_type, product_id, quantity,
         {_PRICE} * CASE WHEN event_type = 'signup'
                         THEN CAST({LATE_PRICE_FACTOR} AS DECIMAL(3,2))
                         ELSE CAST(1 AS DECIMAL(3,2)) END AS price
  FROM evt WHERE price > 0 AND quantity > 0
)"""
_SILVER_AMOUNT = "price * CAST(quantity AS DECIMAL(9,0))"

# The same, after all purchases came once more under new keys, corrected.
_REFRESHED = f"""{_SILVER},
refreshed AS (
  SELECT region, event_type, product_id, {_SILVER_AMOUNT} AS amount FROM silver
  UNION ALL
  SELECT region, event_type, product_id,
         {_PRICE} * CAST({LATE_PRICE_FACTOR} AS DECIMAL(3,2)) * CAST(quantity AS DECIMAL(9,0))
  FROM evt WHERE price > 0 AND quantity > 0 AND event_type = 'purchase'
)"""


ORACLES: dict[str, str] = {
    "bronze_ingest": f"""WITH {_SALES}
SELECT region, COUNT(*) AS n_rows, {_REVENUE} AS total_revenue FROM sales GROUP BY region""",
    "raw_glob_ingest": f"""WITH {_SALES}
SELECT region, COUNT(*) AS n_rows, {_REVENUE} AS total_revenue FROM sales GROUP BY region""",
    "bronze_dims": """SELECT 'users' AS table_name, COUNT(*) AS n_rows,
  COUNT(DISTINCT c_custkey) AS n_keys, CAST(SUM(c_custkey) AS BIGINT) AS key_sum,
  MIN(r_name) AS first_text, MAX(r_name) AS last_text
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT 'products', COUNT(*), COUNT(DISTINCT p_partkey), CAST(SUM(p_partkey) AS BIGINT),
  MIN(p_type), MAX(p_type)
FROM part""",
    "format_roundtrip": _stored_values(FORMATS),
    "filtered_scan": _stored_values(
        (*FORMATS, "parquet by region"), f"WHERE region = '{FILTER_REGION}'"
    ),
    "versioned_scan": f"""WITH {_SALES}
SELECT 'all' AS region, COUNT(*) AS n_rows FROM sales
UNION ALL
SELECT '{FILTER_REGION}', COUNT(*) FROM sales WHERE region = '{FILTER_REGION}'""",
    "clean_sales": f"""WITH {_DIRTY}
SELECT order_id, user_id, event_timestamp, event_type, product_id, price,
       CAST(quantity AS INTEGER) AS quantity, region
FROM dirty
WHERE order_id IS NOT NULL AND user_id IS NOT NULL AND event_timestamp IS NOT NULL
  AND event_type IS NOT NULL AND price > 0 AND quantity > 0""",
    "revenue_by_region_type": f"""WITH {_SALES}
SELECT region, event_type, {_REVENUE} AS total_revenue, COUNT(order_id) AS event_count
FROM sales GROUP BY region, event_type""",
    "agg_region_type_stats": f"""WITH {_SALES}
SELECT region, event_type, COUNT(*) AS n, {_REVENUE} AS total_revenue,
       CAST(SUM({_PRICE}) AS DOUBLE) / COUNT(price) AS avg_price, MAX(price) AS max_price
FROM sales GROUP BY region, event_type""",
    "daily_event_counts": f"""WITH {_SALES}
SELECT CAST(event_timestamp AS DATE) AS date, region, COUNT(order_id) AS event_count
FROM sales GROUP BY 1, 2""",
    "top_products": f"""WITH {_SALES}, {_PRODUCTS},
best AS (
  SELECT product_id, SUM({_AMOUNT}) AS amount
  FROM sales WHERE event_type = 'R' GROUP BY product_id
)
SELECT product_id, CAST(amount AS DOUBLE) AS total_revenue, category, base_price
FROM best LEFT JOIN products USING (product_id)
ORDER BY amount DESC, product_id LIMIT 10""",
    "user_region_revenue": f"""WITH {_SALES}
SELECT user_id, region, {_REVENUE} AS user_revenue FROM sales GROUP BY user_id, region""",
    "grand_totals": f"""WITH {_DIRTY}
SELECT {_REVENUE} AS total_revenue, COUNT(price * quantity) AS n
FROM dirty WHERE region IS NOT NULL AND event_type IS NOT NULL""",
    "category_revenue_broadcast": _CATEGORY,
    "category_revenue_shuffle": _CATEGORY,
    "rolling_revenue": f"""WITH {_DAILY}
SELECT region, date, CAST(amount AS DOUBLE) AS daily_revenue,
       CAST(SUM(amount) OVER (PARTITION BY region ORDER BY date
            ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) AS rolling_7d_revenue
FROM daily""",
    "rolling_revenue_days": f"""WITH {_DAILY}
SELECT region, date, CAST(amount AS DOUBLE) AS daily_revenue,
       CAST(SUM(amount) OVER (PARTITION BY region ORDER BY date
            RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS DOUBLE)
         AS rolling_7d_revenue
FROM daily""",
    "rank_in_day": f"""WITH {_DAILY}
SELECT region, date, CAST(amount AS DOUBLE) AS daily_revenue,
       CAST(RANK() OVER (PARTITION BY date ORDER BY amount DESC) AS INTEGER) AS rank_in_day
FROM daily""",
    "region_features": f"""WITH {_SALES},
units AS (
  SELECT region, CAST({_PRICE} * 10000 AS HUGEINT) AS u FROM sales WHERE price IS NOT NULL
),
means AS (
  SELECT region, CAST(COUNT(*) AS HUGEINT) AS n, CAST(SUM(u) AS HUGEINT) // COUNT(*) AS mean,
         CAST(SUM(u) AS HUGEINT) % COUNT(*) AS rest
  FROM units GROUP BY region
),
spreads AS (
  SELECT region, n, rest, CAST(SUM((u - mean) * (u - mean)) AS HUGEINT) AS spread
  FROM units JOIN means USING (region) GROUP BY region, n, rest
),
deviations AS (
  SELECT region,
         SQRT((CAST(spread // 4294967296 AS DOUBLE) * 4294967296 + CAST(spread % 4294967296 AS DOUBLE)
               - CAST(rest AS DOUBLE) * CAST(rest AS DOUBLE) / CAST(n AS DOUBLE))
              / CAST(n - 1 AS DOUBLE)) / 10000 AS price_std
  FROM spreads WHERE n > 1
),
stats AS (
  SELECT region, COUNT(*) AS event_count,
         CAST(SUM({_PRICE}) AS DOUBLE) / COUNT(price) AS mean_price,
         {_REVENUE} AS total_revenue,
         CAST(SUM(CAST(quantity AS DECIMAL(9,0))) AS DOUBLE) / COUNT(quantity) AS avg_quantity
  FROM sales GROUP BY region
),
listed AS (SELECT r_name AS region FROM region UNION ALL SELECT 'UNSERVED')
SELECT region, COALESCE(event_count, 0) AS event_count, COALESCE(mean_price, 0.0) AS mean_price,
       price_std, COALESCE(total_revenue, 0.0) AS total_revenue, avg_quantity
FROM listed LEFT JOIN stats USING (region) LEFT JOIN deviations USING (region)""",
    "score_by_region": f"""WITH {_SCORED}
SELECT event_id, region, ROUND(score, 6) AS score FROM scored""",
    "score_sample": f"""WITH {_SCORED}
SELECT event_id, region, ROUND(score, 6) AS score FROM scored
WHERE event_id IN (SELECT event_id FROM evt ORDER BY event_id LIMIT {SAMPLE_ROWS})""",
    "score_summary": f"""WITH {_SCORED}
SELECT region, COUNT(*) AS n,
       CAST(SUM(CAST(ROUND(score, 4) AS DECIMAL(18,4))) AS DOUBLE) / COUNT(score) AS mean_score
FROM scored GROUP BY region""",
    "path_summary": f"""WITH {_PATHS}
SELECT product_id, base_price, ROUND(final_price, 6) AS final_price,
       ROUND(max_price, 6) AS max_price, ROUND(min_price, 6) AS min_price,
       ROUND(volatility, 6) AS volatility
FROM paths""",
    "path_mean_final": f"""WITH {_PATHS}
SELECT ROUND(AVG(final_price), 6) AS avg_final FROM paths""",
    "snapshot_current": f"""WITH {_EVT}
SELECT {_EVT_COLUMNS} FROM evt
WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND event_timestamp IS NOT NULL
  AND event_type IS NOT NULL AND price > 0 AND quantity > 0""",
    "as_of_v0": f"WITH {_EVT} SELECT {_EVT_COLUMNS} FROM evt",
    "append_version": f"""WITH {_EVT},
both_loads AS (
  SELECT event_type, price, CAST(NULL AS DOUBLE) AS discount FROM evt
  UNION ALL
  SELECT event_type, price, CAST(0 AS DOUBLE) FROM evt WHERE event_type = 'purchase'
)
SELECT event_type, COUNT(*) AS n_rows, COUNT(discount) AS n_discounts,
       CAST(SUM({_PRICE}) AS DOUBLE) AS total_price
FROM both_loads GROUP BY event_type""",
    "evolve_schema": f"WITH {_EVT} SELECT event_id, price, CAST(NULL AS DOUBLE) AS discount FROM evt",
    "late_upsert": f"""WITH {_EVT},
late AS (SELECT event_id AS late_id FROM evt ORDER BY event_id LIMIT {LATE_ROWS})
SELECT event_id,
       CASE WHEN late_id IS NULL THEN price ELSE price * {_FACTOR} END AS price,
       CASE WHEN late_id IS NULL THEN NULL ELSE {_DISCOUNT} END AS discount
FROM evt LEFT JOIN late ON event_id = late_id""",
    "late_upsert_insert": f"""WITH {_EVT}
SELECT event_id, event_type,
       CASE WHEN event_type = 'purchase' THEN price * {_FACTOR} ELSE price END AS price,
       CASE WHEN event_type = 'purchase' THEN {_DISCOUNT} ELSE NULL END AS discount, region
FROM evt
UNION ALL
SELECT event_id + {NEW_ID_OFFSET}, event_type, price * {_FACTOR}, {_DISCOUNT}, region
FROM evt WHERE event_type = 'signup'""",
    "version_diff": f"""WITH {_EVT}
SELECT CAST(0 AS BIGINT) AS version, COUNT(*) AS n_rows, CAST(8 AS INTEGER) AS n_cols,
       '{_COLUMN_LIST}' AS columns FROM evt
UNION ALL
SELECT CAST(2 AS BIGINT), {_N_MERGED}, CAST(9 AS INTEGER), '{_COLUMN_LIST},discount'""",
    "version_history": f"""WITH {_EVT}
SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, COUNT(*) AS n_rows FROM evt
UNION ALL SELECT CAST(1 AS BIGINT), 'EVOLVE', COUNT(*) FROM evt
UNION ALL SELECT CAST(2 AS BIGINT), 'MERGE', {_N_MERGED}""",
    "pipeline_revenue": f"""WITH {_SILVER}
SELECT region, event_type, CAST(SUM({_SILVER_AMOUNT}) AS DOUBLE) AS total_revenue,
       COUNT(event_id) AS event_count
FROM silver GROUP BY region, event_type""",
    "gold_daily_counts": f"""WITH {_SILVER}
SELECT CAST(event_timestamp AS DATE) AS date, region, COUNT(event_id) AS event_count
FROM silver GROUP BY 1, 2""",
    "gold_top_products": f"""WITH {_SILVER}, {_PRODUCTS},
best AS (
  SELECT product_id, SUM({_SILVER_AMOUNT}) AS amount
  FROM silver WHERE event_type = 'purchase' GROUP BY product_id
)
SELECT product_id, CAST(amount AS DOUBLE) AS total_revenue, category, base_price
FROM best LEFT JOIN products USING (product_id)
ORDER BY amount DESC, product_id LIMIT 10""",
    "gold_rolling": f"""WITH {_SILVER},
days AS (
  SELECT region, CAST(event_timestamp AS DATE) AS date, SUM({_SILVER_AMOUNT}) AS amount
  FROM silver GROUP BY 1, 2
)
SELECT region, date, CAST(amount AS DOUBLE) AS daily_revenue,
       CAST(SUM(amount) OVER (PARTITION BY region ORDER BY date
            ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) AS rolling_7d_revenue
FROM days""",
    "refreshed_revenue": f"""WITH {_REFRESHED}
SELECT region, event_type, CAST(SUM(amount) AS DOUBLE) AS total_revenue, COUNT(*) AS event_count
FROM refreshed GROUP BY region, event_type""",
    "refreshed_top_products": f"""WITH {_REFRESHED}, {_PRODUCTS},
best AS (
  SELECT product_id, SUM(amount) AS total FROM refreshed
  WHERE event_type = 'purchase' GROUP BY product_id
)
SELECT product_id, CAST(total AS DOUBLE) AS total_revenue, category, base_price
FROM best LEFT JOIN products USING (product_id)
ORDER BY total DESC, product_id LIMIT 10""",
    "job_results": f"""WITH {_DAILY}, {_PRODUCTS},
types AS (
  SELECT region, event_type, {_REVENUE} AS revenue,
         CAST(SUM({_PRICE}) AS DOUBLE) / COUNT(price) AS avg_price
  FROM sales GROUP BY region, event_type
),
categories AS (
  SELECT category, {_REVENUE} AS revenue
  FROM sales LEFT JOIN products USING (product_id) GROUP BY category
),
users AS (SELECT user_id, region, {_REVENUE} AS revenue FROM sales GROUP BY user_id, region),
ranked AS (
  SELECT region, CAST(date AS VARCHAR) AS date,
         CAST(SUM(amount) OVER (PARTITION BY region ORDER BY date
              ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) AS rolled,
         CAST(RANK() OVER (PARTITION BY date ORDER BY amount DESC) AS DOUBLE) AS place
  FROM daily
)
SELECT 'region_types' AS job, region AS first_key, event_type AS second_key,
       revenue AS figure, avg_price AS second_figure FROM types
UNION ALL
SELECT job, category, CAST(NULL AS VARCHAR), revenue, CAST(NULL AS DOUBLE)
FROM categories
CROSS JOIN (VALUES ('categories_by_broadcast'), ('categories_by_shuffle')) names(job)
UNION ALL
SELECT 'ranked_days', region, date, rolled, place FROM ranked
UNION ALL
SELECT job, CAST(user_id AS VARCHAR), region, revenue, CAST(NULL AS DOUBLE)
FROM users
CROSS JOIN (VALUES ('users_in_2_ranges'), ('users_in_4_ranges'), ('users_in_8_ranges')) names(job)""",
}
