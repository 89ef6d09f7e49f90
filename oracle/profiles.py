"""DuckDB oracle for EDA profiles and data-quality checks."""

from __future__ import annotations

from oracle.marts import DEC, mart_sql

Q = {}

# The eight profiled tables (marts where they exist, cleaned tables otherwise).
PROFILED = {
    "orders": "m_fact_orders",
    "order_items": "m_fact_order_items",
    "customers": "m_dim_customers",
    "products": "m_dim_products",
    "sellers": "m_dim_sellers",
    "payments": "c_order_payments",
    "reviews": "c_order_reviews",
    "categories": "c_category_translation",
}


def _null_profile_ctes(tables: dict[str, str]) -> str:
    """Per table: one row per column with its NULL count, plus the table's row count."""
    parts = []
    for name, view in tables.items():
        parts.append(f"""text_{name} AS (SELECT COLUMNS(*)::VARCHAR FROM {view}),
        nulls_{name} AS (
            SELECT '{name}' AS tbl, col, COUNT(*) FILTER (WHERE v IS NULL) AS n
            FROM (SELECT * FROM text_{name} UNPIVOT INCLUDE NULLS (v FOR col IN (COLUMNS(*))))
            GROUP BY col),
        rows_{name} AS (SELECT '{name}' AS tbl, COUNT(*) AS rows FROM {view})""")
    union_n = " UNION ALL ".join(f"SELECT * FROM nulls_{n}" for n in tables)
    union_r = " UNION ALL ".join(f"SELECT * FROM rows_{n}" for n in tables)
    return ", " + ",\n".join(parts) + f",\nall_nulls AS ({union_n}),\nall_rows AS ({union_r})"


Q["eda_overview"] = mart_sql(_null_profile_ctes(PROFILED) + """
SELECT r.tbl AS "table", r.rows, CAST(COUNT(n.col) AS BIGINT) AS columns, CAST(SUM(n.n) AS BIGINT) AS missing_cells,
       ROUND(CAST(SUM(n.n) AS DOUBLE) / CAST(GREATEST(r.rows * COUNT(n.col), 1) AS DOUBLE) * 100, 2) AS missing_pct
FROM all_rows r JOIN all_nulls n ON r.tbl = n.tbl GROUP BY r.tbl, r.rows ORDER BY r.rows DESC, r.tbl""")

Q["eda_missing"] = mart_sql(_null_profile_ctes(PROFILED) + """
, m AS (SELECT n.tbl, n.col, ROUND(CAST(n.n AS DOUBLE) / CAST(r.rows AS DOUBLE) * 100, 2) AS missing_pct,
               CAST(n.n AS DOUBLE) / CAST(r.rows AS DOUBLE) AS exact
        FROM all_nulls n JOIN all_rows r ON n.tbl = r.tbl WHERE n.n > 0)
SELECT tbl AS "table", col AS "column", missing_pct FROM m
QUALIFY ROW_NUMBER() OVER (PARTITION BY tbl ORDER BY exact DESC, col) <= 8
ORDER BY missing_pct DESC, tbl, col""")


def _histogram(values_sql: str) -> str:
    return mart_sql(f"""
, vals AS (SELECT v FROM ({values_sql}) WHERE v IS NOT NULL AND NOT isnan(v)),
b AS (SELECT MIN(v) AS lo, MAX(v) AS hi FROM vals),
w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 40 ELSE 1.0::DOUBLE END AS width FROM b),
c AS (SELECT LEAST(CAST(FLOOR((v - w.lo) / w.width) AS BIGINT), 39) AS bin, COUNT(*) AS n FROM vals, w GROUP BY 1)
SELECT g.bin, w.lo + g.bin * w.width AS bin_start, w.lo + (g.bin + 1) * w.width AS bin_end, COALESCE(c.n, 0) AS count
FROM (SELECT range AS bin FROM range(40)) g CROSS JOIN w LEFT JOIN c ON g.bin = c.bin
WHERE w.lo IS NOT NULL ORDER BY g.bin""")


CUSTOMER_METRICS = f"""SELECT f.customer_id, COUNT(DISTINCT f.order_id) AS total_orders,
        CAST(SUM(CAST(f.order_value AS {DEC})) AS DOUBLE) AS revenue, d.customer_unique_id,
        COUNT(DISTINCT f.order_id) > 1 AS repeat_customer
    FROM m_fact_orders f LEFT JOIN (SELECT customer_id AS cid, customer_unique_id FROM m_dim_customers) d
      ON f.customer_id = d.cid
    GROUP BY f.customer_id, d.customer_unique_id"""

Q["eda_hist_order_value"] = _histogram("SELECT CAST(order_value AS DOUBLE) AS v FROM m_fact_orders")
Q["eda_hist_freight"] = _histogram("SELECT CAST(freight_value AS DOUBLE) AS v FROM m_fact_order_items")
Q["eda_hist_weight"] = _histogram("SELECT CAST(product_weight_g AS DOUBLE) AS v FROM m_dim_products")
Q["eda_hist_customer_revenue"] = _histogram(f"SELECT revenue AS v FROM ({CUSTOMER_METRICS})")

Q["eda_review_counts"] = mart_sql("""
SELECT review_score, COUNT(*) AS count FROM c_order_reviews WHERE review_score IS NOT NULL GROUP BY review_score ORDER BY count DESC, review_score""")

Q["eda_weekday_counts"] = mart_sql("""
, days AS (SELECT * FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'), (4, 'Friday'),
                                 (5, 'Saturday'), (6, 'Sunday')) AS t(weekday_index, weekday)),
cnt AS (SELECT weekday, COUNT(*) AS orders FROM m_fact_orders WHERE weekday IS NOT NULL GROUP BY weekday)
SELECT d.weekday_index, d.weekday, COALESCE(c.orders, 0) AS orders
FROM days d LEFT JOIN cnt c ON d.weekday = c.weekday ORDER BY d.weekday_index""")

Q["eda_monthly_trend"] = mart_sql(f"""
SELECT order_month, COUNT(DISTINCT order_id) AS orders, CAST(SUM(CAST(order_value AS {DEC})) AS DOUBLE) AS revenue
FROM m_fact_orders WHERE order_month IS NOT NULL GROUP BY order_month ORDER BY order_month""")

# Numeric columns of the correlated tables, in schema order; reviews have only one.
CORR_COLUMNS = {
    "orders": ("m_fact_orders", [
        "total_items", "unique_products", "unique_sellers", "gross_item_value", "gross_freight_value",
        "average_item_price", "total_payment_value", "total_installments", "payment_method_count",
        "average_review_score", "review_count", "total_orders", "customer_span_days", "customer_revenue",
        "average_order_value_customer", "total_orders_by_customer", "order_value", "average_order_value",
        "delivery_time_days", "approval_time_hours", "delivery_delay_days", "month", "quarter", "year",
        "monthly_revenue",
    ]),
    "order_items": ("m_fact_order_items", [
        "order_item_id", "price", "freight_value", "item_total_value", "freight_share", "product_name_length",
        "product_description_length", "product_photos_qty", "product_weight_g", "product_length_cm",
        "product_height_cm", "product_width_cm", "product_volume_cm3", "product_density_g_per_cm3", "seller_items",
        "seller_unique_orders", "seller_revenue", "seller_freight", "revenue", "profit_margin",
    ]),
    "products": ("m_dim_products", [
        "product_name_length", "product_description_length", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm", "product_volume_cm3",
        "product_density_g_per_cm3", "product_units_sold", "product_revenue", "product_freight",
    ]),
}


def _corr_sql() -> str:
    parts = []
    for name, (view, cols) in CORR_COLUMNS.items():
        pairs = [(a, c) for i, a in enumerate(cols) for c in cols[i + 1:]]
        items = ", ".join(
            f"{{'column_a': '{a}', 'column_b': '{c}', 'r': corr(CAST({a} AS DOUBLE), CAST({c} AS DOUBLE))}}"
            for a, c in pairs
        )
        parts.append(f"SELECT '{name}' AS tbl, UNNEST([{items}], recursive := true) FROM {view}")
    return " UNION ALL ".join(parts)


Q["eda_correlation"] = mart_sql(f"""
, pc AS ({_corr_sql()})
SELECT tbl AS "table", column_a, column_b, CASE WHEN NOT isnan(r) THEN ROUND(r, 4) END AS correlation
FROM pc ORDER BY 1, 2, 3""")

_STATE_SUMMARY = f"""SELECT c.customer_state, CAST(SUM(CAST(f.order_value AS {DEC})) AS DOUBLE) AS revenue,
        COUNT(DISTINCT f.order_id) AS orders
    FROM m_fact_orders f LEFT JOIN (SELECT customer_id AS cid, customer_state FROM m_dim_customers) c
      ON f.customer_id = c.cid
    WHERE c.customer_state IS NOT NULL GROUP BY c.customer_state"""

Q["eda_top_states"] = mart_sql(f"""
{_STATE_SUMMARY} ORDER BY revenue DESC NULLS LAST, customer_state LIMIT 15""")

Q["eda_customer_metrics"] = mart_sql(f"""
{CUSTOMER_METRICS} ORDER BY revenue DESC NULLS LAST, customer_id LIMIT 10""")

Q["eda_repeat_counts"] = mart_sql(f"""
SELECT CASE WHEN repeat_customer THEN 'Repeat' ELSE 'One-time' END AS segment, COUNT(*) AS customers
FROM ({CUSTOMER_METRICS}) GROUP BY 1 ORDER BY customers DESC, segment""")

_CATEGORY_SUMMARY = f"""SELECT t.product_category_name_english,
        CAST(SUM(CAST(COALESCE(i.price, 0.0) + COALESCE(i.freight_value, 0.0) AS {DEC})) AS DOUBLE) AS revenue,
        COUNT(DISTINCT i.order_id) AS orders, COUNT(i.product_id) AS units_sold
    FROM c_order_items i
    LEFT JOIN (SELECT product_id AS pid, product_category_name FROM c_products) p ON i.product_id = p.pid
    LEFT JOIN c_category_translation t ON p.product_category_name = t.product_category_name
    WHERE t.product_category_name_english IS NOT NULL GROUP BY t.product_category_name_english"""

Q["eda_top_categories_15"] = mart_sql(f"""
{_CATEGORY_SUMMARY} ORDER BY revenue DESC NULLS LAST, product_category_name_english LIMIT 15""")

Q["eda_headlines"] = mart_sql(f"""
, cm AS ({CUSTOMER_METRICS}), ss AS ({_STATE_SUMMARY}), cs AS ({_CATEGORY_SUMMARY})
SELECT (SELECT CAST(SUM(CAST(revenue AS {DEC})) AS DOUBLE) FROM cm) AS total_revenue,
       (SELECT customer_state FROM ss ORDER BY revenue DESC NULLS FIRST, customer_state LIMIT 1) AS top_state,
       (SELECT product_category_name_english FROM cs ORDER BY revenue DESC NULLS FIRST, product_category_name_english
        LIMIT 1) AS top_category,
       (SELECT ROUND(AVG(CAST(repeat_customer AS DOUBLE)), 4) FROM cm) AS repeat_customer_share""")

# Data quality --------------------------------------------------------------------------------
CLEAN_KEYS = {
    "customers": ["customer_id"],
    "geolocation": ["geolocation_zip_code_prefix"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id"],
    "orders": ["order_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "category_translation": ["product_category_name"],
}


def _health_sql() -> str:
    from oracle.cleaning import cleaned_ctes
    from oracle.fixtures import with_ctes

    tables = {t: f"c_{t}" for t in CLEAN_KEYS}
    selects = []
    for t, keys in CLEAN_KEYS.items():
        null_key = " OR ".join(f"{k} IS NULL" for k in keys)
        selects.append(f"""SELECT '{t}' AS "table", (SELECT COUNT(*) FROM c_{t}) AS rows,
            (SELECT CAST(SUM(n) AS BIGINT) FROM nulls_{t}) AS null_cells,
            (SELECT COUNT(*) FROM c_{t} WHERE {null_key}) AS null_key_rows,
            (SELECT CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) FROM (SELECT COUNT(*) AS c FROM c_{t}
             GROUP BY {', '.join(keys)})) AS duplicate_key_rows""")
    body = _null_profile_ctes(tables) + "\n" + " UNION ALL ".join(selects) + ' ORDER BY "table"'
    return with_ctes(body, *cleaned_ctes(*CLEAN_KEYS))


Q["dq_table_health"] = _health_sql()

Q["dq_reconcile_revenue"] = mart_sql(f"""
, tot AS (SELECT order_id, SUM(CAST(COALESCE(price, 0.0) AS {DEC})) AS p,
                 SUM(CAST(COALESCE(freight_value, 0.0) AS {DEC})) AS f FROM c_order_items GROUP BY order_id),
direct AS (SELECT strftime(o.order_purchase_timestamp, '%Y-%m') AS order_month,
                  CAST(SUM(COALESCE(t.p, 0) + COALESCE(t.f, 0)) AS DOUBLE) AS recomputed_revenue
           FROM c_orders o LEFT JOIN tot t ON o.order_id = t.order_id
           WHERE o.order_purchase_timestamp IS NOT NULL GROUP BY 1),
j AS (SELECT COALESCE(m.order_month, d.order_month) AS order_month, m.monthly_revenue AS mart_revenue,
             d.recomputed_revenue
      FROM m_monthly_revenue m FULL OUTER JOIN direct d ON m.order_month = d.order_month)
SELECT order_month, mart_revenue, recomputed_revenue,
       ROUND(COALESCE(mart_revenue, 0.0) - COALESCE(recomputed_revenue, 0.0), 2) AS difference,
       ROUND(COALESCE(mart_revenue, 0.0) - COALESCE(recomputed_revenue, 0.0), 2) = 0 AS matches
FROM j ORDER BY order_month""")

# Profiles of the raw exports ------------------------------------------------------------------
# Raw tables with missing-value tokens as NULL are the second step of each cleaning chain.
RAW = {"orders": "orders", "order_items": "order_items", "customers": "customers", "products": "products",
       "sellers": "sellers", "payments": "order_payments", "reviews": "order_reviews",
       "categories": "category_translation"}


def raw_sql_over(body: str) -> str:
    from oracle.cleaning import CLEAN_CTES, retail_ctes_for
    from oracle.fixtures import with_ctes

    ctes = retail_ctes_for(RAW.values())
    for name, table in RAW.items():
        ctes += CLEAN_CTES[table][:2]
        ctes.append((f"w_{name}", f"SELECT * EXCLUDE (source_row_order) FROM {CLEAN_CTES[table][1][0]}"))
    number = "TRY_CAST(trim({0}) AS DOUBLE)".format
    when = "TRY_CAST(trim(order_purchase_timestamp) AS TIMESTAMP)"
    ctes += [
        ("e_items", f"SELECT order_id, product_id, {number('price')} AS price, {number('freight_value')} AS freight_value "
                    "FROM w_order_items"),
        ("e_totals", f"SELECT order_id, COALESCE(CAST(SUM(CAST(price AS {DEC})) AS DOUBLE), 0.0) AS order_value "
                     "FROM e_items GROUP BY order_id"),
        ("e_orders", f"""SELECT o.order_id, customer_id, order_value, strftime({when}, '%Y-%m') AS order_month,
                     dayname({when}) AS weekday FROM w_orders o LEFT JOIN e_totals t ON o.order_id = t.order_id"""),
        ("e_customers", f"""SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders,
                     COALESCE(CAST(SUM(CAST(order_value AS {DEC})) AS DOUBLE), 0.0) AS revenue
                     FROM e_orders GROUP BY customer_id"""),
        ("e_metrics", """SELECT e.customer_id, total_orders, revenue, customer_unique_id, total_orders > 1 AS repeat_customer
                     FROM e_customers e LEFT JOIN w_customers c ON e.customer_id = c.customer_id"""),
        ("e_states", f"""SELECT customer_state, COALESCE(CAST(SUM(CAST(order_value AS {DEC})) AS DOUBLE), 0.0) AS revenue,
                     COUNT(DISTINCT order_id) AS orders
                     FROM e_orders e LEFT JOIN w_customers c ON e.customer_id = c.customer_id
                     WHERE customer_state IS NOT NULL GROUP BY customer_state"""),
        ("e_categories", f"""SELECT product_category_name_english,
                     CAST(SUM(CAST(COALESCE(price, 0.0) + COALESCE(freight_value, 0.0) AS {DEC})) AS DOUBLE) AS revenue,
                     COUNT(DISTINCT order_id) AS orders, COUNT(i.product_id) AS units_sold
                     FROM e_items i LEFT JOIN w_products p ON i.product_id = p.product_id
                     LEFT JOIN w_categories t ON p.product_category_name = t.product_category_name
                     WHERE product_category_name_english IS NOT NULL GROUP BY ALL"""),
    ]
    return with_ctes(body, *ctes)


def _raw_histogram(values_sql: str) -> str:
    chain = _histogram(values_sql)
    return raw_sql_over("SELECT * FROM (WITH" + chain[chain.index(", vals AS")+ 1:] + ")")


Q["eda_raw_overview"] = raw_sql_over("SELECT * FROM (WITH " + _null_profile_ctes({n: f"w_{n}" for n in RAW})[1:] + """
SELECT r.tbl AS "table", r.rows, CAST(COUNT(n.col) AS BIGINT) AS columns, CAST(SUM(n.n) AS BIGINT) AS missing_cells,
       ROUND(CAST(SUM(n.n) AS DOUBLE) / CAST(GREATEST(r.rows * COUNT(n.col), 1) AS DOUBLE) * 100, 2) AS missing_pct
FROM all_rows r JOIN all_nulls n ON r.tbl = n.tbl GROUP BY r.tbl, r.rows)""")
Q["eda_raw_hist_order_value"] = _raw_histogram("SELECT order_value AS v FROM e_orders")
Q["eda_raw_hist_freight"] = _raw_histogram("SELECT freight_value AS v FROM e_items")
Q["eda_raw_hist_weight"] = _raw_histogram("SELECT TRY_CAST(trim(product_weight_g) AS DOUBLE) AS v FROM w_products")
Q["eda_raw_review_counts"] = raw_sql_over("""
SELECT TRY_CAST(trim(review_score) AS DOUBLE) AS review_score, COUNT(*) AS count FROM w_reviews
WHERE TRY_CAST(trim(review_score) AS DOUBLE) IS NOT NULL GROUP BY 1""")
Q["eda_raw_weekday_counts"] = raw_sql_over("""
SELECT d.weekday_index, d.weekday, COUNT(e.order_id) AS orders
FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'), (4, 'Friday'), (5, 'Saturday'),
             (6, 'Sunday')) AS d(weekday_index, weekday)
LEFT JOIN e_orders e ON e.weekday = d.weekday GROUP BY ALL""")
Q["eda_raw_monthly_trend"] = raw_sql_over(f"""
SELECT order_month, COUNT(DISTINCT order_id) AS orders,
       COALESCE(CAST(SUM(CAST(order_value AS {DEC})) AS DOUBLE), 0.0) AS revenue
FROM e_orders WHERE order_month IS NOT NULL GROUP BY order_month""")
Q["eda_raw_top_states"] = raw_sql_over("SELECT * FROM e_states ORDER BY revenue DESC, customer_state LIMIT 15")
Q["eda_raw_customer_metrics"] = raw_sql_over("SELECT * FROM e_metrics ORDER BY revenue DESC, customer_id LIMIT 10")
Q["eda_raw_top_categories_15"] = raw_sql_over(
    "SELECT * FROM e_categories ORDER BY revenue DESC, product_category_name_english LIMIT 15")
Q["eda_raw_headlines"] = raw_sql_over(f"""
SELECT (SELECT CAST(SUM(CAST(revenue AS {DEC})) AS DOUBLE) FROM e_metrics) AS total_revenue,
       (SELECT customer_state FROM e_states ORDER BY revenue DESC, customer_state LIMIT 1) AS top_state,
       (SELECT product_category_name_english FROM e_categories ORDER BY revenue DESC, 1 LIMIT 1) AS top_category,
       (SELECT ROUND(AVG(CAST(repeat_customer AS DOUBLE)), 4) FROM e_metrics) AS repeat_customer_share""")

# Marts against the SQL pack -------------------------------------------------------------------
_LIVE = "order_status IN ('delivered', 'shipped', 'invoiced', 'processing', 'approved')"
Q["dq_reconcile_pack"] = mart_sql(f"""
, mart AS (
  SELECT order_month AS k, CAST(SUM(CAST(order_value AS {DEC})) AS DOUBLE) AS monthly_revenue, COUNT(*) AS orders_in_month,
         CAST(SUM(CAST(order_value AS {DEC})) AS DOUBLE) / CAST(COUNT(order_value) AS DOUBLE) AS average_order_value
  FROM m_fact_orders WHERE {_LIVE} AND order_purchase_timestamp IS NOT NULL GROUP BY 1),
sums AS (SELECT order_id, SUM(CAST(price AS DECIMAL(18,4)) + CAST(freight_value AS DECIMAL(18,4))) AS gross
         FROM c_order_items GROUP BY order_id),
pack AS (
  SELECT strftime(order_purchase_timestamp, '%Y-%m') AS k, COUNT(*) AS orders, CAST(SUM(gross) AS DOUBLE) AS revenue,
         CAST(SUM(COALESCE(gross, 0)) AS DOUBLE) AS gross_revenue, ROUND(AVG(COALESCE(gross, 0)), 4) AS aov
  FROM c_orders o LEFT JOIN sums s ON o.order_id = s.order_id
  WHERE {_LIVE} AND order_purchase_timestamp IS NOT NULL GROUP BY 1),
both_sides AS (SELECT COALESCE(mart.k, pack.k) AS order_month, mart.k AS lk, pack.k AS rk, mart.* EXCLUDE (k), pack.* EXCLUDE (k)
               FROM mart FULL OUTER JOIN pack ON mart.k = pack.k),
entries AS (
  SELECT order_month, lk, rk, 'revenue_analysis' AS report, 'monthly_revenue' AS "column", monthly_revenue AS l, gross_revenue AS r FROM both_sides
  UNION ALL SELECT order_month, lk, rk, 'revenue_analysis', 'orders_in_month', orders_in_month, orders FROM both_sides
  UNION ALL SELECT order_month, lk, rk, 'revenue_analysis', 'average_order_value', average_order_value, aov FROM both_sides
  UNION ALL SELECT order_month, lk, rk, 'growth_rate', 'monthly_revenue', monthly_revenue, revenue FROM both_sides
  UNION ALL SELECT order_month, lk, rk, 'growth_rate', 'orders_in_month', orders_in_month, orders FROM both_sides)
SELECT order_month, report, "column", CAST(l AS DOUBLE) AS left_value, CAST(r AS DOUBLE) AS right_value,
       CAST(l AS DOUBLE) - CAST(r AS DOUBLE) AS difference,
       CASE WHEN lk IS NULL THEN 'only_right' WHEN rk IS NULL THEN 'only_left'
            WHEN (l IS NULL AND r IS NULL) OR abs(l - r) <= 0.005 THEN 'match' ELSE 'differs' END AS verdict
FROM entries""")
