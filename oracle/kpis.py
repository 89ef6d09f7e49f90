"""DuckDB oracle for the KPI reports, stacked on the mart CTEs."""

from __future__ import annotations

from oracle.marts import DEC, mart_sql

Q = {}

Q["kpi_total_revenue"] = mart_sql(f"""
SELECT 'total_revenue' AS metric,
       CAST(COALESCE(SUM(CAST(COALESCE(order_value, 0.0) AS {DEC})), 0) AS DOUBLE) AS value, 'BRL' AS currency
FROM m_fact_orders""")

Q["kpi_total_orders"] = mart_sql("""
SELECT 'total_orders' AS metric, COUNT(DISTINCT order_id) AS value,
       COUNT(DISTINCT CASE WHEN order_status = 'delivered' THEN order_id END) AS delivered_orders
FROM m_fact_orders""")

Q["kpi_average_order_value"] = mart_sql(f"""
, v AS (SELECT COALESCE(order_value, 0.0) AS order_value FROM m_fact_orders)
SELECT 'average_order_value' AS metric,
       COALESCE((SELECT CAST(SUM(CAST(order_value AS {DEC})) AS DOUBLE) / CAST(COUNT(order_value) AS DOUBLE) FROM v), 0.0)
           AS value,
       COALESCE((SELECT median(order_value) FROM v), 0.0) AS median_order_value""".replace("\n, v AS", ", v AS", 1))

_PM = f"""
SELECT 'profit_margin' AS metric,
       CASE WHEN SUM(CAST(COALESCE(revenue, 0.0) AS {DEC})) <> 0
            THEN CAST(SUM(CAST(COALESCE(revenue, 0.0) - COALESCE(TRY_CAST(unit_cost AS DOUBLE), 0.0) AS {DEC})) AS DOUBLE)
                 / CAST(SUM(CAST(COALESCE(revenue, 0.0) AS {DEC})) AS DOUBLE) END AS value,
       CAST(COALESCE(SUM(CAST(COALESCE(revenue, 0.0) - COALESCE(TRY_CAST(unit_cost AS DOUBLE), 0.0) AS {DEC})), 0) AS DOUBLE)
           AS gross_profit,
       CAST(COALESCE(SUM(CAST(COALESCE(revenue, 0.0) AS {DEC})), 0) AS DOUBLE) AS revenue
FROM m_fact_order_items"""
Q["kpi_profit_margin_with_cost"] = mart_sql(_PM)


def _group(key: str, alias: str) -> str:
    return f"""SELECT {key} AS {alias}, CAST(SUM(CAST(revenue AS {DEC})) AS DOUBLE) AS revenue,
        COUNT(DISTINCT order_id) AS orders, COUNT(order_item_id) AS units_sold
        FROM m_fact_order_items WHERE {key} IS NOT NULL GROUP BY {key}"""


Q["kpi_top_categories"] = mart_sql(f"""
, g AS ({_group('product_category_name_english', 'category')})
SELECT *, ROW_NUMBER() OVER (ORDER BY revenue DESC NULLS LAST, units_sold DESC NULLS LAST, category) AS rank
FROM g ORDER BY revenue DESC NULLS LAST, units_sold DESC NULLS LAST, category LIMIT 10""".replace("\n, g AS", ", g AS", 1))

Q["kpi_top_sellers"] = mart_sql(f"""
, g AS ({_group('seller_id', 'seller_id')})
SELECT *, ROW_NUMBER() OVER (ORDER BY revenue DESC NULLS LAST, orders DESC NULLS LAST, seller_id) AS rank
FROM g ORDER BY revenue DESC NULLS LAST, orders DESC NULLS LAST, seller_id LIMIT 10""".replace("\n, g AS", ", g AS", 1))

Q["kpi_monthly_growth"] = mart_sql("""
, m AS (SELECT order_month, COALESCE(monthly_revenue, 0.0) AS monthly_revenue, orders_in_month, average_order_value,
               LAG(COALESCE(monthly_revenue, 0.0)) OVER (ORDER BY order_month) AS previous_month_revenue
        FROM m_monthly_revenue)
SELECT *, monthly_revenue - previous_month_revenue AS growth_amount,
       CASE WHEN previous_month_revenue <> 0 THEN (monthly_revenue - previous_month_revenue) / previous_month_revenue END
           AS growth_rate
FROM m ORDER BY order_month""".replace("\n, m AS", ", m AS", 1))

Q["kpi_repeat_customers"] = mart_sql("""
SELECT 'repeat_customers' AS metric, COUNT(*) FILTER (WHERE COALESCE(repeat_customer, FALSE)) AS repeat_customers,
       COUNT(DISTINCT customer_id) AS total_customers,
       CASE WHEN COUNT(DISTINCT customer_id) > 0
            THEN COUNT(*) FILTER (WHERE COALESCE(repeat_customer, FALSE)) / COUNT(DISTINCT customer_id) END
           AS repeat_customer_share
FROM m_dim_customers""")

Q["kpi_customer_retention"] = mart_sql("""
, f AS (SELECT customer_id, first_order_date, strftime(first_order_date, '%Y-%m') AS cohort_month FROM m_dim_customers
        WHERE customer_id IS NOT NULL AND first_order_date IS NOT NULL),
h AS (SELECT customer_id, order_purchase_timestamp FROM m_fact_orders
      WHERE customer_id IS NOT NULL AND order_purchase_timestamp IS NOT NULL),
c AS (SELECT f.cohort_month, f.customer_id,
             BOOL_OR(COALESCE(CAST(FLOOR(CAST(date_diff('microsecond', f.first_order_date, h.order_purchase_timestamp)
                     AS DOUBLE) / 86400000000.0::DOUBLE) AS BIGINT) BETWEEN 1 AND 90, FALSE)) AS retained
      FROM f LEFT JOIN h ON f.customer_id = h.customer_id GROUP BY f.cohort_month, f.customer_id)
SELECT cohort_month, COUNT(DISTINCT customer_id) AS customers_in_cohort,
       COUNT(*) FILTER (WHERE retained) AS retained_customers,
       CASE WHEN COUNT(DISTINCT customer_id) <> 0
            THEN COUNT(*) FILTER (WHERE retained) / COUNT(DISTINCT customer_id) END AS retention_rate,
       CAST(90 AS BIGINT) AS retention_window_days
FROM c GROUP BY cohort_month ORDER BY cohort_month""".replace("\n, f AS", ", f AS", 1))

Q["kpi_revenue_by_state"] = mart_sql(f"""
SELECT c.customer_state, CAST(COALESCE(SUM(CAST(COALESCE(f.order_value, 0.0) AS {DEC})), 0) AS DOUBLE) AS revenue,
       COUNT(DISTINCT f.order_id) AS orders,
       CAST(SUM(CAST(f.order_value AS {DEC})) AS DOUBLE) / CAST(COUNT(f.order_value) AS DOUBLE) AS average_order_value
FROM m_fact_orders f LEFT JOIN m_dim_customers c ON f.customer_id = c.customer_id
WHERE c.customer_state IS NOT NULL GROUP BY c.customer_state ORDER BY revenue DESC NULLS LAST""")

Q["kpi_revenue_by_category"] = mart_sql(f"""
{_group('product_category_name_english', 'category')} ORDER BY revenue DESC NULLS LAST""")
