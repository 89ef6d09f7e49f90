"""DuckDB oracle for the feature marts, stacked on the cleaning CTEs."""

from __future__ import annotations

from oracle.cleaning import cleaned_ctes
from oracle.fixtures import with_ctes

DEC = "DECIMAL(22,4)"
DAY = "86400000000.0::DOUBLE"
HOUR = "3600000000.0::DOUBLE"


def xsum(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS {DEC})) AS DOUBLE)"


def xmean(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS {DEC})) AS DOUBLE) / CAST(COUNT({c}) AS DOUBLE)"


def diff(a: str, b: str, unit: str) -> str:
    return f"CAST(date_diff('microsecond', {a}, {b}) AS DOUBLE) / {unit}"


ALL_CLEAN = ("orders", "order_items", "order_payments", "order_reviews", "customers", "products", "sellers",
             "category_translation")

MART_CTES: list[tuple[str, str]] = [
    ("m_items", f"""SELECT order_id, COUNT(order_item_id) AS total_items, COUNT(DISTINCT product_id) AS unique_products,
        COUNT(DISTINCT seller_id) AS unique_sellers, {xsum('price')} AS gross_item_value,
        {xsum('freight_value')} AS gross_freight_value, {xmean('price')} AS average_item_price
        FROM c_order_items GROUP BY order_id"""),
    ("m_pay_counts", """SELECT order_id, payment_type, COUNT(*) AS n FROM c_order_payments
        WHERE payment_type IS NOT NULL GROUP BY order_id, payment_type"""),
    ("m_pay_mode", """SELECT order_id, payment_type AS dominant_payment_type FROM m_pay_counts
        QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY n DESC, payment_type) = 1"""),
    ("m_pay", f"""SELECT p.order_id, {xsum('payment_value')} AS total_payment_value,
        CAST(SUM(payment_installments) AS BIGINT) AS total_installments,
        COUNT(DISTINCT payment_type) AS payment_method_count,
        COALESCE(ANY_VALUE(m.dominant_payment_type), 'Unknown') AS dominant_payment_type
        FROM c_order_payments p LEFT JOIN m_pay_mode m ON p.order_id = m.order_id GROUP BY p.order_id"""),
    ("m_rev", f"""SELECT order_id, {xmean('review_score')} AS average_review_score, COUNT(review_id) AS review_count,
        MAX(review_answer_timestamp) AS review_answer_timestamp FROM c_order_reviews GROUP BY order_id"""),
    ("m_order_values", f"""SELECT o.order_id, o.customer_id, v.order_value, p.paid FROM c_orders o
        LEFT JOIN (SELECT order_id, SUM(CAST(price AS {DEC})) AS order_value FROM c_order_items GROUP BY order_id) v
          ON o.order_id = v.order_id
        LEFT JOIN (SELECT order_id, SUM(CAST(payment_value AS {DEC})) AS paid FROM c_order_payments GROUP BY order_id) p
          ON o.order_id = p.order_id"""),
    ("m_timing", f"""SELECT customer_id, MIN(order_purchase_timestamp) AS first_order_date,
        MAX(order_purchase_timestamp) AS last_order_date, COUNT(DISTINCT order_id) AS total_orders
        FROM c_orders WHERE customer_id IS NOT NULL GROUP BY customer_id"""),
    ("m_cust_rev", """SELECT customer_id, SUM(order_value) AS items, SUM(paid) AS paid FROM m_order_values
        GROUP BY customer_id"""),
    ("m_cust_base", f"""SELECT t.customer_id, t.first_order_date, t.last_order_date, t.total_orders,
        CAST(FLOOR({diff('t.first_order_date', 't.last_order_date', DAY)}) AS BIGINT) AS customer_span_days,
        r.items, r.paid
        FROM m_timing t LEFT JOIN m_cust_rev r ON t.customer_id = r.customer_id"""),
    ("m_context", """SELECT customer_id, first_order_date, last_order_date, total_orders, customer_span_days,
        CAST(COALESCE(items, 0) AS DOUBLE) AS customer_revenue,
        CASE WHEN total_orders > 0 THEN CAST(COALESCE(items, 0) AS DOUBLE) / total_orders END AS average_order_value_customer,
        total_orders AS total_orders_by_customer FROM m_cust_base"""),
    ("m_fact_base", f"""SELECT o.*, i.total_items, i.unique_products, i.unique_sellers, i.gross_item_value,
        i.gross_freight_value, i.average_item_price, p.total_payment_value, p.total_installments,
        p.payment_method_count, p.dominant_payment_type, r.average_review_score, r.review_count,
        r.review_answer_timestamp, x.first_order_date, x.last_order_date, x.total_orders, x.customer_span_days,
        x.customer_revenue, x.average_order_value_customer, x.total_orders_by_customer,
        COALESCE(i.gross_item_value, 0.0) + COALESCE(i.gross_freight_value, 0.0) AS order_value,
        {diff('o.order_purchase_timestamp', 'o.order_delivered_customer_date', DAY)} AS delivery_time_days,
        {diff('o.order_purchase_timestamp', 'o.order_approved_at', HOUR)} AS approval_time_hours,
        {diff('o.order_estimated_delivery_date', 'o.order_delivered_customer_date', DAY)} AS delivery_delay_days,
        strftime(o.order_purchase_timestamp, '%Y-%m') AS order_month,
        CAST(EXTRACT(MONTH FROM o.order_purchase_timestamp) AS BIGINT) AS month,
        CAST(EXTRACT(QUARTER FROM o.order_purchase_timestamp) AS BIGINT) AS quarter,
        CAST(EXTRACT(YEAR FROM o.order_purchase_timestamp) AS BIGINT) AS year,
        dayname(o.order_purchase_timestamp) AS weekday,
        COALESCE(isodow(o.order_purchase_timestamp) IN (6, 7), FALSE) AS is_weekend_order
        FROM c_orders o LEFT JOIN m_items i ON o.order_id = i.order_id LEFT JOIN m_pay p ON o.order_id = p.order_id
        LEFT JOIN m_rev r ON o.order_id = r.order_id LEFT JOIN m_context x ON o.customer_id = x.customer_id"""),
    ("m_month_rev", f"""SELECT order_month, CAST(SUM(CAST(order_value AS {DEC})) AS DOUBLE) AS monthly_revenue
        FROM m_fact_base WHERE order_month IS NOT NULL GROUP BY order_month"""),
    ("m_fact_orders", """SELECT f.*,
        CASE WHEN f.total_orders_by_customer > 0 THEN f.customer_revenue / f.total_orders_by_customer
             ELSE f.order_value END AS average_order_value,
        f.delivery_delay_days > 0 AS late_deliveries, m.monthly_revenue
        FROM m_fact_base f LEFT JOIN m_month_rev m ON f.order_month = m.order_month"""),
    ("m_product_features", """SELECT p.*, p.product_length_cm * p.product_height_cm * p.product_width_cm AS product_volume_cm3,
        CASE WHEN p.product_length_cm * p.product_height_cm * p.product_width_cm <> 0
             THEN p.product_weight_g / (p.product_length_cm * p.product_height_cm * p.product_width_cm) END
             AS product_density_g_per_cm3,
        COALESCE(p.product_weight_g <= 1000, FALSE) AS is_lightweight, t.product_category_name_english
        FROM c_products p LEFT JOIN c_category_translation t ON p.product_category_name = t.product_category_name"""),
    ("m_seller_metrics", f"""SELECT seller_id, COUNT(order_id) AS seller_items, COUNT(DISTINCT order_id) AS seller_unique_orders,
        {xsum('price')} AS seller_revenue, {xsum('freight_value')} AS seller_freight
        FROM c_order_items GROUP BY seller_id"""),
    ("m_dim_sellers", """SELECT s.*, m.seller_items, m.seller_unique_orders, m.seller_revenue, m.seller_freight
        FROM c_sellers s LEFT JOIN m_seller_metrics m ON s.seller_id = m.seller_id"""),
    ("m_fact_order_items", """SELECT i.*, COALESCE(i.price, 0.0) + COALESCE(i.freight_value, 0.0) AS item_total_value,
        CASE WHEN COALESCE(i.price, 0.0) + COALESCE(i.freight_value, 0.0) <> 0
             THEN i.freight_value / (COALESCE(i.price, 0.0) + COALESCE(i.freight_value, 0.0)) END AS freight_share,
        COALESCE(i.freight_value > i.price, FALSE) AS high_freight_flag,
        o.customer_id, o.order_purchase_timestamp, o.order_status,
        p.* EXCLUDE (product_id), s.* EXCLUDE (seller_id),
        COALESCE(i.price, 0.0) + COALESCE(i.freight_value, 0.0) AS revenue,
        COALESCE(isodow(o.order_purchase_timestamp) IN (6, 7), FALSE) AS weekend_order,
        CASE WHEN COALESCE(i.price, 0.0) <> 0
             THEN (COALESCE(i.price, 0.0) - COALESCE(TRY_CAST(p.unit_cost AS DOUBLE), 0.0)) / COALESCE(i.price, 0.0)
             END AS profit_margin
        FROM c_order_items i LEFT JOIN c_orders o ON i.order_id = o.order_id
        LEFT JOIN m_product_features p ON i.product_id = p.product_id
        LEFT JOIN m_dim_sellers s ON i.seller_id = s.seller_id"""),
    ("m_dim_customers", """SELECT c.*, b.first_order_date, b.last_order_date, COALESCE(b.total_orders, 0) AS total_orders,
        b.customer_span_days,
        CASE WHEN b.customer_id IS NOT NULL THEN CAST(COALESCE(b.items, b.paid, 0) AS DOUBLE) END AS customer_revenue,
        COALESCE(b.total_orders, 0) > 1 AS repeat_customer,
        CASE WHEN COALESCE(b.total_orders, 0) > 0 THEN CAST(COALESCE(b.items, b.paid, 0) AS DOUBLE) / b.total_orders
             ELSE 0.0 END AS revenue_per_customer,
        CASE WHEN COALESCE(b.total_orders, 0) > 1 THEN b.customer_span_days / (b.total_orders - 1) END AS order_frequency_days,
        COALESCE(CAST(COALESCE(b.items, b.paid, 0) AS DOUBLE), 0.0) AS clv_approx,
        COALESCE(CAST(COALESCE(b.items, b.paid, 0) AS DOUBLE), 0.0) AS customer_lifetime_value
        FROM c_customers c LEFT JOIN m_cust_base b ON c.customer_id = b.customer_id"""),
    ("m_dim_products", f"""SELECT p.*, m.product_units_sold, m.product_revenue, m.product_freight FROM m_product_features p
        LEFT JOIN (SELECT product_id, COUNT(order_id) AS product_units_sold, {xsum('price')} AS product_revenue,
                   {xsum('freight_value')} AS product_freight FROM c_order_items GROUP BY product_id) m
        ON p.product_id = m.product_id"""),
    ("m_monthly_revenue", f"""SELECT strftime(order_purchase_timestamp, '%Y-%m') AS order_month,
        CAST(SUM(CAST(order_value AS {DEC})) AS DOUBLE) AS monthly_revenue,
        COUNT(DISTINCT order_id) AS orders_in_month, {xmean('order_value')} AS average_order_value
        FROM m_fact_orders WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1"""),
    ("m_customer_kpis", """SELECT customer_id, customer_unique_id, total_orders, repeat_customer, revenue_per_customer,
        order_frequency_days, customer_lifetime_value, clv_approx FROM m_dim_customers"""),
]


def mart_sql(body: str) -> str:
    return with_ctes(body, *cleaned_ctes(*ALL_CLEAN), *MART_CTES)


Q = {
    "fact_orders": mart_sql("SELECT * FROM m_fact_orders"),
    "fact_order_items": mart_sql("SELECT * FROM m_fact_order_items"),
    "dim_customers": mart_sql("SELECT * FROM m_dim_customers"),
    "dim_products": mart_sql("SELECT * FROM m_dim_products"),
    "dim_sellers": mart_sql("SELECT * FROM m_dim_sellers"),
    "monthly_revenue": mart_sql("SELECT * FROM m_monthly_revenue ORDER BY order_month"),
    "customer_kpis": mart_sql("SELECT * FROM m_customer_kpis"),
}
Q["io_save_marts"] = Q["io_refreshed_month"] = Q["fact_orders"]
for _mart in ("fact_order_items", "dim_customers", "dim_products", "dim_sellers", "monthly_revenue", "customer_kpis"):
    Q[f"io_published_{_mart}"] = Q[_mart]
