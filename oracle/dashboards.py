"""DuckDB oracle for BI measures and dashboard data sets."""

from __future__ import annotations

from oracle.fixtures import with_ctes
from oracle.marts import DEC, mart_sql
from oracle.reports import Q as REPORTS

Q = {}


def msum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS {DEC})) AS DOUBLE)"


ORDER_MEASURES = f"""
    {msum('COALESCE(order_value, 0.0)')} AS total_revenue,
    COUNT(DISTINCT order_id) AS total_orders,
    {msum('COALESCE(order_value, 0.0)')} / NULLIF(CAST(COUNT(DISTINCT order_id) AS DOUBLE), 0) AS average_order_value,
    {msum('COALESCE(order_value, 0.0)')} / NULLIF(CAST(COUNT(DISTINCT customer_id) AS DOUBLE), 0) AS revenue_per_customer,
    CAST(COUNT(*) FILTER (WHERE late_deliveries) AS DOUBLE) / NULLIF(CAST(COUNT(DISTINCT order_id) AS DOUBLE), 0)
        AS late_delivery_rate,
    ROUND(AVG(delivery_time_days), 4) AS average_delivery_time_days,
    ROUND(AVG(approval_time_hours), 4) AS average_approval_time_hours"""

ITEM_MEASURES = f"""
    {msum('freight_value')} / NULLIF({msum('item_total_value')}, 0) AS freight_share,
    {msum('COALESCE(revenue, 0.0) - COALESCE(TRY_CAST(unit_cost AS DOUBLE), 0.0)')}
        / NULLIF({msum('COALESCE(revenue, 0.0)')}, 0) AS profit_margin"""

NOT_CANCELLED = "order_status <> 'canceled'"


def sliced(body: str, orders: str = NOT_CANCELLED, customers: str = "", items: str = "", products: str = "",
           sellers: str = "") -> str:
    """``body`` over x_orders, x_items, x_customers, x_products and x_sellers: each mart under its
    own condition, orders also by their customers and items, items by their orders."""
    by_customer = "AND customer_id IN (SELECT customer_id FROM x_customers)" if customers else ""
    by_item = "AND order_id IN (SELECT order_id FROM x_matching)" if items else ""
    everything = orders == "TRUE" and not (by_customer or by_item)
    by_order = "" if everything else "WHERE order_id IN (SELECT order_id FROM x_orders)"
    return mart_sql(f"""
, x_customers AS (SELECT * FROM m_dim_customers WHERE {customers or 'TRUE'}),
x_products AS (SELECT * FROM m_dim_products WHERE {products or 'TRUE'}),
x_sellers AS (SELECT * FROM m_dim_sellers WHERE {sellers or 'TRUE'}),
x_matching AS (SELECT * FROM m_fact_order_items WHERE {items or 'TRUE'}),
x_orders AS (SELECT * FROM m_fact_orders WHERE {orders} {by_customer} {by_item}),
x_items AS (SELECT * FROM x_matching {by_order}){body}""")


ALL_MEASURES = f"""
SELECT * FROM (SELECT {ORDER_MEASURES} FROM x_orders) CROSS JOIN (SELECT {ITEM_MEASURES} FROM x_items) CROSS JOIN (
    SELECT CAST(SUM(CASE WHEN total_orders > 1 THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0)
               AS repeat_customer_rate,
           ROUND(AVG(customer_lifetime_value), 4) AS customer_lifetime_value_avg,
           CAST(SUM(CASE WHEN repeat_customer THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0)
               AS customer_retention_rate
    FROM x_customers) CROSS JOIN (
    SELECT MAX(product_revenue) AS top_category_revenue FROM x_products) CROSS JOIN (
    SELECT CAST(MAX(r) AS DOUBLE) AS top_category_revenue_by_category FROM (
        SELECT SUM(CAST(product_revenue AS {DEC})) AS r FROM x_products
        WHERE product_category_name_english IS NOT NULL GROUP BY product_category_name_english)) CROSS JOIN (
    SELECT MAX(seller_revenue) AS top_seller_revenue FROM x_sellers)"""

_TWO_CATEGORIES = "product_category_name_english IN ('standard goods', 'small goods')"
_FIVE_SELLERS = "seller_id IN ('1', '2', '3', '5', '8')"
Q["bi_measures"] = sliced(ALL_MEASURES)
Q["bi_measures_delivered_view"] = sliced(ALL_MEASURES, orders="order_status = 'delivered'")
Q["bi_measures_all_orders"] = sliced(ALL_MEASURES, orders="TRUE")
Q["bi_measures_slice_state"] = sliced(ALL_MEASURES, customers="customer_state IN ('EUROPE', 'ASIA')")
Q["bi_measures_slice_city"] = sliced(ALL_MEASURES, customers="customer_city IN ('NATION_3', 'NATION_7', 'NATION_19')")
Q["bi_measures_slice_dates"] = sliced(
    ALL_MEASURES, orders=f"{NOT_CANCELLED} AND order_purchase_timestamp >= TIMESTAMP '1995-03-15' "
    "AND order_purchase_timestamp < TIMESTAMP '1997-07-02'")
Q["bi_measures_slice_category"] = sliced(ALL_MEASURES, items=_TWO_CATEGORIES, products=_TWO_CATEGORIES)
Q["bi_measures_slice_seller"] = sliced(ALL_MEASURES, items=_FIVE_SELLERS, sellers=_FIVE_SELLERS)
Q["bi_measures_slice_payment"] = sliced(ALL_MEASURES, orders="dominant_payment_type IN ('A', 'voucher')")
Q["bi_measures_slice_late"] = sliced(
    ALL_MEASURES, orders=f"{NOT_CANCELLED} AND late_deliveries", customers="repeat_customer")


CUSTOMER_MEASURES = """CAST(SUM(CASE WHEN total_orders > 1 THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0)
        AS repeat_customer_rate,
    ROUND(AVG(customer_lifetime_value), 4) AS customer_lifetime_value_avg,
    CAST(SUM(CASE WHEN repeat_customer THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0)
        AS customer_retention_rate"""
_TOP_OF_CATEGORIES = f"""SELECT product_category_name_english AS axis, SUM(CAST(product_revenue AS {DEC})) AS r
    FROM x_products WHERE product_category_name_english IS NOT NULL GROUP BY 1"""


def by_axis(axis: str, order_axis: str, item_axis: str, cuts: str = "") -> str:
    """Order, item and dimension measures per axis value; the arguments select (order_id, axis)
    pairs for either, ``cuts`` names the dimension that the axis is an attribute of."""
    def dimension(name: str, measures: str, source: str, column: str) -> str:
        if cuts != name:
            return f"CROSS JOIN (SELECT {measures} FROM {source})"
        grouped = f"SELECT {column} AS axis, {measures} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1"
        return f"LEFT JOIN ({grouped}) USING (axis)"

    english = "product_category_name_english"
    return f"""
, po AS (SELECT DISTINCT order_id AS oid, axis FROM ({order_axis}) WHERE axis IS NOT NULL),
o AS (SELECT axis, {ORDER_MEASURES} FROM x_orders JOIN po ON order_id = oid GROUP BY axis),
i AS (SELECT axis, {ITEM_MEASURES} FROM ({item_axis}) WHERE axis IS NOT NULL GROUP BY axis),
sums AS ({_TOP_OF_CATEGORIES})
SELECT axis AS {axis}, * EXCLUDE (axis) FROM (SELECT o.*, i.freight_share, i.profit_margin FROM o LEFT JOIN i ON o.axis = i.axis)
{dimension("customers", CUSTOMER_MEASURES, "x_customers", axis)}
{dimension("products", "MAX(product_revenue) AS top_category_revenue", "x_products", english)}
{dimension("products", "CAST(MAX(r) AS DOUBLE) AS top_category_revenue_by_category", "sums", "sums.axis")}
{dimension("sellers", "MAX(seller_revenue) AS top_seller_revenue", "x_sellers", "seller_id")}"""


def by_order_axis(axis: str, expression: str, source: str = "x_orders", cuts: str = "") -> str:
    pairs = f"SELECT order_id, {expression} AS axis FROM {source}"
    return by_axis(axis, pairs, f"SELECT x.*, p.axis FROM x_items x JOIN ({pairs}) p ON x.order_id = p.order_id", cuts)


def by_customer(column: str) -> str:
    source = f"(SELECT f.order_id, c.{column} FROM x_orders f JOIN x_customers c ON f.customer_id = c.customer_id)"
    return by_order_axis(column, column, source, "customers")


def by_item(axis: str, column: str, cuts: str) -> str:
    return by_axis(axis, f"SELECT order_id, {column} AS axis FROM x_items", f"SELECT *, {column} AS axis FROM x_items", cuts)


Q["bi_measures_by_state"] = sliced(by_customer("customer_state"))
Q["bi_measures_by_city"] = sliced(by_customer("customer_city"))
Q["bi_measures_sliced"] = sliced(
    by_customer("customer_state"),
    orders=f"{NOT_CANCELLED} AND order_purchase_timestamp >= TIMESTAMP '1996-01-01' "
           "AND order_purchase_timestamp < TIMESTAMP '2000-01-01'",
    customers="repeat_customer", items=_TWO_CATEGORIES, products=_TWO_CATEGORIES)
Q["bi_measures_by_payment_type"] = sliced(by_order_axis("dominant_payment_type", "dominant_payment_type"))
Q["bi_measures_by_delivery_status"] = sliced(by_order_axis(
    "delivery_status",
    "CASE late_deliveries WHEN TRUE THEN 'late' WHEN FALSE THEN 'on_time' ELSE 'undelivered' END"))
Q["bi_measures_by_category"] = sliced(by_item("category", "product_category_name_english", "products"))
Q["bi_measures_by_seller"] = sliced(by_item("seller_id", "seller_id", "sellers"))

_PREV_MONTH = "strftime(CAST(order_month || '-01' AS DATE) + INTERVAL 1 MONTH, '%Y-%m')"

_MONTH_TO_DATE = f"""
, daily AS (SELECT CAST(order_purchase_timestamp AS DATE) AS order_date,
                   SUM(CAST(COALESCE(order_value, 0.0) AS {DEC})) AS rev
            FROM x_orders WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1),
d2 AS (SELECT *, strftime(order_date, '%Y-%m') AS order_month FROM daily),
monthly AS (SELECT order_month, SUM(rev) AS month_rev FROM d2 GROUP BY order_month),
prev AS (SELECT {_PREV_MONTH} AS order_month, month_rev AS prev_rev FROM monthly),
mtd AS (SELECT *, SUM(rev) OVER (PARTITION BY order_month ORDER BY order_date ROWS UNBOUNDED PRECEDING) AS mtd FROM d2)
SELECT m.order_date, m.order_month, CAST(m.rev AS DOUBLE) AS daily_revenue, CAST(m.mtd AS DOUBLE) AS month_to_date_revenue,
       CAST(p.prev_rev AS DOUBLE) AS previous_month_revenue,
       CAST(m.mtd - p.prev_rev AS DOUBLE) / NULLIF(CAST(p.prev_rev AS DOUBLE), 0) AS monthly_growth_rate
FROM mtd m LEFT JOIN prev p ON m.order_month = p.order_month ORDER BY m.order_date"""
Q["bi_month_to_date"] = sliced(_MONTH_TO_DATE)
Q["bi_month_to_date_sliced"] = sliced(
    _MONTH_TO_DATE, orders="order_status = 'delivered'", customers="customer_state = 'EUROPE'")

Q["bi_month_over_month"] = sliced(f"""
, mon AS (SELECT order_month, {msum('order_value')} AS monthly_revenue FROM x_orders
          WHERE order_month IS NOT NULL GROUP BY order_month),
prev AS (SELECT {_PREV_MONTH} AS order_month, monthly_revenue AS previous_month_revenue FROM mon)
SELECT m.order_month, m.monthly_revenue, p.previous_month_revenue,
       m.monthly_revenue - p.previous_month_revenue AS growth_amount,
       (m.monthly_revenue - p.previous_month_revenue) / NULLIF(p.previous_month_revenue, 0) AS monthly_growth_rate
FROM mon m LEFT JOIN prev p ON m.order_month = p.order_month ORDER BY m.order_month""")

# Cohort matrix: one column per month of the calendar years of the driver's order dates, 1992-1998.
COHORT_MONTHS = 84
_RATES = ", ".join(f'MAX(retention_rate) FILTER (WHERE month_number = {i}) AS "{i}"' for i in range(COHORT_MONTHS))
Q["ds_cohort_matrix"] = f"""
SELECT cohort_month, cohort_size, {_RATES}
FROM ({REPORTS["q_customer_retention"]}) AS retention GROUP BY cohort_month, cohort_size"""

Q["ds_repeat_share"] = mart_sql(f"""
, g AS (SELECT COALESCE(repeat_customer, FALSE) AS rc, COUNT(*) AS customers,
               SUM(CAST(COALESCE(customer_revenue, 0.0) AS {DEC})) AS rev FROM m_dim_customers GROUP BY 1)
SELECT CASE WHEN rc THEN 'Repeat' ELSE 'One-time' END AS segment, customers, CAST(rev AS DOUBLE) AS revenue,
       ROUND(customers / SUM(customers) OVER (), 4) AS customer_share,
       ROUND(CAST(rev AS DOUBLE) / NULLIF(CAST(SUM(rev) OVER () AS DOUBLE), 0), 4) AS revenue_share
FROM g""")

_CAT = "product_category_name_english"

Q["ds_category_delay"] = mart_sql(f"""
, rv AS (SELECT {_CAT} AS category, {msum('revenue')} AS revenue, COUNT(order_item_id) AS units_sold
         FROM m_fact_order_items WHERE {_CAT} IS NOT NULL GROUP BY 1),
co AS (SELECT DISTINCT {_CAT} AS category, order_id FROM m_fact_order_items WHERE {_CAT} IS NOT NULL),
dl AS (SELECT co.category, COUNT(co.order_id) AS orders, ROUND(AVG(f.delivery_delay_days), 4) AS average_delay_days,
              ROUND(AVG(CAST(f.late_deliveries AS DOUBLE)), 4) AS late_delivery_rate
       FROM co LEFT JOIN m_fact_orders f ON co.order_id = f.order_id GROUP BY co.category)
SELECT rv.category, rv.revenue, rv.units_sold, dl.orders, dl.average_delay_days, dl.late_delivery_rate
FROM rv LEFT JOIN dl ON rv.category = dl.category ORDER BY rv.revenue DESC NULLS LAST, rv.category""")

Q["ds_category_share"] = mart_sql(f"""
, g AS (SELECT {_CAT} AS category, SUM(CAST(revenue AS {DEC})) AS rev, {msum('freight_value')} AS freight,
               COUNT(order_item_id) AS units_sold, COUNT(DISTINCT order_id) AS orders
        FROM m_fact_order_items WHERE {_CAT} IS NOT NULL GROUP BY 1),
t AS (SELECT SUM(rev) AS total FROM g)
SELECT category, CAST(rev AS DOUBLE) AS revenue, freight, units_sold, orders,
       ROUND(CAST(rev AS DOUBLE) / NULLIF(CAST(t.total AS DOUBLE), 0), 4) AS revenue_share,
       ROUND(CAST(SUM(rev) OVER (ORDER BY rev DESC NULLS LAST, category ROWS UNBOUNDED PRECEDING) AS DOUBLE)
             / NULLIF(CAST(t.total AS DOUBLE), 0), 4) AS cumulative_share
FROM g, t ORDER BY revenue DESC, category""")

Q["ds_seller_scorecard"] = mart_sql("""
, pairs AS (SELECT DISTINCT seller_id, order_id FROM m_fact_order_items),
svc AS (SELECT p.seller_id, ROUND(AVG(CAST(f.late_deliveries AS DOUBLE)), 4) AS late_delivery_rate,
               ROUND(AVG(f.average_review_score), 4) AS average_review_score
        FROM pairs p LEFT JOIN m_fact_orders f ON p.order_id = f.order_id GROUP BY p.seller_id)
SELECT s.seller_id, s.seller_state, s.seller_revenue, s.seller_unique_orders, s.seller_items,
       svc.late_delivery_rate, svc.average_review_score
FROM m_dim_sellers s LEFT JOIN svc ON s.seller_id = svc.seller_id""")

Q["ds_seller_geography"] = mart_sql(f"""
SELECT seller_state, COUNT(*) AS sellers, {msum('COALESCE(seller_revenue, 0.0)')} AS revenue,
       CAST(SUM(COALESCE(seller_items, 0)) AS BIGINT) AS items
FROM m_dim_sellers GROUP BY seller_state""")

Q["ds_delivery_trend"] = mart_sql("""
SELECT order_month, COUNT(*) AS orders, ROUND(AVG(delivery_time_days), 4) AS average_delivery_time_days,
       ROUND(AVG(CAST(date_diff('microsecond', order_purchase_timestamp, order_estimated_delivery_date) AS DOUBLE)
                 / 86400000000.0::DOUBLE), 4) AS average_estimated_days
FROM m_fact_orders WHERE order_month IS NOT NULL GROUP BY order_month ORDER BY order_month""")

_WITH_STATE = """(SELECT f.*, c.customer_state FROM m_fact_orders f
    LEFT JOIN (SELECT customer_id AS cid, customer_state FROM m_dim_customers) c ON f.customer_id = c.cid
    WHERE c.customer_state IS NOT NULL)"""

Q["ds_late_rate_by_state"] = mart_sql(f"""
SELECT customer_state, COUNT(*) AS orders, COUNT(*) FILTER (WHERE late_deliveries) AS late_orders,
       ROUND(AVG(CAST(late_deliveries AS DOUBLE)), 4) AS late_delivery_rate
FROM {_WITH_STATE} GROUP BY customer_state""")

Q["ds_weekday_month_heatmap"] = mart_sql(
    "SELECT weekday, " + ", ".join(f'COUNT(*) FILTER (WHERE month = {m}) AS "{m}"' for m in range(1, 13))
    + " FROM m_fact_orders WHERE weekday IS NOT NULL GROUP BY weekday")

Q["ds_growth_waterfall"] = mart_sql(f"""
, m AS (SELECT order_month, COALESCE(monthly_revenue, 0.0) AS monthly_revenue FROM m_monthly_revenue)
SELECT order_month, monthly_revenue,
       monthly_revenue - COALESCE(LAG(monthly_revenue) OVER (ORDER BY order_month), 0.0) AS change,
       CAST(SUM(CAST(monthly_revenue AS {DEC})) OVER (ORDER BY order_month ROWS UNBOUNDED PRECEDING) AS DOUBLE)
           AS cumulative_revenue
FROM m ORDER BY order_month""")

Q["ds_exceptions"] = mart_sql("""
SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_delivered_customer_date,
       order_estimated_delivery_date, delivery_delay_days
FROM m_fact_orders WHERE late_deliveries ORDER BY delivery_delay_days DESC, order_id""")

_STATE_MATRIX = f"""SELECT customer_state, {msum('COALESCE(order_value, 0.0)')} AS revenue,
       COUNT(DISTINCT order_id) AS orders,
       CAST(SUM(CAST(order_value AS {DEC})) AS DOUBLE) / CAST(COUNT(order_value) AS DOUBLE) AS average_order_value,
       ROUND(AVG(CAST(late_deliveries AS DOUBLE)), 4) AS late_delivery_rate,
       ROUND(AVG(delivery_delay_days), 4) AS average_delay_days
FROM {_WITH_STATE} GROUP BY customer_state"""

Q["ds_state_matrix"] = mart_sql(_STATE_MATRIX + " ORDER BY revenue DESC NULLS LAST, customer_state")

Q["ds_state_leaders"] = mart_sql(f"""
, sm AS ({_STATE_MATRIX})
SELECT (SELECT customer_state FROM sm ORDER BY revenue DESC NULLS FIRST, customer_state LIMIT 1) AS top_revenue_state,
       (SELECT customer_state FROM sm ORDER BY orders DESC NULLS FIRST, customer_state LIMIT 1) AS top_orders_state,
       (SELECT customer_state FROM sm ORDER BY average_delay_days DESC NULLS LAST, customer_state LIMIT 1)
           AS top_delay_state""")

Q["ds_drilldown_rollup"] = mart_sql(f"""
SELECT c.customer_state, i.{_CAT} AS category, i.seller_id, {msum('i.revenue')} AS revenue,
       COUNT(i.order_item_id) AS items,
       CAST(GROUPING(c.customer_state, i.{_CAT}, i.seller_id) AS BIGINT) AS grouping_level
FROM m_fact_order_items i
LEFT JOIN (SELECT customer_id AS cid, customer_state FROM m_dim_customers) c ON i.customer_id = c.cid
GROUP BY ROLLUP (c.customer_state, i.{_CAT}, i.seller_id)""")

_ = with_ctes  # re-exported helper kept for symmetry with other oracle modules

Q["ds_top_categories_by_units"] = mart_sql(f"""
SELECT {_CAT} AS category, COUNT(order_item_id) AS units_sold, {msum('revenue')} AS revenue,
       COUNT(DISTINCT order_id) AS orders
FROM m_fact_order_items WHERE {_CAT} IS NOT NULL GROUP BY 1
ORDER BY units_sold DESC, revenue DESC NULLS LAST, category LIMIT 10""")

Q["ds_customer_points"] = mart_sql("""
SELECT customer_id, total_orders, order_frequency_days, customer_revenue FROM m_dim_customers WHERE total_orders > 0""")

Q["ds_customer_points_sample"] = mart_sql("""
SELECT * FROM (SELECT customer_id, total_orders, order_frequency_days, customer_revenue,
                      CASE WHEN total_orders > 1 THEN 'repeat' ELSE 'one_time' END AS segment
               FROM m_dim_customers WHERE total_orders > 0)
QUALIFY ROW_NUMBER() OVER (PARTITION BY segment ORDER BY md5(customer_id), customer_id) <= 200""")

Q["ds_city_volume"] = mart_sql(f"""
SELECT c.customer_state, c.customer_city, COUNT(DISTINCT f.order_id) AS orders,
       {msum('COALESCE(f.order_value, 0.0)')} AS revenue
FROM m_fact_orders f JOIN (SELECT customer_id AS cid, customer_state, customer_city FROM m_dim_customers) c
  ON f.customer_id = c.cid
GROUP BY c.customer_state, c.customer_city HAVING COUNT(DISTINCT f.order_id) >= 20
ORDER BY revenue DESC, c.customer_state, c.customer_city""")

Q["ds_seller_concentration"] = mart_sql(f"""
, s AS (SELECT seller_id, SUM(CAST(revenue AS {DEC})) AS rev FROM m_fact_order_items
        WHERE seller_id IS NOT NULL GROUP BY seller_id),
t AS (SELECT SUM(rev) AS total FROM s)
SELECT seller_id, CAST(rev AS DOUBLE) AS revenue,
       ROUND(CAST(rev AS DOUBLE) / NULLIF(CAST(t.total AS DOUBLE), 0), 4) AS revenue_share,
       ROUND(CAST(SUM(rev) OVER (ORDER BY rev DESC NULLS LAST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             AS DOUBLE) / NULLIF(CAST(t.total AS DOUBLE), 0), 4) AS cumulative_share,
       CAST(RANK() OVER (ORDER BY CAST(rev AS DOUBLE) DESC NULLS LAST) AS INTEGER) AS revenue_rank
FROM s, t""")
