"""Retail views over the driver tables, as DuckDB SQL CTE bodies.

The driver registers its Parquet tables under their own names (``orders``, ``customer``,
...). The retail views therefore get an ``r_`` prefix so nothing is shadowed.
"""

from __future__ import annotations

RETAIL_VIEWS: dict[str, str] = {
    "r_order_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
               CASE WHEN l_orderkey % 97 = 0 THEN CAST(l_extendedprice + 1 AS DECIMAL(18,2))
                    ELSE CAST(l_quantity * (1 + l_tax * 100) AS DECIMAL(18,2)) END AS freight_value
        FROM lineitem""",
    "r_orders": """
        SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
               CASE WHEN o.o_orderstatus = 'F' THEN 'delivered' WHEN o.o_orderstatus = 'O' THEN 'shipped'
                    WHEN o.o_orderkey % 2 = 0 THEN 'processing' ELSE 'canceled' END AS order_status,
               o.o_orderdate AS order_purchase_timestamp,
               CASE WHEN o.o_orderkey % 50 = 0 THEN NULL
                    ELSE o.o_orderdate + (1 + o.o_orderkey % 30) * INTERVAL '1' HOUR END AS order_approved_at,
               CASE WHEN o.o_orderkey % 20 = 0 THEN NULL
                    ELSE o.o_orderdate + (2 + o.o_orderkey % 10) * INTERVAL '1' DAY END AS order_delivered_carrier_date,
               CASE WHEN o.o_orderkey % 20 = 0 THEN NULL
                    ELSE o.o_orderdate + (5 + o.o_orderkey % 60) * INTERVAL '1' DAY
                         + (o.o_orderkey % 24) * INTERVAL '1' HOUR END AS order_delivered_customer_date,
               o.o_orderdate + (20 + o.o_orderkey % 40) * INTERVAL '1' DAY AS order_estimated_delivery_date
        FROM orders o""",
    "r_customers": """
        SELECT c_custkey AS customer_id, CAST(FLOOR(c_custkey / 2.0) AS BIGINT) AS customer_unique_id,
               CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix,
               n_name AS customer_city, r_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        UNION ALL
        SELECT c_custkey + 10000000, c_custkey + 10000000, '99999', 'NOWHERE', 'NONE'
        FROM customer WHERE c_custkey < 10""",
    "r_sellers": """
        SELECT s_suppkey AS seller_id, CAST(s_nationkey AS VARCHAR) AS seller_zip_code_prefix,
               n_name AS seller_city, r_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        UNION ALL
        SELECT s_suppkey + 10000000, '99999', 'NOWHERE', 'NONE' FROM supplier WHERE s_suppkey < 3""",
    "r_products": """
        SELECT p_partkey AS product_id, p_type AS product_category_name,
               CAST(LENGTH(p_name) AS DOUBLE) AS product_name_length,
               CAST(p_size * 50 AS DOUBLE) AS product_weight_g,
               CAST(p_size AS DOUBLE) AS product_length_cm,
               CAST(p_size % 7 AS DOUBLE) AS product_height_cm,
               CAST(1 + p_size % 5 AS DOUBLE) AS product_width_cm,
               CAST(p_retailprice AS DECIMAL(18,2)) AS unit_cost
        FROM part""",
    "r_category_translation": """
        SELECT DISTINCT p_type AS product_category_name, lower(p_type) || ' goods' AS product_category_name_english
        FROM part WHERE p_type <> 'PROMO'""",
    "r_order_payments": """
        SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential, l_returnflag AS payment_type,
               CAST(1 + l_quantity % 10 AS INT) AS payment_installments,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS payment_value
        FROM lineitem
        UNION ALL
        SELECT o_orderkey, 0, 'voucher', 1, CAST(o_totalprice AS DECIMAL(18,2)) FROM orders WHERE o_orderkey % 3 = 0""",
    "r_order_reviews": """
        SELECT event_id AS review_id, CAST(FLOOR(event_id / 2.0) AS BIGINT) AS order_id,
               1 + event_id % 5 AS review_score, ts AS review_creation_date,
               ts + INTERVAL '1' DAY AS review_answer_timestamp
        FROM events""",
    "r_geolocation": """
        SELECT CAST(c_nationkey AS VARCHAR) AS geolocation_zip_code_prefix,
               CAST(c_custkey % 90 AS DOUBLE) AS geolocation_lat, CAST(c_custkey % 180 AS DOUBLE) AS geolocation_lng,
               c_mktsegment AS geolocation_city, r_name AS geolocation_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
}

# The lookup's SQL-pack name points at the same rows.
RETAIL_VIEWS["r_product_category_name_translation"] = "SELECT * FROM r_category_translation"


def with_ctes(body: str, *ctes: tuple[str, str] | str, views: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs.

    ``ctes`` items are view names from ``views`` (default: the retail views) or explicit
    ``(name, sql)`` pairs; order is kept, so list dependencies first.
    """
    catalog = RETAIL_VIEWS if views is None else views
    parts = []
    for item in ctes:
        if isinstance(item, tuple):
            name, sql = item
        else:
            name, sql = item, catalog[item]
        parts.append(f"{name} AS ({sql})")
    return "WITH " + ",\n".join(parts) + "\n" + body
