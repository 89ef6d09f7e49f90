"""Raw (all-text, faulty) marketplace tables derived from the retail views.

The cleaning pipelines expect what a CSV export looks like: every column text, missing-value
tokens, unparsable numbers and dates, misspelt headers, zip codes with a '.0' suffix and
duplicate keys. These projections derive such tables from the driver data by key
arithmetic, so they grow with the data. Each projection is SQL expression text accepted by
both Spark and DuckDB (the oracle builds the same tables from the same text).

``source_row_order`` is the position a row would have in the source file: 0 for the original row,
1 for an appended duplicate; keep-first de-duplication orders by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from souk.sources.fixtures import LazyTables, RetailTables, load_retail


@dataclass(frozen=True)
class RawSpec:
    source: str                 # retail view the raw table derives from
    select: tuple[str, ...]     # 'expression AS name' items
    dup_where: str | None = None
    dup_override: tuple[tuple[str, str], ...] = ()


def _ts(col: str) -> str:
    return f"CAST({col} AS STRING) AS {col}"


RAW_SPECS: dict[str, RawSpec] = {
    "customers": RawSpec(
        "customers",
        (
            "CAST(customer_id AS STRING) AS customer_id",
            "CAST(customer_unique_id AS STRING) AS customer_unique_id",
            "CASE WHEN customer_id % 7 = 0 THEN NULL WHEN customer_id % 5 = 0 "
            "THEN customer_zip_code_prefix || '.0' ELSE customer_zip_code_prefix END AS customer_zip_code_prefix",
            "CASE WHEN customer_id % 11 = 0 THEN 'NA' WHEN customer_id % 13 = 0 THEN 'n/a' "
            "WHEN customer_id % 17 = 0 THEN NULL ELSE customer_city END AS customer_city",
            "CASE WHEN customer_id % 19 = 0 THEN 'null' ELSE customer_state END AS customer_state",
        ),
        "customer_id % 23 = 0",
        (("customer_city", "'ZZ-DUPLICATE'"),),
    ),
    "geolocation": RawSpec(
        "geolocation",
        (
            "CASE WHEN geolocation_lat = 1 THEN geolocation_zip_code_prefix || '.0' "
            "ELSE geolocation_zip_code_prefix END AS geolocation_zip_code_prefix",
            "CASE WHEN geolocation_lat = 13 THEN 'abc' ELSE CAST(geolocation_lat AS STRING) END AS geolocation_lat",
            "CAST(geolocation_lng AS STRING) AS geolocation_lng",
            "CASE WHEN geolocation_lng = 17 THEN NULL ELSE geolocation_city END AS geolocation_city",
            "CASE WHEN geolocation_lng = 19 THEN 'NA' ELSE geolocation_state END AS geolocation_state",
        ),
    ),
    "order_items": RawSpec(
        "order_items",
        (
            "CAST(order_id AS STRING) AS order_id",
            "CAST(order_item_id AS STRING) AS order_item_id",
            "CASE WHEN order_id % 47 = 0 THEN NULL ELSE CAST(product_id AS STRING) END AS product_id",
            "CAST(seller_id AS STRING) AS seller_id",
            "CASE WHEN order_id % 23 = 0 THEN 'bad' ELSE CAST(shipping_limit_date AS STRING) END AS shipping_limit_date",
            "CASE WHEN order_id % 17 = 0 THEN NULL WHEN order_id % 19 = 0 THEN 'abc' "
            "WHEN order_id % 71 = 0 THEN '1.5d' WHEN order_id % 73 = 0 THEN '2f' "
            "ELSE CAST(price AS STRING) END AS price",
            "CASE WHEN order_id % 43 = 0 THEN 'n/a' ELSE CAST(freight_value AS STRING) END AS freight_value",
        ),
    ),
    "order_payments": RawSpec(
        "order_payments",
        (
            "CAST(order_id AS STRING) AS order_id",
            "CAST(payment_sequential AS STRING) AS payment_sequential",
            "CASE WHEN order_id % 13 = 0 THEN NULL ELSE payment_type END AS payment_type",
            "CASE WHEN order_id % 53 = 0 THEN NULL ELSE CAST(payment_installments AS STRING) END AS payment_installments",
            "CASE WHEN order_id % 11 = 0 THEN 'x' ELSE CAST(payment_value AS STRING) END AS payment_value",
        ),
    ),
    "order_reviews": RawSpec(
        "order_reviews",
        (
            "CAST(review_id AS STRING) AS review_id",
            "CASE WHEN review_id % 59 = 0 THEN NULL ELSE CAST(order_id AS STRING) END AS order_id",
            "CASE WHEN review_id % 7 = 0 THEN NULL ELSE CAST(review_score AS STRING) END AS review_score",
            "CASE WHEN review_id % 3 = 0 THEN 'good' WHEN review_id % 5 = 0 THEN 'bad' END AS review_comment_title",
            "CASE WHEN review_id % 4 = 0 THEN 'line one' || chr(10) || 'line \"two\"' END AS review_comment_message",
            _ts("review_creation_date"),
            _ts("review_answer_timestamp"),
        ),
        "review_id % 61 = 0",
        (("review_score", "'1'"),),
    ),
    "orders": RawSpec(
        "orders",
        (
            "CAST(order_id AS STRING) AS order_id",
            "CASE WHEN order_id % 37 = 0 THEN NULL ELSE CAST(customer_id AS STRING) END AS customer_id",
            "CASE WHEN order_id % 29 = 0 THEN NULL ELSE order_status END AS order_status",
            "CASE WHEN order_id % 31 = 0 THEN 'bad' ELSE CAST(order_purchase_timestamp AS STRING) END "
            "AS order_purchase_timestamp",
            _ts("order_approved_at"),
            _ts("order_delivered_carrier_date"),
            _ts("order_delivered_customer_date"),
            _ts("order_estimated_delivery_date"),
        ),
        "order_id % 41 = 0",
        (("order_status", "'ZZ-DUPLICATE'"),),
    ),
    "products": RawSpec(
        "products",
        (
            "CAST(product_id AS STRING) AS product_id",
            "CASE WHEN product_id % 11 = 0 THEN NULL ELSE product_category_name END AS product_category_name",
            "CAST(product_name_length AS STRING) AS product_name_lenght",
            "CAST(LENGTH(product_category_name) * 10 AS STRING) AS product_description_lenght",
            "CAST(product_id % 4 AS STRING) AS product_photos_qty",
            "CASE WHEN product_id % 13 = 0 THEN 'n/a' WHEN product_id % 17 = 0 THEN NULL "
            "WHEN product_id % 19 = 0 THEN '0x1p3' "
            "ELSE CAST(product_weight_g AS STRING) END AS product_weight_g",
            "CAST(product_length_cm AS STRING) AS product_length_cm",
            "CAST(product_height_cm AS STRING) AS product_height_cm",
            "CAST(product_width_cm AS STRING) AS product_width_cm",
            "CAST(unit_cost AS STRING) AS unit_cost",
        ),
        "product_id % 67 = 0",
        (("product_category_name", "'ZZ-DUPLICATE'"),),
    ),
    "sellers": RawSpec(
        "sellers",
        (
            "CAST(seller_id AS STRING) AS seller_id",
            "CASE WHEN seller_id % 7 = 0 THEN NULL WHEN seller_id % 3 = 0 THEN seller_zip_code_prefix || '.0' "
            "ELSE seller_zip_code_prefix END AS seller_zip_code_prefix",
            "CASE WHEN seller_id % 5 = 0 THEN 'NA' ELSE seller_city END AS seller_city",
            "CASE WHEN seller_id % 4 = 0 THEN NULL ELSE seller_state END AS seller_state",
        ),
        "seller_id % 9 = 0",
        (("seller_city", "'ZZ-DUPLICATE'"),),
    ),
    "category_translation": RawSpec(
        "category_translation",
        (
            "product_category_name",
            "CASE WHEN product_category_name = 'LARGE' THEN NULL ELSE product_category_name_english END "
            "AS product_category_name_english",
        ),
        "product_category_name = 'SMALL'",
        (("product_category_name_english", "'ZZ-DUPLICATE'"),),
    ),
}


def _alias(expr: str) -> str:
    return expr.rsplit(" AS ", 1)[-1].strip() if " AS " in expr else expr.strip()


def raw_select(spec: RawSpec, duplicate: bool) -> list[str]:
    items = list(spec.select)
    if duplicate:
        override = dict(spec.dup_override)
        items = [f"{override[_alias(e)]} AS {_alias(e)}" if _alias(e) in override else e for e in items]
    items.append(f"CAST({1 if duplicate else 0} AS BIGINT) AS source_row_order")
    return items


def raw_sql(name: str, view_prefix: str = "r_") -> str:
    """The raw table as SQL over ``{view_prefix}{source}`` (used by the oracle)."""
    spec = RAW_SPECS[name]
    src = f"{view_prefix}{spec.source}"
    sql = f"SELECT {', '.join(raw_select(spec, False))} FROM {src}"
    if spec.dup_where:
        sql += f" UNION ALL SELECT {', '.join(raw_select(spec, True))} FROM {src} WHERE {spec.dup_where}"
    return sql


def raw_table(tables: RetailTables, name: str) -> DataFrame:
    spec = RAW_SPECS[name]
    src = tables[spec.source]
    df = src.selectExpr(*raw_select(spec, False))
    if spec.dup_where:
        df = df.unionByName(src.where(spec.dup_where).selectExpr(*raw_select(spec, True)))
    return df


def raw_from_retail(tables: RetailTables) -> LazyTables:
    return LazyTables({name: (lambda name=name: raw_table(tables, name)) for name in RAW_SPECS})


def load_raw(spark: SparkSession, sf_dir: str) -> LazyTables:
    """The nine raw tables over the driver data in ``sf_dir``."""
    return raw_from_retail(load_retail(spark, sf_dir))
