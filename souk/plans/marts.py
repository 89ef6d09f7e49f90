"""Feature marts: fact_orders, fact_order_items, dim_customers, dim_products, dim_sellers,
monthly_revenue and customer_kpis, built from the cleaned tables.

Semantics follow the pandas workflow (NULL group keys dropped, sums of nothing are 0, NaN
comparisons are False) with the decisions recorded in the README for the places where the
original code cannot run as written (duplicate ``total_orders`` columns, a never-firing
payment fallback, a double seller merge).

Plan shape: every fact is reduced to the grain it is joined at *before* the join (items,
payments and reviews to orders; orders to customers), so each join is key-to-key and no
row is multiplied. Money is summed as exact decimals; averages are exact sum / count.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.dates import days_between, hours_between, is_weekend, month_key, weekday_name, whole_days_floor
from souk.operators import clean as op

SUM_TYPE = "decimal(22,4)"

# Candidate cost and category columns, in order of preference.
COST_COLUMNS = ("unit_cost", "product_cost", "estimated_cost", "cost_price")
CATEGORY_COLUMNS = ("product_category_name_english", "product_category_name", "category_english", "category")

REQUIRED_TABLES = (
    "orders", "order_items", "customers", "products", "sellers", "order_payments", "order_reviews",
    "category_translation",
)


def exact_sum(col: Column | str) -> Column:
    """Sum as an exact decimal, returned as DOUBLE; NULL when there is no value."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast(SUM_TYPE)).cast("double")


def exact_mean(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.try_divide(F.sum(c.cast(SUM_TYPE)).cast("double"), F.count(c).cast("double"))


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


# ----------------------------------------------------------------------------- order-grain parts
def order_item_summary(order_items: DataFrame) -> DataFrame:
    """Order grain: item counts and sums, distinct products and sellers. Sums have map-side sums
    and distinct pairs are counted, so no task gathers the products of a large order; of items
    that lie in buckets by order nothing is shuffled."""

    def distinct(column: str, name: str) -> DataFrame:
        pairs = order_items.select("order_id", column).where(F.col(column).isNotNull()).distinct()
        return pairs.groupBy("order_id").agg(F.count(F.lit(1)).alias(name))

    price = F.sum(F.col("price").cast(SUM_TYPE)).cast("double")
    sums = order_items.groupBy("order_id").agg(
        F.count("order_item_id").alias("total_items"),
        price.alias("gross_item_value"),
        F.sum(F.col("freight_value").cast(SUM_TYPE)).cast("double").alias("gross_freight_value"),
        F.try_divide(price, F.count("price").cast("double")).alias("average_item_price"),
    )
    counted = sums.join(distinct("product_id", "unique_products"), "order_id", "left")
    counted = counted.join(distinct("seller_id", "unique_sellers"), "order_id", "left")
    return counted.select(
        "order_id", "total_items", F.coalesce("unique_products", F.lit(0)).alias("unique_products"),
        F.coalesce("unique_sellers", F.lit(0)).alias("unique_sellers"),
        "gross_item_value", "gross_freight_value", "average_item_price",
    )


def payment_summary(payments: DataFrame) -> DataFrame:
    """Order grain: payment total, installments, distinct types and the most frequent type
    (ties -> smallest, none -> 'Unknown'). Two aggregates, no join: (order, type) first,
    then order — so the mode needs no per-order value map."""
    per_type = payments.groupBy("order_id", "payment_type").agg(
        F.sum(F.col("payment_value").cast(SUM_TYPE)).alias("_value"),
        F.sum("payment_installments").alias("_installments"),
        F.count(F.lit(1)).alias("_n"),
    )
    typed = F.col("payment_type").isNotNull()
    best = F.min(F.when(typed, F.struct((-F.col("_n")).alias("k"), F.col("payment_type").alias("v"))))
    return per_type.groupBy("order_id").agg(
        F.sum("_value").cast("double").alias("total_payment_value"),
        F.sum("_installments").alias("total_installments"),
        F.count("payment_type").alias("payment_method_count"),
        F.coalesce(best["v"], F.lit("Unknown")).alias("dominant_payment_type"),
    )


def review_summary(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        exact_mean("review_score").alias("average_review_score"),
        F.count("review_id").alias("review_count"),
        F.max("review_answer_timestamp").alias("review_answer_timestamp"),
    )


# ----------------------------------------------------------------------------- customer-grain parts
def customer_base(order_base: DataFrame) -> DataFrame:
    """customer_id -> first/last order, total_orders, whole days between, and the exact item and
    payment totals of the customer's orders (NULL where no order has such rows)."""
    per_customer = order_base.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.min("order_purchase_timestamp").alias("first_order_date"),
        F.max("order_purchase_timestamp").alias("last_order_date"),
        F.count("order_id").alias("total_orders"),  # one row per order
        F.sum(F.col("gross_item_value").cast(SUM_TYPE)).alias("item_total"),
        F.sum(F.col("total_payment_value").cast(SUM_TYPE)).alias("payment_total"),
    )
    span = whole_days_floor("first_order_date", "last_order_date")
    return per_customer.withColumn("customer_span_days", span)


# ----------------------------------------------------------------------------- product / seller parts
def product_features(products: DataFrame, category_translation: DataFrame) -> DataFrame:
    df = op.rename_columns(op.lower_trim_names(products), op.PRODUCT_RENAMES)
    df = op.coerce_numeric(
        df,
        [c for c in ("product_name_length", "product_description_length", "product_photos_qty",
                     "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")],
    )

    def dim(c: str) -> Column:
        return F.col(c) if c in df.columns else F.lit(0.0)

    volume = dim("product_length_cm") * dim("product_height_cm") * dim("product_width_cm")
    df = df.withColumn("product_volume_cm3", volume)
    df = df.withColumn(
        "product_density_g_per_cm3",
        F.when(F.col("product_volume_cm3") != 0, F.col("product_weight_g") / F.col("product_volume_cm3")),
    )
    df = df.withColumn("is_lightweight", F.coalesce(F.col("product_weight_g") <= 1000, F.lit(False)))
    translation = op.lower_trim_names(category_translation)
    return df.join(translation, "product_category_name", "left")


def seller_metrics(order_items: DataFrame) -> DataFrame:
    return order_items.groupBy("seller_id").agg(
        F.count("order_id").alias("seller_items"),
        F.count_distinct("order_id").alias("seller_unique_orders"),
        exact_sum("price").alias("seller_revenue"),
        exact_sum("freight_value").alias("seller_freight"),
    )


def profit_margin(df: DataFrame, price: str = "price") -> Column:
    """(price - cost) / price per row when a cost column exists, else NULL."""
    cost_col = op.first_present(df.columns, COST_COLUMNS)
    if cost_col is None:
        return F.lit(None).cast("double")
    revenue = F.coalesce(F.col(price).cast("double"), F.lit(0.0))
    cost = F.coalesce(F.expr(f"try_cast(`{cost_col}` AS DOUBLE)"), F.lit(0.0))
    return F.when(revenue != 0, (revenue - cost) / revenue)


# ----------------------------------------------------------------------------- marts
ORDER_DERIVED = (
    "order_value", "average_order_value", "delivery_time_days", "approval_time_hours", "delivery_delay_days",
    "order_month", "month", "quarter", "year", "weekday", "is_weekend_order", "late_deliveries", "monthly_revenue",
)


def order_sums(orders, order_items, payments, reviews) -> DataFrame:
    """One row per order with its item, payment and review sums."""
    return (
        orders.join(order_item_summary(order_items), "order_id", "left")
        .join(payment_summary(payments), "order_id", "left")
        .join(review_summary(reviews), "order_id", "left")
    )


def with_order_columns(df: DataFrame) -> DataFrame:
    """All that depends on the order row alone; a month that is there stays, so that filters on it
    reach stored months."""
    ts = F.col("order_purchase_timestamp")
    delay = days_between("order_estimated_delivery_date", "order_delivered_customer_date")
    return df.withColumns({
        "order_value": zero_if_null(F.col("gross_item_value")) + zero_if_null(F.col("gross_freight_value")),
        "delivery_time_days": days_between("order_purchase_timestamp", "order_delivered_customer_date"),
        "approval_time_hours": hours_between("order_purchase_timestamp", "order_approved_at"),
        "delivery_delay_days": delay,
        "late_deliveries": delay > 0,
        "order_month": F.col("order_month") if "order_month" in df.columns else month_key(ts),
        "month": F.month(ts).cast("bigint"),
        "quarter": F.quarter(ts).cast("bigint"),
        "year": F.year(ts).cast("bigint"),
        "weekday": weekday_name(ts),
        "is_weekend_order": is_weekend(ts),
    })


def order_base(orders, order_items, payments, reviews) -> DataFrame:
    """``order_sums`` with all that depends on the order alone."""
    return with_order_columns(order_sums(orders, order_items, payments, reviews))


def with_customer_columns(df: DataFrame) -> DataFrame:
    """The order's columns, and what they and its customer's sums give."""
    by_customer, revenue = F.col("total_orders"), F.col("customer_revenue")
    df = with_order_columns(df)
    return df.withColumns({
        "average_order_value_customer": F.when(by_customer > 0, revenue / by_customer),
        "total_orders_by_customer": by_customer,
        "average_order_value": F.when(by_customer > 0, revenue / by_customer).otherwise(F.col("order_value")),
    })


def fact_orders_from(base: DataFrame, customers: DataFrame, monthly: DataFrame, by_month: bool = False) -> DataFrame:
    """The order rows (``order_sums``) with their customer's history and their month's revenue.
    Months are few rows and joined on the month key: a window over months would sort the fact
    table. With ``by_month`` rows of a month meet in few tasks (a large month is split again by
    size). Columns that follow from others come last, so no shuffle carries them."""
    context = customers.select(
        "customer_id", "first_order_date", "last_order_date", "total_orders", "customer_span_days",
        F.coalesce("item_total", F.lit(0)).cast("double").alias("customer_revenue"),
    )
    months = monthly.where(F.col("order_month").isNotNull()).select("order_month", "monthly_revenue")
    df = base.drop(*ORDER_DERIVED).join(context, "customer_id", "left")
    df = df.withColumn("order_month", month_key("order_purchase_timestamp"))
    df = df.hint("rebalance", "order_month") if by_month else df
    first = [c for c in (*base.columns, *context.columns[1:]) if c not in ORDER_DERIVED]
    df = with_customer_columns(df.join(F.broadcast(months), "order_month", "left"))
    return df.select(*first, "average_order_value_customer", "total_orders_by_customer", *ORDER_DERIVED)


def build_fact_orders(orders, order_items, payments, reviews) -> DataFrame:
    base = order_base(orders, order_items, payments, reviews)
    return fact_orders_from(base, customer_base(base), build_monthly_revenue(base))


def with_item_columns(df: DataFrame) -> DataFrame:
    """All that depends on the item row alone."""
    price, freight, total = F.col("price"), F.col("freight_value"), F.col("item_total_value")
    df = df.withColumn("item_total_value", zero_if_null(price) + zero_if_null(freight))
    df = df.withColumns({
        "freight_share": F.when(total != 0, freight / total),
        "high_freight_flag": F.coalesce(freight > price, F.lit(False)),
        "revenue": total,
        "weekend_order": is_weekend("order_purchase_timestamp"),
    })
    return df.withColumn("profit_margin", profit_margin(df))


#: Columns of fact_order_items that its other columns give.
ITEM_DERIVED = (
    "item_total_value", "freight_share", "high_freight_flag", "revenue", "weekend_order", "profit_margin",
)


def fact_order_items_from(order_items, orders, product_base, dim_sellers) -> DataFrame:
    """Item rows with their order, their product's features and their seller's sums. Columns that
    follow from others come last, so no shuffle carries them."""
    order_part = orders.select("order_id", "customer_id", "order_purchase_timestamp", "order_status")
    df = (
        order_items.join(order_part, "order_id", "left")
        .join(product_base, "product_id", "left")
        .join(dim_sellers, "seller_id", "left")
    )
    own = ["seller_id", "product_id", "order_id"]
    own += [c for c in order_items.columns if c not in own]
    rest = [c for c in df.columns if c not in own]
    early, late = ITEM_DERIVED[:3], ITEM_DERIVED[3:]
    return with_item_columns(df).select(*own, *early, *rest, *late)


def dim_customers_from(customers: DataFrame, base: DataFrame) -> DataFrame:
    """Every customer with their orders; revenue falls back to payments without item rows."""
    revenue = F.coalesce("item_total", "payment_total", F.lit(0)).cast("double")
    summary = base.select(
        "customer_id", "first_order_date", "last_order_date", "total_orders", "customer_span_days",
        revenue.alias("customer_revenue"),
    )
    df = customers.join(summary, "customer_id", "left")
    n = F.coalesce(F.col("total_orders"), F.lit(0)).cast("bigint")
    df = df.withColumn("total_orders", n)
    return df.withColumns({
        "repeat_customer": n > 1,
        "revenue_per_customer": F.when(n > 0, F.col("customer_revenue") / n).otherwise(F.lit(0.0)),
        "order_frequency_days": F.when(n > 1, F.col("customer_span_days") / (n - 1)),
        "clv_approx": zero_if_null(F.col("customer_revenue")),
    }).withColumn("customer_lifetime_value", F.col("clv_approx"))


def build_dim_customers(customers, orders, order_items, payments) -> DataFrame:
    base = orders.join(order_item_summary(order_items), "order_id", "left")
    return dim_customers_from(customers, customer_base(base.join(payment_summary(payments), "order_id", "left")))


def dim_products_from(product_base: DataFrame, order_items: DataFrame) -> DataFrame:
    metrics = order_items.groupBy("product_id").agg(
        F.count("order_id").alias("product_units_sold"),
        exact_sum("price").alias("product_revenue"),
        exact_sum("freight_value").alias("product_freight"),
    )
    return product_base.join(metrics, "product_id", "left")


def build_dim_sellers(sellers, order_items) -> DataFrame:
    return op.lower_trim_names(sellers).join(seller_metrics(order_items), "seller_id", "left")


def build_monthly_revenue(fact_orders: DataFrame) -> DataFrame:
    op.require_columns(fact_orders, ["order_purchase_timestamp"], "fact_orders")
    return (
        fact_orders.where(F.col("order_purchase_timestamp").isNotNull())
        .groupBy(month_key("order_purchase_timestamp").alias("order_month"))
        .agg(
            F.sum(F.col("order_value").cast(SUM_TYPE)).cast("double").alias("monthly_revenue"),
            F.count("order_id").alias("orders_in_month"),  # one fact row per order
            exact_mean("order_value").alias("average_order_value"),
        )
        .orderBy("order_month")
    )


CUSTOMER_KPI_COLUMNS = (
    "customer_id", "customer_unique_id", "total_orders", "repeat_customer", "revenue_per_customer",
    "order_frequency_days", "customer_lifetime_value", "clv_approx",
)


def build_customer_kpis(dim_customers: DataFrame) -> DataFrame:
    return dim_customers.select(*CUSTOMER_KPI_COLUMNS)


@dataclass
class FeatureBundle:
    fact_orders: DataFrame
    fact_order_items: DataFrame
    dim_customers: DataFrame
    dim_products: DataFrame
    dim_sellers: DataFrame
    monthly_revenue: DataFrame
    customer_kpis: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def build_feature_bundle(cleaned: dict[str, DataFrame]) -> FeatureBundle:
    """All seven marts as lazy DataFrames over the cleaned tables. ``plans.layers`` builds them
    from written intermediate tables instead."""
    op.require_tables(cleaned, REQUIRED_TABLES)
    c = cleaned
    base = order_base(c["orders"], c["order_items"], c["order_payments"], c["order_reviews"])
    by_customer = customer_base(base)
    monthly = build_monthly_revenue(base)
    products = product_features(c["products"], c["category_translation"])
    dim_sellers = build_dim_sellers(c["sellers"], c["order_items"])
    dim_customers = dim_customers_from(c["customers"], by_customer)
    return FeatureBundle(
        fact_orders=fact_orders_from(base, by_customer, monthly),
        fact_order_items=fact_order_items_from(c["order_items"], c["orders"], products, dim_sellers),
        dim_customers=dim_customers,
        dim_products=dim_products_from(products, c["order_items"]),
        dim_sellers=dim_sellers,
        monthly_revenue=monthly,
        customer_kpis=build_customer_kpis(dim_customers),
    )
