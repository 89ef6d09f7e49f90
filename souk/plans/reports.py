"""The SQL report pack (average order value, customers, cohorts, growth, delivery, monthly
KPIs, products, regions, revenue, sellers, top customers, top products) as DataFrame plans.

Each report keeps the SQL semantics of its original statement (SQL NULL handling, inner vs
left joins, ``COUNT(*)`` vs ``COUNT(col)``), but is planned for scale:

* item, payment and review facts are aggregated to the order grain *before* they meet the
  order table, so joins are order-to-order (no fan-out, one shuffle per side, partial
  aggregation map-side);
* dimension joins happen after the facts are reduced, so the dimension side is joined to a
  table of at most one row per key;
* global windows (``LAG``, ``RANK``) run only on month-grain results or through the
  range-bucketed rank in ``souk.operators.ranking``.

Money sums are exact decimals and leave as DOUBLE; averages are ``round(sum/count, 4)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.dates import days_between, month_start, whole_days_trunc
from souk.functions.numeric import avg4, ratio, round_to, to_double
from souk.operators.ranking import descending, global_rank, top_n
from souk.session import written
from souk.sources.fixtures import RetailTables

# Order statuses the SQL pack counts as live business.
ACTIVE_STATUSES = ("delivered", "shipped", "invoiced", "processing", "approved")


def active_orders(orders: DataFrame, statuses: tuple[str, ...] | None = ACTIVE_STATUSES) -> DataFrame:
    """Orders whose status is in ``statuses`` (``None`` keeps every order)."""
    if statuses is None:
        return orders
    return orders.where(F.col("order_status").isin(*statuses))


def order_item_totals(order_items: DataFrame) -> DataFrame:
    """Order grain: price, freight and gross sums plus the number of item rows."""
    return order_items.groupBy("order_id").agg(
        F.sum("price").alias("item_revenue"),
        F.sum("freight_value").alias("freight_revenue"),
        F.sum(F.col("price") + F.col("freight_value")).alias("gross_revenue"),
        F.count(F.lit(1)).alias("items_in_order"),
    )


# --------------------------------------------------------------------------------------
# Q1 average order value by month
# --------------------------------------------------------------------------------------
def average_order_value(t: RetailTables) -> DataFrame:
    items = t.order_items.groupBy("order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("order_value")
    )
    per_order = (
        active_orders(t.orders)
        .select("order_id", month_start("order_purchase_timestamp").alias("order_month"))
        .join(items, "order_id", "left")
    )
    return (
        per_order.groupBy("order_month")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            to_double(F.sum("order_value")).alias("revenue"),
            avg4("order_value").alias("average_order_value"),
        )
        .orderBy("order_month")
    )


# --------------------------------------------------------------------------------------
# Q2 customer analytics (person = customer_unique_id)
# --------------------------------------------------------------------------------------
def customer_orders(t: RetailTables, statuses=ACTIVE_STATUSES) -> DataFrame:
    """One row per live order with its customer keys and item revenue (0 without items)."""
    items = t.order_items.groupBy("order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("order_revenue")
    )
    customers = t.customers.select("customer_id", "customer_unique_id")
    return (
        active_orders(t.orders, statuses)
        .select("order_id", "customer_id", "order_purchase_timestamp", "order_status")
        .join(customers, "customer_id", "inner")
        .join(items, "order_id", "left")
        .withColumn("order_revenue", F.coalesce("order_revenue", F.lit(0).cast("decimal(18,2)")))
    )


def customer_analytics(t: RetailTables, person_key: str = "customer_unique_id") -> DataFrame:
    life = customer_orders(t).groupBy(person_key).agg(
        F.min("order_purchase_timestamp").alias("first_order_date"),
        F.max("order_purchase_timestamp").alias("last_order_date"),
        F.count("order_id").alias("total_orders"),  # one row per order
        F.sum("order_revenue").alias("total_revenue_dec"),
        avg4("order_revenue").alias("average_order_value"),
    )
    span_days = days_between("first_order_date", "last_order_date")
    orders = F.col("total_orders")
    revenue = to_double("total_revenue_dec")
    return (
        life.select(
            person_key,
            "first_order_date",
            "last_order_date",
            "total_orders",
            revenue.alias("total_revenue"),
            "average_order_value",
            (orders > 1).alias("repeat_customer"),
            F.when(orders > 1, F.try_divide(span_days, (orders - 1).cast("double"))).alias("order_frequency_days"),
            F.when(orders > 0, ratio("total_revenue_dec", orders)).alias("revenue_per_customer"),
            F.when(orders > 0, revenue * (F.lit(1.0) + span_days / F.lit(365.0)))
            .otherwise(revenue)
            .alias("customer_lifetime_value_approx"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_last())
    )


# --------------------------------------------------------------------------------------
# Q3 monthly cohort retention
# --------------------------------------------------------------------------------------
#: A set of months: words of five years each, a bit per month, from January 1970 on.
FIRST_YEAR, WORD_MONTHS, MONTH_WORDS = 1970, 60, 24


def _month_index(ts: str) -> Column:
    """The number of a time's month, from 0 in January 1970."""
    index = (F.year(ts) - FIRST_YEAR) * 12 + F.month(ts) - 1
    beyond = F.concat(F.lit("cohort months run from 1970 to 2089, not to "), F.col(ts).cast("string"))
    held = index.between(0, MONTH_WORDS * WORD_MONTHS - 1) | index.isNull()
    return F.when(held, index).otherwise(F.raise_error(beyond).cast("int"))


def _month_of(index: Column) -> Column:
    zero = F.lit(0)
    year, month = F.floor(index / 12) + FIRST_YEAR, F.pmod(index, F.lit(12)) + 1
    return F.make_timestamp_ntz(year.cast("int"), month.cast("int"), F.lit(1), zero, zero, zero)


def cohort_activity(t: RetailTables, statuses=ACTIVE_STATUSES) -> DataFrame:
    """Distinct (person, cohort month, active month, month number).

    The cohort is the month of a person's first live order. A person's active months are a set of
    bits: orders are or-ed to one row per customer with map-side sums and shuffled once, customers'
    rows are or-ed to their person's, and the months are unfolded from those. Orders without a
    time give one row without a month.
    """
    words = [f"w{i}" for i in range(MONTH_WORDS)]
    starts = [i * WORD_MONTHS for i in range(MONTH_WORDS)]
    ends = [start + WORD_MONTHS - 1 for start in starts]

    def merged(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(key).agg(*[F.expr(f"bit_or({w}) AS {w}") for w in words], F.max("undated").alias("undated"))

    ts = "order_purchase_timestamp"
    orders = active_orders(t.orders, statuses).select("customer_id", _month_index(ts).alias("m"))
    # The month as a bit in one of the words, 0 in all others.
    bit = "CASE WHEN m BETWEEN {0} AND {1} THEN shiftleft(1L, m - {0}) ELSE 0L END AS {2}"
    orders = orders.selectExpr("customer_id", "m IS NULL AS undated", *map(bit.format, starts, ends, words))
    people = t.customers.select("customer_id", "customer_unique_id")
    sets = merged(merged(orders, "customer_id").join(people, "customer_id"), "customer_unique_id")
    lowest = "CASE WHEN {1} <> 0 THEN {0} + bit_count(({1} & -{1}) - 1) END"
    sets = sets.withColumn("cohort", F.expr(f"least({', '.join(map(lowest.format, starts, words))})"))
    bits = F.posexplode(F.array(*words)).alias("word", "bits")
    used = sets.select("customer_unique_id", "cohort", bits).where("bits <> 0")
    set_ = F.filter(
        F.sequence(F.lit(0), F.lit(WORD_MONTHS - 1)),
        lambda k: F.call_function("shiftright", F.col("bits"), k).bitwiseAND(F.lit(1).cast("bigint")) == 1,
    )
    dated = used.select("customer_unique_id", "cohort", "word", F.explode(set_).alias("bit"))
    index = (F.col("word") * WORD_MONTHS + F.col("bit")).alias("month")
    dated = dated.select("customer_unique_id", "cohort", index)
    undated = sets.where("undated").select("customer_unique_id", "cohort", F.lit(None).cast("int").alias("month"))
    return dated.unionByName(undated).select(
        "customer_unique_id",
        _month_of(F.col("cohort")).alias("cohort_month"),
        _month_of(F.col("month")).alias("order_month"),
        (F.col("month") - F.col("cohort")).cast("bigint").alias("month_number"),
    )


def customer_retention(t: RetailTables) -> DataFrame:
    activity = cohort_activity(t)
    # (person, cohort, month_number) is unique in activity, so COUNT(DISTINCT person) = COUNT(*).
    retention = activity.groupBy("cohort_month", "month_number").agg(
        F.count(F.lit(1)).alias("active_customers")
    )
    # cohort_size = persons active in month 0; the retention table has one row per
    # (cohort, month number), so this window works on a month-grain result.
    by_cohort = Window.partitionBy("cohort_month")
    sized = retention.withColumn(
        "cohort_size", F.max(F.when(F.col("month_number") == 0, F.col("active_customers"))).over(by_cohort)
    ).where(F.col("cohort_size").isNotNull())
    return sized.select(
        "cohort_month",
        "month_number",
        "active_customers",
        "cohort_size",
        round_to(ratio("active_customers", "cohort_size"), 4).alias("retention_rate"),
    ).orderBy("cohort_month", "month_number")


# --------------------------------------------------------------------------------------
# Q4 month-over-month growth
# --------------------------------------------------------------------------------------
def monthly_order_revenue(t: RetailTables, statuses=ACTIVE_STATUSES) -> DataFrame:
    items = t.order_items.groupBy("order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("order_value")
    )
    return (
        active_orders(t.orders, statuses)
        .select("order_id", month_start("order_purchase_timestamp").alias("order_month"))
        .join(items, "order_id", "left")
        .groupBy("order_month")
        # orders are keyed by order_id, so at this grain COUNT(order_id) = COUNT(DISTINCT order_id)
        .agg(F.count("order_id").alias("orders"), F.sum("order_value").alias("revenue"))
    )


def growth_rate(t: RetailTables) -> DataFrame:
    monthly = monthly_order_revenue(t)
    # Month-grain input: the un-partitioned window sees one row per month.
    w = Window.orderBy("order_month")
    g = monthly.select(
        "order_month",
        "orders",
        "revenue",
        F.lag("orders").over(w).alias("previous_orders"),
        F.lag("revenue").over(w).alias("previous_revenue"),
    )
    return g.select(
        "order_month",
        "orders",
        to_double("revenue").alias("revenue"),
        round_to(ratio(F.col("orders") - F.col("previous_orders"), "previous_orders"), 4).alias("orders_growth_rate"),
        round_to(ratio(F.col("revenue") - F.col("previous_revenue"), "previous_revenue"), 4).alias("revenue_growth_rate"),
    ).orderBy("order_month")


# --------------------------------------------------------------------------------------
# Q5 late deliveries by month and geography
# --------------------------------------------------------------------------------------
def late_deliveries(t: RetailTables) -> DataFrame:
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    flag = F.when(delivered.isNotNull() & estimated.isNotNull() & (delivered > estimated), 1).otherwise(0)
    metrics = (
        active_orders(t.orders)
        .join(t.customers.select("customer_id", "customer_state", "customer_city"), "customer_id", "inner")
        .select(
            month_start("order_purchase_timestamp").alias("order_month"),
            "customer_state",
            "customer_city",
            flag.alias("late_delivery_flag"),
            whole_days_trunc("order_purchase_timestamp", delivered).alias("delivery_time_days"),
            whole_days_trunc(estimated, delivered).alias("delivery_delay_days"),
        )
    )
    return (
        metrics.groupBy("order_month", "customer_state", "customer_city")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("late_delivery_flag").cast("bigint").alias("late_deliveries"),
            avg4("delivery_time_days").alias("average_delivery_time_days"),
            avg4("delivery_delay_days").alias("average_delay_days"),
            avg4("late_delivery_flag").alias("late_delivery_rate"),
        )
        .orderBy("order_month", F.col("late_delivery_rate").desc_nulls_last())
    )


# --------------------------------------------------------------------------------------
# Q6 monthly KPIs: literal (items x reviews fan-out kept) and fan-out-safe
# --------------------------------------------------------------------------------------
def _monthly_kpis(t: RetailTables, literal: bool) -> DataFrame:
    items = t.order_items.groupBy("order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("item_sum"),
    )
    reviews = t.order_reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("review_rows"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("score_count"),
    )
    delivered = F.col("order_delivered_customer_date")
    flag = F.when(delivered > F.col("order_estimated_delivery_date"), 1).otherwise(0)
    per_order = (
        active_orders(t.orders)
        .select("order_id", "order_purchase_timestamp", delivered, "order_estimated_delivery_date")
        .join(items, "order_id", "left")
        .join(reviews, "order_id", "left")
    )
    if literal:
        # Joining items and reviews on order_id repeats every item once per review row, so the
        # statement's SUM equals item_sum x review rows; the review average is unchanged by the
        # repetition. Computed from the order-grain aggregates, without building the fan-out.
        revenue = F.col("item_sum") * F.greatest(F.coalesce("review_rows", F.lit(0)), F.lit(1))
    else:
        revenue = F.col("item_sum")
    per_order = per_order.select(
        month_start("order_purchase_timestamp").alias("order_month"),
        revenue.alias("order_revenue"),
        F.try_divide(to_double("score_sum"), F.col("score_count")).alias("average_review_score"),
        flag.alias("late_delivery_flag"),
    )
    return (
        per_order.groupBy("order_month")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            to_double(F.sum("order_revenue")).alias("revenue"),
            avg4("order_revenue").alias("average_order_value"),
            avg4("average_review_score").alias("average_review_score"),
            avg4("late_delivery_flag").alias("late_delivery_rate"),
        )
        .orderBy("order_month")
    )


def monthly_kpis(t: RetailTables) -> DataFrame:
    return _monthly_kpis(t, literal=True)


def monthly_kpis_safe(t: RetailTables) -> DataFrame:
    return _monthly_kpis(t, literal=False)


# --------------------------------------------------------------------------------------
# Q7 product analytics / Q12 top products
# --------------------------------------------------------------------------------------
def product_revenue(t: RetailTables) -> DataFrame:
    """Product grain measures with the English category (code when untranslated).

    Items are reduced to one row per product before the product dimension is joined, so
    the join is product-to-product whatever the fact volume. Products are keyed by
    product_id (unique after cleaning).
    """
    per_product = t.order_items.groupBy("product_id").agg(
        F.count_distinct("order_id").alias("orders"),
        F.count(F.lit(1)).alias("units_sold"),
        F.sum("price").alias("revenue_dec"),
        F.sum("freight_value").alias("freight_dec"),
        F.sum("price").alias("_price_sum"),
        F.count("price").alias("_price_count"),
    )
    categories = t.products.select("product_id", "product_category_name").join(
        t.category_translation, "product_category_name", "left"
    )
    return per_product.join(categories, "product_id", "inner").select(
        "product_id",
        F.coalesce("product_category_name_english", "product_category_name").alias("category_english"),
        "orders",
        "units_sold",
        "revenue_dec",
        "freight_dec",
        F.try_divide(to_double("_price_sum"), F.col("_price_count")).alias("average_item_price_raw"),
    )


def product_analytics(t: RetailTables) -> DataFrame:
    products = product_revenue(t)
    return (
        products.groupBy("category_english")
        .agg(
            F.count_distinct("product_id").alias("distinct_products"),
            F.sum("orders").alias("orders"),
            F.sum("units_sold").alias("units_sold"),
            to_double(F.sum("revenue_dec")).alias("product_revenue"),
            to_double(F.sum("freight_dec")).alias("freight_revenue"),
            avg4("average_item_price_raw").alias("average_item_price"),
        )
        .orderBy(F.col("product_revenue").desc_nulls_last(), F.col("units_sold").desc_nulls_last())
    )


def top_products(t: RetailTables, n: int = 100) -> DataFrame:
    products = product_revenue(t).select(
        "product_id",
        "category_english",
        "orders",
        "units_sold",
        to_double("revenue_dec").alias("revenue"),
        to_double("freight_dec").alias("freight_revenue"),
        round_to("average_item_price_raw", 4).alias("average_item_price"),
    )
    order = [F.col("revenue").desc_nulls_last(), F.col("units_sold").desc_nulls_last(), F.col("product_id").asc()]
    # Every product with a larger revenue sorts ahead of a row, so RANK over the first n rows
    # equals RANK over all products; the window then runs on n rows only.
    head = top_n(products, order, n)
    return head.withColumn(
        "revenue_rank", F.rank().over(Window.orderBy(F.col("revenue").desc_nulls_last()))
    ).orderBy(*order)


# --------------------------------------------------------------------------------------
# Q8 regional analytics
# --------------------------------------------------------------------------------------
def regional_analytics(t: RetailTables) -> DataFrame:
    items = t.order_items.groupBy("order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("order_revenue")
    )
    per_order = (
        active_orders(t.orders)
        .select("order_id", "customer_id", month_start("order_purchase_timestamp").alias("month"))
        .join(t.customers.select("customer_id", "customer_state", "customer_city"), "customer_id", "inner")
        .join(items, "order_id", "left")
    )
    # Two-phase instead of two COUNT(DISTINCT ...) in one aggregate (which would Expand rows):
    # months first, then the region; each order is one row at this grain.
    monthly = per_order.groupBy("customer_state", "customer_city", "month").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("order_revenue").alias("revenue"),
        F.count("order_revenue").alias("revenue_rows"),
    )
    return (
        monthly.groupBy("customer_state", "customer_city")
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("revenue").alias("revenue_dec"),
            F.sum("revenue_rows").alias("revenue_rows"),
            F.count("month").alias("active_months"),
        )
        .select(
            "customer_state",
            "customer_city",
            "orders",
            to_double("revenue_dec").alias("revenue"),
            round_to(ratio("revenue_dec", "revenue_rows"), 4).alias("average_order_value"),
            "active_months",
        )
        .orderBy(F.col("revenue").desc_nulls_last(), F.col("orders").desc_nulls_last())
    )


# --------------------------------------------------------------------------------------
# Q9 revenue analysis (pre-aggregated items and payments)
# --------------------------------------------------------------------------------------
def revenue_analysis(t: RetailTables) -> DataFrame:
    items = order_item_totals(t.order_items).select("order_id", "gross_revenue", "items_in_order")
    payments = t.order_payments.groupBy("order_id").agg(F.sum("payment_value").alias("payment_revenue"))
    zero = F.lit(0).cast("decimal(18,2)")
    per_order = (
        active_orders(t.orders)
        .select("order_id", "order_purchase_timestamp")
        .join(items, "order_id", "left")
        .join(payments, "order_id", "left")
        .select(
            "order_id",
            month_start("order_purchase_timestamp").alias("revenue_month"),
            F.coalesce("gross_revenue", zero).alias("gross_revenue"),
            F.coalesce("payment_revenue", zero).alias("payment_revenue"),
            F.coalesce("items_in_order", F.lit(0).cast("bigint")).alias("items_in_order"),
        )
    )
    return (
        per_order.groupBy("revenue_month")
        .agg(
            F.count("order_id").alias("orders"),  # one row per order (orders keyed by order_id)
            to_double(F.sum("gross_revenue")).alias("gross_revenue"),
            to_double(F.sum("payment_revenue")).alias("payment_revenue"),
            avg4("gross_revenue").alias("average_order_value"),
            F.sum("items_in_order").alias("items_sold"),
        )
        .orderBy("revenue_month")
    )


# --------------------------------------------------------------------------------------
# Q10 seller analytics
# --------------------------------------------------------------------------------------
def seller_analytics(t: RetailTables, nulls: str = "last") -> DataFrame:
    """Sellers by revenue. Sellers without sales have none (NULL) and rank last; ``nulls="first"``
    ranks them ahead of all others, as a database does that sorts NULLs first."""
    per_seller_order = t.order_items.groupBy("seller_id", "order_id").agg(
        F.count(F.lit(1)).alias("items_sold"),
        F.sum("price").alias("seller_revenue"),
        F.sum("freight_value").alias("seller_freight"),
    )
    per_seller = per_seller_order.groupBy("seller_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("items_sold").alias("total_items_sold"),
        F.sum("seller_revenue").alias("gross_revenue_dec"),
        F.sum("seller_freight").alias("freight_dec"),
        avg4("seller_revenue").alias("avg_order_revenue"),
    )
    sellers = t.sellers.select("seller_id", "seller_city", "seller_state").join(per_seller, "seller_id", "left")
    result = sellers.select(
        "seller_id",
        "seller_city",
        "seller_state",
        F.coalesce("total_orders", F.lit(0).cast("bigint")).alias("total_orders"),
        "total_items_sold",
        to_double("gross_revenue_dec").alias("gross_revenue"),
        to_double("freight_dec").alias("freight_revenue"),
        "avg_order_revenue",
    )
    ranked = global_rank(written(result, "seller-report"), "gross_revenue", "revenue_rank", descending=True, nulls=nulls)
    return ranked.orderBy(descending("gross_revenue", nulls), descending("total_items_sold", nulls))


# --------------------------------------------------------------------------------------
# Q11 top customers
# --------------------------------------------------------------------------------------
def top_customers(t: RetailTables, n: int = 100, nulls: str = "last") -> DataFrame:
    """The first ``n`` customers by revenue; those without item rows have none (NULL) and come
    last, or first with ``nulls="first"``."""
    items = t.order_items.groupBy("order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("order_revenue")
    )
    per_customer = (
        active_orders(t.orders)
        .select("order_id", "customer_id", "order_purchase_timestamp")
        .join(items, "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),  # one row per order
            F.sum("order_revenue").alias("revenue_dec"),
            F.min("order_purchase_timestamp").alias("first_order_date"),
            F.max("order_purchase_timestamp").alias("last_order_date"),
        )
        .join(t.customers.select("customer_id", "customer_unique_id"), "customer_id", "inner")
    )
    result = per_customer.select(
        "customer_unique_id",
        "customer_id",
        "total_orders",
        to_double("revenue_dec").alias("revenue"),
        round_to(ratio("revenue_dec", "total_orders"), 2).alias("revenue_per_order"),
        "first_order_date",
        "last_order_date",
    )
    order = [
        descending("revenue", nulls),
        descending("total_orders", nulls),
        F.col("customer_unique_id").asc(),
        F.col("customer_id").asc(),
    ]
    return top_n(result, order, n).orderBy(*order).drop("customer_id")
