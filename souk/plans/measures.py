"""BI measures and the aggregates behind the dashboard pages.

Measures are one-row aggregates over the marts (each measure a scalar subquery, so every
one is a distributed partial/final aggregate); slicers are a parametrised ``where`` on the
marts, and all measures can also be grouped by a slicer column. Data sets aggregate to
their display grain first; windows run only on those small group-grain results.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.dates import days_between, month_key
from souk.functions.numeric import avg4, round4
from souk.plans import kpis, reports
from souk.session import written
from souk.plans.marts import CATEGORY_COLUMNS, COST_COLUMNS, SUM_TYPE, FeatureBundle, exact_mean
from souk.operators import clean as op
from souk.operators import sampling
from souk.sources.fixtures import RetailTables


def _money(c: Column) -> Column:
    return F.sum(c.cast(SUM_TYPE)).cast("double")


def _avg4(c: Column) -> Column:
    return avg4(c)


# ----------------------------------------------------------------------------- slicers (X11, X12)
@dataclass(frozen=True)
class Slicers:
    """Dashboard filters. ``status_mode``: 'exclude_cancelled' (default view),
    'delivered' (leadership view) or 'all'."""

    date_from: str | None = None
    date_to: str | None = None
    states: Sequence[str] | None = None
    cities: Sequence[str] | None = None
    categories: Sequence[str] | None = None
    sellers: Sequence[str] | None = None
    statuses: Sequence[str] | None = None
    payment_types: Sequence[str] | None = None
    delivery_status: str | None = None        # 'late' | 'on_time' | 'undelivered'
    customer_segment: str | None = None       # 'repeat' | 'one_time'
    status_mode: str = "exclude_cancelled"


DEFAULT_VIEW = Slicers()


def _delivery_status() -> Column:
    late = F.col("late_deliveries")
    return F.when(late.isNull(), "undelivered").when(late, "late").otherwise("on_time")


@dataclass
class Slice:
    """The marts under a set of slicers. A filter runs along the model's relations: customer
    attributes to orders, orders to items, category and seller to items and to the orders that
    have such an item. Dimensions are filtered by their own attributes only."""

    orders: DataFrame
    items: DataFrame
    customers: DataFrame
    products: DataFrame
    sellers: DataFrame


def slice_bundle(b: FeatureBundle, s: Slicers = DEFAULT_VIEW, items_of_orders: bool = True) -> Slice:
    """The marts under ``s``; without ``items_of_orders`` the caller joins the items to the orders."""

    def chosen(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
        return df.where(F.col(column).isin(*values)) if values else df

    customers = chosen(chosen(b.dim_customers, "customer_state", s.states), "customer_city", s.cities)
    if s.customer_segment:
        customers = customers.where(F.col("repeat_customer") == (s.customer_segment == "repeat"))
    items, products, sellers = b.fact_order_items, b.dim_products, chosen(b.dim_sellers, "seller_id", s.sellers)
    if s.categories:
        items = chosen(items, _category(items), s.categories)
        products = chosen(products, _category(products), s.categories)
    items = chosen(items, "seller_id", s.sellers)

    def filtered(df: DataFrame) -> DataFrame:
        """By the order's status and time."""
        df = chosen(df, "order_status", s.statuses)
        if s.status_mode == "exclude_cancelled":
            df = df.where(F.col("order_status") != "canceled")
        elif s.status_mode == "delivered":
            df = df.where(F.col("order_status") == "delivered")
        elif s.status_mode != "all":
            raise ValueError(f"unknown status mode {s.status_mode!r}")
        bought = F.col("order_purchase_timestamp")
        if "order_month" in df.columns:
            # The months of the range, so that only their folders are read.
            month = F.col("order_month")
            df = df.where(month >= s.date_from[:7]) if s.date_from else df
            df = df.where(month <= s.date_to[:7]) if s.date_to else df
        if s.date_from:
            df = df.where(bought >= F.lit(s.date_from).cast("timestamp_ntz"))
        if s.date_to:
            df = df.where(bought < F.lit(s.date_to).cast("timestamp_ntz"))
        return df

    orders = chosen(filtered(b.fact_orders), "dominant_payment_type", s.payment_types)
    if s.delivery_status:
        orders = orders.where(_delivery_status() == s.delivery_status)
    if s.states or s.cities or s.customer_segment:
        orders = orders.join(customers.select("customer_id"), "customer_id", "left_semi")
    if s.categories or s.sellers:
        orders = orders.join(items.select("order_id"), "order_id", "left_semi")
    by_status_or_time = s.status_mode != "all" or s.statuses or s.date_from or s.date_to
    by_others = s.payment_types or s.delivery_status or s.states or s.cities or s.customer_segment
    carried = {"order_status", "order_purchase_timestamp"} <= set(items.columns)
    if not items_of_orders or s == Slicers(status_mode="all"):
        pass
    elif carried and by_status_or_time and not by_others:
        # Items carry their order's status and time: no join finds them.
        items = filtered(items)
    else:
        items = items.join(orders.select("order_id"), "order_id", "left_semi")
    return Slice(orders, items, customers, products, sellers)


def _category(items: DataFrame) -> str:
    c = op.first_present(items.columns, CATEGORY_COLUMNS)
    if c is None:
        raise kpis.KPIError(f"fact_order_items has none of {CATEGORY_COLUMNS}")
    return c


# ----------------------------------------------------------------------------- measures (B1-B17)
def order_measures() -> list[Column]:
    """Measures over fact_orders rows, one per order (usable in any groupBy)."""
    revenue = _money(F.coalesce(F.col("order_value"), F.lit(0.0)))
    orders = F.count("order_id")
    return [
        revenue.alias("total_revenue"),
        orders.alias("total_orders"),
        F.try_divide(revenue, orders.cast("double")).alias("average_order_value"),
        F.try_divide(revenue, F.count_distinct("customer_id").cast("double")).alias("revenue_per_customer"),
        F.try_divide(F.count_if(F.col("late_deliveries")).cast("double"), orders.cast("double")).alias(
            "late_delivery_rate"
        ),
        _avg4(F.col("delivery_time_days")).alias("average_delivery_time_days"),
        _avg4(F.col("approval_time_hours")).alias("average_approval_time_hours"),
    ]


def item_measures(items: DataFrame) -> list[Column]:
    """Measures over fact_order_items rows."""
    revenue = F.coalesce(F.col("revenue"), F.lit(0.0))
    cost_col = op.first_present(items.columns, COST_COLUMNS)
    margin = F.lit(None).cast("double")
    if cost_col:
        cost = F.coalesce(F.col(cost_col).try_cast("double"), F.lit(0.0))
        margin = F.try_divide(_money(revenue - cost), _money(revenue))
    return [
        F.try_divide(_money(F.col("freight_value")), _money(F.col("item_total_value"))).alias("freight_share"),
        margin.alias("profit_margin"),
    ]


def customer_measures() -> list[Column]:
    """Measures over dim_customers rows, one per customer."""
    customers = F.count("customer_id").cast("double")
    return [
        F.try_divide(F.count_if(F.col("total_orders") > 1).cast("double"), customers).alias("repeat_customer_rate"),
        _avg4(F.col("customer_lifetime_value")).alias("customer_lifetime_value_avg"),
        F.try_divide(F.count_if(F.col("repeat_customer")).cast("double"), customers).alias("customer_retention_rate"),
    ]


def _dimension_parts(x: Slice) -> list[tuple[str, DataFrame, list[Column]]]:
    """Measures over the dimensions: (the axes that cut the dimension, its rows, the measures)."""
    category = "product_category_name_english"
    by_category = x.products.where(F.col(category).isNotNull()).groupBy(category).agg(
        F.sum(F.col("product_revenue").cast(SUM_TYPE)).alias("r")
    )
    return [
        ("customers", x.customers, customer_measures()),
        ("products", x.products, [F.max("product_revenue").alias("top_category_revenue")]),
        ("products", by_category, [F.max("r").cast("double").alias("top_category_revenue_by_category")]),
        ("sellers", x.sellers, [F.max("seller_revenue").alias("top_seller_revenue")]),
    ]


def _scalars(frame: DataFrame, columns: list[Column]) -> list[Column]:
    """One-row aggregates as columns for another frame."""
    row = frame.agg(*columns)
    one = row.select(F.struct("*").alias("row")).scalar()
    return [one.getField(name).alias(name) for name in row.columns]


def bi_measures(b: FeatureBundle, s: Slicers = DEFAULT_VIEW) -> DataFrame:
    """All measures in one row under the slicers: one aggregate per mart."""
    x = slice_bundle(b, s)
    values = _scalars(x.items, item_measures(x.items))
    for _, frame, columns in _dimension_parts(x):
        values += _scalars(frame, columns)
    return x.orders.agg(*order_measures()).select("*", *values)


CUSTOMER_AXES = ("customer_state", "customer_city", "repeat_customer")
ITEM_AXES = ("category", "seller_id")
#: The dimension that an axis cuts as a slicer on it would.
CUTS = {**dict.fromkeys(CUSTOMER_AXES, "customers"), "category": "products", "seller_id": "sellers"}


def bi_measures_by(b: FeatureBundle, axis: str = "customer_state", s: Slicers = DEFAULT_VIEW) -> DataFrame:
    """All measures per value of one slicer axis: a customer attribute, 'category', 'seller_id',
    'delivery_status' or any column of fact_orders. Each row is what ``bi_measures`` gives with a
    slicer on that value: an order counts for every category or seller that it has an item of, and
    a dimension is cut by its own attributes only, so its measures are the same in every row of
    other axes."""
    # Axes of orders join the items to the slice's orders, so these need not be picked out before.
    x = slice_bundle(b, s, items_of_orders=axis in ITEM_AXES)
    orders, items = x.orders, x.items
    if axis in ITEM_AXES:
        items = items.withColumn(axis, F.col(_category(items))) if axis == "category" else items
        # Pairs meet the slice's orders before they are made distinct: one shuffle serves both.
        pairs = items.select("order_id", axis).where(F.col(axis).isNotNull())
        pairs = pairs.join(orders.select("order_id"), "order_id", "left_semi").distinct()
        orders = orders.join(pairs, "order_id")
    else:
        if axis in CUSTOMER_AXES:
            orders = orders.join(x.customers.select("customer_id", axis), "customer_id")
        elif axis == "delivery_status":
            orders = orders.withColumn(axis, _delivery_status())
        items = items.drop(axis).join(orders.select("order_id", axis), "order_id")
    by_orders = orders.where(F.col(axis).isNotNull()).groupBy(axis).agg(*order_measures())
    by_items = items.where(F.col(axis).isNotNull()).groupBy(axis).agg(*item_measures(items))
    out, values = by_orders.join(by_items, axis, "left"), []
    for dimension, frame, columns in _dimension_parts(x):
        if CUTS.get(axis) != dimension:
            values += _scalars(frame, columns)
            continue
        own = _category(frame) if axis == "category" else axis
        per_value = frame.where(F.col(own).isNotNull()).groupBy(F.col(own).alias(axis)).agg(*columns)
        out = out.join(per_value, axis, "left")
    return out.select("*", *values)


def bi_month_to_date(b: FeatureBundle, s: Slicers = DEFAULT_VIEW) -> DataFrame:
    """Day grain: revenue, month-to-date revenue, previous calendar month's revenue and the
    month-to-date growth against it (DAX month-to-date / previous-month measures)."""
    ts = F.col("order_purchase_timestamp")
    daily = (
        slice_bundle(b, s)
        .orders.where(ts.isNotNull())
        .groupBy(F.to_date(ts).alias("order_date"))
        .agg(F.sum(F.coalesce(F.col("order_value"), F.lit(0.0)).cast(SUM_TYPE)).alias("rev"))
        .withColumn("order_month", month_key("order_date"))
    )
    # Partitioned by month, at most 31 rows each.
    mtd_w = Window.partitionBy("order_month").orderBy("order_date").rowsBetween(Window.unboundedPreceding, 0)
    monthly = daily.groupBy("order_month").agg(F.sum("rev").alias("month_rev"))
    previous = monthly.select(
        month_key(F.add_months(F.to_date(F.concat(F.col("order_month"), F.lit("-01"))), 1)).alias("order_month"),
        F.col("month_rev").alias("prev_rev"),
    )
    out = daily.withColumn("mtd", F.sum("rev").over(mtd_w)).join(F.broadcast(previous), "order_month", "left")
    return out.select(
        "order_date",
        "order_month",
        F.col("rev").cast("double").alias("daily_revenue"),
        F.col("mtd").cast("double").alias("month_to_date_revenue"),
        F.col("prev_rev").cast("double").alias("previous_month_revenue"),
        F.try_divide((F.col("mtd") - F.col("prev_rev")).cast("double"), F.col("prev_rev").cast("double")).alias(
            "monthly_growth_rate"
        ),
    ).orderBy("order_date")


def bi_month_over_month(b: FeatureBundle, s: Slicers = DEFAULT_VIEW) -> DataFrame:
    """Month grain: revenue, previous calendar month revenue (NULL when that month has no
    orders), growth amount and rate."""
    orders = slice_bundle(b, s).orders.where(F.col("order_month").isNotNull())
    monthly = orders.groupBy("order_month").agg(_money(F.col("order_value")).alias("monthly_revenue"))
    previous = monthly.select(
        month_key(F.add_months(F.to_date(F.concat(F.col("order_month"), F.lit("-01"))), 1)).alias("order_month"),
        F.col("monthly_revenue").alias("previous_month_revenue"),
    )
    out = monthly.join(previous, "order_month", "left")
    return out.select(
        "order_month",
        "monthly_revenue",
        "previous_month_revenue",
        (F.col("monthly_revenue") - F.col("previous_month_revenue")).alias("growth_amount"),
        F.try_divide(F.col("monthly_revenue") - F.col("previous_month_revenue"), F.col("previous_month_revenue")).alias(
            "monthly_growth_rate"
        ),
    ).orderBy("order_month")


# ----------------------------------------------------------------------------- data sets (G*)
def ds_cohort_matrix(t: RetailTables) -> DataFrame:
    """Cohort x month-number retention matrix. The long report is written once; its columns run
    over the months of the calendar years from its own first to its own last month."""
    long = written(reports.customer_retention(t), "cohort-retention")
    last = F.max(F.add_months("cohort_month", F.col("month_number").cast("int")))
    years = F.year(last) - F.year(F.min("cohort_month")) + 1
    span = long.agg((years * 12).alias("span")).first()["span"]
    rates = [
        F.max(F.when(F.col("month_number") == i, F.col("retention_rate"))).alias(str(i))
        for i in range(span or 1)
    ]
    return long.groupBy("cohort_month", "cohort_size").agg(*rates)


def ds_repeat_share(b: FeatureBundle) -> DataFrame:
    g = b.dim_customers.groupBy(F.coalesce("repeat_customer", F.lit(False)).alias("repeat_customer")).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.coalesce(F.col("customer_revenue"), F.lit(0.0)).cast(SUM_TYPE)).alias("rev"),
    )
    everything = Window.partitionBy()  # two rows
    return g.select(
        F.when(F.col("repeat_customer"), F.lit("Repeat")).otherwise(F.lit("One-time")).alias("segment"),
        "customers",
        F.col("rev").cast("double").alias("revenue"),
        round4(F.col("customers") / F.sum("customers").over(everything)).alias("customer_share"),
        round4(F.try_divide(F.col("rev").cast("double"), F.sum("rev").over(everything).cast("double"))).alias(
            "revenue_share"
        ),
    )


def _category_orders(b: FeatureBundle) -> DataFrame:
    items = b.fact_order_items
    key = _category(items)
    return items.where(F.col(key).isNotNull()).select(F.col(key).alias("category"), "order_id").distinct()


def ds_category_delay(b: FeatureBundle) -> DataFrame:
    """Per category: item revenue and the average delivery delay of the orders containing it."""
    items = b.fact_order_items
    key = _category(items)
    revenue = items.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("category")).agg(
        _money(F.col("revenue")).alias("revenue"), F.count("order_item_id").alias("units_sold")
    )
    delay = (
        _category_orders(b)
        .join(b.fact_orders.select("order_id", "delivery_delay_days", "late_deliveries"), "order_id", "left")
        .groupBy("category")
        .agg(
            F.count("order_id").alias("orders"),
            _avg4(F.col("delivery_delay_days")).alias("average_delay_days"),
            _avg4(F.col("late_deliveries").cast("double")).alias("late_delivery_rate"),
        )
    )
    return by_revenue(revenue.join(delay, "category", "left"))


def by_revenue(categories: DataFrame) -> DataFrame:
    return categories.orderBy(F.col("revenue").desc_nulls_last(), "category")


def ds_category_share(b: FeatureBundle) -> DataFrame:
    items = b.fact_order_items
    key = _category(items)
    g = items.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("category")).agg(
        F.sum(F.col("revenue").cast(SUM_TYPE)).alias("rev"),
        _money(F.col("freight_value")).alias("freight"),
        F.count("order_item_id").alias("units_sold"),
        F.count_distinct("order_id").alias("orders"),
    )
    # Category grain (one row per category): the running window is bounded by the
    # number of categories.
    ordered = Window.orderBy(F.col("rev").desc(), F.col("category"))
    total = g.agg(F.sum("rev")).scalar()
    return g.select(
        "category",
        F.col("rev").cast("double").alias("revenue"),
        "freight",
        "units_sold",
        "orders",
        round4(F.try_divide(F.col("rev").cast("double"), total.cast("double"))).alias("revenue_share"),
        round4(
            F.try_divide(
                F.sum("rev").over(ordered.rowsBetween(Window.unboundedPreceding, 0)).cast("double"),
                total.cast("double"),
            )
        ).alias("cumulative_share"),
    ).orderBy(F.col("revenue").desc(), "category")


def ds_seller_scorecard(b: FeatureBundle) -> DataFrame:
    pairs = b.fact_order_items.select("seller_id", "order_id").distinct()
    service = (
        pairs.join(b.fact_orders.select("order_id", "late_deliveries", "average_review_score"), "order_id", "left")
        .groupBy("seller_id")
        .agg(
            _avg4(F.col("late_deliveries").cast("double")).alias("late_delivery_rate"),
            _avg4(F.col("average_review_score")).alias("average_review_score"),
        )
    )
    return (
        b.dim_sellers.select("seller_id", "seller_state", "seller_revenue", "seller_unique_orders", "seller_items")
        .join(service, "seller_id", "left")
        .orderBy(F.col("seller_revenue").desc_nulls_last(), "seller_id")
    )


def ds_seller_geography(b: FeatureBundle) -> DataFrame:
    return (
        b.dim_sellers.groupBy("seller_state")
        .agg(
            F.count(F.lit(1)).alias("sellers"),
            _money(F.coalesce(F.col("seller_revenue"), F.lit(0.0))).alias("revenue"),
            F.sum(F.coalesce(F.col("seller_items"), F.lit(0))).alias("items"),
        )
        .orderBy(F.col("revenue").desc_nulls_last(), "seller_state")
    )


def ds_delivery_trend(b: FeatureBundle) -> DataFrame:
    f = b.fact_orders.where(F.col("order_month").isNotNull())
    return (
        f.groupBy("order_month")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            _avg4(F.col("delivery_time_days")).alias("average_delivery_time_days"),
            _avg4(days_between("order_purchase_timestamp", "order_estimated_delivery_date")).alias(
                "average_estimated_days"
            ),
        )
        .orderBy("order_month")
    )


def _with_state(b: FeatureBundle) -> DataFrame:
    return b.fact_orders.join(b.dim_customers.select("customer_id", "customer_state"), "customer_id", "left").where(
        F.col("customer_state").isNotNull()
    )


def ds_late_rate_by_state(b: FeatureBundle) -> DataFrame:
    return (
        _with_state(b)
        .groupBy("customer_state")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_if(F.col("late_deliveries")).alias("late_orders"),
            _avg4(F.col("late_deliveries").cast("double")).alias("late_delivery_rate"),
        )
        .orderBy(F.col("late_delivery_rate").desc_nulls_last(), "customer_state")
    )


# Calendar month numbers (the heatmap's columns).
MONTHS = list(range(1, 13))


def ds_weekday_month_heatmap(b: FeatureBundle) -> DataFrame:
    f = b.fact_orders.where(F.col("weekday").isNotNull())
    return f.groupBy("weekday").pivot("month", MONTHS).agg(F.count(F.lit(1))).na.fill(0, [str(m) for m in MONTHS])


def ds_growth_waterfall(b: FeatureBundle) -> DataFrame:
    m = b.monthly_revenue.select("order_month", F.coalesce("monthly_revenue", F.lit(0.0)).alias("monthly_revenue"))
    # Month grain: bounded by the number of months.
    w = Window.orderBy("order_month")
    return m.select(
        "order_month",
        "monthly_revenue",
        (F.col("monthly_revenue") - F.coalesce(F.lag("monthly_revenue").over(w), F.lit(0.0))).alias("change"),
        F.sum(F.col("monthly_revenue").cast(SUM_TYPE)).over(w.rowsBetween(Window.unboundedPreceding, 0))
        .cast("double")
        .alias("cumulative_revenue"),
    ).orderBy("order_month")


def ds_exceptions(b: FeatureBundle) -> DataFrame:
    """Every late order, longest delay first."""
    return (
        b.fact_orders.where(F.col("late_deliveries"))
        .select(
            "order_id", "customer_id", "order_status", "order_purchase_timestamp",
            "order_delivered_customer_date", "order_estimated_delivery_date", "delivery_delay_days",
        )
        .orderBy(F.col("delivery_delay_days").desc(), "order_id")
    )


def ds_state_matrix(b: FeatureBundle) -> DataFrame:
    return (
        _with_state(b)
        .groupBy("customer_state")
        .agg(
            _money(F.coalesce(F.col("order_value"), F.lit(0.0))).alias("revenue"),
            F.count_distinct("order_id").alias("orders"),
            exact_mean(F.col("order_value")).alias("average_order_value"),
            _avg4(F.col("late_deliveries").cast("double")).alias("late_delivery_rate"),
            _avg4(F.col("delivery_delay_days")).alias("average_delay_days"),
        )
        .orderBy(F.col("revenue").desc_nulls_last(), "customer_state")
    )


def ds_state_leaders(b: FeatureBundle) -> DataFrame:
    """Top revenue, order-count and delay states in one row (ties -> smallest state)."""
    m = ds_state_matrix(b)

    def leader(metric: str) -> Column:
        return F.min(F.struct((-F.col(metric)).alias("k"), F.col("customer_state").alias("s")))["s"]

    return m.agg(
        leader("revenue").alias("top_revenue_state"),
        leader("orders").alias("top_orders_state"),
        F.min(
            F.struct((-F.coalesce(F.col("average_delay_days"), F.lit(float("-inf")))).alias("k"),
                     F.col("customer_state").alias("s"))
        )["s"].alias("top_delay_state"),
    )


def ds_drilldown_rollup(b: FeatureBundle) -> DataFrame:
    """State -> category -> seller revenue tree (ROLLUP with grouping level)."""
    items = b.fact_order_items
    key = _category(items)
    states = b.dim_customers.select("customer_id", "customer_state")
    finest = items.join(states, "customer_id", "left").groupBy(
        "customer_state", F.col(key).alias("category"), "seller_id"
    ).agg(F.sum(F.col("revenue").cast(SUM_TYPE)).alias("revenue"), F.count("order_item_id").alias("items"))
    # Items are summed once, at the finest grain; the upper levels add up these rows.
    return finest.rollup("customer_state", "category", "seller_id").agg(
        F.sum("revenue").cast("double").alias("revenue"),
        F.sum("items").alias("items"),
        F.grouping_id().alias("grouping_level"),
    )


def ds_top_categories_by_units(b: FeatureBundle, n: int = 10) -> DataFrame:
    """Top-n categories by units sold (ties: revenue, then name)."""
    items = b.fact_order_items
    key = _category(items)
    g = items.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("category")).agg(
        F.count("order_item_id").alias("units_sold"),
        _money(F.col("revenue")).alias("revenue"),
        F.count_distinct("order_id").alias("orders"),
    )
    order = [F.col("units_sold").desc(), F.col("revenue").desc_nulls_last(), F.col("category")]
    return g.orderBy(*order).limit(n)


def ds_customer_points(b: FeatureBundle) -> DataFrame:
    """Order frequency vs revenue, one point per customer with orders (all of them)."""
    return b.dim_customers.where(F.col("total_orders") > 0).select(
        "customer_id", "total_orders", "order_frequency_days", "customer_revenue"
    )


def ds_customer_points_sample(b: FeatureBundle, per_segment: int = 200) -> DataFrame:
    """``ds_customer_points`` for a chart: up to ``per_segment`` customers of each segment, the
    same ones whenever it is asked."""
    points = ds_customer_points(b).withColumn(
        "segment", F.when(F.col("total_orders") > 1, F.lit("repeat")).otherwise(F.lit("one_time"))
    )
    return sampling.bottom_k(points, "segment", "customer_id", per_segment)


def ds_city_volume(b: FeatureBundle, min_orders: int = 20) -> DataFrame:
    """Revenue by customer city, hiding cities below ``min_orders`` orders (a HAVING)."""
    cities = b.dim_customers.select("customer_id", "customer_state", "customer_city")
    return (
        b.fact_orders.join(cities, "customer_id", "inner")
        .groupBy("customer_state", "customer_city")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            _money(F.coalesce(F.col("order_value"), F.lit(0.0))).alias("revenue"),
        )
        .where(F.col("orders") >= min_orders)
        .orderBy(F.col("revenue").desc(), "customer_state", "customer_city")
    )


def ds_seller_concentration(b: FeatureBundle) -> DataFrame:
    """Seller revenue share and concentration: each seller's share of item revenue and the
    share held by all sellers with at least its revenue, plus its revenue rank.

    The cumulative share is a running total over sellers in revenue order, computed with
    the value-range prefix sums of ``souk.operators.ranking`` (no single-partition window
    over sellers); ties share one cumulative value.
    """
    from souk.operators.ranking import global_rank, running_sums

    per_seller = b.fact_order_items.where(F.col("seller_id").isNotNull()).groupBy("seller_id").agg(
        F.sum(F.col("revenue").cast(SUM_TYPE)).alias("rev")
    )
    per_seller = written(per_seller, "seller-revenue")
    by_value = per_seller.groupBy("rev").agg(F.sum("rev").alias("_w"))
    placed = running_sums(by_value, "rev", "_w", descending=True).select(
        "rev", (F.col("_before") + F.col("_w")).alias("_cum")
    )
    total = per_seller.agg(F.sum("rev")).scalar()
    ranked = global_rank(per_seller.withColumn("revenue", F.col("rev").cast("double")), "revenue", "revenue_rank")
    return ranked.join(placed, "rev", "left").select(
        "seller_id",
        "revenue",
        round4(F.try_divide(F.col("rev").cast("double"), total.cast("double"))).alias("revenue_share"),
        round4(F.try_divide(F.col("_cum").cast("double"), total.cast("double"))).alias("cumulative_share"),
        "revenue_rank",
    )
