"""The eleven KPI reports over the feature marts, and ``build_kpi_report``.

Each KPI is a lazy DataFrame. Scalar KPIs are one global aggregate (partial aggregation on
every partition, one tiny final task); ranked KPIs aggregate to the group grain first and
only then sort / limit / window.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.dates import month_key, whole_days_floor
from souk.operators import clean as op
from souk.operators.ranking import top_n
from souk.plans.marts import CATEGORY_COLUMNS, COST_COLUMNS, SUM_TYPE, FeatureBundle, exact_mean

CURRENCY = "BRL"


class KPIError(RuntimeError):
    """A mart lacks what a KPI needs."""


def _money_total(col) -> F.Column:
    return F.coalesce(F.sum(F.coalesce(col, F.lit(0.0)).cast(SUM_TYPE)), F.lit(0)).cast("double")


def total_revenue(b: FeatureBundle) -> DataFrame:
    return b.fact_orders.agg(
        F.lit("total_revenue").alias("metric"),
        _money_total(F.col("order_value")).alias("value"),
        F.lit(CURRENCY).alias("currency"),
    )


def total_orders(b: FeatureBundle) -> DataFrame:
    return b.fact_orders.agg(
        F.lit("total_orders").alias("metric"),
        F.count("order_id").alias("value"),  # one fact row per order
        F.count_if((F.col("order_status") == "delivered") & F.col("order_id").isNotNull()).alias("delivered_orders"),
    )


def average_order_value(b: FeatureBundle) -> DataFrame:
    """Mean and median order value (NULL values count as 0; 0.0 for no orders)."""
    values = b.fact_orders.select("order_id", F.coalesce("order_value", F.lit(0.0)).alias("order_value"))
    mean = values.agg(exact_mean("order_value").alias("m")).scalar()
    median = op.column_medians(values, ["order_value"]).agg(F.max("median")).scalar()
    return b.fact_orders.sparkSession.range(1).select(
        F.lit("average_order_value").alias("metric"),
        F.coalesce(mean, F.lit(0.0)).alias("value"),
        F.coalesce(median, F.lit(0.0)).alias("median_order_value"),
    )


def profit_margin(b: FeatureBundle) -> DataFrame:
    items = b.fact_order_items
    cost_col = op.first_present(items.columns, COST_COLUMNS)
    if cost_col is None:
        return items.sparkSession.range(1).select(
            F.lit("profit_margin").alias("metric"),
            F.lit(None).cast("double").alias("value"),
            F.lit(None).cast("double").alias("gross_profit"),
            F.lit("No cost column available in source data").alias("note"),
        )
    revenue = F.coalesce(F.col("revenue"), F.lit(0.0))
    cost = F.coalesce(F.expr(f"try_cast(`{cost_col}` AS DOUBLE)"), F.lit(0.0))
    totals = items.agg(
        F.sum((revenue - cost).cast(SUM_TYPE)).alias("gp"),
        F.sum(revenue.cast(SUM_TYPE)).alias("rev"),
    )
    return totals.select(
        F.lit("profit_margin").alias("metric"),
        F.when(F.col("rev") != 0, F.col("gp").cast("double") / F.col("rev").cast("double")).alias("value"),
        F.coalesce(F.col("gp"), F.lit(0)).cast("double").alias("gross_profit"),
        F.coalesce(F.col("rev"), F.lit(0)).cast("double").alias("revenue"),
    )


def _category_column(df: DataFrame) -> str:
    c = op.first_present(df.columns, CATEGORY_COLUMNS)
    if c is None:
        raise KPIError(f"fact_order_items has none of {CATEGORY_COLUMNS}")
    return c


def _group_revenue(items: DataFrame, key: str) -> DataFrame:
    return (
        items.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.sum(F.col("revenue").cast(SUM_TYPE)).cast("double").alias("revenue"),
            F.count_distinct("order_id").alias("orders"),
            F.count("order_item_id").alias("units_sold"),
        )
    )


def _ranked(df: DataFrame, order: list, n: int) -> DataFrame:
    head = top_n(df, order, n)
    # n rows: numbering them in one partition is bounded by n.
    return head.withColumn("rank", F.row_number().over(Window.orderBy(*order))).orderBy("rank")


def top_categories(b: FeatureBundle, top_n_rows: int = 10) -> DataFrame:
    items = b.fact_order_items
    key = _category_column(items)
    summary = _group_revenue(items, key).withColumnRenamed(key, "category")
    order = [F.col("revenue").desc_nulls_last(), F.col("units_sold").desc_nulls_last(), F.col("category").asc()]
    return _ranked(summary, order, top_n_rows)


def top_sellers(b: FeatureBundle, top_n_rows: int = 10) -> DataFrame:
    summary = _group_revenue(b.fact_order_items, "seller_id")
    order = [F.col("revenue").desc_nulls_last(), F.col("orders").desc_nulls_last(), F.col("seller_id").asc()]
    return _ranked(summary, order, top_n_rows)


def monthly_growth(b: FeatureBundle) -> DataFrame:
    monthly = b.monthly_revenue.withColumn("monthly_revenue", F.coalesce("monthly_revenue", F.lit(0.0)))
    # One row per month: the un-partitioned window is bounded by the number of months.
    w = Window.orderBy("order_month")
    g = monthly.withColumn("previous_month_revenue", F.lag("monthly_revenue").over(w))
    g = g.withColumn("growth_amount", F.col("monthly_revenue") - F.col("previous_month_revenue"))
    return g.withColumn(
        "growth_rate",
        F.when(F.col("previous_month_revenue") != 0, F.col("growth_amount") / F.col("previous_month_revenue")),
    ).orderBy("order_month")


def repeat_customers(b: FeatureBundle) -> DataFrame:
    c = b.dim_customers
    return c.agg(
        F.lit("repeat_customers").alias("metric"),
        F.count_if(F.coalesce(F.col("repeat_customer"), F.lit(False))).alias("repeat_customers"),
        F.count_distinct("customer_id").alias("total_customers"),
    ).withColumn(
        "repeat_customer_share",
        F.when(F.col("total_customers") > 0, F.col("repeat_customers") / F.col("total_customers")),
    )


def customer_retention(b: FeatureBundle, retention_window_days: int = 90) -> DataFrame:
    """Share of each first-order-month cohort that orders again 1..N whole days after the
    first order."""
    first = (
        b.dim_customers.select("customer_id", "first_order_date")
        .where(F.col("customer_id").isNotNull() & F.col("first_order_date").isNotNull())
        .withColumn("cohort_month", month_key("first_order_date"))
    )
    history = b.fact_orders.select("customer_id", "order_purchase_timestamp").where(
        F.col("customer_id").isNotNull() & F.col("order_purchase_timestamp").isNotNull()
    )
    days = whole_days_floor("first_order_date", "order_purchase_timestamp")
    retained = F.coalesce(days.between(1, retention_window_days), F.lit(False))
    per_customer = (
        first.join(history, "customer_id", "left")
        .groupBy("cohort_month", "customer_id")
        .agg(F.bool_or(retained).alias("retained"))
    )
    return (
        per_customer.groupBy("cohort_month")
        .agg(
            F.count_distinct("customer_id").alias("customers_in_cohort"),
            F.count_if("retained").alias("retained_customers"),
        )
        .withColumn(
            "retention_rate",
            F.when(F.col("customers_in_cohort") != 0, F.col("retained_customers") / F.col("customers_in_cohort")),
        )
        .withColumn("retention_window_days", F.lit(retention_window_days).cast("bigint"))
        .orderBy("cohort_month")
    )


def revenue_by_state(b: FeatureBundle) -> DataFrame:
    states = b.dim_customers.select("customer_id", "customer_state")
    return (
        b.fact_orders.select("order_id", "customer_id", "order_value")
        .join(states, "customer_id", "left")
        .where(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(
            _money_total(F.col("order_value")).alias("revenue"),
            F.count_distinct("order_id").alias("orders"),
            exact_mean("order_value").alias("average_order_value"),
        )
        .orderBy(F.col("revenue").desc_nulls_last())
    )


def revenue_by_category(b: FeatureBundle) -> DataFrame:
    items = b.fact_order_items
    key = _category_column(items)
    return (
        _group_revenue(items, key)
        .withColumnRenamed(key, "category")
        .orderBy(F.col("revenue").desc_nulls_last())
    )


@dataclass
class KPIReport:
    total_revenue: DataFrame
    total_orders: DataFrame
    average_order_value: DataFrame
    profit_margin: DataFrame
    top_categories: DataFrame
    top_sellers: DataFrame
    monthly_growth: DataFrame
    repeat_customers: DataFrame
    customer_retention: DataFrame
    revenue_by_state: DataFrame
    revenue_by_category: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def build_kpi_report(b: FeatureBundle) -> KPIReport:
    """All KPIs of a bundle of marts, or of anything that has the marts as attributes (a written
    layer, saved marts)."""
    missing = [f.name for f in fields(FeatureBundle) if not isinstance(getattr(b, f.name, None), DataFrame)]
    if missing:
        raise KPIError(f"{type(b).__name__} lacks the marts {missing}")
    return KPIReport(
        total_revenue=total_revenue(b),
        total_orders=total_orders(b),
        average_order_value=average_order_value(b),
        profit_margin=profit_margin(b),
        top_categories=top_categories(b),
        top_sellers=top_sellers(b),
        monthly_growth=monthly_growth(b),
        repeat_customers=repeat_customers(b),
        customer_retention=customer_retention(b),
        revenue_by_state=revenue_by_state(b),
        revenue_by_category=revenue_by_category(b),
    )
