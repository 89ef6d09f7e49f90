"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver tables in ``sf_dir`` (through the retail views, the raw text
tables derived from them, or the cleaned / mart layers Spark materializes from those), so
its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.plans import cleaning, eda, kpis, layers, measures, quality, reconcile, reports, sources_eda
from souk.plans.stats import stats_of
from souk.session import scratch_path, small_tasks, written
from souk.sources import io, versions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str, build: Callable[[SparkSession, str], DataFrame]) -> None:
    QUERIES[name] = build


# --------------------------------------------------------------------- SQL report pack
def _report(fn) -> Query:
    return lambda spark, sf_dir: fn(layers.retail_layer(spark, sf_dir))


for _name, _fn in [
    ("q_average_order_value", reports.average_order_value),
    ("q_customer_analytics", reports.customer_analytics),
    ("q_customer_retention", reports.customer_retention),
    ("q_growth_rate", reports.growth_rate),
    ("q_late_deliveries", reports.late_deliveries),
    ("q_monthly_kpis", reports.monthly_kpis),
    ("q_monthly_kpis_safe", reports.monthly_kpis_safe),
    ("q_product_analytics", reports.product_analytics),
    ("q_regional_analytics", reports.regional_analytics),
    ("q_revenue_analysis", reports.revenue_analysis),
    ("q_seller_analytics", reports.seller_analytics),
    ("q_top_customers", reports.top_customers),
    ("q_top_products", reports.top_products),
]:
    register(_name, _report(_fn))


register("q_seller_analytics_nulls_first", _report(lambda t: reports.seller_analytics(t, nulls="first")))
register("q_top_customers_nulls_first", _report(lambda t: reports.top_customers(t, nulls="first")))


# --------------------------------------------------------------------- cleaning pipelines
def _clean_query(table: str) -> Query:
    return lambda spark, sf_dir: layers.cleaned_layer(spark, sf_dir)[table]


for _table in cleaning.SPECS:
    register(f"clean_{_table}", _clean_query(_table))


# --------------------------------------------------------------------- files
# The driver's own line items repeat some keys.
REPEATED_KEYS = ("order_items", "order_payments")


def _csv_query(table: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, f"csv-{table}")
        raw = layers.raw_layer(spark, sf_dir)[table]
        back = io.csv_round_trip(raw, path, table in REPEATED_KEYS)
        with small_tasks(spark):
            return cleaning.clean_table(table, back)

    return build


for _table in cleaning.SPECS:
    register(f"io_csv_{_table}", _csv_query(_table))


def _saved_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All marts saved with month partitions; the orders read back."""
    m = layers.mart_layer(spark, sf_dir)
    folder = scratch_path(spark, "marts")
    io.save_marts(m.as_dict(), folder)
    return io.read_mart(spark, folder, "fact_orders", m.fact_orders.schema)


register("io_save_marts", _saved_facts)


def _published(name: str) -> Query:
    """A mart published as a version and read back."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = scratch_path(spark, f"published-{name}")
        versions.publish(getattr(layers.mart_layer(spark, sf_dir), name), table)
        return versions.read_published(spark, table)

    return build


for _mart in ("fact_order_items", "dim_customers", "dim_products", "dim_sellers", "monthly_revenue", "customer_kpis"):
    register(f"io_published_{_mart}", _published(_mart))


def _refreshed_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders published by month with the amounts of one month doubled, then that month (the one
    with the most orders) refreshed from the mart: the table as it should be."""
    m = layers.mart_layer(spark, sf_dir)
    orders = m.fact_orders
    table = scratch_path(spark, "refreshed-orders")
    months = orders.where("order_month IS NOT NULL").groupBy("order_month").agg(F.count(F.lit(1)).alias("n"))
    busiest = months.orderBy(F.desc("n"), "order_month").first()
    month = busiest["order_month"] if busiest else None
    wrong = F.when(F.col("order_month") == month, F.col("order_value") * 2).otherwise(F.col("order_value"))
    with small_tasks(spark, m.parts):  # the mart lies by month
        versions.publish(orders.withColumn("order_value", wrong), table, "order_month", gathered=True)
        versions.refresh(orders, table, [month], gathered=True)
    return versions.read_published(spark, table)


register("io_refreshed_month", _refreshed_facts)


# --------------------------------------------------------------------- feature marts
def _mart_query(name: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(layers.mart_layer(spark, sf_dir), name)
        return df.orderBy("order_month") if name == "monthly_revenue" else df

    return build


for _mart in ("fact_orders", "fact_order_items", "dim_customers", "dim_products", "dim_sellers",
              "monthly_revenue", "customer_kpis"):
    register(_mart, _mart_query(_mart))


# --------------------------------------------------------------------- KPIs
def _kpi(fn) -> Query:
    return lambda spark, sf_dir: fn(layers.mart_layer(spark, sf_dir))


register("kpi_total_revenue", _kpi(kpis.total_revenue))
register("kpi_total_orders", _kpi(kpis.total_orders))
register("kpi_average_order_value", _kpi(kpis.average_order_value))
register("kpi_profit_margin_with_cost", _kpi(kpis.profit_margin))
register("kpi_top_categories", _kpi(kpis.top_categories))
register("kpi_top_sellers", _kpi(kpis.top_sellers))
register("kpi_monthly_growth", _kpi(kpis.monthly_growth))
register("kpi_repeat_customers", _kpi(kpis.repeat_customers))
register("kpi_customer_retention", _kpi(kpis.customer_retention))
register("kpi_revenue_by_state", _kpi(kpis.revenue_by_state))
register("kpi_revenue_by_category", _kpi(kpis.revenue_by_category))


# --------------------------------------------------------------------- BI measures
def _on_marts(fn) -> Query:
    return lambda spark, sf_dir: fn(layers.mart_layer(spark, sf_dir))


def _written_on_marts(fn) -> Query:
    """A small result of large joins, evaluated as layers are: in small tasks, with shuffles that
    start from the size of the input and go with the write."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = layers.mart_layer(spark, sf_dir)
        with small_tasks(spark, m.parts):
            return written(fn(m), "result")

    return build


def _on_marts_and_clean(fn) -> Query:
    return lambda spark, sf_dir: fn(layers.mart_layer(spark, sf_dir), layers.cleaned_layer(spark, sf_dir))


SLICES = {
    "bi_measures": measures.DEFAULT_VIEW,
    "bi_measures_delivered_view": measures.Slicers(status_mode="delivered"),
    "bi_measures_all_orders": measures.Slicers(status_mode="all"),
    "bi_measures_slice_state": measures.Slicers(states=("EUROPE", "ASIA")),
    "bi_measures_slice_city": measures.Slicers(cities=("NATION_3", "NATION_7", "NATION_19")),
    "bi_measures_slice_dates": measures.Slicers(date_from="1995-03-15", date_to="1997-07-02"),
    "bi_measures_slice_category": measures.Slicers(categories=("standard goods", "small goods")),
    "bi_measures_slice_seller": measures.Slicers(sellers=("1", "2", "3", "5", "8")),
    "bi_measures_slice_payment": measures.Slicers(payment_types=("A", "voucher"), status_mode="all"),
    "bi_measures_slice_late": measures.Slicers(delivery_status="late", customer_segment="repeat"),
}
for _name, _slicers in SLICES.items():
    register(_name, _on_marts(lambda b, s=_slicers: measures.bi_measures(b, s)))
for _name, _axis in (
    ("bi_measures_by_state", "customer_state"),
    ("bi_measures_by_category", "category"),
    ("bi_measures_by_city", "customer_city"),
    ("bi_measures_by_seller", "seller_id"),
    ("bi_measures_by_payment_type", "dominant_payment_type"),
    ("bi_measures_by_delivery_status", "delivery_status"),
):
    register(_name, _written_on_marts(lambda b, a=_axis: measures.bi_measures_by(b, a)))
register("bi_measures_sliced", _on_marts(lambda b: measures.bi_measures_by(
    b, "customer_state",
    measures.Slicers(date_from="1996-01-01", date_to="2000-01-01",
                     categories=["standard goods", "small goods"], customer_segment="repeat"))))
register("bi_month_to_date", _on_marts(measures.bi_month_to_date))
register("bi_month_to_date_sliced", _on_marts(lambda b: measures.bi_month_to_date(
    b, measures.Slicers(states=("EUROPE",), status_mode="delivered"))))
register("bi_month_over_month", _on_marts(measures.bi_month_over_month))

# --------------------------------------------------------------------- dashboard data sets
register("ds_cohort_matrix", _report(measures.ds_cohort_matrix))
register("ds_category_delay", lambda spark, d: measures.by_revenue(_written_on_marts(measures.ds_category_delay)(spark, d)))
for _name in ("ds_repeat_share", "ds_category_share", "ds_seller_scorecard",
              "ds_seller_geography", "ds_delivery_trend", "ds_late_rate_by_state", "ds_weekday_month_heatmap",
              "ds_growth_waterfall", "ds_exceptions", "ds_state_matrix", "ds_state_leaders", "ds_drilldown_rollup"):
    register(_name, _on_marts(getattr(measures, _name)))

# --------------------------------------------------------------------- EDA profiles
register("eda_overview", _on_marts_and_clean(lambda b, c: eda.overview(eda.profile_tables(b, c))))
register("eda_missing", _on_marts_and_clean(lambda b, c: eda.missing_values(eda.profile_tables(b, c))))
register("eda_hist_order_value", _on_marts(lambda b: eda.histogram(eda.profiled(b, "fact_orders"), "order_value")))
register("eda_hist_freight", _on_marts(lambda b: eda.histogram(eda.profiled(b, "fact_order_items"), "freight_value")))
register("eda_hist_weight", _on_marts(lambda b: eda.histogram(eda.profiled(b, "dim_products"), "product_weight_g")))
register("eda_hist_customer_revenue", _on_marts(lambda b: eda.histogram(eda.profiled(b, "customer_metrics"), "revenue")))
register("eda_review_counts", lambda spark, d: eda.value_counts(layers.cleaned_layer(spark, d)["order_reviews"],
                                                                "review_score"))
register("eda_weekday_counts", _on_marts(eda.weekday_counts))
register("eda_monthly_trend", _on_marts(eda.monthly_trend))
register("eda_correlation", _on_marts_and_clean(lambda b, c: eda.correlation(eda.correlation_tables(b, c))))
register("eda_top_states", _on_marts(eda.top_states))
register("eda_customer_metrics", _on_marts(eda.top_customers))
register("eda_repeat_counts", _on_marts(eda.repeat_counts))
register("eda_top_categories_15", _on_marts_and_clean(eda.top_categories))
register("eda_headlines", _on_marts_and_clean(eda.headlines))



def _on_raw(fn) -> Query:
    """A profile of the raw exports: no mart or cleaned table is built."""
    return lambda spark, sf_dir: fn(sources_eda.from_raw(layers.raw_layer(spark, sf_dir)))


def _on_resolved(fn) -> Query:
    return _on_raw(lambda tables: fn(sources_eda.resolved(tables)))


register("eda_raw_overview", _on_raw(lambda t: eda.overview({n: eda.Profiled(df, stats_of(df)) for n, df in t.items()})))
register("eda_raw_hist_order_value", _on_resolved(lambda r: eda.histogram(r.fact_orders, "order_value")))
register("eda_raw_hist_freight", _on_resolved(lambda r: eda.histogram(r.fact_order_items, "freight_value")))
register("eda_raw_hist_weight", _on_resolved(lambda r: eda.histogram(r.dim_products, "product_weight_g")))
register("eda_raw_review_counts", _on_resolved(lambda r: eda.value_counts(r.reviews, "review_score")))
for _name, _fn in (("weekday_counts", eda.weekday_counts), ("monthly_trend", eda.monthly_trend),
                   ("top_states", eda.top_states), ("customer_metrics", eda.top_customers)):
    register(f"eda_raw_{_name}", _on_resolved(_fn))
register("eda_raw_top_categories_15", _on_resolved(lambda r: eda.top_categories(r, r.cleaned)))
register("eda_raw_headlines", _on_resolved(lambda r: eda.headlines(r, r.cleaned)))

# --------------------------------------------------------------------- data quality
register("dq_table_health", lambda spark, d: quality.table_health(layers.cleaned_layer(spark, d)))
register("dq_reconcile_revenue", _on_marts_and_clean(quality.reconcile_monthly_revenue))
register("dq_reconcile_pack", _on_marts_and_clean(reconcile.reconcile_pack))

# --------------------------------------------------------------------- more dashboard data sets
register("ds_top_categories_by_units", _on_marts(measures.ds_top_categories_by_units))
register("ds_customer_points", _on_marts(measures.ds_customer_points))
register("ds_customer_points_sample", _on_marts(measures.ds_customer_points_sample))
register("ds_city_volume", _on_marts(measures.ds_city_volume))
register("ds_seller_concentration", _on_marts(measures.ds_seller_concentration))
