"""Profiling / EDA data sets: table overview, missing values, histograms, value counts,
correlations, trends and headline figures.

Everything is computed in Spark and returned as small result tables; nothing is drawn.
Row counts, NULL counts and column ranges are figures of a table that its write has counted
(``plans.stats``); tables that no layer has written are counted in one aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.functions.numeric import exact_avg, round_to
from souk.plans.marts import SUM_TYPE, FeatureBundle, exact_sum, zero_if_null
from souk.plans.stats import TableStats, stats_of


def _round(c: Column, d: int) -> Column:
    return round_to(c, d)


def profile_tables(b: FeatureBundle, cleaned: Mapping[str, DataFrame]) -> dict[str, Profiled]:
    """The eight tables the EDA looks at (marts where they exist, cleaned tables otherwise)."""
    marts = {"orders": "fact_orders", "order_items": "fact_order_items", "customers": "dim_customers",
             "products": "dim_products", "sellers": "dim_sellers"}
    others = {"payments": "order_payments", "reviews": "order_reviews", "categories": "category_translation"}
    sources = [(name, b, mart) for name, mart in marts.items()] + [(name, cleaned, t) for name, t in others.items()]
    return {name: profiled(source, table) for name, source, table in sources}


@dataclass(frozen=True)
class Profiled:
    """A table and its figures, which a written layer knows without a scan."""

    frame: DataFrame
    stats: TableStats


def profiled(source, table: str) -> Profiled:
    """A table of a layer with what its write has counted; of other sources, counted now."""
    frame = source[table] if isinstance(source, Mapping) else getattr(source, table)
    return Profiled(frame, source.stats(table) if hasattr(source, "stats") else stats_of(frame))


def overview(tables: dict[str, Profiled]) -> DataFrame:
    """Rows, columns, missing cells and their share per table, from the tables' figures."""
    spark = next(iter(tables.values())).frame.sparkSession
    rows = [(n, p.stats.rows, len(p.stats.nulls), sum(p.stats.nulls.values())) for n, p in tables.items()]
    df = spark.createDataFrame(rows, "table string, rows bigint, columns bigint, missing_cells bigint")
    cells = F.greatest(F.col("rows") * F.col("columns"), F.lit(1)).cast("double")
    share = _round(F.try_divide(F.col("missing_cells").cast("double"), cells) * 100, 2)
    return df.withColumn("missing_pct", share).orderBy(F.col("rows").desc(), "table")


def missing_values(tables: dict[str, Profiled], per_table: int = 8) -> DataFrame:
    """Columns with missing values: percentage per column, the top ``per_table`` per table."""
    spark = next(iter(tables.values())).frame.sparkSession
    rows = [
        (name, column, n, p.stats.rows)
        for name, p in tables.items()
        for column, n in sorted(p.stats.nulls.items(), key=lambda x: (-x[1], x[0]))[:per_table]
        if n
    ]
    df = spark.createDataFrame(rows, "table string, column string, n bigint, rows bigint")
    share = _round(F.col("n").cast("double") / F.col("rows").cast("double") * 100, 2)
    df = df.select("table", "column", share.alias("missing_pct"))
    return df.orderBy(F.col("missing_pct").desc(), "table", "column")


def histogram(of: Profiled | DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Equal-width histogram over [min, max] (last bin closed), every bin listed. The range comes
    from the table's figures where they are known, so the table is read once."""
    of = of if isinstance(of, Profiled) else Profiled(of, stats_of(of.select(column)))
    df, lo, hi = of.frame, of.stats.low.get(column), of.stats.high.get(column)
    spark = df.sparkSession
    schema = "bin bigint, bin_start double, bin_end double, count bigint"
    if lo is None:
        return spark.createDataFrame([], schema)
    v = F.col(column).cast("double")
    vals = df.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    width = (hi - lo) / bins if hi > lo else 1.0
    idx = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("bigint")
    counts = vals.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = spark.range(bins).select(F.col("id").alias("bin"))
    return (
        grid.join(F.broadcast(counts), "bin", "left")  # a row per bin
        .select(
            "bin",
            (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
            (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
            F.coalesce(F.col("count"), F.lit(0)).alias("count"),
        )
        .orderBy("bin")
    )


def customer_metrics(b: FeatureBundle) -> DataFrame:
    """Orders and revenue per customer id, with the person key and repeat flag."""
    per = b.fact_orders.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        zero_if_null(exact_sum("order_value")).alias("revenue"),
    )
    return per.join(b.dim_customers.select("customer_id", "customer_unique_id"), "customer_id", "left").withColumn(
        "repeat_customer", F.col("total_orders") > 1
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), column)


# Calendar order of weekday names.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def weekday_counts(b: FeatureBundle) -> DataFrame:
    spark = b.fact_orders.sparkSession
    days = spark.createDataFrame([(i, d) for i, d in enumerate(WEEKDAYS)], "weekday_index int, weekday string")
    counts = b.fact_orders.where(F.col("weekday").isNotNull()).groupBy("weekday").agg(
        F.count(F.lit(1)).alias("orders")
    )
    return (
        days.join(counts, "weekday", "left")
        .select("weekday_index", "weekday", F.coalesce("orders", F.lit(0)).alias("orders"))
        .orderBy("weekday_index")
    )


def monthly_trend(b: FeatureBundle) -> DataFrame:
    return (
        b.fact_orders.where(F.col("order_month").isNotNull())
        .groupBy("order_month")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            zero_if_null(exact_sum("order_value")).alias("revenue"),
        )
        .orderBy("order_month")
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def correlation_tables(b: FeatureBundle, cleaned: Mapping[str, DataFrame]) -> dict[str, Profiled]:
    return {
        "orders": profiled(b, "fact_orders"),
        "order_items": profiled(b, "fact_order_items"),
        "products": profiled(b, "dim_products"),
        "reviews": profiled(cleaned, "order_reviews"),
    }


def _moments(df: DataFrame, cols: list[str], base: list[float]) -> DataFrame:
    """Per column pair the sums over the rows where both have a value: n, x, y, xx, yy, xy, of
    values taken relative to ``base``, the columns' minima. Each task reduces its batches with matrix
    products and emits one row per pair."""
    n = len(cols)
    first, second = np.triu_indices(n, 1)

    def reduce_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, len(first)))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            has = np.isfinite(x).astype(float)
            x = np.where(has > 0, x, 0.0)
            sums = (has.T @ has, x.T @ has, (x * x).T @ has, x.T @ x)
            parts = (sums[0], sums[1], sums[1].T, sums[2], sums[2].T, sums[3])
            total += np.array([p[first, second] for p in parts])
        names = ["n", "x", "y", "xx", "yy", "xy"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(first))), *map(pa.array, total)], names=["pair", *names]
        )

    shifted = df.select(*[(F.col(c).cast("double") - F.lit(base[i])).alias(f"c{i}") for i, c in enumerate(cols)])
    rows = shifted.mapInArrow(reduce_batches, "pair long, n double, x double, y double, xx double, yy double, xy double")
    return rows.groupBy("pair").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])


def correlation(tables: dict[str, Profiled | DataFrame]) -> DataFrame:
    """Pairwise-complete Pearson correlation of the numeric columns within each table; NULL
    where a column has no spread. A table is read once, for sums of products that each task
    reduces to a row per column pair; the columns' minima are among its figures."""
    parts = []
    for name, of in tables.items():
        of = of if isinstance(of, Profiled) else Profiled(of, stats_of(of))
        df = of.frame
        cols = numeric_columns(df)
        pairs = [(a, c) for i, a in enumerate(cols) for c in cols[i + 1:]]
        if not pairs:
            continue
        n = F.col("n")
        spread_x, spread_y = n * F.col("xx") - F.col("x") * F.col("x"), n * F.col("yy") - F.col("y") * F.col("y")
        # Rounding leaves a trace of spread where there is none.
        some = (spread_x > n * F.col("xx") * 1e-13) & (spread_y > n * F.col("yy") * 1e-13)
        r = F.when(some, (n * F.col("xy") - F.col("x") * F.col("y")) / (F.sqrt(spread_x) * F.sqrt(spread_y)))
        names_a, names_b = (F.array(*[F.lit(p[k]) for p in pairs]) for k in (0, 1))
        parts.append(
            _moments(df, cols, [of.stats.low.get(c, 0.0) for c in cols]).select(
                F.lit(name).alias("table"),
                F.get(names_a, F.col("pair")).alias("column_a"),
                F.get(names_b, F.col("pair")).alias("column_b"),
                _round(r, 4).alias("correlation"),
            )
        )
    return reduce(DataFrame.unionByName, parts).orderBy("table", "column_a", "column_b")


def _state_summary(b: FeatureBundle) -> DataFrame:
    return (
        b.fact_orders.join(b.dim_customers.select("customer_id", "customer_state"), "customer_id", "left")
        .groupBy("customer_state")
        .agg(
            zero_if_null(exact_sum("order_value")).alias("revenue"),
            F.count_distinct("order_id").alias("orders"),
        )
        .where(F.col("customer_state").isNotNull())
    )


def top_states(b: FeatureBundle, n: int = 15) -> DataFrame:
    return _state_summary(b).orderBy(F.col("revenue").desc_nulls_last(), "customer_state").limit(n)


def top_customers(b: FeatureBundle, n: int = 10) -> DataFrame:
    return customer_metrics(b).orderBy(F.col("revenue").desc_nulls_last(), "customer_id").limit(n)


def repeat_counts(b: FeatureBundle) -> DataFrame:
    m = customer_metrics(b)
    return (
        m.groupBy(F.when(F.col("repeat_customer"), F.lit("Repeat")).otherwise(F.lit("One-time")).alias("segment"))
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(F.col("customers").desc(), "segment")
    )


def category_summary(b: FeatureBundle, cleaned: dict[str, DataFrame]) -> DataFrame:
    """Item revenue (price + freight), orders and units per English category."""
    items = cleaned["order_items"]
    products = cleaned["products"].select("product_id", "product_category_name")
    cats = cleaned["category_translation"]
    df = items.join(products, "product_id", "left").join(cats, "product_category_name", "left")
    item_revenue = F.coalesce(F.col("price"), F.lit(0.0)) + F.coalesce(F.col("freight_value"), F.lit(0.0))
    return (
        df.where(F.col("product_category_name_english").isNotNull())
        .groupBy("product_category_name_english")
        .agg(
            F.sum(item_revenue.cast(SUM_TYPE)).cast("double").alias("revenue"),
            F.count_distinct("order_id").alias("orders"),
            F.count("product_id").alias("units_sold"),
        )
    )


def top_categories(b: FeatureBundle, cleaned: dict[str, DataFrame], n: int = 15) -> DataFrame:
    return (
        category_summary(b, cleaned)
        .orderBy(F.col("revenue").desc_nulls_last(), "product_category_name_english")
        .limit(n)
    )


def headlines(b: FeatureBundle, cleaned: dict[str, DataFrame]) -> DataFrame:
    """Total revenue, top state, top category and repeat-customer share in one row."""
    m = customer_metrics(b)
    total = m.agg(F.sum(F.col("revenue").cast(SUM_TYPE)).cast("double")).scalar()
    share = m.agg(exact_avg(F.col("repeat_customer").cast("double"))).scalar()

    def leader(df: DataFrame, key: str) -> Column:
        return df.agg(F.min(F.struct((-F.col("revenue")).alias("k"), F.col(key).alias("s")))["s"]).scalar()

    return b.fact_orders.sparkSession.range(1).select(
        total.alias("total_revenue"),
        leader(_state_summary(b), "customer_state").alias("top_state"),
        leader(category_summary(b, cleaned), "product_category_name_english").alias("top_category"),
        _round(share, 4).alias("repeat_customer_share"),
    )
