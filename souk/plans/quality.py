"""Data-quality checks: row counts and key health of the cleaned tables, and the
reconciliation of mart revenue against an independent recomputation (SQL-pack style)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.numeric import round_to
from souk.plans.cleaning import SPECS
from souk.plans.marts import SUM_TYPE, FeatureBundle
from souk.plans.stats import stats_of

# Key columns that must be unique and non-NULL after cleaning.
CLEAN_KEYS = {name: spec.keys for name, spec in SPECS.items() if spec.keys}
CLEAN_KEYS["geolocation"] = ("geolocation_zip_code_prefix",)


def table_health(cleaned: Mapping[str, DataFrame]) -> DataFrame:
    """Per cleaned table: rows, NULL cells, rows with a NULL key, surplus rows per key. The figures
    of written layers come from their writes; only the keys are read again, to be counted."""
    parts = []
    for name, df in cleaned.items():
        keys = list(CLEAN_KEYS.get(name, ()))
        s = cleaned.stats(name) if hasattr(cleaned, "stats") else stats_of(df, keys)
        surplus = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint")
        repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(surplus) if keys else None
        figures = (F.lit(v).cast("bigint").alias(n) for n, v in (
            ("rows", s.rows), ("null_cells", sum(s.nulls.values())), ("null_key_rows", s.null_keys)
        ))
        one = df.sparkSession.range(1) if repeated is None else repeated.toDF("_surplus")
        duplicates = F.lit(0).cast("bigint") if repeated is None else F.col("_surplus")
        parts.append(one.select(F.lit(name).alias("table"), *figures, duplicates.alias("duplicate_key_rows")))
    return reduce(DataFrame.unionByName, parts).orderBy("table")


def reconcile_monthly_revenue(b: FeatureBundle, cleaned: dict[str, DataFrame]) -> DataFrame:
    """Mart monthly revenue vs. a direct recomputation from the cleaned tables (orders left
    join item totals, all statuses): one row per month with both values and the gap."""
    orders, items = cleaned["orders"], cleaned["order_items"]
    totals = items.groupBy("order_id").agg(
        F.sum(F.coalesce(F.col("price"), F.lit(0.0)).cast(SUM_TYPE)).alias("p"),
        F.sum(F.coalesce(F.col("freight_value"), F.lit(0.0)).cast(SUM_TYPE)).alias("f"),
    )
    direct = (
        orders.where(F.col("order_purchase_timestamp").isNotNull())
        .join(totals, "order_id", "left")
        .groupBy(F.date_format("order_purchase_timestamp", "yyyy-MM").alias("order_month"))
        .agg(
            F.sum(F.coalesce(F.col("p"), F.lit(0)) + F.coalesce(F.col("f"), F.lit(0))).cast("double").alias(
                "recomputed_revenue"
            )
        )
    )
    mart = b.monthly_revenue.select("order_month", F.col("monthly_revenue").alias("mart_revenue"))
    joined = mart.join(direct, "order_month", "full_outer")
    gap = round_to(F.coalesce(F.col("mart_revenue"), F.lit(0.0)) - F.coalesce(F.col("recomputed_revenue"), F.lit(0.0)), 2)
    return joined.select(
        "order_month", "mart_revenue", "recomputed_revenue", gap.alias("difference"), (gap == 0).alias("matches")
    ).orderBy("order_month")
