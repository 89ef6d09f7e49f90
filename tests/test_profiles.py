"""EDA on raw exports, frame comparison, samples, modes of long texts, and the options of fills,
zips and ranks."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from souk.operators import clean as op
from souk.operators import ranking, sampling
from souk.plans import cleaning, eda, kpis, layers, reconcile, reports, sources_eda
from souk.sources import io
from souk.sources.fixtures import RetailTables

SF = "/root/testdata/sf0.001"


# EDA on raw exports ---------------------------------------------------------------------------
def raw_tables(spark):
    def frame(rows, columns):
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns.split()))

    return {
        "orders": frame(
            [("o1", "c1", "2020-01-06 10:00:00"), ("o2", "c1", "bad"), ("o3", "c2", "2020-02-01 00:00:00"), ("o4", "c2", None)],
            "order_id customer_id order_purchase_timestamp",
        ),
        "order_items": frame(
            [("o1", "p1", "10.5", "1"), ("o1", "p2", "oops", "2"), ("o3", "p1", "abc", None), (None, "p1", "7", "7")],
            "order_id product_id price freight_value",
        ),
        "customers": frame([("c1", "u1", "SP"), ("c2", "u2", None)], "customer_id customer_unique_id customer_state"),
        "products": frame([("p1", "toys", "100"), ("p2", None, "x")], "product_id product_category_name product_weight_g"),
        "sellers": frame([("s1",)], "seller_id"),
        "payments": frame([("o1",)], "order_id"),
        "reviews": frame([("5",), ("5.0",), ("n",), (None,)], "review_score"),
        "categories": frame([("toys", "Toys")], "product_category_name product_category_name_english"),
    }


def test_raw_columns_come_from_their_next_producer(spark):
    r = sources_eda.resolved(raw_tables(spark))
    orders = {x.order_id: x for x in r.fact_orders.collect()}
    assert (orders["o1"].order_value, orders["o1"].order_month, orders["o1"].weekday) == (10.5, "2020-01", "Monday")
    assert orders["o3"].order_value == 0.0  # rows without a number
    assert orders["o4"].order_value is None and orders["o2"].order_month is None  # no rows; no time
    trend = {x.order_month: (x.orders, x.revenue) for x in eda.monthly_trend(r).collect()}
    assert trend == {"2020-01": (1, 10.5), "2020-02": (1, 0.0)}
    assert {x.review_score: x["count"] for x in eda.value_counts(r.reviews, "review_score").collect()} == {5.0: 2}
    [top] = eda.top_categories(r, r.cleaned).collect()
    assert (top.product_category_name_english, top.revenue, top.orders, top.units_sold) == ("Toys", 25.5, 2, 3)


def test_marts_are_preferred_to_sums(spark):
    tables = raw_tables(spark)
    mart = tables["orders"].withColumn("order_value", F.lit(3.0)).withColumn("order_month", F.lit("1999-09"))
    chosen = sources_eda.resolve({n: d.columns for n, d in (tables | {"orders": mart}).items()})
    assert chosen["orders"]["order_value"] == sources_eda.Own("order_value", "number")
    assert isinstance(sources_eda.resolve({n: d.columns for n, d in tables.items()})["orders"]["order_value"], sources_eda.SumOf)
    r = sources_eda.resolved(tables | {"orders": mart})
    assert {(x.order_value, x.order_month) for x in r.fact_orders.collect()} == {(3.0, "1999-09")}


def test_all_unresolved_columns_are_reported(spark):
    tables = raw_tables(spark)
    tables["order_items"] = tables["order_items"].drop("price")
    tables["customers"] = tables["customers"].drop("customer_state")
    with pytest.raises(sources_eda.Unresolved) as err:
        sources_eda.resolved(tables)
    assert all(x in str(err.value) for x in ("orders.order_value", "order_items.price", "customers.customer_state"))


def test_eda_opens_saved_tables_before_exports(spark, tmp_dir):
    saved, raw = os.path.join(tmp_dir, "saved"), os.path.join(tmp_dir, "raw")
    tables = raw_tables(spark)
    for name, (_, table) in sources_eda.EDA_SOURCES.items():
        tables[name].coalesce(1).write.option("header", True).csv(f"{raw}/{io.SOURCE_FILENAMES[table]}")
    mart = tables["orders"].withColumn("order_value", F.lit(42.0))
    mart.write.parquet(f"{saved}/fact_orders_features")
    opened = sources_eda.open_tables(spark, saved, raw)
    r = sources_eda.resolved(opened)
    assert {x.order_value for x in r.fact_orders.collect()} == {42.0}
    assert r.fact_order_items.count() == 4
    assert sources_eda.from_raw(layers.raw_layer(spark, SF)).keys() == tables.keys()


# Comparison -----------------------------------------------------------------------------------
def test_compare_finds_every_kind_of_difference(spark):
    left = spark.createDataFrame(
        [("a", 1.0, "x"), ("b", 2.0, "x"), ("c", None, None), ("d", 4.0, "x"), ("e", 1.0, "x"), ("e", 1.0, "x"), (None, 7.0, "n")],
        "k string, v double, t string",
    )
    right = spark.createDataFrame(
        [("a", 1, "x"), ("b", 3, "y"), ("c", None, None), ("e", 1, "x"), ("f", 6, "x"), (None, 7, None)],
        "k string, v int, t string",
    )
    got = {(r.k, r.column): r.verdict for r in reconcile.compare(left, right, ["k"], ["v", "t"], 0.5).collect()}
    assert got == {
        ("a", "v"): "match", ("a", "t"): "match", ("b", "v"): "differs", ("b", "t"): "differs", ("c", "v"): "match",
        ("c", "t"): "match", ("d", "v"): "only_left", ("d", "t"): "only_left", ("e", "v"): "repeated_key",
        ("e", "t"): "repeated_key", ("f", "v"): "only_right", ("f", "t"): "only_right", (None, "v"): "match",
        (None, "t"): "differs",
    }
    types = reconcile.compare(left, right.withColumn("v", F.col("v").cast("string")), ["k"], ["v"])
    assert {r.verdict for r in types.where("k = 'a'").collect()} == {"types"}
    counts = {(r.column, r.verdict): r.rows for r in reconcile.verdicts(reconcile.compare(left, right, ["k"], ["v"])).collect()}
    assert counts["v", "match"] == 3 and counts["v", "differs"] == 1


def test_pack_agrees_with_the_marts_and_planted_errors_are_found(spark):
    marts, cleaned = layers.mart_layer(spark, SF), layers.cleaned_layer(spark, SF)
    rows = reconcile.reconcile_pack(marts, cleaned).collect()
    assert {r.verdict for r in rows} == {"match"} and {r.report for r in rows} == {"revenue_analysis", "growth_rate"}
    month = rows[0].order_month

    class Wrong:
        fact_orders = marts.fact_orders.withColumn(
            "order_value", F.when(F.col("order_month") == month, F.col("order_value") + 1).otherwise(F.col("order_value"))
        ).where("order_month <> '1997-05'")

    found = {(r.order_month, r.report, r.column): r.verdict for r in reconcile.reconcile_pack(Wrong(), cleaned).collect()}
    bad = {k: v for k, v in found.items() if v != "match"}
    assert {k[0] for k in bad} == {month, "1997-05"}
    assert all(v == ("only_right" if k[0] == "1997-05" else "differs") for k, v in bad.items())
    assert bad[month, "growth_rate", "monthly_revenue"] == "differs"


# Samples --------------------------------------------------------------------------------------
def test_samples_repeat_and_are_taken_by_stratum(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3).cast("string").alias("s")).where("s <> '2' OR id < 30")
    first = sampling.bottom_k(df, "s", "id", 40)
    again = sampling.bottom_k(df.repartition(7).withColumn("more", F.lit(1)), "s", "id", 40)
    rows = {(r.s, r.id) for r in first.collect()}
    assert rows == {(r.s, r.id) for r in again.collect()}
    assert {s: sum(r[0] == s for r in rows) for s in "012"} == {"0": 40, "1": 40, "2": 10}
    assert rows != {(r.s, r.id) for r in sampling.bottom_k(df, "s", "id", 40, seed="other").collect()}
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()


# Fills, zips, ranks, reports ------------------------------------------------------------------
def test_mode_of_long_texts(spark):
    a, b = "b" * 100, "a" * 100
    df = spark.createDataFrame([(a, "s"), (a, a), (b, a), (b, "s"), (None, None), ("z", "s")], "long string, mixed string")
    assert [(r.long, r.mixed) for r in op.fill_categorical_mode(df, ["long", "mixed"]).where("long = 'z' OR mixed IS NULL").collect() or []] == [("z", "s")]
    filled = {tuple(r) for r in op.fill_categorical_mode(df, ["long", "mixed"]).collect()}
    assert (b, "s") in filled and (None, None) not in filled  # ties: the smallest text
    counts = op.value_counts(df, [], ["long", "mixed"])
    assert counts.where("length(text) > 64").count() == 0 and counts.where("long_text IS NOT NULL").count() == 3
    alone = spark.createDataFrame([(f"{i}" + "x" * 99,) for i in range(5)] + [(None,)], "t string")
    assert sorted(r.t for r in op.fill_categorical_mode(alone, ["t"]).collect())[:2] == ["0" + "x" * 99] * 2


def test_fill_strategy_and_legacy_zip(spark):
    raw = spark.createDataFrame(
        [("1", "SAO PAULO", None, "01037.0"), ("2", "SAO PAULO", "SP", "0"), ("3", None, "SP", "00420"), ("4", "X", "SP", None)],
        "customer_id string, customer_city string, customer_state string, customer_zip_code_prefix string",
    )
    constant = {r.customer_id: r for r in cleaning.clean_table("customers", raw, strategy="constant").collect()}
    assert constant["3"].customer_city == "Unknown" and constant["1"].customer_state == "Unknown"
    mode = {r.customer_id: r for r in cleaning.clean_table("customers", raw, legacy_zip=True).collect()}
    assert mode["3"].customer_city == "SAO PAULO"
    assert [mode[k].customer_zip_code_prefix for k in "1234"] == ["1037", "0", "420", "00000"]
    assert constant["3"].customer_zip_code_prefix == "00420"
    with pytest.raises(ValueError, match="strategy"):
        op.fill_categorical_mode(raw, ["customer_city"], strategy="guess")


def test_rank_with_nulls_first(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 9.0), (4, None), (5, 5.0)], "id int, v double")
    got = {r.id: r.rk for r in ranking.global_rank(df, "v", "rk", nulls="first").collect()}
    assert got == {2: 1, 4: 1, 3: 3, 1: 4, 5: 4}
    with pytest.raises(ValueError, match="nulls"):
        ranking.descending("v", "middle")


def test_kpi_report_takes_layers_and_names_missing_marts(spark):
    report = kpis.build_kpi_report(layers.mart_layer(spark, SF))
    assert report.total_revenue.first().value > 0
    with pytest.raises(kpis.KPIError, match="dim_sellers"):
        kpis.build_kpi_report(object())


def test_distinct_products_of_a_large_order(spark):
    from souk.plans import marts

    rows = [("o", i, f"p{i % 700}" if i % 5 else None, f"s{i % 3}" if i % 2 else None, 1.25, None) for i in range(3000)]
    schema = "order_id string, order_item_id long, product_id string, seller_id string, price double, freight_value double"
    [r] = marts.order_item_summary(spark.createDataFrame(rows, schema).repartition(4)).collect()
    products, sellers = {x[2] for x in rows} - {None}, {x[3] for x in rows} - {None}
    assert (r.total_items, r.unique_products, r.unique_sellers) == (3000, len(products), len(sellers))
    assert (r.gross_item_value, r.gross_freight_value, r.average_item_price) == (3750.0, None, 1.25)


def cohort_tables(spark, orders, people):
    rows = [(i, c, "delivered", t) for i, (c, t) in enumerate(orders)]
    schema = "order_id int, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz"
    frame = spark.createDataFrame(rows, schema)
    customers = spark.createDataFrame(people, "customer_id string, customer_unique_id string")
    return RetailTables({"orders": lambda: frame, "customers": lambda: customers})


def test_cohorts_from_month_bits(spark):
    d = dt.datetime
    orders = [("a", d(1970, 1, 31)), ("b", d(1974, 12, 1)), ("a", d(1975, 1, 1)), ("b", d(1974, 12, 30)), ("c", d(2089, 12, 31)),
              ("d", d(1999, 5, 5)), ("d", None), ("e", None)]
    people = [("a", "p"), ("b", "p"), ("c", "q"), ("d", "r"), ("e", "s")]
    got = {(r.customer_unique_id, r.cohort_month, r.order_month, r.month_number)
           for r in reports.cohort_activity(cohort_tables(spark, orders, people)).collect()}
    start = d(1970, 1, 1)
    assert got == {
        ("p", start, start, 0), ("p", start, d(1974, 12, 1), 59), ("p", start, d(1975, 1, 1), 60),
        ("q", d(2089, 12, 1), d(2089, 12, 1), 0), ("r", d(1999, 5, 1), d(1999, 5, 1), 0), ("r", d(1999, 5, 1), None, None),
        ("s", None, None, None),
    }
    late = cohort_tables(spark, [("a", d(2090, 1, 1))], people)
    with pytest.raises(Exception, match="1970 to 2089"):
        reports.cohort_activity(late).collect()
