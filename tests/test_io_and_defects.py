"""CSV/Parquet sources and sinks, and the pinned decisions for defects of the original
workflow (duplicate total_orders, payment fallback, fan-out report)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from souk.operators import clean as op
from souk.plans import cleaning, marts
from souk.sources import io


def _write(path, text, bom=False):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(("﻿" if bom else "") + text)


def test_read_csv_handles_quotes_newlines_bom_and_na_tokens(spark, tmp_dir):
    p = os.path.join(tmp_dir, "reviews.csv")
    _write(
        p,
        'Review ID,order_id,review_comment_message\r\n'
        '1,10,"line one\nline ""two"""\r\n'
        '2,NA,plain\r\n'
        '3,11,\r\n',
        bom=True,
    )
    df = io.read_csv(spark, p)
    assert df.columns == ["review_id", "order_id", "review_comment_message", "source_row_order"]
    rows = sorted(df.collect(), key=lambda r: r.review_id)
    assert rows[0].review_comment_message == 'line one\nline "two"'
    assert rows[1].order_id is None
    assert rows[2].review_comment_message is None
    assert [r.source_row_order for r in rows] == sorted(r.source_row_order for r in rows)


def test_load_raw_datasets_reports_every_missing_file(spark, tmp_dir):
    _write(os.path.join(tmp_dir, io.SOURCE_FILENAMES["customers"]), "customer_id\n1\n")
    with pytest.raises(io.DatasetLoadError) as err:
        io.load_raw_datasets(spark, tmp_dir)
    msg = str(err.value)
    assert all(io.SOURCE_FILENAMES[t] in msg for t in io.SOURCES if t != "customers")


def test_missing_required_column_is_reported(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "x.csv"), "a,b\n1,2\n")
    with pytest.raises(Exception, match="customer_id"):
        io.load_table(spark, tmp_dir, io.SourceFile("customers", "x.csv", ("customer_id",), None))


def test_write_overwrite_and_skip(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    io.write_table(spark.range(3), path)
    io.write_table(spark.range(5), path, overwrite=False)
    assert spark.read.parquet(path).count() == 3
    io.write_table(spark.range(5), path, overwrite=True)
    assert spark.read.parquet(path).count() == 5


def test_csv_round_trip_and_fallback(spark, tmp_dir):
    df = spark.createDataFrame([("a,b", 'say "hi"'), ("x\ny", None)], "p string, q string")
    out = os.path.join(tmp_dir, "rt")
    io.write_table(df, out, fmt="csv")
    back = io.read_first_available(spark, (os.path.join(tmp_dir, "missing"), "parquet"), (out, "csv"))
    assert sorted((r.p, r.q) for r in back.collect()) == sorted([("a,b", 'say "hi"'), ("x\ny", None)])
    with pytest.raises(FileNotFoundError):
        io.read_first_available(spark, (os.path.join(tmp_dir, "nope"), "parquet"))


def _tables(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", "delivered", dt.datetime(2020, 1, 5)),
         ("o2", "c1", "delivered", dt.datetime(2020, 3, 5)),
         ("o3", "c2", "shipped", dt.datetime(2020, 2, 1)),
         ("o4", "c3", "shipped", None)],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz",
    )
    for c in ("order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
              "order_estimated_delivery_date"):
        orders = orders.withColumn(c, F.lit(None).cast("timestamp_ntz"))
    items = spark.createDataFrame(
        [("o1", 1, "p1", "s1", 10.0, 1.0), ("o2", 1, "p1", "s1", 20.0, 2.0)],
        "order_id string, order_item_id long, product_id string, seller_id string, price double, freight_value double",
    )
    payments = spark.createDataFrame(
        [("o3", 1, "card", 1, 55.5), ("o1", 1, "card", 1, 11.0)],
        "order_id string, payment_sequential long, payment_type string, payment_installments long, payment_value double",
    )
    customers = spark.createDataFrame(
        [("c1", "u1", "SP"), ("c2", "u2", "RJ"), ("c3", "u3", "MG"), ("c4", "u4", "SP")],
        "customer_id string, customer_unique_id string, customer_state string",
    )
    return orders, items, payments, customers


def test_payment_fallback_applies_only_without_item_rows(spark):
    orders, items, payments, customers = _tables(spark)
    dim = {r.customer_id: r for r in marts.build_dim_customers(customers, orders, items, payments).collect()}
    assert dim["c1"].customer_revenue == 30.0          # item revenue wins
    assert dim["c2"].customer_revenue == 55.5          # no items: payment total
    assert dim["c3"].customer_revenue == 0.0           # neither
    assert dim["c4"].customer_revenue is None and dim["c4"].clv_approx == 0.0
    assert dim["c1"].total_orders == 2 and dim["c1"].repeat_customer
    assert dim["c1"].order_frequency_days == 60.0      # whole days between first and last order


def test_monthly_revenue_drops_null_months(spark):
    orders, items, payments, customers = _tables(spark)
    reviews = spark.createDataFrame([], "review_id string, order_id string, review_score long, "
                                        "review_answer_timestamp timestamp_ntz")
    fact = marts.build_fact_orders(orders, items, payments, reviews)
    monthly = {r.order_month: r for r in marts.build_monthly_revenue(fact).collect()}
    assert set(monthly) == {"2020-01", "2020-02", "2020-03"}
    assert monthly["2020-02"].monthly_revenue == 0.0   # order without items counts as 0
    f = {r.order_id: r for r in fact.collect()}
    assert f["o4"].order_month is None and f["o4"].monthly_revenue is None
    assert f["o1"].total_orders == 2 and f["o1"].total_orders_by_customer == 2


def test_clean_customers_keeps_first_duplicate_then_fills(spark):
    raw = spark.createDataFrame(
        [("1", "SAO PAULO", "SP", "1037.0", 0), ("1", "OTHER", "RJ", "1", 1), ("2", None, None, None, 0),
         ("3", "SAO PAULO", "SP", "01037", 0)],
        "customer_id string, customer_city string, customer_state string, customer_zip_code_prefix string, "
        "source_row_order long",
    )
    out = {r.customer_id: r for r in cleaning.clean_table("customers", raw).collect()}
    assert out["1"].customer_city == "SAO PAULO" and out["1"].customer_zip_code_prefix == "1037"
    assert out["2"].customer_city == "SAO PAULO" and out["2"].customer_zip_code_prefix == "00000"
    assert out["3"].customer_zip_code_prefix == "01037"
    assert "source_row_order" not in cleaning.clean_table("customers", raw).columns


def test_csv_export_round_trip_cleans_like_the_raw_table(spark, tmp_dir):
    """Raw customers written as one CSV export (duplicates after the originals, as in the
    source file) and read back: keep-first by file position must give the same cleaned
    table as the raw table with its explicit source order."""
    from souk.plans import layers

    raw = layers.raw_layer(spark, "/root/testdata/sf0.001")["customers"]
    ordered = raw.orderBy("source_row_order", "customer_id")
    out = os.path.join(tmp_dir, "export")
    io.write_table(ordered.drop("source_row_order").coalesce(1), out, fmt="csv")
    from_csv = cleaning.clean_table("customers", io.read_csv(spark, out))
    from_raw = cleaning.clean_table("customers", raw)
    key = ["customer_id", "customer_city", "customer_state", "customer_zip_code_prefix", "customer_unique_id"]
    assert sorted(tuple(r) for r in from_csv.select(*key).collect()) == sorted(
        tuple(r) for r in from_raw.select(*key).collect()
    )


def test_layers_are_written_under_the_checkpoint_dir(spark):
    from souk.plans import layers
    from souk.session import ensure_checkpoint_dir

    def plain(p):
        return p.replace("file:", "").lstrip("/")

    base = plain(ensure_checkpoint_dir(spark))
    paths = layers.cleaned_layer(spark, "/root/testdata/sf0.001")["orders"].inputFiles()
    assert paths and all(plain(p).startswith(base) for p in paths)


def test_source_order_follows_file_names(spark, tmp_dir):
    for name, rows in (("b.csv", "1,later"), ("a.csv", "1,first\n2,x"), ("c.csv", "2,y")):
        _write(os.path.join(tmp_dir, name), "customer_id,customer_city\n" + rows + "\n")
    from souk.operators import clean as op

    kept = op.dedupe_first(io.read_csv(spark, tmp_dir), ["customer_id"], ["source_row_order"])
    assert {r.customer_id: r.customer_city for r in kept.collect()} == {"1": "first", "2": "x"}


def test_saved_tables_and_month_partitions(spark, tmp_dir):
    fact = spark.createDataFrame([("o1", "2020-01", 1.0), ("o2", "2020-02", 2.0), ("o3", None, 3.0)],
                                 "order_id string, order_month string, order_value double")
    paths = io.save_marts({"fact_orders": fact}, tmp_dir)
    folders = [d for d in os.listdir(paths["fact_orders_features"]) if d.startswith("order_month=")]
    assert len(folders) == 3
    for d in folders:
        files = os.listdir(os.path.join(paths["fact_orders_features"], d))
        assert sum(f.endswith(".parquet") for f in files) == 1
    back = io.read_mart(spark, tmp_dir, "fact_orders", fact.schema)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, fact.collect()))
    cleaned = io.save_cleaned({"orders": fact}, tmp_dir)
    assert spark.read.parquet(cleaned["orders"]).count() == 3 and cleaned["orders"].endswith("orders_clean")


def test_kpi_report_runs_every_kpi(spark):
    from souk.plans import kpis, layers

    bundle = marts.FeatureBundle(**layers.mart_layer(spark, "/root/testdata/sf0.001").as_dict())
    report = kpis.build_kpi_report(bundle)
    frames = [getattr(report, f) for f in report.__dataclass_fields__] if hasattr(report, "__dataclass_fields__") else list(report.values())
    assert len(frames) >= 11 and all(f.columns for f in frames)


def test_profit_margin_without_cost_reads_as_missing(spark):
    from types import SimpleNamespace

    from souk.plans import kpis

    items = spark.createDataFrame([(1.0,)], "revenue double")
    row = kpis.profit_margin(SimpleNamespace(fact_order_items=items)).first()
    assert row.value is None and row.note


def test_exports_of_one_position_become_several_files_in_source_order(spark, tmp_dir):
    rows = [(f"r{i % 4000}", f"o{i % 4000}", str(i // 4000 + 1), i // 4000) for i in range(8000)]
    raw = spark.createDataFrame(rows, "review_id string, order_id string, review_score string, source_row_order long")
    for keep_order in (False, True):
        path = os.path.join(tmp_dir, f"export-{keep_order}")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            back = io.csv_round_trip(raw, path, keep_order)
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        sizes = [n for (n,) in back.groupBy(F.input_file_name()).count().select("count").collect()]
        assert len(sizes) > 2 and max(sizes) < 3000  # two positions used to make two files
        kept = op.dedupe_first(back, ["review_id"], ["source_row_order"])
        assert kept.count() == 4000 and {r.review_score for r in kept.collect()} == {"1"}


def test_export_files_hold_limited_rows(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(io, "EXPORT_ROWS", 50)
    raw = spark.range(1000).selectExpr("CAST(id AS STRING) AS order_id", "0L AS source_row_order")
    back = io.csv_round_trip(raw, os.path.join(tmp_dir, "export"))
    assert max(r["count"] for r in back.groupBy(F.input_file_name()).count().collect()) <= 50
    places = [r.order_id for r in back.orderBy("source_row_order").collect()]
    assert places == sorted(map(str, range(1000)))  # files follow each other by name


def test_layers_are_built_in_small_tasks(spark):
    from souk.plans.layers import Layer

    key, seen = "spark.sql.files.maxPartitionBytes", []
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes

    def build():
        seen.append(size(spark.conf.get(key)))
        return spark.range(3)

    before = spark.conf.get(key)
    for name in ("a", "b"):
        Layer(spark, "/nowhere", "small", {name: build})[name]
        assert spark.conf.get(key) == before
        spark.conf.set(key, before := "2m")  # a smaller setting of the session stays
    spark.conf.unset(key)
    assert seen == [16 << 20, 2 << 20]
