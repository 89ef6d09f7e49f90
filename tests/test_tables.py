"""Versions and month refreshes, figures counted by writes, month folders and their filters."""

import os

import pytest
from pyspark.sql import functions as F

from souk.plans import eda, layers, measures, quality
from souk.plans.stats import observed, stats_of
from souk.session import written
from souk.sources import versions

SF = "/root/testdata/sf0.001"


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(folder) for f in fs}


def test_publish_replaces_and_skips(spark, tmp_dir):
    table = os.path.join(tmp_dir, "t")
    with pytest.raises(FileNotFoundError):
        versions.read_published(spark, table)
    assert versions.publish(spark.range(3), table)
    assert not versions.publish(spark.range(5), table, overwrite=False)
    assert versions.read_published(spark, table).count() == 3
    assert versions.publish(spark.range(5), table)
    assert versions.read_published(spark, table).count() == 5


def test_a_write_that_dies_leaves_the_old_table(spark, tmp_dir):
    table = os.path.join(tmp_dir, "t")
    versions.publish(spark.range(3), table)
    dies = spark.range(0, 100, 1, 4).withColumn("x", F.when(F.col("id") > 60, F.raise_error(F.lit("died"))).otherwise("a"))
    with pytest.raises(Exception, match="died"):
        versions.publish(dies, table)
    assert versions.read_published(spark, table).count() == 3


def test_skip_does_not_take_remains_for_a_table(spark, tmp_dir):
    table = os.path.join(tmp_dir, "t")
    spark.range(9).write.parquet(f"{table}/version=dead")  # written, never published
    assert versions.publish(spark.range(2), table, overwrite=False)
    assert versions.read_published(spark, table).count() == 2


def test_two_writers_conflict(spark, tmp_dir):
    table = os.path.join(tmp_dir, "t")
    versions.publish(spark.range(1), table)
    store = versions._Files(spark, table)
    with pytest.raises(versions.Conflict):
        store.publish("_manifests/00000001.json", "{}")
    assert versions.read_published(spark, table).count() == 1


def test_refresh_of_a_month_leaves_other_files(spark, tmp_dir):
    table = os.path.join(tmp_dir, "t")
    rows = [("2020-01", 1, "a"), ("2020-02", 2, "b"), (None, 3, "c")]
    old = spark.createDataFrame(rows, "order_month string, order_id long, note string")
    versions.publish(old, table, "order_month")
    before = files(table)
    new = spark.createDataFrame([("2020-02", 20, "x"), ("2020-02", 21, None), ("2020-01", 99, "no")], old.schema)
    versions.refresh(new, table, ["2020-02", "2020-03"])
    assert {k: v for k, v in files(table).items() if k in before} == before
    got = sorted(map(tuple, versions.read_published(spark, table).collect()), key=repr)
    assert got == sorted([rows[0], rows[2], ("2020-02", 20, "x"), ("2020-02", 21, None)], key=repr)
    versions.refresh(new.limit(0), table, [None, "2020-02"])
    assert [tuple(r) for r in versions.read_published(spark, table).collect()] == [rows[0]]
    plan = versions.read_published(spark, table).where("order_month = '2020-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    versions.refresh(new.limit(0), table, ["2020-01"])
    assert versions.read_published(spark, table).collect() == []


def test_figures_of_a_write_are_those_of_the_table(spark):
    rows = [(1, "a", 2.5), (None, None, float("nan")), (3, "c", None), (7, "d", -1.0)]
    df = spark.createDataFrame(rows, "id long, name string, x double").repartition(3)
    counted, figures = observed(df, ["id", "name"])
    back = written(counted, "test-figures")
    s = figures()
    assert s == stats_of(back, ["id", "name"]) == stats_of(df, ["id", "name"])
    assert (s.rows, s.null_keys, s.nulls) == (4, 1, {"id": 1, "name": 1, "x": 1})
    assert (s.low, s.high) == ({"id": 1.0, "x": -1.0}, {"id": 7.0, "x": 2.5})
    empty = stats_of(df.limit(0), ["id"])
    assert (empty.rows, empty.null_keys, empty.low) == (0, 0, {})


def test_health_and_profiles_need_no_scan_but_for_keys(spark):
    cleaned = layers.cleaned_layer(spark, SF)
    health = quality.table_health(cleaned)
    plan = health._jdf.queryExecution().executedPlan().toString()
    read = [x.split("\n")[0] for x in plan.split("ReadSchema: ")[1:]]
    assert len(read) == 9 and not any("freight_value" in x or "order_status" in x for x in read)  # keys only
    marts = layers.mart_layer(spark, SF)
    tables = eda.profile_tables(marts, cleaned)
    for frame in (eda.overview(tables), eda.missing_values(tables)):
        assert "parquet" not in frame._jdf.queryExecution().toString().lower()


def test_histogram_and_correlation_read_their_table_once(spark):
    marts = layers.mart_layer(spark, SF)
    for frame in (eda.histogram(eda.profiled(marts, "fact_orders"), "order_value"),
                  eda.correlation({"t": eda.profiled(marts, "dim_products")})):
        assert frame._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_date_slicer_picks_month_folders(spark):
    marts = layers.mart_layer(spark, SF)
    s = measures.Slicers(date_from="1996-02-10", date_to="1996-04-01", status_mode="all")
    orders = measures.slice_bundle(marts, s).orders
    assert "PartitionFilters: [isnotnull(order_month" in orders._jdf.queryExecution().executedPlan().toString()
    months = {r.order_month for r in orders.select("order_month").distinct().collect()}
    assert months <= {"1996-02", "1996-03"}
    whole = marts.fact_orders.where("order_purchase_timestamp >= '1996-02-10' AND order_purchase_timestamp < '1996-04-01'")
    assert orders.count() == whole.count() > 0


def test_drilldown_sums_items_before_expanding(spark):
    plan = measures.ds_drilldown_rollup(layers.mart_layer(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Expand"):]
    assert "Aggregate [customer_state" in below


def test_views_are_planned_when_asked_for(spark):
    from souk.sources.fixtures import load_retail

    layers.drop_layers(spark)
    tables = load_retail(spark, SF)
    assert tables.orders is load_retail(spark, SF).orders
    assert set(tables._built) == {"orders"}
    layers.drop_layers(spark)
    assert load_retail(spark, SF) is not tables


@pytest.mark.parametrize(("axis", "slicer"), [("customer_state", "states"), ("category", "categories"), ("seller_id", "sellers")])
def test_a_row_of_an_axis_is_what_its_slicer_gives(spark, axis, slicer):
    marts = layers.mart_layer(spark, SF)
    rows = {r[axis]: r.asDict() for r in measures.bi_measures_by(marts, axis).collect()}
    value = sorted(rows)[1]
    one = measures.bi_measures(marts, measures.Slicers(**{slicer: (value,)})).first().asDict()
    got = rows[value]
    assert set(got) - {axis} == set(one)
    assert all(got[k] == pytest.approx(one[k]) for k in one if one[k] is not None)
