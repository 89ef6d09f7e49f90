"""What layers store and shuffle: buckets by order, columns that are not stored, shuffle files that go."""

import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from souk.plans import layers, marts, measures
from souk.session import INITIAL_PARTITIONS, small_tasks, written

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_write_gives_back_its_shuffle_files(spark):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if "shuffle" in files.apply(i).getName()}

    before = shuffles()
    back = written(spark.range(5000).repartition(5, "id"), "test-shuffle")
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert shuffles() <= before
    assert back.count() == 5000


def test_sums_by_order_shuffle_reviews_only(spark):
    c = layers.cleaned_layer(spark, SF)
    plan = plan_of(marts.order_sums(c["orders"], c["order_items"], c["order_payments"], c["order_reviews"]))
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_table_with_a_hot_order_is_not_bucketed(spark):
    ids = spark.range(30000)
    assert layers.hot(ids.select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("order_id")), "order_id")
    assert not layers.hot(ids.select((F.col("id") / 4).cast("long").alias("order_id")), "order_id")
    assert not layers.hot(ids.select(F.lit(None).cast("string").alias("order_id")), "order_id")


@pytest.mark.parametrize("hot", [True, False])
def test_marts_are_the_same_with_and_without_buckets(spark, monkeypatch, hot):
    layers.drop_layers(spark)
    monkeypatch.setattr(layers, "hot", lambda *a: hot)
    got, c = layers.mart_layer(spark, SF), layers.cleaned_layer(spark, SF)
    want = marts.build_feature_bundle(dict(c)).as_dict()
    for name in ("fact_orders", "fact_order_items", "dim_customers", "dim_sellers"):
        a, b = got[name], want[name]
        assert a.dtypes == b.dtypes
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name
    layers.drop_layers(spark)


def test_columns_that_follow_from_others_are_not_stored(spark):
    m = layers.mart_layer(spark, SF)
    for name, gone in (("fact_order_items", {"revenue", "item_total_value"}), ("fact_orders", {"order_value", "late_deliveries"})):
        stored = set(pq.read_schema(m[name].inputFiles()[0].removeprefix("file://")).names)
        assert not gone & stored and gone <= set(m[name].columns)


def test_shuffles_start_from_the_size_of_the_input(spark):
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    with small_tasks(spark, 99):
        assert spark.conf.get(INITIAL_PARTITIONS) == "99"
    assert spark.conf.get(INITIAL_PARTITIONS, None) == before
    with small_tasks(spark, 2):
        assert spark.conf.get(INITIAL_PARTITIONS, None) == before


@pytest.mark.parametrize("s", [
    measures.DEFAULT_VIEW, measures.Slicers(status_mode="delivered", date_from="1995-03-15", date_to="1997-07-02"),
    measures.Slicers(sellers=("1", "2", "3"), statuses=("shipped",), status_mode="all"),
])
def test_items_of_a_status_or_time_need_no_join(spark, s):
    m = layers.mart_layer(spark, SF)
    x = measures.slice_bundle(m, s)
    assert "Join" not in plan_of(x.items)
    items = m.fact_order_items
    items = items.where(F.col("seller_id").isin(*s.sellers)) if s.sellers else items
    want = items.join(x.orders.select("order_id"), "order_id", "left_semi").select(*items.columns)
    assert x.items.exceptAll(want).isEmpty() and want.exceptAll(x.items).isEmpty() and not want.isEmpty()


def test_rows_that_lie_by_month_are_published_without_a_shuffle(spark, tmp_dir):
    from souk.sources import versions

    orders = layers.mart_layer(spark, SF).fact_orders
    ends, tracker = [], spark.sparkContext.statusTracker()
    for gathered in (True, False):
        spark.sparkContext.setJobGroup(f"publish-{gathered}", "publish")
        versions.publish(orders, f"{tmp_dir}/{gathered}", "order_month", gathered=gathered)
        jobs = tracker.getJobIdsForGroup(f"publish-{gathered}")
        ends.append(sum(len(tracker.getJobInfo(j).stageIds) for j in jobs))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert ends[0] < ends[1]
    a, b = (versions.read_published(spark, f"{tmp_dir}/{g}") for g in (True, False))
    assert a.exceptAll(b).isEmpty() and a.count() == b.count() == orders.count()


@pytest.mark.parametrize("name", ["bi_measures_by_category", "bi_measures_by_delivery_status", "ds_category_delay"])
def test_small_results_of_large_joins_are_evaluated_in_small_tasks(spark, name):
    from souk.plans import catalog

    got, m = catalog.QUERIES[name](spark, SF), layers.mart_layer(spark, SF)
    assert "Join" not in plan_of(got) and "Aggregate" not in plan_of(got)
    want = measures.ds_category_delay(m) if name.startswith("ds_") else measures.bi_measures_by(m, name[15:])
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    if name.startswith("ds_"):
        assert got.collect() == want.collect()
