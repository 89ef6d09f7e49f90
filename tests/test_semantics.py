"""One small in-memory case per semantics rule the engine relies on."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from souk.functions import dates, numeric
from souk.operators import clean as op
from souk.operators import ranking


def test_mode_ties_go_to_smallest_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "c string")
    out = op.fill_categorical_mode(df, ["c"], default="Unknown").collect()
    assert [r.c for r in out] == ["b", "a", "a", "b", "a"]


def test_mode_of_all_null_column_is_default(spark):
    df = spark.createDataFrame([(None,), (None,)], "c string")
    assert {r.c for r in op.fill_categorical_mode(df, ["c"], default="Unknown").collect()} == {"Unknown"}


def test_median_fill_interpolates_and_defaults_to_zero(spark):
    df = spark.createDataFrame([(1.0, None), (4.0, None), (None, None), (2.0, None), (10.0, None)], "a double, b double")
    out = op.fill_numeric_median(df, ["a", "b"]).collect()
    assert [r.a for r in out] == [1.0, 4.0, 3.0, 2.0, 10.0]
    assert {r.b for r in out} == {0.0}


@pytest.mark.parametrize("n", [1, 2, 7, 100, 1001])
def test_exact_median_matches_numpy(spark, n):
    rnd = random.Random(n)
    values = [float(rnd.randint(-50, 50)) / 4 for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = op.column_medians(df, ["v"]).collect()[0].median
    assert got == pytest.approx(float(np.median(values)))


def test_column_medians_one_pass_matches_numpy(spark):
    rnd = random.Random(3)
    rows = [(rnd.random() * 100, float(rnd.randint(0, 5)), None) for _ in range(500)]
    df = spark.createDataFrame(rows, "x double, y double, z double")
    got = {r.name: r.median for r in op.column_medians(df, ["x", "y", "z"]).collect()}
    assert got["x"] == pytest.approx(float(np.median([r[0] for r in rows])))
    assert got["y"] == pytest.approx(float(np.median([r[1] for r in rows])))
    assert "z" not in got


def test_global_rank_matches_min_rank_with_nulls_last(spark):
    rnd = random.Random(11)
    values = [None if rnd.random() < 0.1 else float(rnd.randint(0, 30)) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    got = {r.id: r.rk for r in ranking.global_rank(df, "v", "rk", descending=True).collect()}
    present = [v for v in values if v is not None]
    for i, v in enumerate(values):
        expected = len(present) + 1 if v is None else 1 + sum(1 for w in present if w > v)
        assert got[i] == expected


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double")
    assert [r[0] for r in df.select(numeric.half_even_long("x")).collect()] == [0, 2, 2, 0]


def test_round_to_is_half_away_from_zero_on_the_double(spark):
    df = spark.createDataFrame([(0.03125,), (203713.45375,), (-0.03125,)], "x double")
    got = [r[0] for r in df.select(numeric.round_to("x", 4)).collect()]
    assert got == [0.0313, 203713.4537, -0.0313]


def test_day_spans_floor_and_truncate(spark):
    a = dt.datetime(2020, 1, 2, 13, 0)
    b = a - dt.timedelta(days=1.54)
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(
        dates.whole_days_floor("a", "b").alias("f"),
        dates.whole_days_trunc("a", "b").alias("t"),
        dates.days_between("a", "b").alias("d"),
    ).first()
    assert (r.f, r.t) == (-2, -1)
    assert r.d == pytest.approx(-1.54)


def test_zero_denominators_give_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(numeric.ratio("a", "b")).collect()] == [None, None, 1.5]


def test_na_tokens_become_null(spark):
    df = spark.createDataFrame([("NA",), ("n/a",), ("null",), ("",), ("x",)], "c string")
    assert [r.c for r in op.nullify_na_tokens(df, ["c"]).collect()] == [None, None, None, None, "x"]


def test_zip_normalisation_keeps_leading_zeros(spark):
    df = spark.createDataFrame([("01037",), ("1037.0",), (None,)], "z string")
    assert [r.z for r in op.normalize_zip(df, "z").collect()] == ["01037", "1037", "00000"]


def test_snake_case_names():
    assert op.snake_case("  Product Name Lenght ") == "product_name_lenght"
    assert op.snake_case("a--b__c") == "a_b_c"


def test_weekend_flag_null_is_false(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 6),), (dt.datetime(2024, 1, 8),), (None,)], "t timestamp_ntz")
    assert [r[0] for r in df.select(dates.is_weekend("t")).collect()] == [True, False, False]


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_dedupe_first_is_partition_independent(spark, partitions):
    rows = [(k % 7, i, f"v{i}") for i, k in enumerate(range(200))]
    df = spark.createDataFrame(rows, "k int, pos long, v string").repartition(partitions)
    out = {r.k: r.v for r in op.dedupe_first(df, ["k"], ["pos"]).collect()}
    assert out == {k: f"v{k}" for k in range(7)}


def test_coerce_and_parse_turn_bad_values_into_null(spark):
    df = spark.createDataFrame([("1.5", "2020-01-01 10:00:00"), ("abc", "bad")], "n string, t string")
    out = op.parse_datetimes(op.coerce_numeric(df, ["n"]), ["t"]).collect()
    assert out[0].n == 1.5 and out[0].t == dt.datetime(2020, 1, 1, 10)
    assert out[1].n is None and out[1].t is None


def test_month_index_between(spark):
    df = spark.createDataFrame([(dt.datetime(2019, 11, 1), dt.datetime(2020, 2, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(dates.month_index_between("a", "b")).first()[0] == 3


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(0.2,)] * 10, "x double")
    total = df.agg(F.sum(F.col("x").cast("decimal(22,4)")).cast("double")).first()[0]
    assert total == 3.0


def test_hot_key_dedupe_and_mode_stay_exact(spark):
    # One key holds 40% of the rows: keep-first and the grouped mode must not depend on
    # how the hot key's rows are spread over partitions.
    rows = [("hot" if i % 5 < 2 else f"k{i}", i, "b" if i % 3 else "a") for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, pos long, v string").repartition(16)
    first = {r.k: r.pos for r in op.dedupe_first(df, ["k"], ["pos"]).collect()}
    assert first["hot"] == 0 and len(first) == 1 + sum(1 for i in range(3000) if i % 5 >= 2)
    from souk.plans.cleaning import mode_per_key

    modes = {r.k: r.v for r in mode_per_key(df, "k", "v").collect()}
    hot = [v for k, _, v in rows if k == "hot"]
    assert modes["hot"] == max(sorted(set(hot)), key=hot.count)


def test_hot_value_rank_is_exact(spark):
    values = [7.0] * 1000 + [float(i) for i in range(2000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double").repartition(8)
    ranks = {r.id: r.rk for r in ranking.global_rank(df, "v", "rk", descending=True).collect()}
    greater_than_7 = sum(1 for v in values if v > 7.0)
    assert {ranks[i] for i in range(1000)} == {greater_than_7 + 1}


def test_day_spans_ignore_session_time_zone(spark):
    # Brazil moved clocks forward at midnight on 2018-11-04; zone-less spans must not notice.
    df = spark.createDataFrame(
        [(dt.datetime(2018, 11, 3, 12, 0), dt.datetime(2018, 11, 4, 12, 0))], "a timestamp_ntz, b timestamp_ntz"
    )
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        r = df.select(dates.days_between("a", "b").alias("d"), dates.month_start("b").alias("m")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.d == 1.0 and r.m == dt.datetime(2018, 11, 1)


@pytest.mark.parametrize("partitions", [1, 4, 200])
def test_rank_and_medians_do_not_depend_on_partitions(spark, partitions):
    rnd = random.Random(5)
    values = [float(rnd.randint(0, 40)) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double").repartition(partitions)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        ranks = {r.id: r.rk for r in ranking.global_rank(df, "v", "rk").collect()}
        median = op.column_medians(df, ["v"]).collect()[0].median
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert all(ranks[i] == 1 + sum(w > v for w in values) for i, v in enumerate(values))
    assert median == float(np.median(values))


@pytest.mark.parametrize("text", ["1.5d", "2f", "0x1p3", "1_000", "1,5", "", " ", "--1", "1e", "."])
def test_numbers_with_engine_suffixes_do_not_parse(spark, text):
    df = spark.createDataFrame([(text,)], "n string")
    assert df.select(op.parse_number(F.col("n"))).first()[0] is None


@pytest.mark.parametrize(("text", "value"), [(" 1.5 ", 1.5), ("-.5", -0.5), ("+2.", 2.0), ("1e3", 1000.0), ("1E-2", 0.01)])
def test_plain_numbers_parse(spark, text, value):
    df = spark.createDataFrame([(text,)], "n string")
    assert df.select(op.parse_number(F.col("n"))).first()[0] == value


def test_declared_types_hold_after_cleaning(spark):
    from souk.plans import cleaning, layers

    cleaned = layers.cleaned_layer(spark, "/root/testdata/sf0.001")
    for name in ("orders", "order_items", "customers"):
        types = {f.name: f.dataType for f in cleaned[name].schema}
        assert all(types[f.name] == f.dataType for f in cleaning.SPECS[name].schema())


def test_value_counts_leave_nulls_out(spark):
    from souk.plans import eda

    df = spark.createDataFrame([(1,), (1,), (None,)], "s int")
    assert [tuple(r) for r in eda.value_counts(df, "s").collect()] == [(1, 2)]


def test_correlation_matches_numpy_and_skips_constants(spark):
    from souk.plans import eda

    rng = np.random.default_rng(4)
    x, y = rng.normal(1e6, 3, 200), rng.normal(0, 1, 200)
    rows = [(float(a), float(a + b) if i % 5 else None, 7.0) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    got = {
        (r.column_a, r.column_b): r.correlation
        for r in eda.correlation({"t": spark.createDataFrame(rows, "x double, z double, c double").repartition(3)}).collect()
    }
    pairs = np.array([(a, b) for a, b, _ in rows if b is not None])
    assert got["x", "z"] == pytest.approx(np.corrcoef(pairs.T)[0, 1], abs=1e-4)
    assert got["x", "c"] is None and got["z", "c"] is None


def _bundle(spark):
    """Three orders of two customers: one cancelled, one late."""
    from types import SimpleNamespace

    day = dt.datetime(2020, 1, 5)
    orders = [("o1", "c1", "delivered", "card", day, 10.0, True), ("o2", "c1", "canceled", "cash", day, 20.0, None),
              ("o3", "c2", "shipped", "card", None, 40.0, False)]
    items = [("o1", "s1", "a", 1.0, 10.0, 10.0, 4.0), ("o2", "s1", "a", 10.0, 20.0, 20.0, 20.0),
             ("o3", "s2", "b", 4.0, 40.0, 40.0, 10.0), (None, "s2", None, 1.0, 1.0, 1.0, None)]
    return SimpleNamespace(
        fact_orders=spark.createDataFrame(
            orders, "order_id string, customer_id string, order_status string, dominant_payment_type string, "
            "order_purchase_timestamp timestamp_ntz, order_value double, late_deliveries boolean"
        ).withColumns({"delivery_time_days": F.lit(1.0), "approval_time_hours": F.lit(None).cast("double")}),
        fact_order_items=spark.createDataFrame(
            items, "order_id string, seller_id string, product_category_name_english string, freight_value double, "
            "item_total_value double, revenue double, unit_cost double"),
        dim_customers=spark.createDataFrame(
            [("c1", "SP", "x", 2, True, 30.0), ("c2", None, "y", 1, False, 40.0)],
            "customer_id string, customer_state string, customer_city string, total_orders long, "
            "repeat_customer boolean, customer_lifetime_value double"),
        dim_products=spark.createDataFrame([("a", 30.0), ("b", 40.0)], "product_category_name_english string, product_revenue double"),
        dim_sellers=spark.createDataFrame([("s1", 30.0), ("s2", 40.0)], "seller_id string, seller_revenue double"),
    )


def test_slicers_reach_items_and_dimensions(spark):
    from souk.plans import measures as m

    b = _bundle(spark)
    one = lambda **k: m.bi_measures(b, m.Slicers(**k)).first()
    usual, delivered, everything = one(), one(status_mode="delivered"), one(status_mode="all")
    assert (usual.total_orders, delivered.total_orders, everything.total_orders) == (2, 1, 3)
    assert (usual.freight_share, delivered.freight_share) == (5.0 / 50.0, 1.0 / 10.0)
    assert everything.freight_share == pytest.approx(16.0 / 71.0)
    assert (usual.profit_margin, delivered.profit_margin) == (36.0 / 50.0, 6.0 / 10.0)
    state, category = one(states=["SP"]), one(categories=["b"])
    assert (state.total_orders, state.freight_share, state.repeat_customer_rate) == (1, 0.1, 1.0)
    assert (category.total_revenue, category.top_category_revenue) == (40.0, 40.0)
    assert one(sellers=["s1"]).top_seller_revenue == 30.0
    assert one(delivery_status="late").total_orders == 1
    nothing = one(states=["nowhere"])
    assert nothing.total_orders == 0 and nothing.average_order_value is None and nothing.freight_share is None
    by = {r.category: r for r in m.bi_measures_by(b, "category", m.Slicers(status_mode="all")).collect()}
    assert by["a"].total_orders == 2 and by["b"].freight_share == 0.1 and None not in by
    with pytest.raises(ValueError, match="status mode"):
        one(status_mode="other")
