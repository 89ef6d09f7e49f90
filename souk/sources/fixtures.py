"""Retail views over the driver's TPC-H-style Parquet tables.

The retail engine works on the marketplace schema (orders, order_items, customers, ...).
The test data is a TPC-H-like star schema, so these adapters derive the retail tables
from it with plain projections, joins and key arithmetic. Every view is lazy; Catalyst
prunes the Parquet columns each query needs and pushes filters into the scans.

The same definitions exist as SQL text for the DuckDB oracle (``oracle/fixtures.py``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions.numeric import MONEY

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


class LazyTables(Mapping):
    """Tables by name, each planned when it is first asked for and kept. Planning a Parquet scan
    reads a footer, so a report that needs two tables should not pay for nine."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def __contains__(self, name: object) -> bool:
        return name in self._builders


class RetailTables(LazyTables):
    """The nine retail tables as lazy DataFrames, also by attribute."""

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._builders:
            raise AttributeError(name)
        return self[name]

    def as_dict(self) -> dict[str, DataFrame]:
        return dict(self)

    def register(self) -> None:
        """Expose the tables as temp views (the lookup also under its SQL name)."""
        for name, df in self.items():
            df.createOrReplaceTempView(name)
        self.category_translation.createOrReplaceTempView("product_category_name_translation")


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"), F.lit(0), F.lit(0))


def _days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"), F.lit(0), F.lit(0), F.lit(0))


def order_items_view(lineitem: DataFrame) -> DataFrame:
    k = F.col("l_orderkey")
    return lineitem.select(
        k.alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.when(k % 97 == 0, (F.col("l_extendedprice") + 1).cast(MONEY))
        .otherwise((F.col("l_quantity") * (F.lit(1) + F.col("l_tax") * 100)).cast(MONEY))
        .alias("freight_value"),
    )


def orders_view(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit("delivered"))
        .when(F.col("o_orderstatus") == "O", F.lit("shipped"))
        .when(k % 2 == 0, F.lit("processing"))
        .otherwise(F.lit("canceled"))
    )
    return orders.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        d.alias("order_purchase_timestamp"),
        F.when(k % 50 == 0, F.lit(None)).otherwise(d + _hours(1 + k % 30)).alias("order_approved_at"),
        F.when(k % 20 == 0, F.lit(None)).otherwise(d + _days(2 + k % 10)).alias("order_delivered_carrier_date"),
        F.when(k % 20 == 0, F.lit(None))
        .otherwise(d + _days(5 + k % 60) + _hours(k % 24))
        .alias("order_delivered_customer_date"),
        (d + _days(20 + k % 40)).alias("order_estimated_delivery_date"),
    )


def _geo(dim: DataFrame, nation: DataFrame, region: DataFrame, nation_key: str) -> DataFrame:
    n = nation.select("n_nationkey", "n_name", "n_regionkey")
    r = region.select("r_regionkey", "r_name")
    return dim.join(n, dim[nation_key] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])


def customers_view(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    base = _geo(customer, nation, region, "c_nationkey").select(
        F.col("c_custkey").alias("customer_id"),
        F.floor(F.col("c_custkey") / F.lit(2.0)).cast("bigint").alias("customer_unique_id"),
        F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        F.col("r_name").alias("customer_state"),
    )
    # Ten customers without orders exercise the zero-order branches.
    extra = customer.where(F.col("c_custkey") < 10).select(
        (F.col("c_custkey") + 10_000_000).alias("customer_id"),
        (F.col("c_custkey") + 10_000_000).alias("customer_unique_id"),
        F.lit("99999").alias("customer_zip_code_prefix"),
        F.lit("NOWHERE").alias("customer_city"),
        F.lit("NONE").alias("customer_state"),
    )
    return base.unionByName(extra)


def sellers_view(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    base = _geo(supplier, nation, region, "s_nationkey").select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").cast("string").alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.col("r_name").alias("seller_state"),
    )
    extra = supplier.where(F.col("s_suppkey") < 3).select(
        (F.col("s_suppkey") + 10_000_000).alias("seller_id"),
        F.lit("99999").alias("seller_zip_code_prefix"),
        F.lit("NOWHERE").alias("seller_city"),
        F.lit("NONE").alias("seller_state"),
    )
    return base.unionByName(extra)


def products_view(part: DataFrame) -> DataFrame:
    size = F.col("p_size")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").cast("double").alias("product_name_length"),
        (size * 50).cast("double").alias("product_weight_g"),
        size.cast("double").alias("product_length_cm"),
        (size % 7).cast("double").alias("product_height_cm"),
        (1 + size % 5).cast("double").alias("product_width_cm"),
        F.col("p_retailprice").cast(MONEY).alias("unit_cost"),
    )


def category_translation_view(part: DataFrame) -> DataFrame:
    """The categories that occur among the products, with an English name; promotional goods
    have no entry, so the lookup misses them."""
    code = F.col("p_type")
    return (
        part.where(code != "PROMO")
        .select(code.alias("product_category_name"))
        .distinct()
        .withColumn("product_category_name_english", F.concat(F.lower("product_category_name"), F.lit(" goods")))
    )


def order_payments_view(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    items = lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        (1 + F.col("l_quantity") % 10).cast("int").alias("payment_installments"),
        F.col("l_extendedprice").cast(MONEY).alias("payment_value"),
    )
    vouchers = orders.where(F.col("o_orderkey") % 3 == 0).select(
        F.col("o_orderkey").alias("order_id"),
        F.lit(0).alias("payment_sequential"),
        F.lit("voucher").alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        F.col("o_totalprice").cast(MONEY).alias("payment_value"),
    )
    return items.unionByName(vouchers)


def order_reviews_view(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    return events.select(
        e.alias("review_id"),
        F.floor(e / F.lit(2.0)).cast("bigint").alias("order_id"),
        (1 + e % 5).alias("review_score"),
        F.col("ts").alias("review_creation_date"),
        (F.col("ts") + _days(F.lit(1))).alias("review_answer_timestamp"),
    )


def geolocation_view(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    return _geo(customer, nation, region, "c_nationkey").select(
        F.col("c_nationkey").cast("string").alias("geolocation_zip_code_prefix"),
        (F.col("c_custkey") % 90).cast("double").alias("geolocation_lat"),
        (F.col("c_custkey") % 180).cast("double").alias("geolocation_lng"),
        F.col("c_mktsegment").alias("geolocation_city"),
        F.col("r_name").alias("geolocation_state"),
    )


def driver_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    folder = sf_dir.rstrip("/")
    return LazyTables({n: (lambda n=n: spark.read.parquet(f"{folder}/{n}.parquet")) for n in DRIVER_TABLES})


def file_bytes(table: DataFrame) -> int:
    """The size of the files that a plain scan reads."""
    return int(table._jdf.queryExecution().analyzed().stats().sizeInBytes())


#: Which driver tables each retail view is built from, and how.
VIEWS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "orders": (orders_view, ("orders",)),
    "order_items": (order_items_view, ("lineitem",)),
    "customers": (customers_view, ("customer", "nation", "region")),
    "products": (products_view, ("part",)),
    "sellers": (sellers_view, ("supplier", "nation", "region")),
    "order_payments": (order_payments_view, ("lineitem", "orders")),
    "order_reviews": (order_reviews_view, ("events",)),
    "category_translation": (category_translation_view, ("part",)),
    "geolocation": (geolocation_view, ("customer", "nation", "region")),
}

_LOADED: dict[tuple[str, str], RetailTables] = {}


def load_retail(spark: SparkSession, sf_dir: str, register: bool = False) -> RetailTables:
    """The nine retail tables over the driver tables in ``sf_dir``, kept per application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _LOADED:
        t = driver_tables(spark, sf_dir)
        _LOADED[key] = RetailTables({n: (lambda f=f, of=of: f(*[t[x] for x in of])) for n, (f, of) in VIEWS.items()})
    tables = _LOADED[key]
    if register:
        tables.register()
    return tables


def forget_retail(application: str | None = None) -> None:
    """Forget the tables of all applications, or of one."""
    for key in list(_LOADED):
        if application in (None, key[0]):
            del _LOADED[key]
