"""Layers: retail views, raw text tables, cleaned tables and feature marts.

Retail and raw tables are views over the driver's Parquet files; reports plan straight over
them, so a report reads the columns of the tables it needs and nothing is copied. Cleaned tables
and marts are the workflow's own persistence points. Each is written as Parquet under the
session's shared checkpoint folder the first time a query asks for it, after those it is built
from, and read back: statistics and joins run once, lineage ends there, and later plans see
real sizes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.plans import cleaning, eda, marts, quality
from souk.plans.stats import TableStats, observed
from souk.session import small_tasks, written
from souk.sources.fixtures import LazyTables, RetailTables, driver_tables, file_bytes, forget_retail, load_retail
from souk.sources.raw import raw_from_retail

_TABLES: dict[tuple[str, str], dict[str, DataFrame]] = {}
_STATS: dict[tuple[str, str], dict[str, TableStats]] = {}

#: Tables written in a folder per purchase month, so that date slicers pick folders.
MONTHLY = {"mart-fact_orders": "order_month"}

#: Columns that a row's other columns give: they are not stored, but part of every read.
DERIVED = {
    "mart-fact_orders": (
        tuple(c for c in marts.ORDER_DERIVED if c not in ("order_month", "monthly_revenue"))
        + ("average_order_value_customer", "total_orders_by_customer"),
        marts.with_customer_columns,
    ),
    "mart-fact_order_items": (marts.ITEM_DERIVED, marts.with_item_columns),
}

#: Cleaned tables that the marts bring together by order, written in buckets of it: what follows
#: by order then shuffles none of them.
BY_ORDER = ("orders", "order_items", "order_payments")
#: Bytes of input (files) for each bucket and for each shuffle partition of a layer's jobs.
PART_BYTES = 4 * 1024 * 1024
#: An order with more than this share of a table's rows would make one bucket a long task: such a
#: table is not bucketed, and sums by order are first taken where its rows lie.
HOT_SHARE = 0.01


class Layer(Mapping):
    """Tables by name, each built and written when it is first asked for. The write counts the
    table's figures (see ``stats``) on its way."""

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        layer: str,
        builders: dict[str, Callable[[], DataFrame]],
        keys: Mapping[str, Sequence[str]] | None = None,
        parts: int = 0,
        buckets: Mapping[str, tuple[int, str]] | None = None,
    ):
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        self._spark = spark
        self._done = _TABLES.setdefault(key, {})
        self._stats = _STATS.setdefault(key, {})
        self._layer = layer
        self._builders = builders
        self._keys = keys or {}
        self.parts = parts
        self._buckets = {} if buckets is None else buckets  # filled by builders

    def __getitem__(self, name: str) -> DataFrame:
        build = self._builders[name]
        label = f"{self._layer}-{name}"
        if label not in self._done:
            with small_tasks(self._spark, self.parts):
                df = build()
                counted, figures = observed(df, self._keys.get(name, ()))
                given, derive = DERIVED.get(label, ((), None))
                back = written(counted.drop(*given), label, MONTHLY.get(label), self._buckets.get(name))
                self._done[label] = derive(back).select(*df.columns) if derive else back
                self._stats[label] = figures()
        return self._done[label]

    def stats(self, name: str) -> TableStats:
        """What the table's write has counted; no further read."""
        self[name]
        return self._stats[f"{self._layer}-{name}"]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(list(iter(self)))

    def __contains__(self, name: object) -> bool:
        return name in self._builders


class MartLayer(Layer):
    """The marts, also by attribute like a ``FeatureBundle``; tables that only serve others are
    not listed."""

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._builders:
            raise AttributeError(name)
        return self[name]

    def __iter__(self) -> Iterator[str]:
        return (f.name for f in fields(marts.FeatureBundle))

    def as_dict(self) -> dict[str, DataFrame]:
        return dict(self)


def retail_layer(spark: SparkSession, sf_dir: str) -> RetailTables:
    return load_retail(spark, sf_dir)


def raw_layer(spark: SparkSession, sf_dir: str) -> LazyTables:
    return raw_from_retail(load_retail(spark, sf_dir))


def layer_parts(spark: SparkSession, sf_dir: str) -> int:
    """Buckets, and shuffle partitions to start from, by the size of the input's files."""
    found = driver_tables(spark, sf_dir)
    size = sum(file_bytes(found[name]) for name in ("orders", "lineitem", "events"))
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))


def hot(df: DataFrame, column: str) -> bool:
    """Whether one value holds more than HOT_SHARE of the rows, judged by a sample of them; it
    decides how a table's rows lie, not what they are."""
    counts = df.where(F.col(column).isNotNull()).sample(0.01, seed=1).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    return row["most"] is not None and row["most"] > max(HOT_SHARE * row["rows"], 20)


def cleaned_layer(spark: SparkSession, sf_dir: str) -> Layer:
    raw = raw_layer(spark, sf_dir)
    parts = layer_parts(spark, sf_dir)
    buckets: dict[str, tuple[int, str]] = {}

    def build(name: str) -> DataFrame:
        if name not in BY_ORDER or hot(raw[name], "order_id"):
            return cleaning.clean_table(name, raw[name])
        buckets[name] = (parts, "order_id")
        return cleaning.clean_table(name, raw[name], spread=lambda df: df.repartition(*buckets[name]))

    builders = {name: (lambda n=name: build(n)) for name in cleaning.SPECS}
    return Layer(spark, sf_dir, "clean", builders, quality.CLEAN_KEYS, parts, buckets)


def broadcast_rows(layer: Layer, name: str, most: int = 500_000) -> DataFrame:
    """A table to be broadcast while it has few rows."""
    df = layer[name]
    return F.broadcast(df) if layer.stats(name).rows <= most else df


def mart_layer(spark: SparkSession, sf_dir: str) -> MartLayer:
    """Order-grain sums are written once and serve fact_orders, dim_customers and
    monthly_revenue; products' features and dim_sellers serve fact_order_items."""
    c = cleaned_layer(spark, sf_dir)
    builders: dict[str, Callable[[], DataFrame]] = {}
    m = MartLayer(spark, sf_dir, "mart", builders, parts=c.parts)
    builders |= {
        "order_base": lambda: marts.order_sums(
            c["orders"], c["order_items"], c["order_payments"], c["order_reviews"]
        ),
        "customer_base": lambda: marts.customer_base(m["order_base"]),
        "product_base": lambda: marts.product_features(c["products"], c["category_translation"]),
        "fact_orders": lambda: marts.fact_orders_from(
            m["order_base"], m["customer_base"], m["monthly_revenue"], by_month=True
        ),
        "fact_order_items": lambda: marts.fact_order_items_from(
            c["order_items"], c["orders"], m["product_base"], broadcast_rows(m, "dim_sellers")
        ),
        "dim_customers": lambda: marts.dim_customers_from(c["customers"], m["customer_base"]),
        "dim_products": lambda: marts.dim_products_from(m["product_base"], c["order_items"]),
        "dim_sellers": lambda: marts.build_dim_sellers(c["sellers"], c["order_items"]),
        "monthly_revenue": lambda: marts.build_monthly_revenue(marts.with_order_columns(m["order_base"])),
        "customer_kpis": lambda: marts.build_customer_kpis(m["dim_customers"]),
        "customer_metrics": lambda: eda.customer_metrics(m),
    }
    return m


def drop_layers(spark: SparkSession | None = None) -> None:
    """Forget written tables (all, or those of one session)."""
    for key in list(_TABLES):
        if spark is None or key[0] == spark.sparkContext.applicationId:
            del _TABLES[key]
            _STATS.pop(key, None)
    forget_retail(spark and spark.sparkContext.applicationId)
