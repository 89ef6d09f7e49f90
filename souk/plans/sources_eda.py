"""EDA over whatever tables there are: marts where they were saved, raw exports otherwise.

The profiles in ``plans.eda`` read columns of marts. Raw exports lack some (an order's value) and
have others as text (numbers, times). For each column a profile needs, ``NEEDS`` lists its
producers in order of preference: the table's own column, a sum over another table's rows, or an
expression over columns that are resolved themselves. ``resolve`` picks the first producer whose
columns exist from the tables' schemas alone, before anything is planned, and reports all
columns that none can produce in one error; ``resolved`` then builds each table with one
projection, and one aggregate and join per table that sums come from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.functions.dates import month_key, weekday_name
from souk.operators import clean as op
from souk.plans.cleaning import ORDER_COL
from souk.plans.marts import SUM_TYPE
from souk.sources import io

NUMBER, TIME, TEXT = "number", "time", "text"


class Unresolved(op.ValidationError):
    """Columns that no producer can make from the given tables."""


@dataclass(frozen=True)
class Own:
    """The table's own column, parsed as its kind where it is text."""

    column: str
    kind: str = TEXT


@dataclass(frozen=True)
class SumOf:
    """The sum of another table's column over the rows of this table's key; 0 where none of the
    rows has a value, NULL without rows."""

    table: str
    column: str
    key: str


@dataclass(frozen=True)
class From:
    """An expression over resolved columns of the same table."""

    columns: tuple[str, ...]
    make: Callable[..., Column]


Producer = Own | SumOf | From

#: table -> column -> its producers, in order of preference
NEEDS: dict[str, dict[str, tuple[Producer, ...]]] = {
    "orders": {
        "order_id": (Own("order_id"),),
        "customer_id": (Own("customer_id"),),
        "order_purchase_timestamp": (Own("order_purchase_timestamp", TIME),),
        "order_value": (Own("order_value", NUMBER), SumOf("order_items", "price", "order_id")),
        "freight_value": (Own("gross_freight_value", NUMBER), SumOf("order_items", "freight_value", "order_id")),
        "order_month": (Own("order_month"), From(("order_purchase_timestamp",), month_key)),
        "weekday": (Own("weekday"), From(("order_purchase_timestamp",), weekday_name)),
    },
    "order_items": {
        "order_id": (Own("order_id"),),
        "product_id": (Own("product_id"),),
        "price": (Own("price", NUMBER),),
        "freight_value": (Own("freight_value", NUMBER),),
    },
    "customers": {
        "customer_id": (Own("customer_id"),),
        "customer_unique_id": (Own("customer_unique_id"), Own("customer_id")),
        "customer_state": (Own("customer_state"),),
    },
    "products": {
        "product_id": (Own("product_id"),),
        "product_category_name": (Own("product_category_name"),),
        "product_weight_g": (Own("product_weight_g", NUMBER),),
    },
    "reviews": {"review_score": (Own("review_score", NUMBER),)},
    "categories": {
        "product_category_name": (Own("product_category_name"),),
        "product_category_name_english": (Own("product_category_name_english"),),
    },
}

#: The EDA's tables, with the saved mart or cleaned table preferred to the export.
EDA_SOURCES = {
    "orders": ("fact_orders_features", "orders"),
    "order_items": ("fact_order_items_features", "order_items"),
    "customers": ("dim_customers_features", "customers"),
    "products": ("dim_products_features", "products"),
    "sellers": ("dim_sellers_features", "sellers"),
    "payments": ("order_payments_clean", "order_payments"),
    "reviews": ("order_reviews_clean", "order_reviews"),
    "categories": ("category_translation_clean", "category_translation"),
}


def open_tables(spark: SparkSession, saved_dir: str, raw_dir: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The EDA's eight tables: the saved one where it exists, else the raw export."""
    return {
        name: io.read_first_available(
            spark, (f"{saved_dir.rstrip('/')}/{saved}", fmt), (f"{raw_dir.rstrip('/')}/{io.SOURCE_FILENAMES[raw]}", "csv")
        )
        for name, (saved, raw) in EDA_SOURCES.items()
    }


def from_raw(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The EDA's tables from the nine raw ones, names and missing-value tokens normalised."""
    return {
        name: op.nullify_na_tokens(raw[table], raw[table].columns).drop(ORDER_COL)
        for name, (_, table) in EDA_SOURCES.items()
    }


# ----------------------------------------------------------------------------- resolution
def resolve(schemas: Mapping[str, Iterable[str]], needs=None) -> dict[str, dict[str, Producer]]:
    """The producer of each needed column, by table. ``schemas``: the columns of each table."""
    needs = NEEDS if needs is None else needs
    have = {t: set(columns) for t, columns in schemas.items()}
    chosen: dict[str, dict[str, Producer]] = {}
    failures = []

    def possible(table: str, producer: Producer) -> bool:
        if isinstance(producer, Own):
            return producer.column in have.get(table, ())
        if isinstance(producer, SumOf):
            there = have.get(producer.table, set())
            return {producer.column, producer.key} <= there and producer.key in have.get(table, ())
        return all(find(table, c) is not None for c in producer.columns)

    def find(table: str, column: str) -> Producer | None:
        done = chosen.setdefault(table, {})
        if column not in done:
            found = next((p for p in needs[table].get(column, ()) if possible(table, p)), None)
            if found is None:
                return None
            done[column] = found
        return done[column]

    for table, columns in needs.items():
        failures += [f"{table}.{c} (tried {list(ps)})" for c, ps in columns.items() if find(table, c) is None]
    if failures:
        raise Unresolved(f"no producer for {'; '.join(failures)}")
    return chosen


def _parsed(df: DataFrame, column: str, kind: str) -> Column:
    c, is_text = F.col(column), isinstance(df.schema[column].dataType, T.StringType)
    if kind == NUMBER:
        return op.parse_number(c) if is_text else c.cast("double")
    if kind == TIME:
        return F.trim(c).try_cast("timestamp_ntz") if is_text else c.cast("timestamp_ntz")
    return c


def build(tables: Mapping[str, DataFrame], table: str, producers: Mapping[str, Producer]) -> DataFrame:
    """One table with its resolved columns."""
    df = tables[table]
    sums: dict[tuple[str, str], dict[str, str]] = {}
    for name, p in producers.items():
        if isinstance(p, SumOf):
            sums.setdefault((p.table, p.key), {})[name] = p.column
    own = [_parsed(df, p.column, p.kind).alias(n) for n, p in producers.items() if isinstance(p, Own)]
    out = df.select(*own)
    for (other, key), columns in sums.items():
        rows = tables[other]
        numbers = {n: _parsed(rows, c, NUMBER) for n, c in columns.items()}
        totals = rows.groupBy(F.col(key).alias("_key")).agg(
            *[F.coalesce(F.sum(x.cast(SUM_TYPE)).cast("double"), F.lit(0.0)).alias(n) for n, x in numbers.items()]
        )
        out = out.join(totals, F.col(key) == F.col("_key"), "left").drop("_key")
    late = {n: p for n, p in producers.items() if isinstance(p, From)}
    while late:
        ready = {n: p for n, p in late.items() if set(p.columns) <= set(out.columns)}
        out = out.withColumns({n: p.make(*p.columns) for n, p in ready.items()})
        late = {n: p for n, p in late.items() if n not in ready}
    return out.select(*producers)


@dataclass(frozen=True)
class Resolved:
    """The tables that the profiles of ``plans.eda`` read, under the names they use."""

    fact_orders: DataFrame
    fact_order_items: DataFrame
    dim_customers: DataFrame
    dim_products: DataFrame
    reviews: DataFrame
    cleaned: Mapping[str, DataFrame]


def resolved(tables: Mapping[str, DataFrame]) -> Resolved:
    chosen = resolve({name: df.columns for name, df in tables.items()})
    t = {name: build(tables, name, producers) for name, producers in chosen.items()}
    cleaned = {"order_items": t["order_items"], "products": t["products"], "category_translation": t["categories"]}
    return Resolved(t["orders"], t["order_items"], t["customers"], t["products"], t["reviews"], cleaned)
