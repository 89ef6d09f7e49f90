"""Cleaning as data: one typed specification per source table, one pipeline for all.

A ``Table`` names its columns with their kinds (text, number, whole number, date, zip code) and
what replaces a missing value; ``clean_table`` turns that into

1. one parse projection: names, missing-value tokens and typed parsing of every column at once,
2. one statistics pass: the distinct values of all columns to be filled with their counts; medians
   and modes come from that table alone (texts too long to be counted by value are looked up),
3. one fill-and-filter projection, then keep-first de-duplication.

So the input is read twice, however many columns are filled. The order of steps is part of a
table's meaning, because it changes the statistics: only ``dedupe_first=True`` tables (customers)
remove duplicates before values are counted. ``source_row_order`` (source row position), when
present, decides which duplicate is first and is dropped from the output.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.functions.numeric import exact_avg, half_even_long
from souk.operators import clean as op

ORDER_COL = "source_row_order"

TEXT, NUMBER, WHOLE, DATE, ZIP = "text", "number", "whole", "date", "zip"
_TYPES = {
    TEXT: T.StringType(), ZIP: T.StringType(), NUMBER: T.DoubleType(),
    WHOLE: T.LongType(), DATE: T.TimestampNTZType(),
}


@dataclass(frozen=True)
class Col:
    """A column: its kind, and for text the default behind the most frequent value (``mode``).
    Numbers with ``median`` take the median, then 0."""

    name: str
    kind: str = TEXT
    mode: str | None = None
    median: bool = False


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Col, ...]
    required: tuple[str, ...]
    keys: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    dedupe_first: bool = False
    finish: Callable[[DataFrame], DataFrame] | None = field(default=None, compare=False)

    def schema(self) -> T.StructType:
        """The declared types of the cleaned columns."""
        return T.StructType([T.StructField(c.name, _TYPES[c.kind]) for c in self.columns])


def _cols(kind: str, *names: str, **fill) -> tuple[Col, ...]:
    return tuple(Col(n, kind, **fill) for n in names)


def merge_by_zip(rows: DataFrame) -> DataFrame:
    """Distinct location rows to one per zip prefix: mean position, most frequent names."""
    zip_col = "geolocation_zip_code_prefix"
    rows = rows.drop(ORDER_COL).distinct()
    merged = rows.groupBy(zip_col).agg(
        exact_avg("geolocation_lat").alias("geolocation_lat"),
        exact_avg("geolocation_lng").alias("geolocation_lng"),
    )
    for name in ("geolocation_city", "geolocation_state"):
        merged = merged.join(mode_per_key(rows, zip_col, name), zip_col, "left")
        merged = merged.withColumn(name, F.coalesce(name, F.lit("Unknown")))
    return merged


def mode_per_key(df: DataFrame, key: str, col: str) -> DataFrame:
    """Most frequent non-NULL ``col`` per ``key`` (ties: the smallest), counted per (key, value)."""
    counts = df.where(F.col(col).isNotNull()).groupBy(key, col).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("k"), F.col(col).alias("v")))
    return counts.groupBy(key).agg(best["v"].alias(col))


# The source tables with their columns, keys and fill defaults.
SPECS: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            "customers",
            (
                *_cols(TEXT, "customer_id", "customer_unique_id"),
                Col("customer_zip_code_prefix", ZIP),
                *_cols(TEXT, "customer_city", "customer_state", mode="Unknown"),
            ),
            ("customer_id",), ("customer_id",), dedupe_first=True,
        ),
        Table(
            "geolocation",
            (
                Col("geolocation_zip_code_prefix", ZIP),
                *_cols(NUMBER, "geolocation_lat", "geolocation_lng"),
                *_cols(TEXT, "geolocation_city", "geolocation_state", mode="Unknown"),
            ),
            ("geolocation_zip_code_prefix",), (), finish=merge_by_zip,
        ),
        Table(
            "order_items",
            (
                Col("order_id"), Col("order_item_id", WHOLE, median=True), Col("product_id"), Col("seller_id"),
                Col("shipping_limit_date", DATE), *_cols(NUMBER, "price", "freight_value", median=True),
            ),
            ("order_id", "order_item_id", "product_id", "seller_id"), ("order_id", "order_item_id"),
            not_null=("order_id", "product_id", "seller_id"),
        ),
        Table(
            "order_payments",
            (
                Col("order_id"), Col("payment_sequential", WHOLE, median=True), Col("payment_type", mode="Unknown"),
                Col("payment_installments", WHOLE, median=True), Col("payment_value", NUMBER, median=True),
            ),
            ("order_id", "payment_sequential"), ("order_id", "payment_sequential"), not_null=("order_id",),
        ),
        Table(
            "order_reviews",
            (
                *_cols(TEXT, "review_id", "order_id"), Col("review_score", WHOLE, median=True),
                *_cols(TEXT, "review_comment_title", "review_comment_message", mode=""),
                *_cols(DATE, "review_creation_date", "review_answer_timestamp"),
            ),
            ("review_id", "order_id"), ("review_id",), not_null=("order_id",),
        ),
        Table(
            "orders",
            (
                *_cols(TEXT, "order_id", "customer_id"), Col("order_status", mode="unknown"),
                *_cols(
                    DATE, "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                    "order_delivered_customer_date", "order_estimated_delivery_date",
                ),
            ),
            ("order_id", "customer_id"), ("order_id",), not_null=("order_id", "customer_id"),
        ),
        Table(
            "products",
            (
                Col("product_id"), Col("product_category_name", mode="unknown_category"),
                *_cols(
                    NUMBER, "product_name_length", "product_description_length", "product_photos_qty",
                    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm", median=True,
                ),
            ),
            ("product_id",), ("product_id",),
        ),
        Table(
            "sellers",
            (
                Col("seller_id"), Col("seller_zip_code_prefix", ZIP),
                *_cols(TEXT, "seller_city", "seller_state", mode="Unknown"),
            ),
            ("seller_id",), ("seller_id",),
        ),
        Table(
            "category_translation",
            _cols(TEXT, "product_category_name", "product_category_name_english", mode="Unknown"),
            ("product_category_name",), ("product_category_name",),
        ),
    )
}


def normalize_read(df: DataFrame) -> DataFrame:
    """Names and missing-value tokens of a table as it was read."""
    df = op.rename_columns(op.standardize_names(df), op.PRODUCT_RENAMES)
    return op.nullify_na_tokens(df, df.columns)


def parsed(df: DataFrame, spec: Table, legacy_zip: bool = False) -> DataFrame:
    """Every known column in its kind, in one projection; other columns stay as they are."""
    df = op.require_columns(normalize_read(df), spec.required, spec.name)
    kinds = {c.name: c.kind for c in spec.columns}

    def typed(name: str) -> Column:
        c, is_text = F.col(name), isinstance(df.schema[name].dataType, T.StringType)
        kind = kinds.get(name)
        if kind in (NUMBER, WHOLE):
            return op.parse_number(c) if is_text else c.cast("double")
        if kind == DATE:
            return F.trim(c).try_cast("timestamp_ntz") if is_text else c.cast("timestamp_ntz")
        return op.zip_prefix(c, legacy_zip) if kind == ZIP else c

    return df.select(*[typed(c).alias(c) for c in df.columns])


def _first_rows(df: DataFrame, spec: Table) -> DataFrame:
    order = [ORDER_COL] if ORDER_COL in df.columns else []
    return op.dedupe_first(df, spec.keys, order) if spec.keys else df


def clean_table(
    name: str,
    raw: DataFrame,
    strategy: str = "mode",
    legacy_zip: bool = False,
    spread: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One raw table cleaned by its specification. Writes the table of values to be counted
    (see ``op.value_counts``) when it is called; the rest is lazy. ``strategy="constant"`` fills
    texts with their defaults instead of the most frequent value; ``legacy_zip`` strips the zeros
    that zip codes lose when an export is read with inferred types. ``spread`` deals the rows out
    before duplicates go."""
    spec = SPECS[name]
    df = parsed(raw, spec, legacy_zip)
    if spec.dedupe_first:
        df = _first_rows(df, spec)
    present = [c for c in spec.columns if c.name in df.columns]
    medians = [c.name for c in present if c.median]
    modes = {c.name: c.mode for c in present if c.mode is not None}
    df = op.fill_missing(df, medians, modes, strategy)
    whole = [c.name for c in present if c.kind == WHOLE]
    if spec.not_null:
        df = op.drop_null_keys(df, spec.not_null)
    if not spec.dedupe_first:
        df = _first_rows(spread(df) if spread else df, spec)
    df = df.withColumns({c: half_even_long(c) for c in whole}) if whole else df
    df = spec.finish(df) if spec.finish else df
    return df.drop(ORDER_COL)


def clean_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every source table cleaned; all must be given."""
    op.require_tables(raw, SPECS)
    return {name: clean_table(name, raw[name]) for name in SPECS}
