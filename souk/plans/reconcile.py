"""Comparison of two keyed frames, and the reconciliation of the marts with the SQL pack.

``compare`` says for every key and compared column whether both sides agree: a full outer join on
the keys (NULL keys match each other), then one row per key and column. Numbers agree within
a tolerance, everything else when equal; two NULLs agree, a NULL and a value do not. Rows of one
side only, keys that a side holds more than once, and columns whose types can't be compared are
verdicts of their own, so nothing is dropped or multiplied on the way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.functions.dates import month_key
from souk.plans import marts, reports
from souk.sources.fixtures import RetailTables

MATCH, DIFFERS, ONLY_LEFT, ONLY_RIGHT, REPEATED, TYPES = (
    "match", "differs", "only_left", "only_right", "repeated_key", "types",
)


def _kind(t: T.DataType) -> str:
    if isinstance(t, T.NumericType):
        return "number"
    return "time" if isinstance(t, T.DateType | T.TimestampType | T.TimestampNTZType) else t.simpleString()


def compare(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Mapping[str, str] | Sequence[str],
    tolerance: float = 0.0,
) -> DataFrame:
    """Keys, column, left_value, right_value (numbers as DOUBLE, others NULL), left_text, right_text
    (others as text), difference and verdict. ``columns``: common names, or left name -> right."""
    pairs = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}

    def side(df: DataFrame, names: Sequence[str], tag: str) -> DataFrame:
        # A repeated key keeps one row per side: its values do not matter, as its verdict says so.
        first = [F.min(F.col(n)).alias(f"{tag}{i}") for i, n in enumerate(names)]
        grouped = df.groupBy(*[F.col(k).alias(f"{tag}k{i}") for i, k in enumerate(keys)])
        return grouped.agg(F.count(F.lit(1)).alias(f"{tag}n"), *first)

    a, b = side(left, list(pairs), "l"), side(right, list(pairs.values()), "r")
    same = F.lit(True)
    for i in range(len(keys)):
        same = same & F.col(f"lk{i}").eqNullSafe(F.col(f"rk{i}"))
    both = a.join(b, same, "full_outer")

    def entry(i: int, name: str, other: str) -> Column:
        kinds = _kind(left.schema[name].dataType), _kind(right.schema[other].dataType)
        x, y, none = F.col(f"l{i}"), F.col(f"r{i}"), F.lit(None)
        numeric = kinds == ("number", "number")
        gap = (x.cast("double") - y.cast("double")) if numeric else none.cast("double")
        if numeric:
            agree = (F.abs(gap) <= tolerance) | (x.isNull() & y.isNull())
        elif kinds[0] == kinds[1]:
            agree = x.eqNullSafe(y)
        else:
            agree = none.cast("boolean")
        verdict = (
            F.when(F.col("ln").isNull(), ONLY_RIGHT).when(F.col("rn").isNull(), ONLY_LEFT)
            .when((F.col("ln") > 1) | (F.col("rn") > 1), REPEATED)
            .when(F.lit(kinds[0] != kinds[1]), TYPES)
            .when(F.coalesce(agree, F.lit(False)), MATCH).otherwise(DIFFERS)
        )
        number = [v.cast("double") if numeric else none.cast("double") for v in (x, y)]
        text = [none.cast("string") if numeric else v.cast("string") for v in (x, y)]
        fields = (F.lit(name), *number, *text, gap, verdict)
        names = ("column", "left_value", "right_value", "left_text", "right_text", "difference", "verdict")
        return F.struct(*(c.alias(n) for c, n in zip(fields, names, strict=True)))

    rows = F.inline(F.array(*[entry(i, *p) for i, p in enumerate(pairs.items())]))
    key_columns = [F.coalesce(f"lk{i}", f"rk{i}").alias(k) for i, k in enumerate(keys)]
    return both.select(*key_columns, rows)


def verdicts(compared: DataFrame) -> DataFrame:
    """How often each verdict occurs per column."""
    return compared.groupBy("column", "verdict").agg(F.count(F.lit(1)).alias("rows")).orderBy("column", "verdict")


def cleaned_tables(cleaned: Mapping[str, DataFrame]) -> RetailTables:
    """The cleaned tables as the SQL pack reads them, amounts as exact decimals."""

    def exact(name: str) -> DataFrame:
        df = cleaned[name]
        money = [c for c in ("price", "freight_value", "payment_value") if c in df.columns]
        return df.withColumns({c: F.col(c).cast("decimal(18,4)") for c in money}) if money else df

    return RetailTables({name: (lambda name=name: exact(name)) for name in cleaned})


#: Amounts that come from decimals on one side and from sums of DOUBLE columns on the other.
TOLERANCE = 0.005


def reconcile_pack(b, cleaned: Mapping[str, DataFrame]) -> DataFrame:
    """Monthly revenue, orders and average order value of the marts against two reports of the SQL
    pack over the same cleaned tables, on the pack's statuses: month, report, and the columns of
    ``compare``."""
    t = cleaned_tables(cleaned)
    live = reports.active_orders(b.fact_orders)
    mart = marts.build_monthly_revenue(live)
    dated = F.col("order_month").isNotNull()
    revenue = reports.revenue_analysis(t).select(month_key("revenue_month").alias("order_month"), "*")
    growth = reports.growth_rate(t).select(month_key("order_month").alias("month"), "*").drop("order_month")
    growth = growth.withColumnRenamed("month", "order_month")
    parts = [
        ("revenue_analysis", revenue, {
            "monthly_revenue": "gross_revenue", "orders_in_month": "orders", "average_order_value": "average_order_value",
        }),
        ("growth_rate", growth, {"monthly_revenue": "revenue", "orders_in_month": "orders"}),
    ]
    out = None
    for name, report, columns in parts:
        part = compare(mart, report.where(dated), ["order_month"], columns, TOLERANCE)
        part = part.select("order_month", F.lit(name).alias("report"), *part.columns[1:])
        out = part if out is None else out.unionByName(part)
    return out.drop("left_text", "right_text").orderBy("report", "column", "order_month")
