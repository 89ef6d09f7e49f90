"""Exact global rank, running sums and top-n without a single-partition window.

A window with ``ORDER BY`` and no ``PARTITION BY`` sends every row to one task. Here rows are
first collapsed to one per distinct value (a partial aggregate, so a value held by a third of
all rows becomes one row), and these are written once in value order, cut into as many ranges
as the shuffle has partitions. Running sums are taken within each range, and the sums of the
ranges before it, one row each, give the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.session import written


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows in ``order`` (planned as a per-partition top-n plus a merge)."""
    return df.orderBy(*order).limit(n)


def write_ranges(df: DataFrame, *order: str) -> DataFrame:
    """``df`` written in ``order``, with the number of its range in the new column ``range``.
    Range boundaries are sampled, so what follows reads the written rows only."""
    ranged = df.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    return written(ranged, "ranges")


def running_sums(counts: DataFrame, value: str, weight: str, descending: bool = False) -> DataFrame:
    """For one row per distinct non-NULL ``value`` with its ``weight``, add ``_before``: the
    weight of all values strictly ahead of it in the order."""
    rows = write_ranges(counts, value)

    def ahead(window) -> Window:
        return window.rowsBetween(Window.unboundedPreceding, -1)

    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    sizes = rows.groupBy("range").agg(F.sum(weight).alias("_size"))
    # A row per range: this window has no more rows than the shuffle has partitions.
    offset = F.coalesce(F.sum("_size").over(ahead(Window.orderBy(direction("range")))), F.lit(0))
    offsets = sizes.select("range", offset.alias("_offset"))
    inside = F.sum(weight).over(ahead(Window.partitionBy("range").orderBy(direction(value))))
    placed = rows.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(F.broadcast(offsets), "range")
    return placed.withColumn("_before", F.col("_offset") + F.col("_inside")).drop("range", "_offset", "_inside")


def descending(column: str, nulls: str = "last") -> Column:
    """``column DESC`` with NULLs last, or first as PostgreSQL has them by default."""
    if nulls not in ("first", "last"):
        raise ValueError(f"nulls are 'first' or 'last', not {nulls!r}")
    return F.col(column).desc_nulls_first() if nulls == "first" else F.col(column).desc_nulls_last()


def global_rank(df: DataFrame, value: str, out: str, descending: bool = True, nulls: str = "last") -> DataFrame:
    """SQL ``RANK() OVER (ORDER BY value [DESC] NULLS LAST)`` as column ``out``, or ``NULLS FIRST``.
    ``df`` is used three times; give it written if it is not a cheap scan."""
    v = F.col(value)
    counts = df.where(v.isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    ranks = running_sums(counts, value, "_n", descending).select(value, (F.col("_before") + 1).alias(out))
    first = nulls == "first"
    null_rank = F.lit(1) if first else df.agg(F.count(value) + 1).scalar()
    ahead = df.agg(F.count_if(F.col(value).isNull())).scalar() if first else F.lit(0)
    return df.join(ranks, value, "left").withColumn(
        out, F.when(v.isNull(), null_rank).otherwise(F.col(out) + ahead).cast("int")
    )
