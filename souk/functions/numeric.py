"""Money and ratio expressions.

Money is summed as ``DECIMAL(18,2)`` so totals are exact and independent of the order in
which partitions are combined; results leave the engine as DOUBLE. Averages are computed as
exact sum / count and rounded to 4 places. Divisions use ``try_divide`` because ANSI mode
raises on a zero denominator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col: Column | str) -> Column:
    """Cast a raw amount to the money type."""
    return _c(col).cast(MONEY)


def to_double(col: Column | str) -> Column:
    return _c(col).cast("double")


def round_to(col: Column | str, digits: int) -> Column:
    """Round half away from zero on the binary double value: ``round(x * 10^d) / 10^d``.

    Spelled out (rather than ``round(x, d)``, which rounds the shortest decimal string of
    the double) so that every engine computes the same bits from the same double.
    """
    scale = float(10**digits)
    # "+ 0.0" turns a rounded negative zero into 0.0 (engines differ in keeping the sign).
    return F.round(to_double(col) * F.lit(scale), 0) / F.lit(scale) + F.lit(0.0)


def round4(col: Column | str) -> Column:
    return round_to(col, 4)


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as DOUBLE, NULL when the denominator is 0 or NULL."""
    return F.try_divide(to_double(num), to_double(den))


EXACT_SUM = "decimal(38,9)"


def exact_avg(col: Column | str) -> Column:
    """Average of the non-NULL values from an exact decimal sum (aggregate).

    A plain double average depends on the order partitions are combined in; summing the
    values as decimals makes the result a function of the data only.
    """
    c = _c(col)
    return F.try_divide(F.sum(c.cast(EXACT_SUM)).cast("double"), F.count(c).cast("double"))


def avg4(col: Column | str) -> Column:
    """Exact average of the non-NULL values, rounded to 4 places (aggregate)."""
    return round4(exact_avg(col))


def half_even_long(col: Column | str) -> Column:
    """Round half to even, then to a 64-bit integer (NumPy ``round().astype(int64)``)."""
    return F.bround(_c(col).cast("double")).cast("bigint")
