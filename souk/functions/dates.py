"""Date and duration expressions.

Timestamps carry no zone (``timestamp_ntz``); the session time zone is UTC. Durations are
always turned into numbers, never kept as intervals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS_PER_DAY = 86_400_000_000
_MICROS_PER_HOUR = 3_600_000_000


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_start(ts: Column | str) -> Column:
    """First instant of the month, kept zone-less (SQL ``DATE_TRUNC('month', ts)``).

    Built from the calendar fields, so the result does not depend on the session time zone.
    """
    t = _c(ts)
    zero = F.lit(0)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.lit(1), zero, zero, zero)


def month_key(ts: Column | str) -> Column:
    """Month period as text, ``yyyy-MM``."""
    return F.date_format(_c(ts), "yyyy-MM")


def _time_of_day_micros(t: Column) -> Column:
    whole = F.hour(t).cast("bigint") * 3_600_000_000 + F.minute(t).cast("bigint") * 60_000_000
    return whole + (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("bigint")


def _micros(start: Column | str, end: Column | str) -> Column:
    """Microseconds from ``start`` to ``end`` on the wall clock of zone-less timestamps:
    whole calendar days plus the time-of-day difference, independent of the session time
    zone (a zone-aware difference would shift by an hour across daylight-saving changes)."""
    a, b = _c(start), _c(end)
    days = F.datediff(F.to_date(b), F.to_date(a)).cast("bigint")
    return days * _MICROS_PER_DAY + (_time_of_day_micros(b) - _time_of_day_micros(a))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Fractional days from ``start`` to ``end``; NULL when either side is NULL."""
    return _micros(start, end) / F.lit(float(_MICROS_PER_DAY))


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Fractional hours from ``start`` to ``end``."""
    return _micros(start, end) / F.lit(float(_MICROS_PER_HOUR))


def whole_days_floor(start: Column | str, end: Column | str) -> Column:
    """Whole days rounded toward minus infinity (pandas ``Timedelta.days``)."""
    return F.floor(_micros(start, end) / F.lit(float(_MICROS_PER_DAY))).cast("bigint")


def whole_days_trunc(start: Column | str, end: Column | str) -> Column:
    """Whole days rounded toward zero (SQL ``EXTRACT(DAY FROM end - start)``)."""
    # Casting a double to an integer drops the fraction, i.e. truncates toward zero.
    return (_micros(start, end) / F.lit(float(_MICROS_PER_DAY))).cast("bigint")


def weekday_name(ts: Column | str) -> Column:
    """English day name, Monday..Sunday."""
    return F.date_format(_c(ts), "EEEE")


def is_weekend(ts: Column | str) -> Column:
    """Saturday or Sunday (weekday 5 or 6, Monday = 0); NULL timestamps are not weekend."""
    return F.coalesce(F.weekday(_c(ts)).isin(5, 6), F.lit(False))


def month_index_between(earlier_month: Column | str, later_month: Column | str) -> Column:
    """Calendar months from one month to another: (y2 - y1) * 12 + (m2 - m1)."""
    a, b = _c(earlier_month), _c(later_month)
    return ((F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))).cast("bigint")
