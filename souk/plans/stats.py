"""Facts about a table that its write has counted along the way.

``observed`` adds a row count, NULL counts and the smallest and largest number of each numeric
column to a frame that is about to be written; the write itself computes them, so profiles and
health checks need no second scan. ``stats_of`` gives the same figures for any frame, from one
aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableStats:
    rows: int
    #: NULLs per column
    nulls: dict[str, int]
    #: rows in which a key column is NULL
    null_keys: int = 0
    #: smallest and largest value (no NaN) of the numeric columns that have one
    low: dict[str, float] = field(default_factory=dict)
    high: dict[str, float] = field(default_factory=dict)


def _measures(df: DataFrame, keys: Sequence[str]) -> dict[str, Column]:
    """Aggregates by name; names are short, as they travel with every task."""
    out = {"rows": F.count(F.lit(1))}
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        out[f"n{i}"] = F.count(c)
        if isinstance(f.dataType, T.NumericType):
            x = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
            out[f"a{i}"], out[f"z{i}"] = F.min(x), F.max(x)
    if keys:
        out["keys"] = F.count(F.when(reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys]), 1))
    return out


def _read(df: DataFrame, values: dict) -> TableStats:
    rows, names = values.get("rows") or 0, df.columns

    def per_column(letter: str) -> dict:
        return {n: v for i, n in enumerate(names) if (v := values.get(f"{letter}{i}")) is not None}

    nulls = {n: rows - c for n, c in per_column("n").items()}
    return TableStats(rows, nulls, rows - values.get("keys", rows), per_column("a"), per_column("z"))


def observed(df: DataFrame, keys: Sequence[str] = ()) -> tuple[DataFrame, Callable[[], TableStats]]:
    """``df`` to be written once, and what returns its figures after that."""
    seen = Observation()
    counted = df.observe(seen, *(c.alias(n) for n, c in _measures(df, keys).items()))
    return counted, lambda: _read(df, seen.get)


def stats_of(df: DataFrame, keys: Sequence[str] = ()) -> TableStats:
    return _read(df, df.agg(*(c.alias(n) for n, c in _measures(df, keys).items())).first().asDict())
