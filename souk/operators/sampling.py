"""Repeatable samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bottom_k(df: DataFrame, stratum: str, key: str, k: int, seed: str = "") -> DataFrame:
    """Per stratum the ``k`` rows whose keys have the smallest hashes: a uniform sample that depends
    on the keys alone, so it stays the same over runs, partitionings and added columns. Keys
    are unique within a stratum, else equal ones are taken in any order. Each task passes on at
    most ``k`` rows of a stratum (the rank limit is taken before the shuffle too)."""
    digest = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")).cast("binary"))
    place = F.row_number().over(Window.partitionBy(stratum).orderBy("_digest", key))
    ranked = df.withColumn("_digest", digest).withColumn("_place", place)
    return ranked.where(F.col("_place") <= k).drop("_digest", "_place")
