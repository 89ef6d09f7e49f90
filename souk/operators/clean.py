"""Reusable cleaning steps: names, checks, typed parsing, fills, de-duplication, zips.

Everything is a DataFrame -> DataFrame function built from built-in expressions. Fill
statistics (medians, modes) come from one written table of value counts and enter the row
expressions as scalar subqueries of one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.functions.numeric import half_even_long
from souk.operators.ranking import write_ranges
from souk.session import written


class ValidationError(RuntimeError):
    """A required table or column is missing."""


# Strings a CSV reader treats as missing (pandas' default NA tokens).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


# ----------------------------------------------------------------------------- names (P1-P3)
def snake_case(name: str) -> str:
    """The ASCII letter and digit runs of a name, lower-cased, joined by single underscores."""
    return "_".join(re.findall(r"[0-9a-z]+", name.lower()))


def standardize_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])


def lower_trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


# Misspelt product column names in the marketplace source and their fixes.
PRODUCT_RENAMES = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


# ----------------------------------------------------------------------------- checks (V1-V3)
def require_columns(df: DataFrame, columns: Iterable[str], table: str | None = None) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValidationError(f"{table or 'table'} lacks the columns {missing}")
    return df


def require_tables(tables: dict, names: Iterable[str]) -> None:
    missing = sorted(set(names) - set(tables))
    if missing:
        raise ValidationError(f"these tables were not given: {missing}")


def first_present(columns: Iterable[str], candidates: Sequence[str]) -> str | None:
    cols = set(columns)
    return next((c for c in candidates if c in cols), None)


# ----------------------------------------------------------------------------- parsing (P4-P7, L19)
def _is_string(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StringType)


def nullify_na_tokens(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Turn CSV missing-value tokens in string columns into NULL."""
    cols = [c for c in columns if c in df.columns and _is_string(df, c)]
    return df.withColumns({c: F.when(F.col(c).isin(*NA_TOKENS), F.lit(None)).otherwise(F.col(c)) for c in cols})


#: Decimal and exponent notation; excludes the type suffixes and hexadecimal that the engine's
#: own cast would take.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def parse_number(text: Column) -> Column:
    """Text to DOUBLE; NULL unless it is written as a plain number."""
    bare = F.trim(text)
    return F.when(bare.rlike(NUMBER_PATTERN), bare.try_cast("double"))


def coerce_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Numeric parse; values that do not parse become NULL. Missing columns are skipped."""
    out = {}
    for c in columns:
        if c not in df.columns:
            continue
        out[c] = parse_number(F.col(c)) if _is_string(df, c) else F.col(c).cast("double")
    return df.withColumns(out) if out else df


def parse_datetimes(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Zone-less timestamp parse; values that do not parse become NULL."""
    out = {}
    for c in columns:
        if c not in df.columns:
            continue
        if _is_string(df, c):
            out[c] = F.expr(f"try_cast(trim(`{c}`) AS TIMESTAMP_NTZ)")
        else:
            out[c] = F.col(c).cast("timestamp_ntz")
    return df.withColumns(out) if out else df


def to_half_even_long(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: half_even_long(c) for c in columns if c in df.columns})


def zip_prefix(c: Column, legacy_zip: bool = False) -> Column:
    """Zip prefix as text: without a trailing '.0' left by numeric parsing, NULL -> '00000'. With
    ``legacy_zip`` also without leading zeros, as an export read with inferred types has it."""
    bare = F.regexp_replace(c.cast("string"), r"\.0$", "")
    if legacy_zip:
        bare = F.regexp_replace(bare, r"^0+(?=[0-9]+$)", "")
    return F.coalesce(bare, F.lit("00000"))


def normalize_zip(df: DataFrame, column: str, legacy_zip: bool = False) -> DataFrame:
    return df.withColumn(column, zip_prefix(F.col(column), legacy_zip)) if column in df.columns else df


# ----------------------------------------------------------------------------- statistics
#: Texts up to this length stand for themselves while values are counted, longer ones as a hash.
SHORT_TEXT = 64
_DIGEST = "sha2(CAST({0} AS BINARY), 256)"


def value_counts(df: DataFrame, numbers: Sequence[str], texts: Sequence[str] = ()) -> DataFrame:
    """The distinct non-NULL values of the columns with how often each occurs, counted in one
    scan with map-side sums and written once: ``name``, ``number``, ``text`` or ``long_text`` (the
    hash of a text beyond SHORT_TEXT characters), ``n``. Values are spread by hash, so the distinct
    texts of one column do not meet in one task, and long ones are not shuffled."""

    def record(c: str, number: str, short: str, long: str) -> str:
        return f"'{c}', CAST({number} AS DOUBLE), CAST({short} AS STRING), CAST({long} AS STRING)"

    # stack() emits the records without materialising an array per input row.
    records = [record(c, f"`{c}`", "NULL", "NULL") for c in numbers]
    for c in texts:
        is_long = f"length(CAST(`{c}` AS STRING)) > {SHORT_TEXT}"
        short, long = (f"CASE WHEN {x} THEN {v} END" for x, v in (
            (f"NOT {is_long}", f"`{c}`"), (is_long, _DIGEST.format(f"CAST(`{c}` AS STRING)"))
        ))
        records.append(record(c, "NULL", short, long))
    long = df.selectExpr(f"stack({len(records)}, {', '.join(records)}) AS (name, number, text, long_text)")
    long = long.where("number IS NOT NULL OR text IS NOT NULL OR long_text IS NOT NULL")
    counts = long.groupBy("name", "number", "text", "long_text").agg(F.count(F.lit(1)).alias("n"))
    return written(counts, "value-counts")


def column_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column name with the interpolated median of its non-NULL values."""
    return medians_of(value_counts(df, columns))


def medians_of(counts: DataFrame) -> DataFrame:
    """The medians from written value counts: these are written again in ranges of (name, number),
    a range being a contiguous slice of a column's values. Sums per range tell which range holds a
    column's middle; only that range's values are put in order."""
    numbers = write_ranges(counts.where("number IS NOT NULL").select("name", "number", "n"), "name", "number")
    sizes = numbers.groupBy("name", "range").agg(F.sum("n").alias("size"))
    whole = Window.partitionBy("name")  # a row per range
    sizes = sizes.withColumn("total", F.sum("size").over(whole))
    before = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    lo, hi = F.floor((F.col("total") - 1) / 2), F.ceil((F.col("total") - 1) / 2)
    middle = sizes.where((F.col("start") <= hi) & (F.col("start") + F.col("size") > lo))
    rows = numbers.join(middle.select("name", "range", "start", "total"), ["name", "range"])
    inside = Window.partitionBy("name", "range").orderBy("number")
    stop = F.col("start") + F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("stop", stop).withColumn("first", F.col("stop") - F.col("n"))

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("first") <= place) & (F.col("stop") > place), F.col("number")))

    both = rows.groupBy("name").agg(at(lo).alias("a"), at(hi).alias("b"))
    return both.select("name", (F.col("a") + (F.col("b") - F.col("a")) * F.lit(0.5)).alias("median"))


def modes_of(counts: DataFrame, df: DataFrame | None = None) -> DataFrame:
    """The most frequent text per column name from written value counts; ties: the smallest. Only
    where a hash of a long text is among a column's most frequent are its texts looked up in
    ``df``, those of these hashes alone."""
    texts = counts.where("text IS NOT NULL OR long_text IS NOT NULL")
    most = texts.groupBy("name").agg(F.max("n").alias("n"))  # a row per column
    leaders = texts.join(F.broadcast(most), ["name", "n"])
    named = leaders.where("text IS NOT NULL").select("name", "text")
    hashes = leaders.where("long_text IS NOT NULL").select("name", "long_text")
    columns = [r["name"] for r in hashes.select("name").distinct().collect()]
    if columns:
        records = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
        rows = df.selectExpr(f"stack({len(columns)}, {records}) AS (name, text)").where(F.length("text") > SHORT_TEXT)
        rows = rows.withColumn("long_text", F.expr(_DIGEST.format("text")))
        named = named.unionByName(rows.join(hashes, ["name", "long_text"], "left_semi").select("name", "text"))
    return named.groupBy("name").agg(F.min("text").alias("mode"))


def fill_missing(df: DataFrame, medians: Sequence[str], modes: dict[str, str], strategy: str = "mode") -> DataFrame:
    """NULL -> the column's median (0 without values), or its most frequent text (the given
    default without values). With ``strategy="constant"`` texts take the default throughout. All
    values are counted in one scan."""
    if strategy not in ("mode", "constant"):
        raise ValueError(f"unknown strategy {strategy!r}")
    fills: dict[str, Column] = {}
    if strategy == "constant":
        fills, modes = {c: F.coalesce(F.col(c).cast("string"), F.lit(d)) for c, d in modes.items()}, {}
    if medians or modes:
        counts = value_counts(df, medians, list(modes))
    if medians:
        row = _one_row(medians_of(counts), "median", medians)
        fills |= {c: F.coalesce(F.col(c), row.getField(c), F.lit(0.0)) for c in medians}
    if modes:
        row = _one_row(modes_of(counts, df), "mode", list(modes))
        fills |= {c: F.coalesce(F.col(c).cast("string"), row.getField(c), F.lit(d)) for c, d in modes.items()}
    return df.withColumns(fills) if fills else df


def _one_row(stats: DataFrame, key: str, columns: Sequence[str]) -> Column:
    """(name, statistic) rows as one struct, a scalar subquery."""
    return stats.agg(F.struct(*[F.max(F.when(F.col("name") == c, F.col(key))).alias(c) for c in columns])).scalar()


def fill_numeric_median(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return fill_missing(df, [c for c in columns if c in df.columns], {})


def fill_categorical_mode(
    df: DataFrame, columns: Iterable[str], default: str = "Unknown", strategy: str = "mode"
) -> DataFrame:
    return fill_missing(df, [], {c: default for c in columns if c in df.columns}, strategy)


# ----------------------------------------------------------------------------- rows (X1, X8, X9)
def drop_null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=[c for c in columns if c in df.columns])


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key in ``order`` (then the remaining columns).

    Planned as ``min(struct(order..., rest...))`` per key: an aggregate with partial
    (map-side) combining, so a key holding a large share of the rows is reduced before the
    shuffle instead of being sorted inside one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in list(order) + rest])
    return (
        df.groupBy(*keys)
        .agg(F.min(packed).alias("_first"))
        .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in list(order) + rest])
        .select(*df.columns)
    )


def with_source_order(df: DataFrame, column: str = "source_row_order") -> DataFrame:
    """Row position straight after a file scan, for keep-first de-duplication: file name, start
    of the block within the file, position within the block. Files may be packed into tasks
    by size, so a running number alone would not follow their names."""
    place = (F.col("_metadata.file_name"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return df.withColumn(column, F.struct(*(c.alias(n) for c, n in zip(place, ("file", "block", "row"), strict=True))))
