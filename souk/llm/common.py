"""Shared helpers: words, column plumbing and written intermediate tables."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.session import ensure_checkpoint_dir

#: Words: A-Z lower-cased, then runs of digits, letters a-z and everything beyond ASCII.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def _fold_byte(b: int) -> int:
    c = chr(b)
    if c in UPPER:
        return b + 32
    return b if b >= 0x80 or c in LOWER or c in "0123456789" else 0x20


#: One byte-to-byte map does the lower-casing and turns every separator into a space. UTF-8
#: continuation bytes are all >= 0x80, so multi-byte characters pass unchanged.
_FOLD = bytes(_fold_byte(b) for b in range(256))


def words(text: str | None) -> list[bytes]:
    """The words of a whole text as UTF-8 bytes (null: none)."""
    if not text:
        return []
    return text.encode("utf-8", "replace").translate(_FOLD).split()


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


#: Narrow rows in a file, where the number of rows is known.
FILE_ROWS = 200_000


def written(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: the lineage ends there,
    a lost executor costs only re-reading, and later plans see real sizes. ``rows``: a bound on
    the rows of a narrow table that is cheap to make; it is written in files of ``FILE_ROWS``."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if rows is not None:
        df = df.coalesce(rows // FILE_ROWS + 1)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of narrow keys (a few numbers each) that are broadcast at most.
BROADCAST_ROWS = 500_000


def few(rows: DataFrame, bound: int = BROADCAST_ROWS) -> bool:
    """Whether a written table is small enough to be broadcast."""
    return rows.limit(bound + 1).count() <= bound


def with_text_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only id, text and ``_key``: rows are one document to an operator exactly if id and text
    are equal, so joins back on ``_key`` are right for repeated ids too."""
    return docs.select(
        F.col(id_col).alias("_id"),
        F.col(text_col).cast("string").alias("_text"),
        F.xxhash64(F.col(id_col), F.col(text_col).cast("string")).alias("_key"),
    )


def release_memory() -> None:
    """Gives freed memory back to the system. Workers live on between tasks, and what a task's
    batches took would else stay with them beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


#: Rows that a function gets at once, so that what it makes stays small beside the batch.
SLICE_ROWS = 1024


#: Rows in a batch that Spark hands to Python workers, where the session leaves Spark's default. Whole
#: texts take a lot of memory beside the executor's heap, in Arrow buffers and in the workers.
BATCH_ROWS = 2000
_BATCH_CONF, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def small_batches(spark: SparkSession) -> None:
    if spark.conf.get(_BATCH_CONF, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


def text_udf(fn, schema: T.DataType | str):
    """A pandas UDF over texts or other large values: small batches, and a worker gives back what
    earlier batches took before it begins with the next."""
    small_batches(SparkSession.active())

    @functools.wraps(fn)
    def run(*columns):
        release_memory()
        return fn(*columns)

    return F.pandas_udf(run, schema)


def map_rows(df: DataFrame, fn, schema: T.StructType | str) -> DataFrame:
    """``mapInPandas`` over batches; ``fn`` gets a frame and returns a frame. Batches are
    bounded by Spark in rows and bytes, so memory does not grow with a partition."""

    small_batches(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_memory()
        try:
            for batch in batches:
                for at in range(0, len(batch), SLICE_ROWS):
                    out = fn(batch.iloc[at : at + SLICE_ROWS])
                    if len(out):  # an empty frame's columns have no usable type
                        yield out
        finally:
            release_memory()

    return df.mapInPandas(run, schema)
