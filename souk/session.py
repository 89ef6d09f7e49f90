"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every session of this library relies on. Session time zone must be UTC:
# the retail timestamps carry no zone and month truncation returns a zoned timestamp.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Coalescing keeps partitions of at least this size; small enough that modest tables
    # still spread over the cores, irrelevant for large shuffles (sized by the advisory size).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Broadcast only what Spark has measured to be small (static estimate or AQE runtime stats).
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# While a table is built: what a task sorts or aggregates unfolds to some fifteen times its size in
# files, so splits and shuffle partitions of Spark's own sizes outgrow a task's memory and spill.
SMALL_TASKS = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def build_session(
    app_name: str = "souk",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    initial_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    ``master`` and ``shuffle_partitions`` are only applied when given; on a cluster the
    submitter's settings win.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if initial_partitions:
        # Before AQE merges small ones: choose so that a partition of the largest shuffle fits.
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


# Shuffle partitions before small ones are merged; a session without it starts from
# spark.sql.shuffle.partitions, which says nothing of the input's size.
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# For a table's write: its shuffle files go when it is written, not when the driver's garbage
# collector finds its plan; the library's own tables also take less room.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
WRITES = SHUFFLES_GO | {"spark.sql.parquet.compression.codec": "zstd"}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the jobs that run inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def small_tasks(spark: SparkSession, partitions: int = 0) -> Iterator[None]:
    """``SMALL_TASKS`` for the jobs that run inside, with shuffles of at least ``partitions``
    partitions before small ones are merged; what the session has set smaller stays."""
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    values = {k: v for k, v in SMALL_TASKS.items() if size(spark.conf.get(k)) > size(v)}
    if partitions > int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        values[INITIAL_PARTITIONS] = str(partitions)
    with settings(spark, values):
        yield


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/souk-{label}-{uuid.uuid4().hex[:12]}"


def written(
    df: DataFrame, label: str, partition_by: str | None = None, buckets: tuple[int, str] | None = None
) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and read back; with
    ``partition_by`` in a folder per value, so that filters on that column pick folders; with
    ``buckets`` as so many buckets of a column, so that joins and sums by it need no shuffle: its
    rows must have been repartitioned so."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with settings(spark, WRITES):
        if buckets:
            # An external table of this session; its files are those of any written table.
            name = path.rsplit("/", 1)[-1].replace("-", "_")
            empty = spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields))
            empty.write.bucketBy(*buckets).option("path", path).saveAsTable(name)
            df.write.insertInto(name)
            return spark.table(name)
        if partition_by is None:
            df.write.parquet(path)
            return spark.read.schema(df.schema).parquet(path)
        df.write.partitionBy(partition_by).parquet(path)
        return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is; a
    machine-local temporary folder is only chosen for local runs and tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="souk-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
