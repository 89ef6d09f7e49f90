"""Tables as versions: every write goes to a folder of its own, and a small manifest, published
last, says which folders are the table.

A write that dies half-way leaves folders that no manifest names, so readers keep seeing the
table before it and a "skip if it is there" does not take the remains for a table. Tables
partitioned by a column list one folder per value; ``refresh`` writes the folders of some values
anew and publishes a manifest that keeps all others as they are.

    table/version=<id>/[column=value/]part-*.parquet
    table/_manifests/00000007.json      the highest number counts

Manifests are written under a temporary name and renamed, which fails if another writer has
taken the number meanwhile (``Conflict``). Files are reached through Hadoop's file system, so any
store that Spark writes to will do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.session import SHUFFLES_GO, settings

VERSION = "version"
#: What Spark names the folder of a null partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class Conflict(RuntimeError):
    """Another writer has published in between."""


class _Files:
    """The few file system calls that manifests need."""

    def __init__(self, spark: SparkSession, table: str):
        self._jvm = spark._jvm
        self.table = table.rstrip("/")
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self.path("").getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.table}/{name}".rstrip("/"))

    def names(self, name: str) -> list[str]:
        p = self.path(name)
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        temporary = self.path(f"_manifests/_{uuid.uuid4().hex}")
        stream = self._fs.create(temporary, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self._fs.exists(self.path(name)) or not self._fs.rename(temporary, self.path(name)):
            self._fs.delete(temporary, False)
            raise Conflict(f"{self.table}: {name} has been published by another writer")


def _latest(files: _Files) -> int:
    return max((int(n[:8]) for n in files.names("_manifests") if n[:8].isdigit() and n.endswith(".json")), default=0)


def manifest(spark: SparkSession, table: str) -> dict | None:
    """The published manifest, or None where nothing has been published."""
    files = _Files(spark, table)
    number = _latest(files)
    return json.loads(files.read(f"_manifests/{number:08d}.json")) | {"number": number} if number else None


def _write(df: DataFrame, table: str, partition_by: str | None, gathered: bool = False) -> tuple[str, list[str]]:
    """The new version's name and its folders, relative to the table."""
    version = f"{VERSION}={uuid.uuid4().hex[:12]}"
    target = f"{table.rstrip('/')}/{version}"
    with settings(df.sparkSession, SHUFFLES_GO):
        if partition_by is None:
            df.write.parquet(target)
            return version, [version]
        # Rows of one value meet in few tasks; a large one is split again by size.
        df = df if gathered else df.hint("rebalance", partition_by)
        df.write.partitionBy(partition_by).parquet(target)
    names = _Files(df.sparkSession, table).names(version)
    return version, [f"{version}/{n}" for n in names if n.startswith(f"{partition_by}=")]


def _record(df: DataFrame, folders: list[str], partition_by: str | None) -> dict:
    return {"folders": sorted(folders), "partition_by": partition_by, "schema": df.schema.json()}


def publish(
    df: DataFrame, table: str, partition_by: str | None = None, overwrite: bool = True, gathered: bool = False
) -> bool:
    """Writes ``df`` as the table's new version. With ``overwrite=False`` a published table is left
    as it is; remains of a write that was never published do not count. ``gathered`` rows come from
    files of one partition value each and are not shuffled again. Returns whether it wrote."""
    files = _Files(df.sparkSession, table)
    number = _latest(files)
    if number and not overwrite:
        return False
    _, folders = _write(df, table, partition_by, gathered)
    files.publish(f"_manifests/{number + 1:08d}.json", json.dumps(_record(df, folders, partition_by)))
    return True


def _folder(column: str, value: str | None) -> str:
    # Spark escapes what a path can't hold; month keys and plain words need none.
    return f"{column}={NULL_FOLDER if value is None else quote(value, safe='-_. ~')}"


def refresh(df: DataFrame, table: str, values: Collection[str | None], gathered: bool = False) -> list[str]:
    """Writes the rows of ``df`` whose partition value is among ``values`` and puts them in place of
    the table's folders of these values; all other folders stay. ``gathered`` as in ``publish``.
    Returns the folders written."""
    spark = df.sparkSession
    old = manifest(spark, table)
    if old is None or old["partition_by"] is None:
        raise ValueError(f"{table} is not published by partitions")
    column = old["partition_by"]
    given = [v for v in values if v is not None]
    chosen = F.col(column).isin(*given) if given else F.lit(False)
    if None in values:
        chosen = chosen | F.col(column).isNull()
    _, folders = _write(df.where(chosen), table, column, gathered)
    gone = {_folder(column, v) for v in values}
    kept = [f for f in old["folders"] if f.rsplit("/", 1)[-1] not in gone]
    record = _record(df, kept + folders, column)
    _Files(spark, table).publish(f"_manifests/{old['number'] + 1:08d}.json", json.dumps(record))
    return folders


def read_published(spark: SparkSession, table: str) -> DataFrame:
    """The table as last published, with its declared types and column order."""
    found = manifest(spark, table)
    if found is None:
        raise FileNotFoundError(f"{table} has no published version")
    schema = T.StructType.fromJson(json.loads(found["schema"]))
    if not found["folders"]:
        return spark.createDataFrame([], schema)
    base = table.rstrip("/")
    stored = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
    reader = spark.read.schema(stored).option("basePath", base)
    return reader.parquet(*(f"{base}/{f}" for f in found["folders"])).select(*schema.names)
