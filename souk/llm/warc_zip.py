"""WARC archives in ZIP packages: writer, directory reader and range reader.

A package is a ZIP file with two stored (uncompressed) members: ``archive/data.warc.gz``, one gzip
member per WARC record, and ``indexes/index.cdxj``, one JSON line per record with its offset
and length in the archive.

Writing. Each task rolls packages of about ``PACKAGE_BYTES`` straight from its partition and
returns their paths; names hold an attempt's own id, so a lost or repeated attempt can never mix
with the one whose manifest counts.

Reading. The end of a package gives its central directory (ZIP64 records where the plain ones
are saturated), the directory gives stored members, their local headers the members' place in the
file. The index is read in ranges and cut into runs of neighbouring records of about
``RANGE_BYTES``; Spark deals these out, and each is fetched by one range read. Nothing is extracted
to disk, and no task holds more than one range and its largest record. An archive without an
index is walked record by record.

Files go through ``pyarrow.fs``, under the shared folder of the session.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes, that with the largest id is the
response and the others revisit it.

Defined results: a null payload is empty; smaller payloads are never shared; rows with equal
largest ids are all responses; a null id can revisit but is revisited only if no row of its
group has an id, and then all are responses; a null or empty URL gives no target; extra columns
are ignored.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm.common import scratch_path, written

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 16 << 20
RANGE_BYTES = 1 << 20
MIN_REVISIT = 1000

_EOCD, _EOCD64, _LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_CENTRAL, _LOCAL = b"PK\x01\x02", b"PK\x03\x04"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


def file_system(path: str) -> tuple[arrow_fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return arrow_fs.FileSystem.from_uri(path)


# Reading ZIP structures -----------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    offset: int  # of its data in the package


class Package:
    """A ZIP file read by ranges."""

    def __init__(self, file):
        self.file = file
        self.size = file.size()

    @classmethod
    def open(cls, path: str) -> Package:
        system, inner = file_system(path)
        return cls(system.open_input_file(inner))

    def read(self, offset: int, length: int) -> bytes:
        if not 0 <= offset <= offset + length <= self.size:
            raise ValueError(f"range {offset}+{length} is outside a file of {self.size} bytes")
        self.file.seek(offset)
        return self.file.read(length)

    def directory(self) -> tuple[int, int, int]:
        """Start, size and number of entries of the central directory."""
        tail_at = max(0, self.size - 22 - _FULL16)
        tail = self.read(tail_at, self.size - tail_at)
        at = tail.rfind(_EOCD)
        # A comment may hold the signature: the true record's comment ends with the file.
        while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
            at = tail.rfind(_EOCD, 0, at)
        if at < 0:
            raise ValueError("no end of central directory: not a ZIP file")
        entries, size, start = struct.unpack("<HII", tail[at + 10 : at + 20])
        end = tail_at + at
        if entries == _FULL16 or size == _FULL32 or start == _FULL32:
            locator = self.read(end - 20, 20) if end >= 20 else b""
            if locator[:4] == _LOCATOR64:
                end64 = struct.unpack("<Q", locator[8:16])[0]
                record = self.read(end64, 56)
                if record[:4] != _EOCD64:
                    raise ValueError("no ZIP64 end of central directory where its locator points")
                entries, size, start = struct.unpack("<QQQ", record[32:56])
        return start, size, entries

    def members(self) -> Iterator[Member]:
        at, size, entries = self.directory()
        data, p = self.read(at, size), 0
        for _ in range(entries):
            if data[p : p + 4] != _CENTRAL:
                raise ValueError("broken central directory")
            method = int.from_bytes(data[p + 10 : p + 12], "little")
            packed, full, n_name, n_extra, n_comment = struct.unpack("<IIHHH", data[p + 20 : p + 34])
            header = int.from_bytes(data[p + 42 : p + 46], "little")
            name = data[p + 46 : p + 46 + n_name].decode("utf-8", "replace")
            extra = data[p + 46 + n_name : p + 46 + n_name + n_extra]
            wide = _zip64_values(extra, (full, packed, header))
            _, packed, header = wide
            yield Member(name, method, packed, self._data_at(header))
            p += 46 + n_name + n_extra + n_comment

    def _data_at(self, header: int) -> int:
        local = self.read(header, 30)
        if local[:4] != _LOCAL:
            raise ValueError("no local header where the directory points")
        n_name, n_extra = struct.unpack("<HH", local[26:30])
        return header + 30 + n_name + n_extra

    def stored(self, suffixes: tuple[str, ...], folder: str) -> list[Member]:
        found = [m for m in self.members() if m.name.startswith(folder) and m.name.endswith(suffixes)]
        if packed := [m.name for m in found if m.method != zipfile.ZIP_STORED]:
            raise ValueError(f"members are not stored and cannot be read by ranges: {packed}")
        return found


def _zip64_values(extra: bytes, values: tuple[int, int, int]) -> tuple[int, int, int]:
    """Size, packed size and header offset, those saturated taken from the ZIP64 extra field."""
    p = 0
    while p + 4 <= len(extra):
        kind, n = struct.unpack("<HH", extra[p : p + 4])
        if kind == 1:
            wide = iter(struct.unpack(f"<{n // 8}Q", extra[p + 4 : p + 4 + n // 8 * 8]))
            size, packed, header = (next(wide) if v == _FULL32 else v for v in values)
            return size, packed, header
        p += 4 + n
    return values


def index_lines(package: Package, index: Member) -> Iterator[dict]:
    """The index's entries, read in ranges."""
    rest = b""
    for at in range(0, index.size, RANGE_BYTES):
        rest += package.read(index.offset + at, min(RANGE_BYTES, index.size - at))
        *lines, rest = rest.split(b"\n")
        yield from (json.loads(x) for x in lines if x.strip())
    if rest.strip():
        yield json.loads(rest)


def walked(package: Package, archive: Member) -> Iterator[dict]:
    """Index entries of an archive that has none, found by inflating it in ranges."""
    start, at, stream, rest = 0, 0, zlib.decompressobj(31), b""
    while at < archive.size or rest:
        if not rest:
            n = min(RANGE_BYTES, archive.size - at)
            rest = package.read(archive.offset + at, n)
            at += n
        stream.decompress(rest)
        rest = stream.unused_data
        if stream.eof:
            end = at - len(rest)
            yield {"offset": start, "length": end - start}
            start, stream = end, zlib.decompressobj(31)
    if start != archive.size:
        raise ValueError(f"archive {archive.name} ends within a record")


def runs(entries: Iterable[dict], base: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """Neighbouring records as one range: its start in the package, offsets within, lengths."""
    start, offsets, lengths = 0, [], []
    for e in entries:
        at = base + e["offset"]
        if offsets and (at != start + offsets[-1] + lengths[-1] or at + e["length"] - start > RANGE_BYTES):
            yield start, offsets, lengths
            offsets, lengths = [], []
        if not offsets:
            start = at
        offsets.append(at - start)
        lengths.append(e["length"])
    if offsets:
        yield start, offsets, lengths


def package_runs(path: str) -> Iterator[tuple[str, int, list[int], list[int]]]:
    package = Package.open(path)
    archives = package.stored((".warc.gz",), "archive/")
    indexes = package.stored((".cdxj",), "indexes/")
    if len(archives) != 1 and indexes:
        raise ValueError("an index is understood for packages with one archive only")
    for archive in archives:
        entries = index_lines(package, indexes[0]) if indexes else walked(package, archive)
        for start, offsets, lengths in runs(entries, archive.offset):
            yield path, start, offsets, lengths


# WARC records -------------------------------------------------------------------------------

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _urn(record_id: str | None) -> str:
    return f"<urn:page:{'' if record_id is None else record_id}>"


def record(record_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record as a gzip member; a revisit if it refers to another."""
    revisit = refers_to is not None
    block = _HTTP if revisit else _HTTP + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _urn(record_id)),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if url:
        headers.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        headers.append(("WARC-Refers-To", _urn(refers_to)))
    headers.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    out = zlib.compressobj(1, zlib.DEFLATED, 31)
    return out.compress(head.encode("utf-8", "replace")) + out.compress(block + b"\r\n\r\n") + out.flush()


def parse_record(member: bytes) -> dict:
    """Type, ids, digest and payload of one record."""
    data = zlib.decompress(member, 31)
    if not data.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    head, _, body = data.partition(b"\r\n\r\n")
    headers = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        headers[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    block = body[: int(headers[b"content-length"])]
    _, _, payload = block.partition(b"\r\n\r\n")

    def page(name: bytes) -> str | None:
        return headers.get(name, "").removeprefix("<urn:page:").removesuffix(">") or None

    return {
        "record_type": headers[b"warc-type"],
        "record_id": page(b"warc-record-id"),
        "target_uri": headers.get(b"warc-target-uri"),
        "refers_to": page(b"warc-refers-to"),
        "digest": headers.get(b"warc-payload-digest", "").removeprefix("sha1:"),
        "payload": payload,
    }


# Spark jobs -----------------------------------------------------------------------------------

RECORD = (
    "package string, offset long, record_type string, record_id string, target_uri string, "
    "refers_to string, digest string, payload binary"
)


def with_types(pages: DataFrame, id_col: str, url_col: str, body_col: str) -> DataFrame:
    """Adds each page's payload, digest, record type and what it refers to."""
    payload = F.coalesce(F.encode(F.col(body_col).cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= MIN_REVISIT
    shared = rows.where(large).groupBy("digest").agg(F.max("id").alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1 and holder is not null")
    shared = written(shared.select("digest", "holder"), "warc-shared")
    # Empty and small payloads are never shared, however often one occurs: they stay where they are.
    joined = rows.where(large).join(shared, "digest", "left")
    refers = F.when(~F.coalesce(F.col("id") == F.col("holder"), F.col("holder").isNull()), F.col("holder"))
    names = ("id", "url", "payload", "digest")
    small = rows.where(~large).select(*names, F.lit(None).cast(rows.schema["id"].dataType).alias("refers_to"))
    return joined.select(*names, refers.alias("refers_to")).unionByName(small)


def write_packages(typed: DataFrame, folder: str) -> DataFrame:
    """Writes the records of ``typed`` into packages and returns their written manifest."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        mine, made = uuid.uuid4().hex, 0
        archive, lines, at = io.BytesIO(), [], 0

        def flush() -> pd.DataFrame:
            nonlocal archive, lines, at, made
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
                z.writestr(ARCHIVE, archive.getbuffer())
                z.writestr(INDEX, "".join(lines))
            name = f"{mine}-{made:05d}.wacz"
            with system.open_output_stream(f"{root}/{name}") as f:
                f.write(out.getbuffer())
            row = pd.DataFrame({"package": [f"{folder}/{name}"], "records": [len(lines)]})
            archive, lines, at, made = io.BytesIO(), [], 0, made + 1
            return row

        for batch in batches:
            for row in batch.itertuples(index=False):
                member = record(row.id, row.url, bytes(row.payload), row.digest, row.refers_to)
                archive.write(member)
                lines.append(json.dumps({"offset": at, "length": len(member), "id": row.id}) + "\n")
                at += len(member)
                if at >= PACKAGE_BYTES:
                    yield flush()
        if lines:
            yield flush()

    text = {c: F.col(c).cast("string") for c in ("id", "refers_to")}
    return written(typed.withColumns(text).mapInPandas(write, "package string, records long"), "warc-manifest")


def read_records(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """All records of the packages of ``manifest`` (column package), see RECORD."""

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["package", "start", "offsets", "lengths"]
        for batch in batches:
            for path in batch["package"]:
                rows = []
                for row in package_runs(path):
                    rows.append(row)
                    if len(rows) >= 1000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, package = None, None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.package != path:
                    path, package = row.package, Package.open(row.package)
                data = package.read(row.start, int(row.offsets[-1] + row.lengths[-1]))
                found = []
                for at, n in zip(row.offsets, row.lengths, strict=True):
                    parsed = parse_record(data[at : at + n])
                    found.append({"package": path, "offset": row.start + at, **parsed})
                yield pd.DataFrame(found)

    # Both repartitions spread small rows that stand for much reading.
    width = max(spark.sparkContext.defaultParallelism * 4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = "package string, start long, offsets array<long>, lengths array<long>"
    ranges = manifest.select("package").repartition(width).mapInPandas(locate, schema)
    return ranges.repartition(width).mapInPandas(fetch, RECORD)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Writes one record per row of ``pages`` and returns what reading them back yields:
    page_id, payload_bytes, payload_digest, record_type, refers_to, and the record's place."""
    spark = pages.sparkSession
    kind = pages.select(F.col(id_col)).schema[0].dataType.simpleString()
    folder = scratch_path(spark, "warc-packages")
    records = read_records(spark, write_packages(with_types(pages, id_col, url_col, body_col), folder))
    is_response = F.col("record_type") == "response"
    own = records.select(
        "record_id",
        "record_type",
        "refers_to",
        "package",
        "offset",
        F.when(is_response, F.octet_length("payload")).cast("long").alias("bytes"),
        F.when(is_response, F.sha1("payload")).otherwise(F.col("digest")).alias("payload_digest"),
    )
    own = written(own, "warc-records")
    # A revisit has its payload where it refers to.
    held = own.where("record_type = 'response' and record_id is not null")
    held = held.groupBy(F.col("record_id").alias("held"), F.col("payload_digest").alias("held_digest")).agg(F.max("bytes").alias("held_bytes"))
    on = (F.col("refers_to") == F.col("held")) & (F.col("payload_digest") == F.col("held_digest"))
    return own.join(held, on, "left").select(
        F.col("record_id").cast(kind).alias("page_id"),
        F.coalesce("bytes", "held_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
        "package",
        "offset",
    )
