"""WARC archives as a Spark data source.

Reading: whole files are dealt to partitions by size; predicates on the record type and on any other header
are pushed down and decided on the header alone.  The payload of a record that fails them is neither inflated
(gzip members that state their lengths in an ``sl`` extra field are skipped, others are run through) nor decoded,
and no payload is where the schema does not ask for it.

Columns are the header fields by name: ``record_type``, ``record_id``, ``target_uri``, ``refers_to``,
``payload_digest``, ``content_length`` ... and any extension field (``page_id`` is ``Page-Id``), as string or
long; null where the record lacks the field or holds no number.  ``headers`` is all of them as a map with
lower-case names.  ``payload`` (binary), ``payload_bytes`` (long) and ``payload_sha1`` (base32) are read off the
block, after the HTTP header where it has one.

Writing: one row a record, one gzip member a record.  A revisit keeps the digest and the HTTP header of its
payload, not the payload.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, MapType, StructType

from ..sources.filesets import FileSetWriter, listed, located, packed
from .common import with_least, written

#: Header fields with names of their own in the WARC format.
NAMED = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "date": "WARC-Date",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "block_digest": "WARC-Block-Digest",
    "refers_to": "WARC-Refers-To",
    "refers_to_target_uri": "WARC-Refers-To-Target-URI",
    "refers_to_date": "WARC-Refers-To-Date",
    "concurrent_to": "WARC-Concurrent-To",
    "warcinfo_id": "WARC-Warcinfo-ID",
    "ip_address": "WARC-IP-Address",
    "profile": "WARC-Profile",
    "truncated": "WARC-Truncated",
    "content_type": "Content-Type",
    "content_length": "Content-Length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Columns that are read off the block; nothing about them can be decided on a header.
OF_BLOCK = ("payload", "payload_bytes", "payload_sha1")
SUFFIXES = (".warc", ".warc.gz")
DEFAULT_SCHEMA = (
    "record_type string, record_id string, date string, target_uri string, refers_to string, payload_digest string, "
    "content_type string, content_length long, headers map<string,string>, payload binary"
)
_CHUNK = 1 << 20
_BATCH_ROWS, _BATCH_BYTES = 4096, 8 << 20


def header_of(column: str) -> str:
    """Header field that a column stands for."""
    return NAMED.get(column) or "-".join(part.capitalize() for part in column.split("_"))


# --- reading one file ---------------------------------------------------------------------------------------------------


class Member(io.RawIOBase):
    """One gzip member, inflated as far as it is read."""

    def __init__(self, file: io.BufferedReader):
        self.file, self.inflate = file, zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, view) -> int:
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.file.read1(1 << 16)
            out = self.inflate.decompress(data, len(view))
            if out:
                view[: len(out)] = out
                return len(out)
            if not data and not self.inflate.eof:
                raise EOFError("a gzip member is cut off")
        return 0

    def finish(self) -> None:
        """Move the file to the next member."""
        while self.read(_CHUNK):
            pass
        self.file.seek(-len(self.inflate.unused_data), io.SEEK_CUR)


def member_lengths(file: io.BufferedReader) -> tuple[int, int] | None:
    """Compressed and plain bytes of the gzip member at the file's place, if its ``sl`` field states them."""
    place = file.tell()
    head = file.read(12)
    extra = file.read(struct.unpack("<H", head[10:12])[0]) if len(head) == 12 and head[3] & 4 else b""
    file.seek(place)
    while len(extra) >= 4:
        size = struct.unpack("<H", extra[2:4])[0]
        if extra[:2] == b"sl" and size == 8:
            return struct.unpack("<II", extra[4:12])
        extra = extra[4 + size :]
    return None


def read_header(source: io.BufferedIOBase) -> tuple[dict[str, str], int] | None:
    """Header fields by lower-case name, and the bytes they took; None at the end."""
    line, size = source.readline(), 0
    while line in (b"\r\n", b"\n"):
        size += len(line)
        line = source.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record: {line[:80]!r}")
    header: dict[str, str] = {}
    last = None
    while True:
        size += len(line)
        line = source.readline()
        if line in (b"\r\n", b"\n", b""):
            return header, size + len(line)
        text = line.decode("utf-8", "replace").strip("\r\n")
        if text[:1] in (" ", "\t") and last:
            header[last] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            last = name.strip().lower()
            header[last] = value.strip()


@dataclass
class Payload:
    size: int
    sha1: str
    data: bytes | None


def read_payload(header: dict[str, str], source: io.BufferedIOBase, length: int, keep: bool) -> Payload:
    """Payload of a block of ``length`` bytes, read piece by piece; kept as a whole only if asked for."""
    if header.get("content-type", "").lower().startswith("application/http"):
        line = b""
        while length > 0 and line not in (b"\r\n", b"\n"):
            line = source.readline(length)
            length -= len(line)
            if not line:
                raise EOFError("a record is cut off")
    digest, size, kept = hashlib.sha1(), 0, []
    while size < length:
        piece = source.read(min(_CHUNK, length - size))
        if not piece:
            raise EOFError("a record is cut off")
        digest.update(piece)
        size += len(piece)
        if keep:
            kept.append(piece)
    return Payload(size, base64.b32encode(digest.digest()).decode(), b"".join(kept) if keep else None)


def _skip(source: io.BufferedIOBase, n: int) -> None:
    if source.seekable():
        source.seek(n, io.SEEK_CUR)
        return
    while n > 0:
        got = len(source.read(min(_CHUNK, n)))
        if not got:
            raise EOFError("a record is cut off")
        n -= got


def read_records(
    file: io.BufferedReader, wanted: Callable[[dict[str, str]], bool], block: bool, keep: bool
) -> Iterator[tuple[dict[str, str], Payload | None]]:
    """Header and payload of the wanted records of a file, plain or of gzip members."""
    while True:
        place = file.tell()
        magic = file.read(2)
        file.seek(place)
        if not magic:
            return
        lengths, member, source = None, None, file
        if magic == b"\x1f\x8b":
            lengths = member_lengths(file)
            member = Member(file)
            source = io.BufferedReader(member, 1 << 14)
        while (found := read_header(source)) is not None:
            header, size = found
            length = left = int(header.get("content-length", 0))
            if wanted(header):
                payload = None
                if block:
                    payload, left = read_payload(header, source, length, keep), 0
                yield header, payload
            if lengths and lengths[1] == size + length + 4:  # the member holds this record alone
                file.seek(place + lengths[0])
                break
            _skip(source, left)
        else:
            if member is None:
                return
            member.finish()


# --- predicates ---------------------------------------------------------------------------------------------------------

_COMPARE: dict[type, Callable] = {
    ds.EqualTo: lambda v, x: v == x,
    ds.GreaterThan: lambda v, x: v > x,
    ds.GreaterThanOrEqual: lambda v, x: v >= x,
    ds.LessThan: lambda v, x: v < x,
    ds.LessThanOrEqual: lambda v, x: v <= x,
    ds.In: lambda v, x: True if v in x else None if None in x else False,
    ds.StringStartsWith: lambda v, x: v.startswith(x),
    ds.StringEndsWith: lambda v, x: v.endswith(x),
    ds.StringContains: lambda v, x: x in v,
}


def holds(predicate: ds.Filter, value: Callable[[str], object]) -> bool | None:
    """A pushed predicate over header values, with SQL's three values."""
    if isinstance(predicate, ds.Not):
        inner = holds(predicate.child, value)
        return None if inner is None else not inner
    v = value(predicate.attribute[0])
    if isinstance(predicate, ds.IsNull):
        return v is None
    if isinstance(predicate, ds.IsNotNull):
        return v is not None
    if isinstance(predicate, ds.EqualNullSafe):
        return v == predicate.value
    if v is None or getattr(predicate, "value", 0) is None:
        return None
    return _COMPARE[type(predicate)](v, predicate.value)


def _attribute(predicate: ds.Filter) -> tuple[str, ...] | None:
    """Column of a predicate that ``holds`` can decide, else None."""
    if isinstance(predicate, ds.Not):
        return _attribute(predicate.child)
    if type(predicate) in _COMPARE or isinstance(predicate, (ds.IsNull, ds.IsNotNull, ds.EqualNullSafe)):
        return predicate.attribute
    return None


# --- the data source ----------------------------------------------------------------------------------------------------


@dataclass
class Files(ds.InputPartition):
    paths: list[str]


class WarcReader(ds.DataSourceReader):
    def __init__(self, schema: StructType, path: str, partition_bytes: int):
        self.schema, self.path, self.partition_bytes = schema, path, partition_bytes
        self.fields = {f.name: (header_of(f.name).lower(), isinstance(f.dataType, LongType)) for f in schema.fields}
        self.predicates: list[ds.Filter] = []

    def pushFilters(self, filters):
        for predicate in filters:
            name = _attribute(predicate)
            if name and len(name) == 1 and name[0] in self.fields and name[0] not in (*OF_BLOCK, "headers"):
                self.predicates.append(predicate)
            else:
                yield predicate

    def partitions(self):
        # one empty partition where there is no file: Spark would call read(None) otherwise
        return [Files(p) for p in packed(listed(self.path, SUFFIXES), self.partition_bytes)] or [Files([])]

    def value(self, header: dict[str, str], column: str):
        name, number = self.fields[column]
        text = header.get(name)
        if text is None or not number:
            return text
        return int(text) if re.fullmatch(r"[+-]?\d{1,18}", text) else None

    def read(self, partition: Files):
        shape = to_arrow_schema(self.schema)
        names = self.schema.names
        block, keep = any(n in names for n in OF_BLOCK), "payload" in names

        def wanted(header):
            return all(holds(p, lambda c: self.value(header, c)) is True for p in self.predicates)

        def cell(name, header, payload):
            if name == "headers" and isinstance(self.schema[name].dataType, MapType):
                return list(header.items())
            if name in OF_BLOCK:
                return getattr(payload, {"payload": "data", "payload_bytes": "size", "payload_sha1": "sha1"}[name])
            return self.value(header, name)

        rows, held = [], 0
        for path in partition.paths:
            with located(self.path)[0].open_input_file(path) as opened:
                for header, payload in read_records(io.BufferedReader(opened, _CHUNK), wanted, block, keep):
                    rows.append([cell(n, header, payload) for n in names])
                    held += payload.size if keep else 0
                    if len(rows) >= _BATCH_ROWS or held >= _BATCH_BYTES:
                        yield _batch(rows, shape)
                        rows, held = [], 0
        if rows:
            yield _batch(rows, shape)


def _batch(rows: list[list], shape: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), shape.types)], schema=shape)


class WarcWriter(FileSetWriter):
    suffix = ".warc.gz"

    def __init__(self, path: str, overwrite: bool, schema: StructType, date: str, level: int):
        super().__init__(path, overwrite)
        self.names, self.date, self.level = schema.names, date, level
        if not {"record_type", "payload"} <= set(self.names):
            raise ValueError("a WARC record needs the columns record_type and payload")

    def encoded(self, batch) -> tuple[bytes, int]:
        rows = batch.to_pylist()
        return b"".join(gzip_member(record_bytes(row, self.date), self.level) for row in rows), len(rows)


def _header_value(value) -> str:
    """A header line's value: control characters and outer blanks as percent escapes."""
    return re.sub(r"[\x00-\x1f\x7f]|^ +| +$", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), str(value))


def record_bytes(row: dict, date: str) -> bytes:
    """A record: headers, an HTTP header, and the payload unless it is a revisit; a null payload is empty."""
    payload = row["payload"] or b""
    payload = payload.encode() if isinstance(payload, str) else payload
    revisit = row["record_type"] == "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = {
        "WARC-Type": row["record_type"],
        "WARC-Date": date,
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode(),
        "Content-Type": "application/http; msgtype=response",
    }
    if revisit:
        head["WARC-Profile"] = REVISIT_PROFILE
    head |= {header_of(k): v for k, v in row.items() if k != "payload" and v is not None}
    head["Content-Length"] = len(block)
    lines = "".join(f"{k}: {_header_value(v)}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode("utf-8", "replace") + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int) -> bytes:
    """``data`` as one gzip member that states its lengths."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 24 + len(body) + 8
    head = struct.pack("<4sIBB", b"\x1f\x8b\x08\x04", 0, 0, 255) + struct.pack("<H2sHII", 12, b"sl", 8, size, len(data))
    return head + body + struct.pack("<II", zlib.crc32(data), len(data))


class WarcDataSource(ds.DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")``.

    Options: ``path``; reading, ``partitionBytes`` (64 MB of files to a task); writing, ``date`` (the same for all
    records; the time of planning by default) and ``level`` of compression (1).
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self):
        return DEFAULT_SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options["path"], int(self.options.get("partitionBytes", 64 << 20)))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        date = self.options.get("date") or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        return WarcWriter(self.options["path"], overwrite, schema, date, int(self.options.get("level", 1)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, schema: str | StructType = DEFAULT_SCHEMA) -> DataFrame:
    register(spark)
    return spark.read.format("warc").schema(schema).load(path)


# --- pages as archives --------------------------------------------------------------------------------------------------


def _urn(of: Column) -> Column:
    h = F.md5(of)
    parts = [F.substring(h, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def page_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """A record a row of (page_id, url, html).

    Of the pages with equal payloads of at least ``least_bytes`` bytes, that with the smallest page_id is a
    response and the others revisit it; every other page is a response.  A null html is empty; pages with a null
    id revisit one with an id; rows that repeat the smallest id, or that all have none, are responses each.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("target_uri"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("_hash", F.unhex(F.sha2("payload", 256)))
    large = F.octet_length("payload") >= least_bytes
    # a payload below the bound has a key of its own, so that it meets no other
    alone = F.concat(F.col("_hash"), F.coalesce(F.col("page_id").cast("string"), F.lit("")).cast("binary"))
    marked = with_least(rows.withColumn("_same", F.when(large, F.col("_hash")).otherwise(alone)), "_same", "page_id", "_least")
    revisits = F.coalesce(F.col("_least") < F.col("page_id"), F.col("_least").isNotNull() & F.col("page_id").isNull())

    def urn(page_id: str) -> Column:
        return _urn(F.concat_ws(":", F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.hex("_hash")))

    return marked.select(
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        urn("page_id").alias("record_id"),
        "target_uri",
        F.when(revisits, urn("_least")).alias("refers_to"),
        "page_id",
        "payload",
    )


def write_pages(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """The pages as WARC files, copies as revisits; see ``page_records``."""
    register(pages.sparkSession)
    page_records(pages, least_bytes).write.format("warc").mode("append").save(path)


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row a page record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Size and digest are taken of the payload as read; those of a revisit, whose block is not read, are the ones
    of the response that it names.  Without records there are no rows.
    """
    seen = "record_type string, record_id string, page_id long, payload_bytes long, payload_sha1 string"
    responses = written(read_warc(spark, path, seen).where("record_type = 'response'"))
    named = responses.groupBy(F.col("record_id").alias("refers_to")).agg(
        F.min("page_id").alias("_page"), F.min("payload_bytes").alias("payload_bytes"), F.min("payload_sha1").alias("payload_sha1")
    )
    revisits = read_warc(spark, path, "record_type string, page_id long, refers_to string").where("record_type = 'revisit'")
    both = responses.withColumn("_page", F.lit(None).cast("long")).unionByName(
        revisits.join(named, "refers_to", "left"), allowMissingColumns=True
    )
    return both.select(
        "page_id", "payload_bytes", F.col("payload_sha1").alias("payload_digest"), "record_type", F.col("_page").alias("refers_to")
    )
