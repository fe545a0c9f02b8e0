"""JSON arrays read in byte ranges: one large file is many tasks' work.

A range cannot tell by itself whether it begins inside a string or how deep it is nested.  A first light pass
counts quotes and brackets of every range for both cases; running sums over a file's ranges then give each its
state.  In the second pass a range reads the records that begin in it, the last one beyond its end if need be.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .filesets import located
from .readers import _BROKEN, BLOCK, FILE, POSITION, _drop_broken

#: Bytes of a range, and of a piece that is read on after its end.
RANGE, PIECE = 32 << 20, 1 << 16
_ESCAPED = re.compile(rb"\\.", re.DOTALL)
_MARK = re.compile(rb'\\.|["{}\[\],]', re.DOTALL)
_BLANK = " \t\r\n"


def ranges(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    """``path, start, end`` of every range of the files; only their names and lengths are read."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    start = F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(range_bytes).cast("bigint")))
    rows = files.select("path", "length", start.alias("start"))
    return rows.select("path", "start", F.least(F.col("start") + range_bytes, F.col("length")).alias("end"))


def _spread(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(tasks, "path", "start")


def escapes_before(file, start: int) -> bool:
    """Whether the byte at ``start`` is escaped: an odd number of backslashes stands before it."""
    count = 0
    while count < start:
        file.seek(max(0, start - count - PIECE))
        piece = file.read(start - count - file.tell())
        run = len(piece) - len(piece.rstrip(b"\\"))
        count += run
        if run < len(piece):
            break
    return count % 2 == 1


def summary(data: bytes) -> tuple[int, int, int]:
    """Parity of quotes, and change of depth for a range that begins outside and inside a string."""
    parts = _ESCAPED.sub(b"", data).split(b'"')
    changes = []
    for k in (0, 1):
        text = b"".join(parts[k::2])
        changes.append(text.count(b"{") + text.count(b"[") - text.count(b"}") - text.count(b"]"))
    return (len(parts) - 1) % 2, *changes


def states(parts: DataFrame) -> DataFrame:
    """``path, start, end, inside, depth``: every range with the state at its start."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                fs, name = located(row["path"])
                with fs.open_input_file(name) as file:
                    skip = escapes_before(file, row["start"])
                    file.seek(row["start"])
                    rows.append((*row.values(), *summary(file.read(row["end"] - row["start"])[skip:])))
            if rows:
                names = ["path", "start", "end", "quotes", "outside", "within"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    scanned = _spread(parts).mapInArrow(scan, "path string, start long, end long, quotes long, outside long, within long")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # the scan costs a pass over the files, so its few rows are kept
    known = scanned.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    change = F.when(F.col("inside"), F.col("within")).otherwise(F.col("outside"))
    placed = known.withColumn("_change", change)
    return placed.select("path", "start", "end", "inside", F.coalesce(F.sum("_change").over(before), F.lit(0)).alias("depth"))


def first_record(data: bytes, inside: bool, depth: int, skip: bool) -> int | None:
    """Where the first record that begins in a range may begin: after an opening bracket or a comma between records."""
    at = int(skip)
    while (found := _MARK.search(data, at)) is not None:
        mark, at = found[0], found.end()
        if mark == b'"':
            inside = not inside
        elif inside or mark[:1] == b"\\":
            continue
        elif mark in b"{[":
            depth += 1
            if depth == 1 and mark == b"[":
                return at
        elif mark in b"}]":
            depth -= 1
        elif depth == 1:
            return at
    return None


def is_array(file) -> bool:
    """Whether the first byte of a file, beside a byte-order mark and blanks, opens an array."""
    file.seek(0)
    while piece := file.read(PIECE):
        if bare := piece.lstrip(codecs.BOM_UTF8 + _BLANK.encode()):
            return bare[:1] == b"["
    return False


def records(file, start: int, end: int, inside: bool, depth: int) -> Iterator[tuple[int, str | None]]:
    """(place, text) of the records that begin in a range; a text of None says that the file is broken."""
    if not is_array(file):  # one record of its own, or nothing
        file.seek(0)
        if start == 0 and (whole := file.read().decode("utf-8-sig", "replace").strip()):
            yield 0, whole
        return
    skip = escapes_before(file, start)
    file.seek(start)
    data = file.read(end - start)
    at = first_record(data, inside, depth, skip)
    if at is None:
        return
    decoder, parser = codecs.getincrementaldecoder("utf-8")("replace"), json.JSONDecoder()
    text, ended = decoder.decode(data[at:]), False
    own = len(text)  # a record belongs to the range of the bracket or comma before it
    place, after_comma = 0, data[at - 1 : at] == b","
    while True:
        while place < len(text) and text[place] in _BLANK:
            place += 1
        if text[place : place + 1] == "]":
            if after_comma:
                yield start + at + place, None
            return
        try:
            _, stop = parser.raw_decode(text, place)
            while stop < len(text) and text[stop] in _BLANK:
                stop += 1
        except json.JSONDecodeError:
            stop = len(text)
        if stop >= len(text) and not ended:
            more = file.read(max(PIECE, len(text)))
            ended = not more
            text += decoder.decode(more, final=ended)
            continue
        if stop >= len(text) or text[stop] not in ",]":
            yield start + at + place, None
            return
        yield start + at + place, text[place:stop].rstrip()
        if text[stop] == "]" or stop >= own:
            return
        place, after_comma = stop + 1, True


def array_records(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    """File, start of the range, place and ``value``, the text, of every record of the files' arrays.

    A file with a broken record has none; one that holds a single object is one record.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, name = located(row["path"])
                with fs.open_input_file(name) as file:
                    rows, held = [], 0
                    for place, text in records(file, row["start"], row["end"], row["inside"], row["depth"]):
                        rows.append((row["path"], row["start"], place, text))
                        held += len(text or "")
                        if held > 8 << 20:
                            yield _table(rows)
                            rows, held = [], 0
                    if rows:
                        yield _table(rows)

    def _table(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[FILE, BLOCK, POSITION, "value"])

    shape = f"{FILE} string, {BLOCK} long, {POSITION} long, value string"
    found = _spread(states(ranges(spark, path, range_bytes))).mapInArrow(read, shape)
    broken = found.where("value IS NULL").select(FILE).distinct()
    return found.join(broken, FILE, "left_anti")


def load_array(
    spark: SparkSession, path: str, schema: T.StructType, placed: bool = False, range_bytes: int = RANGE
) -> DataFrame:
    """Records of JSON array files, each file read by as many tasks as it has ranges."""
    full = T.StructType(schema.fields + [T.StructField(_BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    parsed = array_records(spark, path, range_bytes).withColumn("record", F.from_json("value", full, options))
    place = [FILE, BLOCK, POSITION] if placed else []
    return _drop_broken(parsed.select("record.*", *place), schema)
