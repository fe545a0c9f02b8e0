"""Bulk files for a search index: an action line and a document line for each row.

Documents carry ids, so loading a file again replaces them instead of adding to them; which files count is
settled by the job's commit (see ``filesets``).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from .filesets import FileSetWriter, listed, located, packed

SUFFIX = ".ndjson"


class BulkWriter(FileSetWriter):
    suffix = SUFFIX

    def __init__(self, path: str, overwrite: bool, index: str):
        super().__init__(path, overwrite)
        self.index = index

    def encoded(self, batch) -> tuple[bytes, int]:
        lines = []
        for row in batch.to_pylist():
            lines += [json.dumps({"index": {"_index": self.index, "_id": row["id"]}}, ensure_ascii=False), row["value"]]
        return "".join(f"{line}\n" for line in lines).encode("utf-8", "surrogatepass"), batch.num_rows


@dataclass
class Files(ds.InputPartition):
    paths: list[str]


class BulkReader(ds.DataSourceReader):
    def __init__(self, path: str, partition_bytes: int):
        self.path, self.partition_bytes = path, partition_bytes

    def partitions(self):
        return [Files(p) for p in packed(listed(self.path, (SUFFIX,)), self.partition_bytes)] or [Files([])]

    def read(self, partition: Files):
        for path in partition.paths:
            with located(self.path)[0].open_input_stream(path) as opened:
                rows, action = [], None
                for line in _lines(opened):
                    if action is None:
                        action = json.loads(line)["index"]
                        continue
                    rows.append((action["_index"], action["_id"], line))
                    action = None
                    if len(rows) == 4096:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)


def _lines(opened):
    rest = b""
    while piece := opened.read(1 << 20):
        *whole, rest = (rest + piece).split(b"\n")
        for line in whole:
            yield line.decode("utf-8", "surrogatepass")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["index", "id", "value"])


class BulkDataSource(ds.DataSource):
    """``format("bulk_index")``: written from (id, value), read as (index, id, value); options path and index."""

    @classmethod
    def name(cls) -> str:
        return "bulk_index"

    def schema(self):
        return "index string, id string, value string"

    def reader(self, schema):
        return BulkReader(self.options["path"], int(self.options.get("partitionBytes", 64 << 20)))

    def writer(self, schema, overwrite: bool):
        return BulkWriter(self.options["path"], overwrite, self.options["index"])


def save_bulk(df: DataFrame, path: str, index: str, key: str) -> str:
    """Every row as a document whose id is column ``key``; replaces what was committed there before.

    A row without an id gets the hash of its document, so that it too is loaded once however often it is sent.
    """
    df.sparkSession.dataSource.register(BulkDataSource)
    document = F.to_json(F.struct("*"))
    named = F.coalesce(F.col(f"`{key}`").cast("string"), F.sha2(document, 256))
    rows = df.select(named.alias("id"), document.alias("value"))
    rows.write.format("bulk_index").option("index", index).mode("overwrite").save(path)
    return path


def read_bulk(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(BulkDataSource)
    return spark.read.format("bulk_index").load(path)
