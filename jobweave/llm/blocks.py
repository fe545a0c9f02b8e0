"""Blocks of documents that exchange packed messages with buckets of hashes.

Some operators must look up a hash for nearly every word or byte of a text.  Instead of one row for each,
a block of documents (by hash of the id) sends one packed row to each bucket of hashes, and gets one back.
Within a block equal hashes are merged first, so a hash that stands in a third of all texts reaches its
bucket once per block.  Blocks and buckets have a fixed expected size; their numbers follow the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least number of blocks and buckets, so that small inputs run in parallel too.
LEAST = 48


def parts(total_bytes: int, size: int) -> int:
    return max(LEAST, -(-total_bytes // size))


def blocked(docs: DataFrame, blocks: int, *extra: str) -> DataFrame:
    """block, doc_id, text and further columns; a document's block depends on its id alone."""
    doc_id: Column = F.col("doc_id").cast("long")
    return docs.select(
        F.pmod(F.xxhash64(doc_id, F.lit("block")), F.lit(blocks)).alias("block"),
        doc_id.alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *extra,
    )


def in_order(table: pa.Table) -> pa.Table:
    """Rows of a block in the same order whenever the block is read: by id, then text."""
    if not table.num_rows:
        return table
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def pieces(texts: list[str | None], size: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` characters, to bound the arrays made at once."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "") + 1
        if held >= size:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def low_bytes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of 64-bit numbers."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def from_low_bytes(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, width)
    return out.view(np.uint64).ravel()


def pack_ids(ids: np.ndarray) -> bytes:
    """Signed 64-bit ids in as few bytes as the largest needs; the width stands in front."""
    width = 8
    if len(ids) and ids.min() >= 0:
        width = max(1, -(-int(ids.max()).bit_length() // 8))
    return bytes([width]) + low_bytes(ids.astype(np.int64), width)


def unpack_ids(raw: bytes) -> np.ndarray:
    return from_low_bytes(raw[1:], raw[0]).view(np.int64)


def pack_counts(counts: np.ndarray) -> bytes:
    """One byte for each count below 255; the others follow as 64-bit numbers."""
    big = counts[counts >= 255].astype("<u8").tobytes()
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + big


def unpack_counts(raw: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(raw[:n], dtype=np.uint8).astype(np.int64)
    out[out == 255] = np.frombuffer(raw[n:], dtype="<u8").astype(np.int64)
    return out
