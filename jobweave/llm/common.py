"""Helpers shared by the operators: byte-wise words, rolling hashes, blocks of documents."""

from __future__ import annotations

import gc
import time
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Odd multiplier of the polynomial hash, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2**64 for i < n, kept between calls."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        _POWERS[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Final mixing of 64-bit hashes."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each slice of ``data`` (uint8), equal for equal bytes anywhere."""
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(_INVERSE, n + 1)[starts])


def lut(pairs) -> np.ndarray:
    """Table over the 256 byte values that is true inside the given inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in pairs:
        table[low : high + 1] = True
    return table


#: Letters, digits and everything beyond ASCII, after A-Z became a-z.
WORD = lut([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
#: Everything but blank and 09-0D.
INK = ~lut([(0x20, 0x20), (0x09, 0x0D)])
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def joined_bytes(texts: list[str | None], separator: bytes = b"\n") -> tuple[bytes, np.ndarray]:
    """Lower-cased (A-Z) UTF-8 of all texts, each closed by the separator, and where each begins."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) + len(separator) for p in parts], out=offsets[1:])
    return (separator.join([*parts, b""])).translate(LOWER), offsets


def word_spans(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of bytes for which ``inside`` holds."""
    flags = np.zeros(len(data) + 2, dtype=np.int8)
    flags[1:-1] = inside[data]
    steps = np.diff(flags)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def words_of(texts: list[str | None], inside: np.ndarray):
    """All words of all texts: bytes, starts, ends, hashes, and the first word of each text (n+1)."""
    raw, offsets = joined_bytes(texts)
    data = np.frombuffer(raw, dtype=np.uint8)
    starts, ends = word_spans(data, inside)
    return raw, starts, ends, slice_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes (positions 0 .. len - n)."""
    m = max(0, len(hashes) - n + 1)
    out = np.zeros(m, dtype=np.uint64)
    for i in range(n):
        out = mixed(out * np.uint64(_BASE) + hashes[i : i + m])
    return out


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of a text column over all rows; one light pass that steers block counts."""
    return int(df.agg(F.sum(F.octet_length(column))).first()[0] or 0)


def written(df: DataFrame) -> DataFrame:
    """The frame written as a compressed table in the shared checkpoint folder and read again.

    Cuts lineage as ``checkpoint()`` does, which writes rows uncompressed.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Keys with more than this share of the rows (one in so many) are hot, so there are at most so many of them;
#: the rows of each are dealt to this many places.
HOT, PLACES = 512, 128


def with_groups(rows: DataFrame, key: str, groups: DataFrame, apart: str, count: int) -> DataFrame:
    """``rows`` left-joined with ``groups``, one row of which stands for each ``key`` and has its rows' number, ``_n``.

    A key may hold a third of all ``count`` rows.  The rows of hot keys are dealt to PLACES by ``apart``, and their
    groups, at most HOT, are repeated for each.  ``groups`` should be a written table.
    """
    names = [c for c in groups.columns if c not in (key, "_n")]
    hot = F.col("_n") * HOT > F.lit(count)
    hottest = [r[0] for r in groups.where(hot).select(key).collect()]
    spread = F.lit(0)
    if hottest:
        spread = F.when(F.col(key).isin(hottest), F.pmod(F.xxhash64(apart), F.lit(PLACES)).cast("int")).otherwise(0)
    places = F.when(hot, F.sequence(F.lit(0), F.lit(PLACES - 1))).otherwise(F.array(F.lit(0)))
    of = groups.select(F.col(key).alias("_key"), *names, F.explode(places).alias("_place"))
    joined = rows.withColumn("_dealt", spread).join(of, (F.col(key) == F.col("_key")) & (F.col("_dealt") == F.col("_place")), "left")
    return joined.select(*rows.columns, *names)


def with_least(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``rows`` and, as ``name``, the least ``value`` among the rows of the same ``key``; null for single rows."""
    groups = rows.groupBy(key).agg(F.min(value).alias(name), F.count("*").alias("_n")).where("_n > 1")
    return with_groups(rows, key, written(groups), value, rows.count())


def release(spark: SparkSession) -> None:
    """Let Spark drop shuffle files whose frames are gone already.

    Twice: frames that the first pass sets free on either side of the gateway go in the second.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
