"""Document fingerprints: content-defined chunks and the set of their digests.

A gear hash runs over the bytes; a chunk ends where its top bits are zero, with more bits asked for
before the normal size than after it.  A boundary depends on the 32 bytes before it alone, so an edit
changes the chunks around it and no others.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_bytes

LEAST, NORMAL, MOST = 32, 64, 256
HARD_BITS, EASY_BITS = 7, 5
GEAR = np.random.default_rng(2024).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)
#: Bytes of text in one stretch of the order by id.
STRETCH_BYTES = 8 << 20
#: Up to this number stretches grow with the input, beyond it with its root: 100 TB make 220,000 of 450 MB.
STRETCHES = 4096

RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
RESULT_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes that end at each position, by doubling the window five times."""
    h = GEAR[data]
    for k in (1, 2, 4, 8, 16):
        moved = h[:-k] << np.uint32(k)
        h[k:] += moved
    return h


def boundaries(texts: list[bytes]) -> list[list[int]]:
    """Chunk ends of each text, as positions within it."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    h = gear_hash(data)
    easy = np.flatnonzero((h >> np.uint32(32 - EASY_BITS)) == 0)
    hard = easy[(h[easy] >> np.uint32(32 - HARD_BITS)) == 0]
    easy, hard = (easy + 1).tolist(), (hard + 1).tolist()
    out, base, n_easy, n_hard = [], 0, len(easy), len(hard)
    for text in texts:
        end, at, cuts = base + len(text), base, []
        while end - at > LEAST:
            normal = min(at + NORMAL, end)
            k = bisect_left(hard, at + LEAST)
            if k < n_hard and hard[k] < normal:
                at = hard[k]
            else:
                last = min(at + MOST, end)
                k = bisect_left(easy, normal)
                at = easy[k] if k < n_easy and easy[k] < last else last
            cuts.append(at - base)
        if at < end:
            cuts.append(end - base)
        out.append(cuts)
        base = end
    return out


def digest_sets(texts: list[bytes]) -> list[dict[str, int]]:
    """Digest and length of every distinct chunk of each text."""
    digest = xxhash.xxh3_64_hexdigest
    out = []
    for text, cuts in zip(texts, boundaries(texts), strict=True):
        at, found = 0, {}
        for cut in cuts:
            found[digest(text[at:cut])] = cut - at
            at = cut
        out.append(found)
    return out


def fingerprint(chunks: dict[str, int]) -> str:
    return ",".join([f"{k}:{chunks[k]}" for k in sorted(chunks)])


def likeness(a: dict[str, int], b: dict[str, int]) -> float:
    """Shared bytes over the bytes of the smaller set: 1 where one holds the other, or both are empty."""
    if not a or not b:
        return float(not a and not b)
    if len(a) > len(b):
        a, b = b, a
    shared = sum(size for k, size in a.items() if k in b)
    return shared / min(sum(a.values()), sum(b.values()))


def edited_text(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _encoded(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def fingerprinted(rows: Iterator[tuple], at_once: int = 256) -> Iterator[list[tuple]]:
    """Result rows of (stretch, guest, doc_id, text) rows in order.

    A guest is the first row of the following stretch: it is the next text of the last row and has no
    result here.
    """
    import hashlib

    held: list[tuple] = []

    def run(rows: list[tuple]) -> list[tuple]:
        pairs = [(a, b) for a, b in zip(rows[:-1], rows[1:], strict=True) if not a[1]]
        if not pairs:
            return []
        own = [_encoded(a[3]) for a, _ in pairs]
        following = [_encoded(b[3]) for _, b in pairs]
        changed = [_encoded(edited_text(a[3], b[3])) for a, b in pairs]
        # the next text of a row is most often the text of the row after it
        distinct = list(dict.fromkeys([*own, *following]))
        sets = dict(zip(distinct, digest_sets(distinct), strict=True))
        out = []
        for (a, _), x, y, z, edited in zip(pairs, own, following, changed, digest_sets(changed), strict=True):
            out.append(
                (
                    a[2],
                    len(a[3]),
                    hashlib.sha256(z).hexdigest(),
                    fingerprint(sets[x]),
                    fingerprint(edited),
                    likeness(sets[x], edited),
                    likeness(sets[x], sets[y]),
                )
            )
        return out

    for stretch, guest, doc_id, text in rows:
        if guest and held and held[-1][1] and held[-1][0] == stretch:
            continue  # one guest is enough
        held.append((stretch, guest, doc_id, text or ""))
        if len(held) > at_once:
            yield run(held)
            held = held[-1:]
    yield run(held)


def stretch_number(key: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are less than ``key``, by binary search in a constant array."""
    if not cuts:
        return F.lit(0)
    # text that is folded into one array literal; a literal per cut would make a plan of as many nodes
    array = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]

    def further(at: Column, step: Column) -> Column:
        less = F.get(array, at + step - 1) < key  # null beyond the end
        return F.when(less, at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), further)


def fingerprints(docs: DataFrame, stretch_bytes: int = STRETCH_BYTES) -> DataFrame:
    """Fingerprint of every text and of its edited text, and how alike they are.

    The order is by doc_id, nulls first, rows of one id by text; each row is a document, repeated rows
    too.  A null text is empty; an empty text has the empty fingerprint, and two empty ones are alike
    (1).  A single row is its own next document.  Extra columns are not read.

    Ids are cut into stretches at quantiles; the first row of a stretch also visits the stretch before
    it, so the texts are shuffled once and a task streams over them.
    """
    spark = docs.sparkSession
    wanted = text_bytes(docs) // stretch_bytes
    stretches = max(1, min(wanted, isqrt(wanted * STRETCHES)))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shares = [i / stretches for i in range(1, stretches)]
    accuracy = max(100_000, 10 * stretches)
    cuts = sorted(set(source.agg(F.percentile_approx("doc_id", shares, accuracy)).first()[0] or [])) if shares else []
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    placed = source.withColumn("key", key).withColumn("stretch", stretch_number(key, cuts))
    # one row per stretch
    firsts = sorted((r[0], r[1]) for r in placed.groupBy("stretch").agg(F.min("key")).collect())
    if not firsts:
        firsts = [(0, 0)]
    visits = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    guests = spark.createDataFrame(visits, "key long, visits int")
    rows = (
        placed.join(F.broadcast(guests), "key", "left")
        .withColumn(
            "places",
            F.when(
                F.col("visits").isNotNull(),
                F.array(
                    F.struct(F.col("stretch").alias("stretch"), F.lit(0).alias("guest")),
                    F.struct(F.col("visits").alias("stretch"), F.lit(1).alias("guest")),
                ),
            ).otherwise(F.array(F.struct(F.col("stretch").alias("stretch"), F.lit(0).alias("guest")))),
        )
        .select(F.explode("places").alias("place"), "doc_id", "text")
        .select("place.stretch", "place.guest", "doc_id", "text")
        .repartition(len(firsts), "stretch")
        .sortWithinPartitions("stretch", "guest", "doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for out in fingerprinted(stream):
            if out:
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, RESULT, strict=True)], schema=RESULT
                )

    return rows.mapInArrow(run, RESULT_DDL)
