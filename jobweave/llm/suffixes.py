"""Suffix-array dedup: repeated passages by the common-prefix interval tree of a sparse suffix array.

Every stretch of ``LENGTH`` bytes holds an anchor: the run of ``ANCHOR`` bytes with the smallest hash in it.
So the suffixes around the anchors, as far as a stretch reaches to either side, find all repeats, and the
suffix array can be split by anchor.  Equal surroundings of an anchor are one entry of the array, kept by
their least document.  An anchor with several different surroundings gets its enhanced suffix array: the
sorted suffixes from every start before the anchor, their common-prefix lengths, and a stack scan that
yields the intervals; an interval whose occurrences are preceded by different bytes is a maximal repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import blocked, from_low_bytes, in_order, low_bytes, pack_ids, parts, pieces, unpack_ids
from .common import _BASE, _INVERSE, mixed, powers, release, text_bytes, written

LENGTH = 50
ANCHOR = 25
#: Starts of a stretch before its anchor, which is also the reach of the surroundings on either side.
REACH = LENGTH - ANCHOR
BLOCK_BYTES, BUCKET_BYTES = 8 << 20, 4 << 20
#: Different surroundings of one anchor that one task sorts; those of a more frequent anchor are split by
#: the stretches that hold it.
LARGEST = 50_000
#: Suffixes sorted in one task, about.
SHARD_ROWS = 25_000
LEAST_SHARDS = 48

DEAD, REPEATED, BRANCHING, HOT = 0, 1, 2, 3


def _window(values: np.ndarray, size: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every ``size`` neighbours, by doubling."""
    out, have = values, 1
    while have * 2 <= size:
        out = pick(out[:-have], out[have:])
        have *= 2
    return pick(out[: len(out) - (size - have)], out[size - have :]) if have < size else out


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Text number, position, anchor hash and hash of the surroundings of every anchor."""
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    n = len(data)
    none = np.zeros(0, dtype=np.int64)
    if n < LENGTH:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=sums[1:])
    inverse = powers(_INVERSE, n + 1)
    h = mixed((sums[ANCHOR:] - sums[:-ANCHOR]) * inverse[: n - ANCHOR + 1]) | np.uint64(1)
    least = _window(h, REACH + 1, np.minimum)
    # stretches that run over the end of a text choose nothing
    for end in offsets[1:-1]:
        least[max(0, end - LENGTH + 1) : end] = 0
    edge = np.zeros(REACH, dtype=np.uint64)
    least = np.concatenate([edge, least, edge])
    chosen = np.flatnonzero(_window(least, REACH + 1, np.maximum)[: len(h)] == h)
    owner = np.searchsorted(offsets, chosen, side="right") - 1
    left = np.maximum(chosen - REACH, offsets[owner])
    right = np.minimum(chosen + LENGTH, offsets[owner + 1])
    around = mixed((sums[right] - sums[left]) * inverse[left] + (chosen - left).astype(np.uint64))
    return owner, chosen - offsets[owner], h[chosen], around


class Block:
    """A block's anchors and its entries: the distinct (anchor, surroundings) by bucket."""

    def __init__(self, table: pa.Table, buckets: int):
        table = in_order(table)
        self.table = table
        self.ids = [i if i is not None else -(1 << 63) for i in table.column("doc_id").to_pylist()]
        strings = table.column("text").to_pylist()
        self.texts = [(t or "").encode("utf-8", "surrogatepass") for t in strings]
        found = []
        for begin, end in pieces(strings):
            owner, at, key, around = anchors(self.texts[begin:end])
            found.append((owner + begin, at, key, around))
        self.owner, self.at, key, around = (np.concatenate(c) for c in zip(*found, strict=True))
        # bucket and 40 bits of the anchor's hash, 48 bits of its surroundings'
        bucket = (key >> np.uint64(40)) % np.uint64(buckets)
        key = (bucket << np.uint64(40)) | (key & np.uint64((1 << 40) - 1))
        around &= np.uint64((1 << 48) - 1)
        self.doc = np.array(self.ids, dtype=np.int64)[self.owner]
        order = np.lexsort((self.at, self.doc, around, key))
        self.key, self.around = key[order], around[order]
        self.owner, self.at, self.doc = self.owner[order], self.at[order], self.doc[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (self.key[1:] != self.key[:-1]) | (self.around[1:] != self.around[:-1])
        self.first = np.flatnonzero(new)
        self.entry = np.cumsum(new) - 1
        self.bucket = (self.key[self.first] >> np.uint64(40)).astype(np.int64)

    def messages(self) -> Iterator[tuple[int, bytes]]:
        """A packed row for each bucket: anchors, surroundings, least document of each entry."""
        if not len(self.first):
            return
        key, around, doc = self.key[self.first], self.around[self.first], self.doc[self.first]
        cuts = np.flatnonzero(np.diff(self.bucket)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(key)], strict=True):
            body = low_bytes(key[a:b], 5) + low_bytes(around[a:b], 6) + pack_ids(doc[a:b])
            yield int(self.bucket[a]), int(b - a).to_bytes(4, "little") + body


def _unpacked(message: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int.from_bytes(message[:4], "little")
    keys, arounds = from_low_bytes(message[4 : 4 + 5 * n], 5), from_low_bytes(message[4 + 5 * n : 4 + 11 * n], 6)
    return keys, arounds, unpack_ids(message[4 + 11 * n :])


def judge(messages: list[bytes], largest: int = LARGEST) -> list[bytes]:
    """What each entry of each message is, as one byte.

    REPEATED: the same surroundings stand in a smaller document.  BRANCHING: the least of several different
    surroundings of an anchor; HOT: the same, where they are too many for one task.
    """
    unpacked = [_unpacked(m) for m in messages]
    key, around, doc = (np.concatenate(c) for c in zip(*unpacked, strict=True))
    order = np.lexsort((doc, around, key))
    key, around, doc = key[order], around[order], doc[order]
    new_key = np.ones(len(key), dtype=bool)
    new_key[1:] = key[1:] != key[:-1]
    new = new_key.copy()
    new[1:] |= around[1:] != around[:-1]
    group = np.cumsum(new) - 1
    least = doc[np.flatnonzero(new)][group]
    different = np.bincount((np.cumsum(new_key) - 1)[new])[np.cumsum(new_key) - 1]
    sorted_verdict = np.where(doc > least, REPEATED, np.where(~new | (different < 2), DEAD, np.where(different > largest, HOT, BRANCHING)))
    verdict = np.empty(len(key), dtype=np.uint8)
    verdict[order] = sorted_verdict
    ends = np.cumsum([len(u[0]) for u in unpacked])
    return [verdict[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _united(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """Per owner the union of its spans (touching spans are one), as packed starts and ends."""
    if not len(owner):
        return
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    cuts = np.flatnonzero(np.diff(owner)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(owner)], strict=True):
        reached = np.maximum.accumulate(end[a:b])
        new = np.flatnonzero(np.concatenate([[True], start[a + 1 : b] > reached[:-1]]))
        last = np.concatenate([new[1:] - 1, [b - a - 1]])
        yield int(owner[a]), start[a:b][new].astype("<i8").tobytes(), reached[last].astype("<i8").tobytes()


FOUND = pa.schema(
    [
        ("block", pa.int64()),
        ("row", pa.int64()),
        ("kind", pa.int32()),
        ("doc_id", pa.int64()),
        ("key", pa.int64()),
        ("at", pa.int64()),
        ("before", pa.int64()),
        ("starts", pa.binary()),
        ("ends", pa.binary()),
    ]
)
FOUND_DDL = "block long, row long, kind int, doc_id long, key long, at long, before long, starts binary, ends binary"
SPANS_DDL = "block long, row long, starts binary, ends binary"


def block_findings(block: Block, verdicts: dict[int, bytes], number: int) -> Iterator[tuple]:
    """Rows of kind 0 (spans known to be repeated) and of kind BRANCHING or HOT (surroundings to sort)."""
    verdict = np.frombuffer(b"".join(verdicts[b] for b in sorted(verdicts)), dtype=np.uint8)[block.entry]
    least = block.doc[block.first][block.entry]
    sizes = np.array([len(t) for t in block.texts], dtype=np.int64)
    known = (verdict == REPEATED) | (block.doc > least)
    start = np.maximum(block.at[known] - REACH, 0)
    end = np.minimum(block.at[known] + LENGTH, sizes[block.owner[known]])
    long_enough = end - start >= LENGTH
    for row, starts, ends in _united(block.owner[known][long_enough], start[long_enough], end[long_enough]):
        yield number, row, 0, None, None, None, None, starts, ends
    for i in np.flatnonzero((verdict >= BRANCHING) & ~known):
        row, at = int(block.owner[i]), int(block.at[i])
        before = min(at, REACH)
        around = block.texts[row][at - before : at + LENGTH]
        yield number, row, int(verdict[i]), int(block.doc[i]), int(block.key[i]), at, before, around, None


class Intervals:
    """Enhanced suffix arrays of the surroundings of many anchors, for one start before the anchor at a time."""

    def __init__(self, key: np.ndarray, before: np.ndarray, arounds: list[bytes]):
        n = len(arounds)
        self.bytes = np.zeros((n, REACH + LENGTH), dtype=np.uint8)
        for k, (text, left) in enumerate(zip(arounds, before, strict=True)):
            self.bytes[k, REACH - left : REACH - left + len(text)] = np.frombuffer(text, dtype=np.uint8)
        self.begin = REACH - before
        self.end = self.begin + np.array([len(t) for t in arounds], dtype=np.int64)
        self.group = np.unique(key, return_inverse=True)[1].astype(np.int64)

    def arrays(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(start, suffix array, common prefix with the suffix before) for each start of a stretch."""
        tails = np.ascontiguousarray(self.bytes[:, LENGTH:]).view(f"V{REACH}").ravel()
        rank = np.unique(tails, return_inverse=True)[1].astype(np.int64)
        # from the anchor backwards: a suffix is ordered by its first byte and the rank of the rest
        for start in range(REACH, -1, -1):
            if start < REACH:
                keyed = (self.bytes[:, start].astype(np.int64) << 40) | rank
                rank = np.unique(keyed, return_inverse=True)[1].astype(np.int64)
            held = np.flatnonzero((self.begin <= start) & (self.end - start >= LENGTH))
            if len(held) < 2:
                continue
            order = held[np.lexsort((rank[held], self.group[held]))]
            a, b = order[:-1], order[1:]
            differ = self.bytes[a, start:] != self.bytes[b, start:]
            common = np.where(differ.any(axis=1), differ.argmax(axis=1), differ.shape[1])
            common = np.minimum(common, np.minimum(self.end[a], self.end[b]) - start)
            common[self.group[a] != self.group[b]] = 0
            yield start, order, common

    def before(self, start: int, members: np.ndarray) -> np.ndarray:
        """The byte in front of each suffix; -1 where the text, or the reach, begins."""
        if start == 0:
            return np.full(len(members), -1)
        return np.where(self.begin[members] < start, self.bytes[members, start - 1].astype(np.int64), -1)

    def maximal(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(start, length, members) of every maximal repeat of at least LENGTH bytes.

        The scan keeps a stack of open intervals (length, left end); an interval is closed, and put out with
        all its occurrences, when a shorter common prefix follows.  Where all occurrences are preceded by one
        same byte the repeat is longer to the left and is found from there.
        """
        for start, order, common in self.arrays():
            left = self.before(start, order)
            # differs[i]: how many of the first i neighbours in the array have different bytes before them
            differs = np.concatenate([[0], np.cumsum((left[1:] != left[:-1]) | (left[1:] < 0))])
            open_at = np.flatnonzero(common >= LENGTH)
            stack: list[tuple[int, int]] = []
            last = -2
            for i in [*open_at.tolist(), len(common)]:
                if i != last + 1 or i == len(common):  # shorter than LENGTH in between: all intervals end
                    for interval in reversed(stack):
                        yield from self._closed(start, order, differs, interval, last + 1)
                    stack = []
                last = i
                if i == len(common):
                    break
                height, low = int(common[i]), i
                while stack and stack[-1][0] > height:
                    low = stack[-1][1]
                    yield from self._closed(start, order, differs, stack.pop(), i)
                if not stack or stack[-1][0] < height:
                    stack.append((height, low))

    @staticmethod
    def _closed(start, order, differs, interval, right) -> Iterator[tuple[int, int, np.ndarray]]:
        height, low = interval
        if differs[right] > differs[low]:
            yield start, height, order[low : right + 1]


def repeated_stretches(table: pa.Table) -> Iterator[tuple]:
    """Spans of rows of kind BRANCHING that also stand in a smaller document, by their maximal repeats."""
    before = table.column("before").to_numpy()
    tree = Intervals(table.column("key").to_numpy(), before, table.column("starts").to_pylist())
    doc, at = table.column("doc_id").to_numpy(), table.column("at").to_numpy()
    block, row = table.column("block").to_numpy(), table.column("row").to_numpy()
    members, starts, ends = [], [], []
    for start, length, occurrences in tree.maximal():
        later = occurrences[doc[occurrences] > doc[occurrences].min()]
        members.append(later)
        starts.append(at[later] - REACH + start)
        ends.append(at[later] - REACH + start + length)
    if not members:
        return
    member, start, end = np.concatenate(members), np.concatenate(starts), np.concatenate(ends)
    places = np.unique(np.stack([block, row], axis=1), axis=0, return_inverse=True)
    for owner, packed_starts, packed_ends in _united(places[1].ravel()[member], start, end):
        yield int(places[0][owner][0]), int(places[0][owner][1]), packed_starts, packed_ends


def _table(rows, schema: pa.Schema) -> pa.Table:
    rows = list(rows)
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


SPANS = pa.schema([("block", pa.int64()), ("row", pa.int64()), ("starts", pa.binary()), ("ends", pa.binary())])


def hot_spans(found: DataFrame) -> DataFrame:
    """Spans of rows of kind HOT: each stretch that holds the anchor meets its equals by hash.

    The least document of a stretch is a partial aggregate, so no task gets all surroundings.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .common import slice_hashes

        for batch in batches:
            out = {k: [] for k in ("block", "row", "doc_id", "key", "stretch", "start")}
            for block, row, doc, key, at, before, around in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                starts = np.arange(0, len(around) - LENGTH + 1)
                stretch = slice_hashes(np.frombuffer(around, dtype=np.uint8), starts, starts + LENGTH)
                out["stretch"] += stretch.view(np.int64).tolist()
                out["start"] += (at - before + starts).tolist()
                for name, value in (("block", block), ("row", row), ("doc_id", doc), ("key", key)):
                    out[name] += [value] * len(starts)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in out.items()})

    rows = (
        found.where(F.col("kind") == HOT)
        .select("block", "row", "doc_id", "key", "at", "before", "starts")
        .mapInArrow(run, "block long, row long, doc_id long, key long, stretch long, start long")
    )
    least = rows.groupBy("key", "stretch").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    hit = rows.join(least.drop("most"), ["key", "stretch"]).where("doc_id > least").select("block", "row", "start")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = batch.column(2).to_numpy(zero_copy_only=False)
            pack = lambda v: pa.array([x.tobytes() for x in v.astype("<i8")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pack(starts), pack(starts + LENGTH)], schema=SPANS)

    return hit.mapInArrow(packed, SPANS_DDL)


def repeated_spans(docs: DataFrame, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES, largest: int = LARGEST):
    """(blocked documents, spans): block, row within it, and the packed starts and ends to remove."""
    spark = docs.sparkSession
    size = text_bytes(docs)
    blocks, buckets = parts(size, block_bytes), parts(size, bucket_bytes)
    source = blocked(docs, blocks)

    def send(key, table):
        block = Block(table, buckets)
        rows = [(bucket, key[0].as_py(), message) for bucket, message in block.messages()]
        return _table(rows, pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("message", pa.binary())]))

    def answer(key, table):
        verdicts = judge(table.column("message").to_pylist(), largest)
        return pa.table({"bucket": table.column("bucket"), "block": table.column("block"), "verdict": pa.array(verdicts, pa.binary())})

    messages = source.groupBy("block").applyInArrow(send, "bucket long, block long, message binary")
    verdicts = written(messages.groupBy("bucket").applyInArrow(answer, "bucket long, block long, verdict binary"))
    del messages
    release(spark)

    def find(key, table, answers):
        if not table.num_rows:
            return _table([], FOUND)
        block = Block(table, buckets)
        of = dict(zip(answers.column("bucket").to_pylist(), answers.column("verdict").to_pylist(), strict=True))
        return _table(block_findings(block, of, key[0].as_py()), FOUND)

    found = written(source.groupBy("block").cogroup(verdicts.groupBy("block")).applyInArrow(find, FOUND_DDL))
    release(spark)
    branching = found.where(F.col("kind") == BRANCHING)
    shards = max(LEAST_SHARDS, -(-branching.count() // SHARD_ROWS))

    def sort(table):
        return _table(repeated_stretches(table), SPANS)

    tree = (
        branching.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))).groupBy("shard").applyInArrow(sort, SPANS_DDL)
    )
    known = found.where("kind = 0").select("block", "row", "starts", "ends")
    spans = written(known.unionByName(tree).unionByName(hot_spans(found)))
    del tree, branching
    release(spark)
    return source, spans


REMOVED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
    ]
)
REMOVED_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def spans_by_row(spans: pa.Table) -> dict[int, list[tuple[int, int]]]:
    owner, start, end = [], [], []
    for row, starts, ends in zip(*(spans.column(c).to_pylist() for c in ("row", "starts", "ends")), strict=True):
        start.append(np.frombuffer(starts, "<i8"))
        end.append(np.frombuffer(ends, "<i8"))
        owner.append(np.full(len(start[-1]), row))
    if not owner:
        return {}
    united = _united(np.concatenate(owner), np.concatenate(start), np.concatenate(end))
    return {r: list(zip(np.frombuffer(s, "<i8").tolist(), np.frombuffer(e, "<i8").tolist(), strict=True)) for r, s, e in united}


def remaining(text: bytes, spans: list[tuple[int, int]]) -> list[bytes]:
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    kept.append(text[at:])
    return kept


def remove_repeats(docs: DataFrame, **sizes) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    A byte goes if a stretch of LENGTH bytes over it also starts in a document with a smaller id.  A null
    text is empty.  Rows of one id are one document, which removes nothing from itself; a null id is the
    smallest.  Texts shorter than LENGTH lose nothing.  Extra columns are not read.
    """
    source, spans = repeated_spans(docs, **sizes)

    def apply(key, table, found):
        table, by_row, rows = in_order(table), spans_by_row(found), []
        for k, (doc_id, text) in enumerate(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), strict=True)):
            raw, cut = (text or "").encode("utf-8", "surrogatepass"), by_row.get(k, [])
            gone = sum(b - a for a, b in cut)
            rows.append((doc_id, len(raw), gone, len(cut), hashlib.sha256(b"".join(remaining(raw, cut))).hexdigest()))
        return _table(rows, REMOVED)

    return source.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(apply, REMOVED_DDL)


def without_repeats(docs: DataFrame, **sizes) -> DataFrame:
    """The rows of ``docs`` with their repeated bytes taken out of ``text``.

    A span is narrowed to whole characters, so what is left is valid UTF-8.  Null texts stay null; other
    columns are passed on as they are.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    blocks = parts(text_bytes(docs), sizes.get("block_bytes", BLOCK_BYTES))
    _, spans = repeated_spans(docs, **sizes)
    # the other columns travel under names of their own, so none clashes
    carried = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"other_{i}") for i, c in enumerate(others)])
    source = blocked(carried, blocks, *[f"other_{i}" for i in range(len(others))])

    def apply(key, table, found):
        table, by_row = in_order(table), spans_by_row(found)
        texts = table.column("text").to_pylist()
        for k, cut in by_row.items():
            raw = texts[k].encode("utf-8", "surrogatepass")
            texts[k] = b"".join(remaining(raw, [_whole(raw, *s) for s in cut])).decode("utf-8", "surrogatepass")
        kept = table.drop_columns(["block"])
        return kept.set_column(kept.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))

    schema = source.drop("block").schema
    cleaned = source.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(apply, schema)
    named = {f"other_{i}": c for i, c in enumerate(others)}
    return cleaned.select(
        *[
            F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id") if c == "doc_id"
            else F.col("text") if c == "text"
            else F.col(next(k for k, v in named.items() if v == c)).alias(c)
            for c in docs.columns
        ]
    )


def _whole(raw: bytes, start: int, end: int) -> tuple[int, int]:
    while start < end and raw[start] & 0xC0 == 0x80:
        start += 1
    while end > start and end < len(raw) and raw[end] & 0xC0 == 0x80:
        end -= 1
    return start, end
