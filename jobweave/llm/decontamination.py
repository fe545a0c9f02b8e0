"""Benchmark decontamination: Wu-Manber search for many word windows at once.

The alphabet is words, as 64-bit hashes.  Windows of one length form a search set with a shift table
over blocks of two words: it says how far the end of a window may move on without missing an
occurrence.  All texts of a batch are searched side by side, one cursor per stretch of text, so a step
is one array operation; cursors that the table cannot move look up their bucket (the hash of the whole
window), and the bytes of the words are compared before an occurrence counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.filesets import located
from .common import _BASE, WORD, gram_hashes, mixed, word_spans, words_of, written

WINDOW = 10
#: Bits of a shift table: 2**18 bytes.
TABLE_BITS = 18
#: Words searched by one cursor.
STRETCH = 512
#: Bytes of item texts whose windows a task holds at once; about 300 bytes of tables for each window.
ROUND_BYTES = 2 << 20
#: An item is stored in pieces of at most this many words that share ``window - 1`` words with the next.
PIECE_WORDS = 4096
#: Bytes of document texts searched for one round of items after the other.
CHUNK_BYTES = 64 << 20

RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("n_items", pa.int64()),
        ("items_sha256", pa.string()),
        ("contaminated", pa.bool_()),
    ]
)
RESULT_DDL = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


@dataclass
class SearchSet:
    """Windows of one length: shift table, buckets by window hash, and what each window is."""

    length: int
    block: int
    shifts: np.ndarray
    keys: np.ndarray
    windows: list[list[tuple[bytes, set[int]]]]


def items_windows(items: list[tuple[int, str | None]], window: int = WINDOW) -> dict[int, dict[tuple, set[int]]]:
    """Windows of each length, as word tuples, with the items that have them."""
    by_length: dict[int, dict[tuple, set[int]]] = {}
    for item_id, text in items:
        raw, starts, ends, _, _ = words_of([text], WORD)
        words = [raw[a:b] for a, b in zip(starts, ends, strict=True)]
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            by_length.setdefault(n, {}).setdefault(tuple(words[i : i + n]), set()).add(item_id)
    return by_length


def search_sets(items: list[tuple[int, str | None]], window: int = WINDOW) -> list[SearchSet]:
    sets = []
    for length, found in sorted(items_windows(items, window).items()):
        block = min(2, length)
        shifts = np.full(1 << TABLE_BITS, length - block + 1, dtype=np.uint8)
        buckets: dict[int, list] = {}
        for words, ids in found.items():
            raw, _, _, hashes, _ = words_of([b" ".join(words).decode("utf-8", "surrogatepass")], WORD)
            blocks = gram_hashes(hashes, block) >> np.uint64(64 - TABLE_BITS)
            for i, b in enumerate(blocks):
                shifts[b] = min(shifts[b], length - block - i)
            buckets.setdefault(int(gram_hashes(hashes, length)[0]), []).append((raw[:-1], ids))
        keys = np.array(sorted(buckets), dtype=np.uint64)
        sets.append(SearchSet(length, block, shifts, keys, [buckets[int(k)] for k in keys]))
    return sets


def candidates(hashes: np.ndarray, first: np.ndarray, search: SearchSet) -> np.ndarray:
    """Word positions at which a window may begin: the shift table cannot move past them.

    ``first`` holds the first word of each text and the end.  A cursor stands on the last word of a
    window and owns the windows that end in its stretch.
    """
    length, block = search.length, search.block
    if len(hashes) < length:
        return np.zeros(0, dtype=np.int64)
    table = (gram_hashes(hashes, block) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    sizes = np.diff(first)
    texts = np.flatnonzero(sizes >= length)
    low, high = first[:-1][texts] + length - 1, first[1:][texts]
    parts = -(-(high - low) // STRETCH)
    owner = np.repeat(np.arange(len(texts)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    at = low[owner] + nth * STRETCH
    stop = np.minimum(at + STRETCH, high[owner])
    found = []
    while len(at):
        shift = search.shifts[table[at - block + 1]]
        found.append(at[shift == 0])
        at = at + np.maximum(shift, 1)
        keep = at < stop
        at, stop = at[keep], stop[keep]
    return np.concatenate(found) - (length - 1) if found else np.zeros(0, dtype=np.int64)


def occurrences(words, search: SearchSet) -> Iterator[tuple[int, set[int]]]:
    """(first word, items) of every confirmed occurrence of a window."""
    raw, starts, ends, hashes, first = words
    at = candidates(hashes, first, search)
    if not len(at) or not len(search.keys):
        return
    key = np.zeros(len(at), dtype=np.uint64)
    for i in range(search.length):  # as gram_hashes does, at the candidates alone
        key = mixed(key * np.uint64(_BASE) + hashes[at + i])
    slot = np.minimum(np.searchsorted(search.keys, key), len(search.keys) - 1)
    for k in np.flatnonzero(search.keys[slot] == key):
        begin = int(at[k])
        stretch = raw[starts[begin] : ends[begin + search.length - 1]]
        spans = word_spans(np.frombuffer(stretch, dtype=np.uint8), WORD)
        plain = b" ".join(stretch[a:b] for a, b in zip(*spans, strict=True))
        for text, ids in search.windows[slot[k]]:
            if text == plain:
                yield begin, ids


def hits(texts: list[str | None], sets: list[SearchSet]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[set[int]]]:
    """Word starts, hit flags of the words, the first word of each text, and the items of each text."""
    words = words_of(texts, WORD)
    first = words[4]
    flags = np.zeros(len(words[1]) + 1, dtype=np.int32)
    items: list[set[int]] = [set() for _ in texts]
    for search in sets:
        for begin, ids in occurrences(words, search):
            flags[begin] += 1
            flags[begin + search.length] -= 1
            items[int(np.searchsorted(first, begin, side="right")) - 1] |= ids
    return words[1], np.cumsum(flags[:-1]) > 0, first, items


def item_pieces(items: list[tuple[int, str | None]], window: int = WINDOW) -> Iterator[tuple[int, str]]:
    """The items cut so that every window lies whole in a piece and no piece has other windows than its item."""
    for item_id, text in items:
        raw, starts, ends, _, _ = words_of([text], WORD)
        for at in range(0, max(len(starts) - window + 1, min(len(starts), 1)), PIECE_WORDS):
            last = min(at + PIECE_WORDS + window - 1, len(starts)) - 1
            yield item_id, raw[starts[at] : ends[last]].decode("utf-8", "surrogatepass")


def stored_items(benchmark: DataFrame, window: int = WINDOW) -> list[str]:
    """Files in the shared checkpoint folder that hold the items in pieces; tasks read them by themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids, texts = (c.to_pylist() for c in batch.slice(at, 1).columns)
                cut = list(item_pieces(list(zip(ids, texts, strict=True)), window))
                columns = [pa.array([c[0] for c in cut], pa.int64()), pa.array([c[1] for c in cut], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["item_id", "text"])

    source = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return sorted(written(source.mapInArrow(run, "item_id long, text string")).inputFiles())


class StoredSets:
    """Search sets of stored items, a round of bounded size at a time; a single round is kept between passes."""

    def __init__(self, files: list[str], window: int = WINDOW):
        self.files, self.window = files, window
        self.single: list[SearchSet] | None = None

    def _rounds(self) -> Iterator[list[tuple[int, str]]]:
        held, size = [], 0
        for file in self.files:
            store, path = located(file)
            with store.open_input_file(path) as opened:
                for batch in pq.ParquetFile(opened).iter_batches(batch_size=16):
                    for item_id, text in zip(*(batch.column(c).to_pylist() for c in ("item_id", "text")), strict=True):
                        if held and size + len(text) > ROUND_BYTES:
                            yield held
                            held, size = [], 0
                        held.append((item_id, text))
                        size += len(text)
        yield held

    def __iter__(self) -> Iterator[list[SearchSet]]:
        if self.single is not None:
            yield self.single
            return
        count, sets = 0, []
        for items in self._rounds():
            count, sets = count + 1, search_sets(items, self.window)
            yield sets
        if count == 1:
            self.single = sets


def _chunks(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[list[pa.RecordBatch]]:
    """Slices of at most 1,024 rows, gathered up to ``CHUNK_BYTES`` of text."""
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            held.append(part)
            size += pc.sum(pc.binary_length(part.column(place))).as_py() or 0
            if size >= CHUNK_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def searched(batches: Iterator[pa.RecordBatch], place: int, stored: StoredSets):
    """(slice, hit flags of the words, first word of each text, items of each text) over all rounds of items."""
    for chunk in _chunks(batches, place):
        found: list = [None] * len(chunk)
        for sets in stored:
            for i, part in enumerate(chunk):
                _, flags, first, items = hits(part.column(place).to_pylist(), sets)
                if found[i] is None:
                    found[i] = [flags, first, items]
                else:
                    found[i][0] |= flags
                    for mine, more in zip(found[i][2], items, strict=True):
                        mine |= more
        for part, (flags, first, items) in zip(chunk, found, strict=True):
            yield part, flags, first, items


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Words of each document that lie in a window of a benchmark item, and those items.

    Windows never cross documents.  Null, empty or wordless texts have no words and no hits; wordless
    items have no window; items and documents that occur several times count as they stand (an item id
    once per document).  Extra columns are not read; empty tables on either side are fine.

    The documents are read once and stay where they are.  Items are written in pieces to the checkpoint
    folder; a task reads them in rounds of ``ROUND_BYTES`` and unites what the rounds find, so neither a
    task nor the driver ever holds a benchmark of any size.
    """
    files = stored_items(benchmark, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, flags, first, items in searched(batches, 1, StoredSets(files, window)):
            counts = np.concatenate([[0], np.cumsum(flags)])
            n_hit = counts[first[1:]] - counts[first[:-1]]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).cast(pa.int64()),
                    pa.array(np.diff(first)),
                    pa.array(n_hit.astype(np.int64)),
                    pa.array([len(f - {None}) for f in items], pa.int64()),
                    pa.array([_digest(f) for f in items]),
                    pa.array(n_hit > 0),
                ],
                schema=RESULT,
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, RESULT_DDL)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in whose text no window of a benchmark item occurs, with all their columns."""
    place = docs.columns.index("text")
    files = stored_items(benchmark, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, flags, first, _ in searched(batches, place, StoredSets(files, window)):
            counts = np.concatenate([[0], np.cumsum(flags)])
            yield part.filter(pa.array(counts[first[1:]] == counts[first[:-1]]))

    return docs.mapInArrow(run, docs.schema)


def _digest(ids) -> str:
    return hashlib.sha256(",".join(sorted(str(i) for i in ids if i is not None)).encode()).hexdigest()
