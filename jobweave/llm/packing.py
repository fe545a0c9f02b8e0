"""Packing: first-fit decreasing over a tournament tree, in randomised groups of documents.

A document is tokenised once, where it is read.  Its full stretches of ``LENGTH`` ids fill sequences of
their own; pieces travel as a few numbers to one of many random groups of bounded expected size.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 2048
#: Expected documents in a group.  A group wastes part of one sequence, so this bounds the padding.
GROUP_DOCS = 16384
END_ID = 1
#: Pieces in each of the two generations of a worker's tokenizer cache; a matter of memory only.
CACHE = 400_000

# Unicode white space; ASCII signs without the apostrophe; letters of ASCII and Latin-1.
_SPACE = r"\t\n\x0b\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SIGNS = r"!-&(-/:-@\[-`{-~"
_LETTERS = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
#: The byte-level pre-tokenizer never joins a visible character with white space that follows it, nor a letter
#: with such a sign, so a text may be tokenised piece by piece, cut there.
_PIECES = re.compile(
    f"[{_SPACE}]*[{_LETTERS}]++(?![^{_SPACE}{_SIGNS}])"
    f"|(?<=[{_LETTERS}])[{_SIGNS}]++(?![^{_SPACE}])"
    f"|[{_SPACE}]*[^{_SPACE}]+"
    f"|[{_SPACE}]+"
)

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("row", pa.int64()),
    ]
)
PIECE_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, row long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary, by its rule."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def fast_encoding(path: str):
    """The byte-level BPE of a tokenizer file with its own merge loop in another library, or None.

    It needs a vocabulary whose ids follow the order of the merges, which then are the ranks.
    """
    import json

    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocabulary, letters = spec["model"]["vocab"], byte_letters()
    merges = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in spec["model"]["merges"]]
    if spec["normalizer"] or spec["pre_tokenizer"].get("add_prefix_space") or not all(
        vocabulary[m] == 256 + i for i, m in enumerate(merges)
    ):
        return None
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in special}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers, remembering pieces."""

    def __init__(self, path: str):
        self.fast = fast_encoding(path)
        if self.fast is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids(self, pieces: list[str]) -> list[list[int]]:
        if self.fast is None:
            return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        plain, marked, special = self.fast.encode_ordinary, self.fast.encode, self.fast.special_tokens_set
        return [marked(p, allowed_special="all") if any(t in p for t in special) else plain(p) for p in pieces]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        if len(self.known) > CACHE:
            self.known, self.older = {}, self.known
        split = [_PIECES.findall(t or "") for t in texts]
        known, older = self.known, self.older
        new = set(chain.from_iterable(split)).difference(known)
        known.update((p, older[p]) for p in new if p in older)
        unknown = list(new.difference(known))
        for piece, found in zip(unknown, self.ids(unknown), strict=True):
            known[piece] = struct.pack(f"<{len(found)}I", *found)
        for pieces in split:
            yield b"".join(map(known.__getitem__, pieces))


def tokenised(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``length`` ids of every document, numbered over all rows by ``row``."""
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        encoder = Encoder(tokenizer)
        for batch in batches:
            ids, texts, rows = (c.to_pylist() for c in batch.columns)
            out: list[tuple] = []
            for at in range(0, len(ids), 256):
                for k, encoded in enumerate(encoder.encode(texts[at : at + 256]), at):
                    encoded += end
                    n = len(encoded) // 4
                    for start in range(0, n, length):
                        piece = encoded[4 * start : 4 * (start + length)]
                        out.append((ids[k], start, len(piece) // 4, zlib.crc32(piece), n, rows[k]))
            if out:
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=PIECES)

    numbered = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    return numbered.mapInArrow(run, PIECE_DDL)


class Tournament:
    """Complete binary tree of free room; the leftmost bin with enough room wins."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.tree = [room] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Put a piece into the first bin that has room: (bin, room left before it)."""
        tree, node = self.tree, 1
        while node < self.leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        before = tree[node]
        tree[node] = before - size
        leaf = node - self.leaves
        while node > 1:
            node //= 2
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left > right else right
        return leaf, before


def first_fit_decreasing(sizes: np.ndarray, room: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size; the sizes are in decreasing order.

    Sizes that fill a bin take the first bins, one each; the tree holds the bins after them.
    """
    full = int(np.count_nonzero(sizes >= room))
    tree = Tournament(max(1, len(sizes) - full), room)
    placed = [tree.place(int(s)) for s in sizes[full:]]
    bins = np.concatenate([np.arange(full), np.array([full + p[0] for p in placed], dtype=np.int64)])
    return bins, np.array([0] * full + [room - p[1] for p in placed], dtype=np.int64)


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    length: int = LENGTH,
    end_id: int = END_ID,
    group_docs: int = GROUP_DOCS,
) -> DataFrame:
    """Sequences of at most ``length`` ids that hold every id of every document once.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.  A null or
    empty text is the closing id alone.  Repeated rows are packed once each.  Extra columns are not
    read.  An empty table gives no rows.  A sequence id holds group and number, so ids are unique but
    not dense.
    """
    groups = max(1, -(-docs.count() // group_docs))
    pieces = tokenised(docs, tokenizer or default_tokenizer(), length, end_id).withColumn(
        # by piece, so that the many full pieces of a very long document spread over the groups
        "bin_group",
        F.pmod(F.xxhash64("doc_id", "row", "start", F.lit("group")), F.lit(groups)),
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "row"], ascending=[False, True, True, True], kind="stable")
        bins, offsets = first_fit_decreasing(pdf["length"].to_numpy(), length)
        return pdf.assign(sequence_id=pdf["bin_group"].to_numpy() * (1 << 32) + bins, offset=offsets)[
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        ]

    return pieces.groupBy("bin_group").applyInPandas(
        run,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
