"""Language-model scoring: deleted interpolation of bigram, unigram and uniform estimates.

Counts are taken over all training documents.  The weights of the mixture depend on how often the context
was seen and are learned by expectation-maximisation on deleted counts: each training token is held out of
the counts that predict it.  Those tokens are summed up, per context frequency, in a table of probability
ratios whose size does not depend on the input, and that table is all the learning sees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import blocked, from_low_bytes, in_order, low_bytes, pack_counts, parts, pieces, unpack_counts
from .common import _BASE, INK, fold_of, mixed, release, text_bytes, words_of, written

#: The token that ends a text and is the context of the next text's first word.
END = np.uint64(0x1F3D5B79A2C4E680)
BLOCK_BYTES, BUCKET_BYTES = 10 << 20, 5 << 20
#: Context frequencies are told apart by powers of two, ratios of probabilities by a quarter of e.
FREQUENCIES, STEPS, BINS = 32, 4.0, 160
ROUNDS = 60


class Block:
    """Tokens of a block of documents, and its distinct tokens and pairs by bucket."""

    def __init__(self, table: pa.Table, buckets: int):
        table = in_order(table)
        texts = table.column("text").to_pylist()
        self.ids = table.column("doc_id").to_pylist()
        self.held_out = np.array(table.column("held_out").to_pylist(), dtype=bool)
        tokens, sizes = [], []
        for begin, end in pieces(texts):
            _, _, _, hashes, first = words_of(texts[begin:end], INK)
            tokens.append(np.insert(hashes, first[1:], END))
            sizes.append(np.diff(first) + 1)
        tokens, self.sizes = np.concatenate(tokens), np.concatenate(sizes)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.training = np.repeat(~self.held_out, self.sizes)
        before = np.concatenate([[END], tokens[:-1]])
        pairs = mixed(before * np.uint64(_BASE) + tokens)
        wide = np.uint64(buckets)
        self.words, self.word_of = self._distinct(tokens, (tokens >> np.uint64(20)) % wide)
        # a pair is known by its bucket and 40 bits
        bucket = (pairs >> np.uint64(40)) % wide
        self.pairs, self.pair_of = self._distinct((bucket << np.uint64(40)) | (pairs & np.uint64((1 << 40) - 1)), bucket)
        self.buckets = buckets

    def _distinct(self, keys: np.ndarray, bucket: np.ndarray):
        """(keys, buckets, training counts) by bucket, and the entry of each token."""
        found, inverse = np.unique(keys, return_inverse=True)
        where = np.zeros(len(found), dtype=np.int64)
        where[inverse] = bucket
        counts = np.bincount(inverse, weights=self.training, minlength=len(found)).astype(np.int64)
        order = np.argsort(where, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        return (found[order], where[order], counts[order]), place[inverse]

    def messages(self) -> Iterator[tuple[int, int, bytes]]:
        """(bucket, width, message): pairs in five bytes, words in eight, each with its training count."""
        for width, (keys, where, counts) in ((8, self.words), (5, self.pairs)):
            cuts = np.flatnonzero(np.diff(where)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                body = low_bytes(keys[a:b], width) + pack_counts(counts[a:b])
                yield int(where[a]), width, int(b - a).to_bytes(4, "little") + body

    def counts(self, replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of each token and of each pair that ends in it."""
        out = []
        for width, (_, where, _), of in ((8, self.words, self.word_of), (5, self.pairs, self.pair_of)):
            rows = replies.filter(pc.equal(replies.column("width"), width)).sort_by("bucket")
            found = np.bincount(where)
            sizes = found[found > 0]
            replied = [unpack_counts(r, n) for r, n in zip(rows.column("reply").to_pylist(), sizes, strict=True)]
            out.append(np.concatenate(replied)[of])
        return out[0], out[1]

    def contexts(self, word_counts: np.ndarray, ends: int) -> np.ndarray:
        return np.concatenate([[ends], word_counts[:-1]])


def summed(width: int, messages: list[bytes]) -> tuple[list[bytes], int, int]:
    """Reply to each message with the counts over all of them; tokens and distinct tokens seen."""
    keys, counts = [], []
    for m in messages:
        n = int.from_bytes(m[:4], "little")
        keys.append(from_low_bytes(m[4 : 4 + width * n], width))
        counts.append(unpack_counts(m[4 + width * n :], n))
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(inverse, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
    per_entry = totals[inverse]
    ends = np.cumsum([len(k) for k in keys])
    replies = [pack_counts(per_entry[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    return replies, int(totals.sum()), int(np.count_nonzero(totals))


def frequency(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(np.log2(context + 1.0)).astype(np.int64), FREQUENCIES - 1)


def estimates(pair, context, word, tokens: int, types: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Bigram and unigram maximum-likelihood estimates, and the uniform one."""
    two = np.where(context > 0, pair / np.maximum(context, 1), 0.0)
    return two, word / max(tokens, 1), 1.0 / (types + 1)


def _bin(ratio: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        logs = np.log(ratio)
    return np.where(ratio > 0, np.clip(np.round(np.where(ratio > 0, logs, 0) * STEPS) + 40, 1, BINS - 1), 0).astype(np.int64)


def deleted_table(pair, context, word, tokens: int, types: int) -> tuple[np.ndarray, ...]:
    """Held-out tokens by (context frequency, bigram / uniform, unigram / uniform): cell, number, sums."""
    # each token is taken out of all the counts that predict it
    pair, context, word = pair - 1, context - 1, word - 1
    two, one, zero = estimates(pair, context, word, tokens - 1, types)
    two, one = two / zero, one / zero
    cell = (frequency(context) * BINS + _bin(two)) * BINS + _bin(one)
    found, inverse = np.unique(cell, return_inverse=True)
    number = np.bincount(inverse)
    return found, number, np.bincount(inverse, weights=two), np.bincount(inverse, weights=one)


def learned_weights(rows: list[tuple[int, int, float, float]]) -> np.ndarray:
    """Mixture weights (bigram, unigram, uniform) of each context frequency, by EM on the deleted table."""
    weights = np.tile(np.array([0.0, 0.9, 0.1]), (FREQUENCIES, 1))
    if not rows:
        return weights
    cell, number, two, one = (np.array(c) for c in zip(*rows, strict=True))
    where = cell // (BINS * BINS)
    likely = np.stack([two / number, one / number, np.ones(len(cell))], axis=1)
    for f in range(FREQUENCIES):
        at = where == f
        if not at.any():
            weights[f] = weights[f - 1] if f else weights[f]
            continue
        w = np.full(3, 1 / 3)
        for _ in range(ROUNDS):
            share = likely[at] * w
            share /= share.sum(axis=1, keepdims=True)
            w = (share * number[at][:, None]).sum(axis=0) / number[at].sum()
        w = np.maximum(w, 1e-6 * np.array([0.0, 1.0, 1.0]))
        weights[f] = w / w.sum()
    return weights


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)
RESULT_DDL = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def scored(block: Block, replies: pa.Table, tokens: int, types: int, ends: int, weights: np.ndarray) -> pa.Table:
    word, pair = block.counts(replies)
    context = block.contexts(word, ends)
    two, one, zero = estimates(pair, context, word, tokens, types)
    w = weights[frequency(context)]
    score = np.log10(w[:, 0] * two + w[:, 1] * one + w[:, 2] * zero)
    base = np.log10((word + 0.5) / (tokens + 0.5 * (types + 1)))
    columns = [
        pa.array(block.ids, pa.int64()),
        pa.array(block.held_out),
        pa.array(block.sizes.astype(np.int64)),
        pa.array(np.add.reduceat((word > 0).astype(np.int64), block.first)),
        pa.array(np.full(len(block.ids), tokens, dtype=np.int64)),
        pa.array(np.add.reduceat(base, block.first)),
        pa.array(np.add.reduceat(score, block.first)),
    ]
    return pa.Table.from_arrays(columns, schema=RESULT)


def lm_scores(
    docs: DataFrame, folds: int = 5, held_out: int = 1, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    A null, empty or blank text is the end token alone.  Repeated rows count and are scored each.  With no
    training rows all counts are zero and the uniform estimate is left.  Extra columns are not read.
    """
    spark = docs.sparkSession
    size = text_bytes(docs)
    blocks, buckets = parts(size, block_bytes), parts(size, bucket_bytes)
    flagged = docs.select("doc_id", "text", (fold_of(F.col("doc_id").cast("long"), folds) == held_out).alias("held_out"))
    source = blocked(flagged, blocks, "held_out")
    ends = flagged.where(~F.col("held_out")).count()

    def send(key, table):
        rows = [(bucket, width, key[0].as_py(), m) for bucket, width, m in Block(table, buckets).messages()]
        columns = zip(*rows, strict=True)
        types = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
        names = ["bucket", "width", "block", "message"]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def answer(key, table):
        replies, tokens, types = summed(key[1].as_py(), table.column("message").to_pylist())
        rest = [0] * (len(replies) - 1)
        return pa.table(
            {
                "bucket": table.column("bucket"),
                "width": table.column("width"),
                "block": table.column("block"),
                "reply": pa.array(replies, pa.binary()),
                "tokens": pa.array([tokens, *rest], pa.int64()),
                "types": pa.array([types, *rest], pa.int64()),
            }
        )

    messages = source.groupBy("block").applyInArrow(send, "bucket long, width int, block long, message binary")
    replies = written(
        messages.groupBy("bucket", "width").applyInArrow(
            answer, "bucket long, width int, block long, reply binary, tokens long, types long"
        )
    )
    del messages
    release(spark)
    seen = replies.where("width = 8").agg(F.sum("tokens"), F.sum("types")).first()
    tokens, types = int(seen[0] or 0), int(seen[1] or 0)
    replies = replies.select("bucket", "width", "block", "reply")

    def delete(key, table, replied):
        names = ["cell", "number", "two", "one"]
        block = Block(table, buckets) if table.num_rows else None
        if block is None or not block.training.any():
            return pa.table({n: pa.array([], t) for n, t in zip(names, (pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)})
        word, pair = block.counts(replied)
        context, at = block.contexts(word, ends), block.training
        # the context of a training text's first word is some text's end; all others stand in the same text
        found = deleted_table(pair[at], context[at], word[at], tokens, types)
        return pa.table(dict(zip(names, (pa.array(c) for c in found), strict=True)))

    table = (
        source.groupBy("block")
        .cogroup(replies.groupBy("block"))
        .applyInArrow(delete, "cell long, number long, two double, one double")
        .groupBy("cell")
        .agg(F.sum("number"), F.sum("two"), F.sum("one"))
    )
    # at most FREQUENCIES * BINS * BINS rows, whatever the input
    weights = learned_weights([tuple(r) for r in table.collect()])
    release(spark)

    def score(key, table, replied):
        if not table.num_rows:
            return RESULT.empty_table()
        return scored(Block(table, buckets), replied, tokens, types, ends, weights)

    return source.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(score, RESULT_DDL)
