"""Importance resampling towards a target by hashed word runs, with a head-tail vocabulary.

A feature is a run of consecutive words, its bucket the CRC-32 of its bytes modulo the number of buckets.  The
head of the vocabulary, frequent words with their CRC states and frequent longer runs with their buckets, is
counted over the documents and sent to every task; it has a fixed number of entries of bounded length.  Features
of the tail take their CRC directly, a longer run from the state of its first word where that is in the head.
The head only spares work: every feature of every text is counted, and bucket totals are exact.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import renumber
from .common import LOWER, written

_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Bounds of the head: entries a run length, bytes of one entry.
HEAD_ENTRIES, HEAD_BYTES = 16384, 64
#: What a task reports of its own counts, and how many entries it holds while it counts.
_REPORTED, _HELD = 2048, 1 << 18


@dataclass(frozen=True)
class Settings:
    most_words: int = 1
    buckets: int = 10_000
    seed: int = 2024
    least_words: int = 20
    percent: int = 10


class States(dict):
    """CRC-32 of words: the head's are kept, any other is taken directly."""

    def __missing__(self, word: bytes) -> int:
        return zlib.crc32(word)


class Buckets(dict):
    """Bucket of a run of words (a tuple): the head's are kept, any other continues from its first word's state."""

    def __init__(self, known: dict, states: States, buckets: int):
        super().__init__(known)
        self.states, self.buckets = states, buckets

    def __missing__(self, run: tuple[bytes, ...]) -> int:
        return zlib.crc32(b"".join(b" " + w for w in run[1:]), self.states[run[0]]) % self.buckets


def words_of(text: str | None) -> list[bytes]:
    return _WORDS.findall((text or "").encode("utf-8", "surrogatepass").translate(LOWER))


def runs_of(words: list[bytes], n: int) -> Iterator:
    """All runs of n consecutive words; single words as themselves."""
    return iter(words) if n == 1 else zip(*(words[i:] for i in range(n)))


class Head:
    """The frequent part of the vocabulary, as every task holds it."""

    def __init__(self, frequent: list[bytes], settings: Settings):
        states = States({w: zlib.crc32(w) for w in frequent if b" " not in w})
        runs = {tuple(w.split(b" ")): zlib.crc32(w) % settings.buckets for w in frequent if b" " in w}
        self.states, self.settings = states, settings
        self.singles = {w: c % settings.buckets for w, c in states.items()}
        self.runs = Buckets(runs, states, settings.buckets)

    def counted(self, features: Counter, n: int) -> Iterator[tuple[int, int]]:
        """(bucket, count) of distinct features."""
        if n == 1:
            states, buckets, singles = self.states, self.settings.buckets, self.singles
            for word, count in features.items():
                bucket = singles.get(word)
                yield (states[word] % buckets if bucket is None else bucket), count
        else:
            for run, count in features.items():
                yield self.runs[run], count


def _reported(batches, most_words: int):
    """The most frequent features of a task's rows.

    While it counts, a task holds a bounded number of entries: beyond it the median count is taken off all, as
    in Misra and Gries, which loses no feature with a larger share.
    """
    heads = [Counter() for _ in range(most_words)]
    for batch in batches:
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            for n, head in enumerate(heads, 1):
                head.update(runs_of(words, n))
                if len(head) > _HELD:
                    cut = int(np.median(np.fromiter(head.values(), dtype=np.int64, count=len(head))))
                    heads[n - 1] = Counter({k: v - cut for k, v in head.items() if v > cut})
    for n, head in enumerate(heads, 1):
        best = [(k if n == 1 else b" ".join(k), c) for k, c in head.most_common(_REPORTED)]
        best = [(k, c) for k, c in best if len(k) <= HEAD_BYTES]
        yield pa.RecordBatch.from_arrays(
            [pa.array([n] * len(best), pa.int32()), pa.array([k for k, _ in best], pa.binary()), pa.array([c for _, c in best], pa.int64())],
            names=["words", "feature", "n"],
        )


def fit_head(texts: DataFrame, settings: Settings = Settings()) -> Head:
    """The head of the vocabulary of a text column, from counts over all rows.

    At most HEAD_ENTRIES features of each run length and HEAD_BYTES bytes: what the driver holds and sends does not
    grow with the data.
    """
    most = settings.most_words
    rows = texts.select("text").mapInArrow(lambda b: _reported(b, most), "words int, feature binary, n long")
    totals = rows.groupBy("words", "feature").agg(F.sum("n").alias("n"))
    found = []
    for n in range(1, most + 1):
        best = totals.where(F.col("words") == n).orderBy(F.desc("n"), "feature").limit(HEAD_ENTRIES)
        found += [bytes(r["feature"]) for r in best.select("feature").collect()]
    return Head(found, settings)


def _totals(batches, head: Head):
    totals = np.zeros(head.settings.buckets, dtype=np.int64)
    for batch in batches:
        for n in range(1, head.settings.most_words + 1):
            features: Counter = Counter()
            for text in batch.column("text").to_pylist():
                features.update(runs_of(words_of(text), n))
            for bucket, count in head.counted(features, n):
                totals[bucket] += count
    hit = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(totals[hit], pa.int64())], names=["bucket", "n"])


def bucket_totals(texts: DataFrame, head: Head) -> np.ndarray:
    """Exact number of features in each bucket, over all rows; one row a bucket comes to the driver."""
    rows = texts.select("text").mapInArrow(lambda b: _totals(b, head), "bucket int, n long")
    totals = np.zeros(head.settings.buckets, dtype=np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        totals[r["bucket"]] = r["n"]
    return totals


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the log ratio of target to source share, one added to every bucket of each."""
    from math import floor, log

    n, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    pairs = zip(source.tolist(), target.tolist())
    return np.array([floor(1000 * log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n)))) for s, t in pairs], dtype=np.int64)


def _weighed(batches, head: Head, gains: np.ndarray):
    most, gain = head.settings.most_words, gains.tolist()
    # gains of head words are looked up by the word itself
    known = {w: gain[b] for w, b in head.singles.items()}
    buckets, states = head.settings.buckets, head.states
    for batch in batches:
        n_words, n_features, weights = [], [], []
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            features = weight = 0
            if words:
                for word in words:
                    g = known.get(word)
                    weight += gain[states[word] % buckets] if g is None else g
                features = len(words)
            for n in range(2, most + 1):
                found = [gain[head.runs[run]] for run in runs_of(words, n)]
                weight += sum(found)
                features += len(found)
            n_words.append(len(words))
            n_features.append(features)
            weights.append(weight)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()), pa.array(weights, pa.int64())],
            names=["doc_id", "n_words", "n_features", "weight"],
        )


def _noise(seed: int) -> Column:
    """Gumbel noise of a document in whole thousandths, from its id; a null id counts as empty text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every document's weight towards the target and, for those drawn, its rank.

    Columns: doc_id, n_features, weight, score, rank.  Of the documents with at least ``least_words`` words,
    ``percent`` hundredths (rounded down) with the highest scores are drawn; ties go to the smaller doc_id (a null
    one first), then to the smaller weight and number of features, and equal rows take consecutive ranks.  Null and
    empty texts have no features and weight 0.  An empty target or an empty table of documents changes nothing
    but the counts.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    head = fit_head(texts, settings)
    gains = bucket_gains(bucket_totals(texts, head), bucket_totals(target.select(F.col("text").cast("string").alias("text")), head))
    shape = "doc_id long, n_words long, n_features long, weight long"
    weighed = texts.mapInArrow(lambda b: _weighed(b, head, gains), shape)
    scored = written(weighed.withColumn("score", F.col("weight") + _noise(settings.seed)))
    able = F.col("n_words") >= settings.least_words
    drawn = settings.percent * scored.where(able).count() // 100
    ranked = renumber(scored.where(able), F.desc("score"), "doc_id", "weight", "n_features", name="rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    both = ranked.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))
    return both.select("doc_id", "n_features", "weight", "score", "rank")
