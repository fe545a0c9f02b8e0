"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Learning takes a bounded, documented sample of labelled rows; scoring takes every row.  L1 sparsity
leaves a few thousand weights, which go to the tasks with the scoring function.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, fold_of, gram_hashes, mixed, words_of

#: Labelled rows that are learned from: those with the smallest hash of their id.
SAMPLE_ROWS = 16_000
#: Bits of a feature's number.
FEATURE_BITS = 22
THRESHOLD = 0.7
ALPHA, BETA, L1, L2 = 4.0, 1.0, 3.0, 0.02
EPOCHS = 4

SCORED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]
)


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of every word, pair of neighbours, and pair with one word between."""
    _, _, _, hashes, first = words_of(texts, WORD)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    shift = np.uint64(64 - FEATURE_BITS)
    n = len(hashes)
    texts_of, found = [owner], [hashes]
    if n > 1:
        same = owner[:-1] == owner[1:]
        texts_of.append(owner[:-1][same])
        found.append(gram_hashes(hashes, 2)[same])
    if n > 2:
        same = owner[:-2] == owner[2:]
        texts_of.append(owner[:-2][same])
        found.append(mixed(hashes[:-2] * np.uint64(0x9FB21C651E98DF25) + hashes[2:])[same])
    return np.concatenate(texts_of), (np.concatenate(found) >> shift).astype(np.int64)


def distinct_features(texts: list[str | None], keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, feature) pairs in order of text; ``keep`` flags the features of interest."""
    owner, feature = features(texts)
    if keep is not None:
        wanted = keep[feature]
        owner, feature = owner[wanted], feature[wanted]
    pairs = np.unique((owner << FEATURE_BITS) | feature)
    return pairs >> FEATURE_BITS, pairs & ((1 << FEATURE_BITS) - 1)


class FollowTheLeader:
    """Per-coordinate FTRL-proximal; a weight is zero until its gradients exceed the L1 bound."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.bias_z, self.bias_n = 0.0, 0.0

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * L1 - z
        return np.where(np.abs(z) <= L1, 0.0, shrunk / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def bias(self) -> float:
        return -self.bias_z / ((BETA + np.sqrt(self.bias_n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, label: float) -> None:
        w, b = self.weights(at), self.bias()
        g = sigmoid(w.sum() + b) - label
        grown = np.sqrt(self.n[at] + g * g)
        self.z[at] += g - (grown - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] += g * g
        self.bias_z += g - (np.sqrt(self.bias_n + g * g) - np.sqrt(self.bias_n)) / ALPHA * b
        self.bias_n += g * g


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def train(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Features with a weight, their weights, and the bias; rows are read in seeded random order."""
    model = FollowTheLeader(1 << FEATURE_BITS)
    order = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            model.learn(rows[i], float(labels[i]))
    w = model.weights(slice(None))
    at = np.flatnonzero(w)
    return at, w[at], float(model.bias())


def known_labels(labels: DataFrame, column: str, folds: int, held_out: int) -> DataFrame:
    """One (doc_id, label) for each labelled id outside the held-out fold.

    Null ids and labels other than 0 and 1 are not learned from; of contradicting labels 1 counts.
    """
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .where(fold_of(F.col("doc_id"), folds) != held_out)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )


def labelled_sample(
    docs: DataFrame, labels: DataFrame, column: str, folds: int, held_out: int, rows: int, by_class: bool = False
) -> DataFrame:
    """(doc_id, text, label) of a bounded sample outside the held-out fold.

    The ids come from ``labels`` alone: those with the smallest hash, at most ``rows`` (of each class
    where ``by_class``), so the join's small side is bounded.
    """
    known = known_labels(labels, column, folds, held_out)
    picked = [known] if not by_class else [known.where(F.col("label") == k) for k in (0, 1)]
    sample = None
    for part in picked:
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        sample = part if sample is None else sample.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most 12 bytes for each of ``rows`` rows; of rows that share an id the smallest text is taken
    return texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, rows: int = SAMPLE_ROWS):
    """Learned (features, weights, bias): features are made where the rows are, learned in one task.

    The one task holds the features of at most ``rows`` texts.
    """

    def to_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                texts = part.column(1).to_pylist()
                owner, feature = distinct_features(texts)
                ends = np.searchsorted(owner, np.arange(len(texts) + 1))
                packed = [feature[a:b].astype("<u4").tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(packed, pa.binary()), part.column(2)], names=["doc_id", "features", "label"]
                )

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "label"], kind="stable")
        found = [np.frombuffer(f, "<u4") for f in pdf["features"]]
        at, weights, bias = train(found, pdf["label"].to_numpy())
        return pd.DataFrame({"feature": np.append(at, -1), "weight": np.append(weights, bias)})

    sample = labelled_sample(docs, labels, "toxic", folds, held_out, rows)
    made = sample.select("doc_id", "text", "label").mapInArrow(to_features, "doc_id long, features binary, label int")
    learned = made.groupBy(F.lit(0).alias("one")).applyInPandas(learn, "feature long, weight double").toPandas()
    plain = learned["feature"] >= 0
    bias = float(learned.loc[~plain, "weight"].sum())
    return learned.loc[plain, "feature"].to_numpy(np.int64), learned.loc[plain, "weight"].to_numpy(), bias


def score_texts(texts: list[str | None], dense: np.ndarray, bias: float) -> np.ndarray:
    owner, feature = distinct_features(texts, dense != 0)
    return sigmoid(np.bincount(owner, weights=dense[feature], minlength=len(texts)) + bias)


def score_toxicity(docs: DataFrame, model, folds: int = 3, held_out: int = 1, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    A null, empty or wordless text has the score of the bias alone.  With no labelled rows every score
    is 0.5.  Repeated rows are scored alike; extra columns are not read.
    """
    at, weights, bias = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << FEATURE_BITS)
        dense[at] = weights
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                score = score_texts(part.column(2).to_pylist(), dense, bias)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(score),
                        pa.array((score >= threshold).astype(np.int32)),
                    ],
                    schema=SCORED,
                )

    ids = F.col("doc_id").cast("long")
    source = docs.select(
        ids.alias("doc_id"),
        (fold_of(ids, folds) == held_out).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return source.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold, with all their columns, in one pass."""
    at, weights, bias = model
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << FEATURE_BITS)
        dense[at] = weights
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                yield part.filter(pa.array(score_texts(part.column(place).to_pylist(), dense, bias) < threshold))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, learned from the labels outside the held-out fold.

    Null, empty and wordless texts get the score of the bias alone.  Without labels, or without documents that
    have one, every score is 0.5; without documents there are no rows.  Rows that repeat an id are scored each
    by their own text.  Extra columns of either table are not read.
    """
    return score_toxicity(docs, fit(docs, labels))
