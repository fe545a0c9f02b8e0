"""Quality: a small byte-level convolutional network in numpy.

A text is cut into overlapping chunks that cover all of it.  Learned filters run over each chunk's
embedded bytes and are max-pooled; a text's features are the largest and the mean pooled value over its
chunks, and one logistic unit makes a probability of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of
from .toxicity import known_labels, labelled_sample, sigmoid

#: Labelled rows of each class that are learned from: those with the smallest hash of their id.
SAMPLE_ROWS = 2_500
CHUNK, STRIDE = 512, 496
DEPTH, WIDTH, FILTERS = 4, 6, 12
EPOCHS, BATCH, RATE = 6, 32, 0.01
#: Chunks put through the filters at once.
AT_ONCE = 64
THRESHOLD = 0.7

SCORED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]
)


def new_model(seed: int = 5) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    return {
        "embedding": draw.normal(0, 0.5, (256, DEPTH)).astype(np.float32),
        "filters": draw.normal(0, 0.3, (WIDTH * DEPTH, FILTERS)).astype(np.float32),
        "filter_bias": np.zeros(FILTERS, dtype=np.float32),
        "out": draw.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        "out_bias": np.zeros(1, dtype=np.float32),
    }


def chunked(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of all texts, as rows of bytes closed with zeros, and the first chunk of each text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    counts = 1 + np.maximum(0, -(-(sizes - CHUNK) // STRIDE))
    first = np.concatenate([[0], np.cumsum(counts)])
    rows = np.zeros((first[-1], CHUNK), dtype=np.uint8)
    for r, a, n in zip(raw, first[:-1], counts, strict=True):
        if n == 1:
            rows[a, : len(r)] = np.frombuffer(r, dtype=np.uint8)
            continue
        padded = np.zeros((n - 1) * STRIDE + CHUNK, dtype=np.uint8)
        padded[: len(r)] = np.frombuffer(r, dtype=np.uint8)
        rows[a : a + n] = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STRIDE]
    return rows, first


def pooled(rows: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Largest filter answer of each chunk and where it is."""
    steps = CHUNK - WIDTH + 1
    best = np.empty((len(rows), FILTERS), dtype=np.float32)
    where = np.empty((len(rows), FILTERS), dtype=np.int64)
    for a in range(0, len(rows), AT_ONCE):
        embedded = model["embedding"][rows[a : a + AT_ONCE]].reshape(-1, CHUNK * DEPTH)
        windows = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH * DEPTH, axis=1)[:, ::DEPTH]
        answers = (np.ascontiguousarray(windows).reshape(-1, WIDTH * DEPTH) @ model["filters"]).reshape(
            -1, steps, FILTERS
        )
        where[a : a + AT_ONCE] = answers.argmax(axis=1)
        best[a : a + AT_ONCE] = answers.max(axis=1)
    return np.maximum(best + model["filter_bias"], 0), where


def pooled_max(rows: np.ndarray, model: dict) -> np.ndarray:
    """As ``pooled``, for scoring: the largest answers alone."""
    best = np.empty((len(rows), FILTERS), dtype=np.float32)
    for a in range(0, len(rows), AT_ONCE):
        embedded = model["embedding"][rows[a : a + AT_ONCE]].reshape(-1, CHUNK * DEPTH)
        windows = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH * DEPTH, axis=1)[:, ::DEPTH]
        answers = np.ascontiguousarray(windows).reshape(-1, WIDTH * DEPTH) @ model["filters"]
        best[a : a + AT_ONCE] = answers.reshape(len(embedded), -1, FILTERS).max(axis=1)
    return np.maximum(best + model["filter_bias"], 0)


def text_features(chunks: np.ndarray, first: np.ndarray) -> np.ndarray:
    top = np.maximum.reduceat(chunks, first[:-1], axis=0)
    mean = np.add.reduceat(chunks, first[:-1], axis=0) / np.diff(first)[:, None]
    return np.concatenate([top, mean], axis=1)


def score_texts(texts: list[str | None], model: dict) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    rows, first = chunked(texts)
    logits = text_features(pooled_max(rows, model), first) @ model["out"] + model["out_bias"]
    return sigmoid(logits.astype(np.float64))


def gradients(rows: np.ndarray, first: np.ndarray, labels: np.ndarray, model: dict) -> dict[str, np.ndarray]:
    """Back-propagation; only the winning window of each filter and chunk carries a gradient."""
    best, where = pooled(rows, model)
    found = text_features(best, first)
    error = ((sigmoid(found @ model["out"] + model["out_bias"]) - labels) / len(labels)).astype(np.float32)
    back = error[:, None] * model["out"]
    owner = np.repeat(np.arange(len(labels)), np.diff(first))
    top = (best == found[owner, :FILTERS]) * back[owner, :FILTERS]
    to_chunk = (top + back[owner, FILTERS:] / np.diff(first)[owner][:, None]) * (best > 0)
    at = where[:, :, None] + np.arange(WIDTH)
    won = rows[np.arange(len(rows))[:, None, None], at]
    windows = model["embedding"][won].reshape(len(rows), FILTERS, WIDTH * DEPTH)
    to_bytes = to_chunk[:, :, None] * model["filters"].T[None]
    embedding = np.zeros_like(model["embedding"])
    np.add.at(embedding, won.ravel(), to_bytes.reshape(-1, DEPTH))
    return {
        "embedding": embedding,
        "filters": np.einsum("cf,cfw->wf", to_chunk, windows),
        "filter_bias": to_chunk.sum(axis=0),
        "out": found.T @ error,
        "out_bias": error.sum(keepdims=True),
    }


def train(texts: list[str | None], labels: np.ndarray, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Adam over seeded random batches of whole texts."""
    model = new_model()
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    order, step = np.random.default_rng(3), 0
    for _ in range(epochs):
        shuffled = order.permutation(len(texts))
        for a in range(0, len(shuffled), BATCH):
            picked = shuffled[a : a + BATCH]
            rows, first = chunked([texts[i] for i in picked])
            step += 1
            for k, g in gradients(rows, first, labels[picked], model).items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                model[k] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, rows: int = SAMPLE_ROWS) -> dict:
    """Learned network: one task learns from at most ``rows`` whole texts of each class.

    The sample holds the classes in other shares than the labels do; the last bias makes up for it.
    """

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "label"], kind="stable")
        model = train(pdf["text"].tolist(), pdf["label"].to_numpy(np.float32))
        seen = np.bincount(pdf["label"], minlength=2)[:2]
        model["seen"] = seen.astype(np.float32)
        return pd.DataFrame({"name": list(model), "numbers": [v.astype("<f4").tobytes() for v in model.values()]})

    sample = labelled_sample(docs, labels, "quality", folds, held_out, rows, by_class=True)
    learned = (
        sample.select("doc_id", "text", "label")
        .groupBy(F.lit(0).alias("one"))
        .applyInPandas(learn, "name string, numbers binary")
        .collect()
    )
    model = new_model()
    for row in learned:
        numbers = np.frombuffer(bytes(row["numbers"]), "<f4")
        model[row["name"]] = numbers.reshape(model[row["name"]].shape) if row["name"] in model else numbers
    shares = known_labels(labels, "quality", folds, held_out).groupBy("label").count().collect()
    count = {r["label"]: r["count"] for r in shares}
    seen = model.pop("seen", np.zeros(2))
    if len(count) == 2 and seen.min() > 0:
        model["out_bias"] = model["out_bias"] + np.log(count[1] / count[0]) - np.log(seen[1] / seen[0])
    return model


def score_quality(docs: DataFrame, model: dict, folds: int = 4, held_out: int = 2, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    A null or empty text is one chunk of zero bytes.  With no labelled rows the network stays as it was
    drawn.  Repeated rows are scored alike; extra columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                score = score_texts(part.column(2).to_pylist(), model)
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


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, learned from the labels outside the held-out fold.

    A null or empty text is scored as one chunk of zero bytes.  Without labels, or without documents that have
    one, the network scores as it was drawn; without documents there are no rows.  Rows that repeat an id are
    scored each by their own text.  Extra columns of either table are not read.
    """
    return score_quality(docs, fit(docs, labels))
