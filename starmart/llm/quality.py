"""Quality classifier: logistic regression on hashed word n-grams.

Features are single words and word pairs, each also by shape (runs of lower
case, upper case, digits or one sign shown once, and whether a word repeats the
one before), hashed to DIMENSIONS indexes, with counts scaled to length one.
Weights are learnt by follow-the-regularised-leader updates: each shard of a
bounded sample is trained by its own task and the shards' weights are averaged.
A score is a sparse dot product through the logistic function.
"""

from __future__ import annotations

import math
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import crc32_fold, filter_texts, hash_sample, map_slices, mix64, picked

DIMENSIONS = 1 << 18
#: Most labelled rows to learn from (about), and the tasks that share them.
TRAIN_ROWS, SHARDS = 16_000, 4
EPOCHS = 5
#: Learning rate, its smoothing, and the L1 and L2 penalties of the updates.
ALPHA, BETA, L1, L2 = 3.0, 1.0, 0.01, 0.001
REJECT_BELOW = 0.3

#: Classes of bytes: white space 0, lower case and all non-ASCII 97, upper case 65, digits 48, else itself.
_CLASSES = np.arange(256, dtype=np.uint8)
_CLASSES[[9, 10, 11, 12, 13, 32]] = 32
_CLASSES[97:123] = 97
_CLASSES[128:] = 97
_CLASSES[65:91] = 65
_CLASSES[48:58] = 48


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and values of a text; index 0 is the intercept, always 1."""
    data = text.encode()
    words = data.split()
    if not words:
        return np.zeros(1, np.int64), np.ones(1)
    kinds = _CLASSES[np.frombuffer(data, np.uint8)]
    keep = np.ones(len(kinds), bool)
    keep[1:] = kinds[1:] != kinds[:-1]
    shapes = kinds[keep].tobytes().split()
    n = len(words)
    w = np.fromiter(map(crc32, words), np.uint64, n)
    s = np.fromiter(map(crc32, shapes), np.uint64, n)
    s[1:] += (w[1:] == w[:-1]).astype(np.uint64) << np.uint64(33)
    k = np.uint64(0x9E3779B97F4A7C15)
    hashed = np.concatenate([w, w[:-1] * k + w[1:] + np.uint64(1 << 40), s + np.uint64(1 << 41), s[:-1] * k + s[1:] + np.uint64(1 << 42)])
    index, count = np.unique(mix64(hashed) % np.uint64(DIMENSIONS - 1), return_counts=True)
    value = count / math.sqrt(float(np.dot(count, count)))
    return np.concatenate([[0], index.astype(np.int64) + 1]), np.concatenate([[1.0], value])


def logistic(x: float) -> float:
    return 1.0 / (1.0 + math.exp(-x)) if x >= 0 else (e := math.exp(x)) / (1.0 + e)


class FollowTheLeader:
    """Per-coordinate FTRL-proximal updates of a logistic model."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)

    def weights(self, index: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def update(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(index)
        gradient = (logistic(float(np.dot(w, value))) - label) * value
        n = self.n[index]
        grown = n + gradient * gradient
        self.z[index] += gradient - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * w
        self.n[index] = grown


def fit(examples: DataFrame) -> np.ndarray:
    """Weights from rows (doc_id, text, label); zeros, a score of 0.5, without any.

    Every shard's rows go to one task (bounded by TRAIN_ROWS); the driver gets
    one vector of DIMENSIONS numbers for each shard.
    """

    def train(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("order")
        rows = [(*features(t), int(y)) for t, y in zip(shard["text"], shard["label"], strict=True)]
        model = FollowTheLeader()
        for _ in range(EPOCHS):
            for index, value, label in rows:
                model.update(index, value, label)
        return pd.DataFrame({"weights": [model.weights().astype(np.float32).tobytes()], "rows": [len(rows)]})

    dealt = examples.select(
        F.coalesce("text", F.lit("")).alias("text"),
        "label",
        F.xxhash64("doc_id", F.lit("order")).alias("order"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)).alias("shard"),
    )
    models = dealt.groupBy("shard").applyInPandas(train, "weights binary, rows long").collect()
    if not models:
        return np.zeros(DIMENSIONS, np.float32)
    total = sum(m.rows for m in models)
    return sum(np.frombuffer(m.weights, np.float32) * np.float32(m.rows / total) for m in models)


def rate(weights: np.ndarray, text: str | None) -> float:
    """Score of one text, by the sparse dot product."""
    index, value = features(text or "")
    return logistic(float(np.dot(weights[index], value)))


def score(df: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher: better) of every row; null texts as empty ones."""
    shared = df.sparkSession.sparkContext.broadcast(weights)
    schema = T.StructType().add("doc_id", df.schema[id_col].dataType).add("score", "double")

    def run(rows: dict[str, list]) -> list[list]:
        return [rows["doc_id"], [rate(shared.value, t) for t in rows["text"]]]

    return map_slices(picked(df, doc_id=id_col, text=text_col), run, schema)


def examples(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts and labels of the rows that may be learnt from (crc32 fold not 0).

    An id labelled both ways, or with a null label or id, is left out.
    """
    labelled = (
        labels.where(crc32_fold("doc_id", 5) != 0)
        .groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("_most"), F.count("quality").alias("_n"), F.count(F.lit(1)).alias("_all"))
        .where((F.col("label") == F.col("_most")) & (F.col("_n") == F.col("_all"))).select("doc_id", "label")
    )
    chosen = hash_sample(labelled, TRAIN_ROWS)
    return picked(docs, doc_id="doc_id", text="text").join(F.broadcast(chosen), "doc_id")  # bounded by TRAIN_ROWS


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, one row for each input row."""
    scored = score(docs, fit(examples(docs, labels)))
    return scored.select(
        "doc_id",
        F.coalesce(crc32_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted"),
    )


def accept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches REJECT_BELOW, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(examples(docs, labels)))
    return filter_texts(docs, lambda texts: [rate(shared.value, t) >= REJECT_BELOW for t in texts])
