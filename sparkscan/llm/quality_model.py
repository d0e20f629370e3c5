"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Words are runs of letters, of digits and of marks; their *shapes* (letters folded
to ``x`` or ``X``, equal neighbours to ``=``) form a second stream. Uni- and
bigrams of words and one- to three-grams of shapes are hashed into 2**18 weights
(1 MB, whatever the corpus). A text's value for a feature is its share of the
n-grams of its kind, so a score is a sparse dot product and whole texts count.

Training takes a bounded sample of labelled rows (``max_rows``, smallest hashes of
the key first). Their features are computed in parallel; one task runs the
updates. Scoring is narrow.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mixed

BITS = 18
MAX_ROWS = 6_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2e-4, 1e-4
WORDS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
MAX_TEXT_WORDS = 300_000


def shape(word: str) -> str:
    if not word[0].isalpha():
        return "9" if word[0].isdigit() else word[:4]
    return "X" if word.isupper() and len(word) > 1 else "Xx" if word[0].isupper() else "x"


class Word(dict):
    """Per word: the hash of the word and that of its shape."""

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) >= MAX_TEXT_WORDS:
            self.clear()
        own = xxhash.xxh3_64_intdigest(word.lower().encode())
        value = self[word] = (own, xxhash.xxh3_64_intdigest(shape(word).encode(), 1))
        return value


HASHES = Word()
SAME = np.uint64(xxhash.xxh3_64_intdigest(b"=", 1))


def features(text: str) -> list[np.ndarray]:
    """Hashed features of a text, one array for each kind of n-gram."""
    found = WORDS.findall(text)
    if not found:
        return []
    both = np.array([HASHES[w] for w in found], np.uint64)
    words, shapes = np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])
    shapes[1:][words[1:] == words[:-1]] = SAME
    twos = mixed(shapes[:-1], shapes[1:])
    kinds = [words, mixed(words[:-1], words[1:]), shapes, twos, mixed(twos[:-1], shapes[2:])]
    return [((k * np.uint64(2 * n + 0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int32)
            for n, k in enumerate(kinds) if len(k)]


def weighed(kinds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and their values."""
    if not kinds:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    at, back = np.unique(np.concatenate(kinds), return_inverse=True)
    shares = np.concatenate([np.full(len(k), 1 / len(k)) for k in kinds])
    return at.astype(np.int32), np.bincount(back, shares).astype(np.float32)


def follow(samples: list[tuple[float, np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last is the bias) after regularised-leader updates over the samples."""
    size = (1 << BITS) + 1
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(samples)):
            label, at, value = samples[k]
            at, value = np.append(at, size - 1), np.append(value, 1.0)
            root = np.sqrt(n[at])
            own = np.where(np.abs(z[at]) <= L1, 0.0, (np.sign(z[at]) * L1 - z[at]) / ((BETA + root) / ALPHA + L2))
            p = 1 / (1 + np.exp(-np.clip(own @ value, -35, 35)))
            g = (p - label) * value
            z[at] += g - (np.sqrt(n[at] + g * g) - root) / ALPHA * own
            n[at] += g * g
    w = np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    return w.astype(np.float32)


def train(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", *,
          max_rows: int = MAX_ROWS, epochs: int = EPOCHS) -> np.ndarray:
    """Learn from at most ``max_rows`` labelled rows.

    Null labels and rows without a text are left out; of several labels of a key
    the largest counts. Without any sample all weights are 0, and every score 0.5.
    """
    sample = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("__key"))
        .agg(F.max(label).cast("double").alias("__label"))
        .orderBy(F.xxhash64("__key"), "__key").limit(max_rows))
    rows = df.select(F.col(key).alias("__key"), F.col(text).alias("__text")).where(F.col("__text").isNotNull())
    # at most max_rows rows of two numbers
    rows = rows.join(F.broadcast(sample), "__key").select(F.col("__key").cast("string"), "__label", "__text")

    def featured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [weighed(features(t)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([a.tobytes() for a, _ in made], pa.binary()),
                pa.array([v.tobytes() for _, v in made], pa.binary())], ["id", "label", "at", "value"])

    def learned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((r["id"], r["label"], r["at"], r["value"]) for b in batches for r in b.to_pylist())
        samples = [(y, np.frombuffer(a, np.int32), np.frombuffer(v, np.float32)) for _, y, a, v in got]
        yield pa.RecordBatch.from_arrays([pa.array([follow(samples, epochs).tobytes()], pa.binary())], ["weights"])

    samples = rows.mapInArrow(featured, "id string, label double, at binary, value binary").repartition(1)
    found = samples.mapInArrow(learned, "weights binary").first()
    return np.frombuffer(found["weights"], np.float32) if found else np.zeros((1 << BITS) + 1, np.float32)


def score_of(weights: np.ndarray, text: str | None) -> float:
    x = float(weights[-1]) + sum(float(weights[k].mean()) for k in features(text or ""))
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def score(df: DataFrame, weights: np.ndarray, text: str = "text") -> Column:
    """The probability of label 1, as a column. Null and empty texts get that of the bias alone."""
    shared = df.sparkSession.sparkContext.broadcast(weights.tobytes())  # 1 MB

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = np.frombuffer(shared.value, np.float32)
        for texts in batches:
            yield pd.Series([score_of(own, t) for t in texts], dtype="float64")

    return scored(F.col(f"`{text}`"))
