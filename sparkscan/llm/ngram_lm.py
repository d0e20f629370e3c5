"""Interpolated modified Kneser-Ney bigram model: counted in Spark, stored as sorted hash arrays, memory-mapped by workers.

Training. Tasks count the pairs (context word, word) of their texts and deal them
out by context as arrays; pairs of the few contexts with a large share of all pairs
are dealt out by pair, so no context lands in one task. Each shard sums its pairs and
writes their 64-bit hashes, sorted, with counts. From the pairs follow, by word: its
count, its number of contexts, and as a context its total and how many words
follow it once, twice, or more. These are dealt out by word, summed and stored likewise.

Scoring is narrow: workers map the files and look the pairs and words of a slice of
texts up by binary search; pages are read as needed and shared between workers.

The folder of the model is in ``spark.checkpoint.dir`` and must be a mounted file
system, as a file can't be mapped from an object store; others are refused. Files
are written under another name and renamed, so a repeated task does no harm.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path
from .common import WordHashes, lower_words, mixed, text_slices
from .components import removed, written
from .near_dup import _groups

END = np.uint64(xxhash.xxh3_64_intdigest(b"", 1))
BEGIN = np.uint64(xxhash.xxh3_64_intdigest(b"", 2))
HASHES = WordHashes()
FLUSH_PAIRS = 3_000_000
SHARD_BYTES = 8 << 20
PAIR = np.dtype([("key", "<u8"), ("count", "<u4")])
WORD_COUNTS = ("count", "contexts", "total", "once", "twice", "more")


class Stats(NamedTuple):
    """What the whole model shares: tokens, distinct tokens, and counts of counts (1, 2, 3, 4) of pairs and of contexts."""

    tokens: int
    distinct: int
    pairs: tuple[int, ...]
    contexts: tuple[int, ...]
    context_total: int
    context_more: tuple[int, ...]  # words with 1, 2, 3 or more contexts


def discounts(n: tuple[int, ...]) -> np.ndarray:
    """The modified Kneser-Ney discounts for counts 0, 1, 2, 3 and more; 0.5, 1, 1.5 where a count of counts is 0."""
    if min(n[:4]) <= 0:
        return np.array([0, 0.5, 1.0, 1.5])
    y = n[0] / (n[0] + 2 * n[1])
    return np.array([0.0, *(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.0), float(k)) for k in (1, 2, 3))])


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def pair_shards(context: np.ndarray, key: np.ndarray, heavy: np.ndarray, shards: int) -> np.ndarray:
    spread = np.isin(context, heavy)
    return shard_of(np.where(spread, key, context * np.uint64(0x9E3779B97F4A7C15)), shards)


def tokens_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts with an end after each, the word before each, and the number of tokens by text."""
    parts, sizes = [], []
    for text in texts:
        words = HASHES.of(lower_words(text))
        parts += [words, np.array([END])]
        sizes.append(len(words) + 1)
    flat = np.concatenate(parts)
    before = np.r_[BEGIN, flat[:-1]]
    before[np.cumsum(sizes)[:-1]] = BEGIN
    return flat, before, np.array(sizes)


def summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys in order, a place of each, and the sums of the counts."""
    order = np.argsort(keys, kind="stable")
    starts = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]]) if len(keys) else order
    return keys[order][starts], order[starts], [np.add.reduceat(c[order], starts) if len(keys) else c for c in counts]


def dealt(shard: np.ndarray, arrays: dict[str, np.ndarray], shards: int) -> pa.RecordBatch:
    """A row for each shard, with its part of each array as bytes."""
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    held = np.flatnonzero(bounds[1:] > bounds[:-1])
    columns = [pa.array(held.astype(np.int32))]
    for values in arrays.values():
        moved = values[order]
        columns.append(pa.array([moved[bounds[s]:bounds[s + 1]].tobytes() for s in held], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, ["shard", *arrays])


def joined(group: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(group.column(name).to_pylist()), kind)


def put(folder: str, name: str, values: np.ndarray) -> None:
    part = f"{folder}/.{name}-{os.getpid()}-{os.urandom(4).hex()}"
    values.tofile(part)
    os.replace(part, f"{folder}/{name}")


def heavy_contexts(texts: DataFrame, shards: int) -> np.ndarray:
    """Contexts with over a quarter of a shard's share of the pairs of all texts: fewer than ``4 * shards``.

    Counted over all texts, added up by each task before the shuffle; the row
    without a hash is the number of all pairs. This only decides where pairs are
    counted, never what is counted.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            every = np.concatenate(befores)
            hashes, counts = np.unique(every, return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([None, *hashes.view(np.int64).tolist()], pa.int64()), pa.array(np.r_[len(every), counts], pa.int64())], ["hash", "n"])

        befores, held = [], 0
        for _, some in text_slices(batches):
            befores.append(tokens_of(some)[1])
            held += len(befores[-1])
            if held >= FLUSH_PAIRS:
                yield out()
                befores, held = [], 0
        if befores:
            yield out()

    counts = texts.mapInArrow(run, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))
    # every context above the share is among as many of the largest counts
    top = counts.orderBy(F.desc("n")).limit(4 * shards + 1).collect()
    of = sum(r["n"] for r in top if r["hash"] is None)
    found = [r["hash"] for r in top if r["hash"] is not None and r["n"] * 4 * shards > of]
    return np.sort(np.array(found, np.int64).view(np.uint64))


class Model(NamedTuple):
    folder: str
    shards: int
    heavy: np.ndarray
    stats: Stats


def train(df: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Count the texts of ``df`` (null: empty; repeated rows count again) and store the model."""
    spark = df.sparkSession
    texts = df.select(key, text)
    size = texts.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))  # so a shard's pairs fit a task, whatever the corpus
    url = urlparse(fresh_path(spark, "ngrams"))
    if url.scheme not in ("", "file"):
        raise ValueError("spark.checkpoint.dir must be a mounted file system, for the model is memory-mapped")
    folder = url.path
    os.makedirs(folder, exist_ok=True)
    heavy = heavy_contexts(texts, shards)

    totals = ["tokens", "distinct", "total", *[f"of{k}" for k in range(9)]]

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            word, before = np.concatenate(words), np.concatenate(befores)
            pair, at, (n,) = summed(mixed(before, word), np.ones(len(word), np.uint32))
            word, before = word[at], before[at]
            order = np.argsort(before, kind="stable")
            shard = pair_shards(before[order], pair[order], heavy, shards)
            return dealt(shard, {"before": before[order], "word": word[order], "n": n[order].astype("<u4")}, shards)

        words, befores, held = [], [], 0
        for _, some in text_slices(batches):
            word, before, _ = tokens_of(some)
            words.append(word)
            befores.append(before)
            held += len(word)
            if held >= FLUSH_PAIRS:
                yield out()
                words, befores, held = [], [], 0
        if words:
            yield out()

    def sum_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        for group in _groups(batches, 1):
            shard = group.column(0)[0].as_py()
            before, word = joined(group, "before", "<u8"), joined(group, "word", "<u8")
            pair, at, (n,) = summed(mixed(before, word), joined(group, "n", "<u4").astype(np.int64))
            before, word = before[at], word[at]
            if n.max() > 0xFFFFFFFF:
                raise OverflowError("a pair occurs more than 2**32 times")
            put(folder, f"pairs-{shard}", pair)
            put(folder, f"counts-{shard}", n.astype("<u4"))
            of_counts = np.array([(n == k).sum() for k in (1, 2, 3, 4)], "<i8")
            one = np.ones(len(n), np.int64)
            words, _, (count_, contexts) = summed(word, n, one)
            befores, _, (total, once, twice) = summed(before, n, (n == 1).astype(np.int64), (n == 2).astype(np.int64))
            more = summed(before, one)[2][0] - once - twice
            zero_w, zero_b = np.zeros(len(words), np.int64), np.zeros(len(befores), np.int64)
            hashes = np.r_[words, befores]
            arrays = dict(zip(WORD_COUNTS, (
                np.r_[count_, zero_b], np.r_[contexts, zero_b], np.r_[zero_w, total],
                np.r_[zero_w, once], np.r_[zero_w, twice], np.r_[zero_w, more])))
            rows = dealt(shard_of(hashes, shards), {"hash": hashes, **{k: v.astype("<i8") for k, v in arrays.items()}}, shards)
            first = [of_counts.tobytes()] + [b""] * (rows.num_rows - 1)
            yield rows.append_column("of_counts", pa.array(first, pa.binary()))

    def sum_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 1):
            shard = group.column(0)[0].as_py()
            hashes, _, sums = summed(joined(group, "hash", "<u8"), *[joined(group, c, "<i8") for c in WORD_COUNTS])
            put(folder, f"words-{shard}", hashes)
            put(folder, f"stats-{shard}", np.column_stack(sums).astype("<i8"))
            n, c = sums[0], sums[1]
            pairs = joined(group, "of_counts", "<i8").reshape(-1, 4).sum(0)
            found = [n.sum(), (n > 0).sum(), c.sum(), *pairs, *[(c == k).sum() for k in (1, 2, 3, 4)], (c > 2).sum()]
            yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in found], totals)

    def by_shard(rows: DataFrame) -> DataFrame:
        return rows.repartition(shards, "shard").sortWithinPartitions("shard")

    counted = texts.mapInArrow(count, "shard int, before binary, word binary, n binary")
    pairs = by_shard(counted).mapInArrow(
        sum_pairs, "shard int, hash binary, " + ", ".join(f"{c} binary" for c in WORD_COUNTS) + ", of_counts binary")
    stored = by_shard(pairs).mapInArrow(sum_words, ", ".join(f"{c} bigint" for c in totals))
    got = [x or 0 for x in stored.agg(*[F.sum(c) for c in totals]).first()]
    tokens, distinct, total, of = *got[:3], got[3:]
    stats = Stats(tokens, distinct, tuple(of[:4]), tuple(of[4:8]), total, (of[4], of[5], of[8]))
    return Model(folder, shards, heavy, stats)


@lru_cache(maxsize=100_000)
def mapped(path: str, kind: str, width: int = 1) -> np.ndarray:
    if not os.path.exists(path) or not os.path.getsize(path):
        return np.zeros((0, width) if width > 1 else 0, kind)
    values = np.memmap(path, kind, "r")
    return values.reshape(-1, width) if width > 1 else values


def looked_up(model: Model, names: tuple[str, str], shard: np.ndarray, keys: np.ndarray, kind: str, width: int = 1) -> np.ndarray:
    """The stored values of distinct, sorted keys; zeros for those not stored."""
    out = np.zeros((len(keys), width) if width > 1 else len(keys), np.int64)
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(model.shards + 1))
    for s in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist():
        own = order[bounds[s]:bounds[s + 1]]
        have = mapped(f"{model.folder}/{names[0]}-{s}", "<u8")
        if not len(have):
            continue
        at = np.minimum(np.searchsorted(have, keys[own]), len(have) - 1)
        hit = have[at] == keys[own]
        out[own[hit]] = mapped(f"{model.folder}/{names[1]}-{s}", kind, width)[at[hit]]
    return out


def scores(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, known tokens, base score and model score of each text."""
    stats = model.stats
    word, before, sizes = tokens_of(texts)
    hashes, back = np.unique(np.r_[word, before], return_inverse=True)
    table = looked_up(model, ("words", "stats"), shard_of(hashes, model.shards), hashes, "<i8", 6)
    count, contexts = table[back[:len(word)], 0], table[back[:len(word)], 1]
    total, once, twice, more = (table[back[len(word):], k] for k in (2, 3, 4, 5))
    pairs, first, pair_back = np.unique(mixed(before, word), return_index=True, return_inverse=True)
    shard = pair_shards(before[first], pairs, model.heavy, model.shards)
    together = looked_up(model, ("pairs", "counts"), shard, pairs, "<u4")[pair_back]

    d = discounts(stats.contexts)
    uniform = 1 / (stats.distinct + 1)
    one = np.full(len(word), uniform)
    if stats.context_total:
        spare = float(np.dot(d[1:], stats.context_more)) / stats.context_total
        one = (contexts - d[np.minimum(contexts, 3)]) / stats.context_total + spare * uniform
    d = discounts(stats.pairs)
    known = total > 0
    of = np.maximum(total, 1)
    spare = (d[1] * once + d[2] * twice + d[3] * more) / of
    chance = np.where(known, (together - d[np.minimum(together, 3)]) / of + spare * one, one)
    base = np.log10((count + 1) / (stats.tokens + stats.distinct + 1))
    starts = np.cumsum(sizes) - sizes
    return sizes, np.add.reduceat((count > 0).astype(np.int64), starts), np.add.reduceat(base, starts), np.add.reduceat(np.log10(chance), starts)


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Score whole texts: ``(key, n_tokens, n_known, base_score, score)``; scores are log10 probabilities.

    A null text is empty: its only token is the end. Repeated rows give repeated results.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_slices(batches):
            n, known, base, own = scores(model, texts)
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(n, pa.int64()), pa.array(known), pa.array(base), pa.array(own)],
                [key, "n_tokens", "n_known", "base_score", "score"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_tokens bigint, n_known bigint, base_score double, score double")


def perplexity(n_tokens: Column, log10_probability: Column) -> Column:
    return F.pow(F.lit(10.0), -log10_probability / n_tokens)


def learn_and_score(df: DataFrame, learns: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the rows for which ``learns`` holds (null: not) and score all rows; adds ``held_out`` and ``train_tokens``.

    The scores are written to the shared folder, and the model is removed.
    """
    taken = F.coalesce(learns, F.lit(False))
    model = train(df.where(taken), key, text)
    marked = df.select(F.col(key), F.col(text), (~taken).alias("__out"))
    # the key and the mark travel together
    packed = marked.select(F.struct(F.col(key).alias("key"), "__out").alias("__row"), F.col(text).alias("__text"))
    found, _ = written(score(packed, model, "__row", "__text"), "scores")
    removed(df.sparkSession, f"file://{model.folder}")
    return found.select(
        F.col("__row.key").alias(key), F.col("__row.__out").alias("held_out"), "n_tokens", "n_known",
        F.lit(model.stats.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
