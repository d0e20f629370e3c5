"""Helpers that several operators share: tables, words, byte arrays, slices of a batch."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What the contracts call white space.
SPACES = r"[\x20\x09-\x0D]+"
SLICE_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def text_slices(batches: Iterable[pa.RecordBatch], key: int = 0, text: int = 1) -> Iterator[tuple[pa.Array, list[str]]]:
    """Cut Arrow batches into slices of about two million characters; null texts become empty."""
    for batch in batches:
        texts = ["" if t is None else t for t in batch.column(text).to_pylist()]
        start, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= SLICE_CHARS or i == len(texts) - 1:
                yield batch.column(key).slice(start, i + 1 - start), texts[start:i + 1]
                start, size = i + 1, 0


def lower_words(text: str) -> list[bytes]:
    """Words between ASCII white space, with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


class WordHashes(dict):
    """64-bit hashes of words, remembered; forgets all beyond ``limit`` words."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """An order-dependent 64-bit hash of two arrays of hashes."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(start, start + length)``."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def binaries(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary array whose items are the bytes of consecutive runs of ``flat``."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths * flat.itemsize, out=offsets[1:])
    data = np.ascontiguousarray(flat)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary())
