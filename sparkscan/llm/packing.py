"""Best-two-fit packing of documents into sequences of bounded length.

A sequence is begun with the longest document left and filled greedily, always
with the longest that fits. While a gap is left, its smallest document is taken
out again if two unpacked documents fill the widened gap more tightly.

Only lengths matter, so this is run over the *counts* of each length: at most
``capacity`` numbers, whatever the corpus. Sequences with the same lengths are
made together, as many as the counts allow before a decision would change; the
outcome is that of packing one sequence after another. The documents then look
their place up by their rank among those of equal length. Ranks are counted in
buckets of each length, so a length that very many documents share is spread.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_ids import byte_vocabulary
from .common import text_slices
from .components import written

CAPACITY = 2048
BUCKET_ROWS = 500
END = np.zeros(1, "<u4").tobytes()


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", *, ids: bool = True) -> DataFrame:
    """Cut each document's ids, ended by id 0: ``(key, piece, start, length, ids_crc32, ids)``; only the first piece may be short.

    ``ids`` are little-endian unsigned 32-bit integers, left out if not asked
    for. A null text is empty, one piece of one id.
    """
    names = [key, "piece", "start", "length", "ids_crc32", "ids"][:5 + ids]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = byte_vocabulary(path)
        for keys, texts in text_slices(batches):
            encoded = [i + END for i in own.encode(texts)]
            at, piece, start, parts = [], [], [], []
            for k, i in enumerate(encoded):
                n = len(i) // 4
                many = -(-n // capacity)
                cuts = [0, *range(n - capacity * (many - 1), n + 1, capacity)]
                for p in range(many):
                    at.append(k)
                    piece.append(p)
                    start.append(cuts[p])
                    parts.append(i[4 * cuts[p]:4 * cuts[p + 1]])
            columns = [
                keys.take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array([len(i) // 4 for i in parts], pa.int64()), pa.array([zlib.crc32(i) for i in parts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(parts, pa.binary())] if ids else columns, names)

    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * ids
    return df.select(key, text).mapInArrow(run, schema)


class Fill:
    """The documents left, by length, and one sequence after another made of them."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.capacity = capacity

    def best(self, free: np.ndarray, gap: int) -> int:
        """The longest length up to ``gap`` that is free, or 0."""
        found = np.flatnonzero(free[:gap + 1])
        return int(found[-1]) if len(found) else 0

    def best_two(self, free: np.ndarray, gap: int) -> tuple[int, int]:
        """The two free lengths with the largest sum up to ``gap``, or zeros."""
        some = np.flatnonzero(free[:gap])
        if not len(some):
            return 0, 0
        with_ = np.minimum(np.searchsorted(some, gap - some, "right") - 1, np.arange(len(some)))
        alone = (with_ == np.arange(len(some))) & (free[some] < 2)
        with_ = np.where(alone, with_ - 1, with_)
        sums = np.where(with_ >= 0, some + some[np.maximum(with_, 0)], 0)
        k = int(np.argmax(sums))
        return (int(some[k]), int(some[with_[k]])) if sums[k] else (0, 0)

    def sequence(self) -> tuple[list[int], int]:
        """The lengths of the next sequence, and how many like it follow one another."""
        free = self.left.copy()
        seen: Counter[int] = Counter()

        def take(length: int) -> int:
            free[length] -= 1
            seen[length] = max(seen[length], int(self.left[length] - free[length]))
            return length

        held = [take(self.best(free, self.capacity))]
        gap = self.capacity - held[0]
        while gap and (length := self.best(free, gap)):
            held.append(take(length))
            gap -= length
        while gap and len(held) > 1:
            least = held[-1]
            a, b = self.best_two(free, gap + least)
            if a + b <= least:
                break
            free[least] += 1
            held[-1:] = [take(a), take(b)]
            held.sort(reverse=True)
            gap += least - a - b
        used = Counter(held)
        many = min((int(self.left[x]) - seen[x]) // used[x] + 1 for x in used)
        for x, n in used.items():
            self.left[x] -= n * many
        return held, many


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> pd.DataFrame:
    """Where the documents of each length go, by their rank: intervals ``(length, first, bins, sequence, offset)``.

    The document of rank ``first + t`` is in sequence ``sequence + t % bins``, at ``offset + t // bins * length``.
    """
    fill, rows, taken, base = Fill(counts, capacity), [], Counter(), 0
    while fill.left.any():
        held, many = fill.sequence()
        offset = 0
        for length, n in sorted(Counter(held).items(), reverse=True):
            rows.append((length, taken[length], many, base, offset))
            taken[length] += n * many
            offset += n * length
        base += many
    out = pd.DataFrame(rows, columns=["length", "first", "bins", "sequence", "offset"], dtype="int64")
    return out.sort_values(["length", "first"], ignore_index=True)


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` from 1 to ``capacity``; ``cut`` must be a written table."""
    counted = cut.groupBy("length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in counted.collect()}  # at most ``capacity`` rows
    places = plan(counts, capacity)
    firsts = places["length"].to_numpy() * (1 << 44) + places["first"].to_numpy()

    order = [c for c in cut.columns if c not in ("length", "ids")]
    buckets = F.greatest(F.ceil(F.col("n") / BUCKET_ROWS), F.lit(1))
    # one row for each length, so at most ``capacity`` rows
    dealt = cut.join(F.broadcast(counted.select("length", buckets.alias("__buckets"))), "length")
    dealt = dealt.withColumn("__bucket", F.pmod(F.xxhash64(*order), "__buckets")).drop("__buckets")
    group = ["length", "__bucket"]
    inside = dealt.withColumn("__rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1)
    earlier = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy(*group).agg(F.count("*").alias("__n")).select(
        *group, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(firsts, length.to_numpy() * (1 << 44) + rank.to_numpy(), "right") - 1
        found = places.iloc[at]
        t = rank.to_numpy() - found["first"].to_numpy()
        return pd.DataFrame({
            "sequence_id": found["sequence"].to_numpy() + t % found["bins"].to_numpy(),
            "offset": found["offset"].to_numpy() + t // found["bins"].to_numpy() * length.to_numpy()})

    ranked = inside.join(before, group).withColumn("__place", place("length", F.col("__rank") + F.col("__before")))
    return ranked.select(*cut.columns, "__place.sequence_id", "__place.offset")


def pack(df: DataFrame, path: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack whole documents: ``(key, piece, start, length, ids_crc32, sequence_id, offset)``, one row per piece.

    Repeated rows are documents of their own; other columns are left out; an empty table gives an empty one.
    """
    stored, _ = written(pieces(df, path, capacity, key, text, ids=False), "pieces")
    return packed(stored, capacity)
