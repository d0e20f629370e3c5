"""Dictionaries of plain texts of any size and any number, found by equi-joins.

A text is indexed by sampled grams: of every window of grams, the one with the least
hash. A window of a literal is a window of each haystack that holds it, so the
literal's sampled grams are among the haystack's. A bitmap of a fixed size keeps most
grams the dictionary lacks from leaving their task; the rarest gram of a literal in the
haystacks is joined on, and what that leads to is confirmed byte by byte on the
haystack. Nothing of the dictionary but the bitmap passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

# Lengths in bytes; a literal is indexed by the largest that is not longer than it.
CLASSES = (1, 2, 4, 8, 16, 32)
# Grams of literals no longer than this are the whole of their window.
WHOLE_GRAM = 8
# Bits of the map of dictionary grams; a full map filters nothing, and the join decides.
MAP_BITS = 1 << 21
ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = left * ODD ^ (right + ODD) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(29))


def sampled_grams(data: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the grams sampled from the windows of ``size`` bytes: half as long, or the whole of a short window;
    the one with the least hash, then the leftmost."""
    gram = size if size <= WHOLE_GRAM else size // 2
    if len(data) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, n = _mixed(np.frombuffer(data, np.uint8).astype(np.uint64), np.array([size], np.uint64)), 1
    while n < gram:
        h, n = _mixed(h[:-n], h[n:]), 2 * n
    least, have, span = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64), 1, size - gram + 1
    while have < span:
        step = min(have, span - have)
        least, have = np.minimum(least[:-step], least[step:]), have + step
    at = np.unique((least & np.uint64(0xFFFFFFFF)).astype(np.int64))
    return at, h[at].view(np.int64)


def _bytes(value: bytes | str | None) -> bytes:
    return value.encode() if isinstance(value, str) else value or b""


def phrase_scan(
    docs: DataFrame, literals: DataFrame, *, payload: str = "text", key: str = "doc_id",
) -> DataFrame:
    """All occurrences of the literals ``(pattern_id, expression)``: ``(key, pattern_id, from, to)``, offsets in bytes.

    Literals are plain texts, compared byte by byte; empty ones are never found, and equal ones under several ids are found
    for each. A null haystack has no occurrences.
    """
    kind = docs.schema[key].dataType.simpleString()
    words = literals.select(F.col("pattern_id").cast("int").alias("pattern_id"), F.col("expression").cast("binary").alias("literal"))
    words = words.where("octet_length(literal) > 0").distinct()

    def of_literals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i, literal in enumerate(batch.column(1).to_pylist()):
                size = max(c for c in CLASSES if c <= len(literal))
                at, grams = sampled_grams(literal, size)
                found.append((np.full(len(at), i), np.full(len(at), size, np.int32), grams, at.astype(np.int32)))
            if found:
                rows, sizes, grams, at = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)), pa.array(sizes), pa.array(grams), pa.array(at)],
                    ["pattern_id", "literal", "size", "gram", "place"])

    index = stored(words.mapInArrow(of_literals, "pattern_id int, literal binary, size int, gram bigint, place int"), "index")
    sizes = [r["size"] for r in index.select("size").distinct().collect()]  # at most one a class
    present = np.zeros(MAP_BITS, bool)
    slot = F.pmod(F.col("gram"), F.lit(MAP_BITS)).cast("int").alias("slot")
    for r in index.select(slot).distinct().toLocalIterator():  # at most MAP_BITS numbers
        present[r["slot"]] = True
    bits = np.packbits(present)

    def of_docs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(bits).astype(bool)
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                data = _bytes(batch.column(1)[i].as_py())
                for size in sizes:
                    at, grams = sampled_grams(data, size)
                    kept = known[grams % MAP_BITS]
                    at, grams = at[kept], grams[kept]
                    found.append((np.full(len(at), i), np.full(len(at), size, np.int32), grams, at.astype(np.int32)))
            if found:
                rows, of, grams, at = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(of), pa.array(grams), pa.array(at)], [key, "size", "gram", "at"])

    grams = docs.select(key, payload).mapInArrow(of_docs, f"`{key}` {kind}, size int, gram bigint, at int")
    # only grams the dictionary has go on
    grams = stored(grams.join(index.select("size", "gram").distinct(), ["size", "gram"], "left_semi"), "grams")
    counts = grams.groupBy("size", "gram").agg(F.count("*").alias("n"))
    known = index.join(counts, ["size", "gram"], "left").groupBy("pattern_id", "literal").agg(
        F.count_if(F.col("n").isNull()).alias("missing"), F.min(F.struct("n", "size", "gram", "place")).alias("m"))
    chosen = stored(known.where("missing = 0").select("pattern_id", "literal", "m.size", "m.gram", "m.place"), "chosen")
    places = grams.join(chosen, ["size", "gram"]).where("at >= place").select(
        key, F.struct((F.col("at") - F.col("place")).alias("at"), "pattern_id", "literal").alias("c"))
    asked = places.groupBy(key).agg(F.collect_set("c").alias("asked"))

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = _bytes(batch.column(1)[i].as_py())
                hits = [(c["pattern_id"], c["at"], c["at"] + len(c["literal"])) for c in batch.column(2)[i].as_py()
                        if data.startswith(c["literal"], c["at"])]
                if hits:
                    ids, starts, ends = zip(*hits)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([i] * len(hits))), pa.array(ids, pa.int32()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                        [key, "pattern_id", "from", "to"])

    return docs.select(key, payload).join(asked, key).select(key, payload, "asked").mapInArrow(
        confirm, f"`{key}` {kind}, pattern_id int, `from` bigint, `to` bigint")
