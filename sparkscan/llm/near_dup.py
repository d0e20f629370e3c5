"""Near duplicates: MinHash signatures, a multi-index Hamming join, and confirmation on full sets.

A text's set holds its distinct k-word shingles as 64-bit hashes. Its signature
has ``POSITIONS`` MinHash values of 16 bits. Signatures of two texts at the
similarity threshold differ in at most ``r`` places but for one pair in
``1 / MISS``. Signatures are cut into ``r // 2 + 1`` chunks: two that differ in at
most ``r`` places have a chunk with at most one error, which is enumerated by
leaving out each place of each chunk in turn. So all pairs within the distance
share a key.

1. Equal sets become one class (counted map-side), named by its smallest key.
2. Keys held by several classes are buckets. Inside a bucket, signatures are
   compared as arrays and only a spanning forest of those within ``r`` is
   given out; members of buckets over ``MAX_BUCKET`` are all linked to the
   smallest one, which can only make candidate clusters larger.
3. Candidate clusters are the components. Full sets go to their clusters, large
   clusters in pairs of blocks, and a spanning forest of the links that hold on
   full sets is given out. Its components are the result.

So the number of pairs given out grows with the number of texts, and no link
between candidates is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, lower_words, mixed, text_slices
from .components import components, written

POSITIONS = 40
MISS = 1e-4
MAX_BUCKET = 2_048
BLOCK_SHINGLES = 2_000_000
HASHES = WordHashes()


def distance_bound(num: int, den: int) -> int:
    """The least r that two signatures at similarity ``num / den`` exceed less often than ``MISS``."""
    differ, held = 1 - num / den, 0.0
    for r in range(POSITIONS - 1):
        held += comb(POSITIONS, r) * differ**r * (1 - differ) ** (POSITIONS - r)
        if 1 - held <= MISS:
            return r
    return POSITIONS - 2


def chunk_places(r: int) -> list[list[int]]:
    return [c.tolist() for c in np.array_split(np.arange(POSITIONS), r // 2 + 1)]


def seeds() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return (rng.integers(1, 1 << 63, POSITIONS, np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, POSITIONS, np.uint64))


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes; with fewer words the whole sequence is one, without words there is none."""
    h = HASHES.of(lower_words(text))
    if not len(h):
        return h
    n = max(len(h) - words + 1, 1)
    made = h[:n]
    for k in range(1, min(words, len(h))):
        made = mixed(made, h[k:k + n])
    return np.unique(made)


def signatures(df: DataFrame, words: int, key: str, text: str) -> DataFrame:
    """``(key, n_shingles, digest, signature)``; digest and signature are null for empty sets."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mul, add = seeds()
        for keys, texts in text_slices(batches):
            sets = [shingle_set(t, words) for t in texts]
            sizes = np.array([len(s) for s in sets])
            full = np.flatnonzero(sizes)
            digests: list[bytes | None] = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            signed: list[bytes | None] = [None] * len(sets)
            if len(full):
                flat = np.concatenate(sets)
                starts = (np.cumsum(sizes) - sizes)[full]
                made = np.empty((len(full), POSITIONS), np.uint16)
                for i in range(POSITIONS):
                    least = np.minimum.reduceat(flat * mul[i] + add[i], starts)
                    made[:, i] = (least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
                for k, i in enumerate(full.tolist()):
                    signed[i] = made[k].tobytes()
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signed, pa.binary())],
                [key, "n_shingles", "digest", "signature"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_shingles bigint, digest binary, signature binary")


def index_keys(classes: DataFrame, r: int) -> DataFrame:
    """``(index, rep)``: one key for each place left out of its chunk."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            signed = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, POSITIONS)
            columns = []
            for chunk in chunk_places(r):
                for place in chunk:
                    made = np.full(len(signed), place, np.uint64)
                    for other in chunk:
                        if other != place:
                            made = mixed(made, signed[:, other].astype(np.uint64))
                    columns.append(made.view(np.int64))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(columns)),
                pa.concat_arrays([batch.column(0)] * len(columns))], ["index", "rep"])

    return classes.select("rep", "signature").mapInArrow(run, f"index bigint, rep {classes.schema['rep'].dataType.simpleString()}")


def spanning(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> tuple[list[int], list[int]]:
    """A spanning forest. ``near(i, rest)`` tells which of ``rest`` are linked with ``i``; no pair is asked for twice."""
    left, right = [], []
    rest = np.arange(n)
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            hit = near(i, rest)
            found = rest[hit].tolist()
            left += [i] * len(found)
            right += found
            queue += found
            rest = rest[~hit]
    return left, right


def _groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Groups of consecutive rows with equal values in the first ``keys`` columns, as tables; one group is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        bounds = [0, *cut.tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            this = tuple(c[a] for c in columns)
            if held and this != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = this
    if held:
        yield pa.Table.from_batches(held)


def bucket_links(members: DataFrame, r: int) -> DataFrame:
    """Spanning links of the signatures within ``r`` of each other, for each bucket."""
    kind = members.schema["rep"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_a, out_b = [], []
        reps = None
        for group in _groups(batches, 1):
            n = group.num_rows
            if n < 2:
                continue
            signed = np.frombuffer(b"".join(group.column(2).to_pylist()), np.uint16).reshape(n, POSITIONS)
            a, b = spanning(n, lambda i, rest: (signed[rest] != signed[i]).sum(1) <= r)  # noqa: B023
            reps = group.column(1).combine_chunks()
            out_a.append(reps.take(pa.array(a, pa.int64())))
            out_b.append(reps.take(pa.array(b, pa.int64())))
            if len(out_a) >= 5_000:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(out_a), pa.concat_arrays(out_b)], ["a", "b"])
                out_a, out_b = [], []
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(out_a), pa.concat_arrays(out_b)], ["a", "b"])

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.select("index", "rep", "signature").repartition(parts, "index").sortWithinPartitions("index", "rep")
    return dealt.mapInArrow(run, f"a {kind}, b {kind}")


def linked(sets: list[np.ndarray], num: int, den: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the sets with ``den * intersection >= num * union``."""
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark = np.zeros(len(flat) + 1, bool)

    def near(i: int, rest: np.ndarray) -> np.ndarray:
        own = flat[starts[i]:starts[i] + sizes[i]]
        hit = (den * np.minimum(sizes[rest], sizes[i]) >= num * np.maximum(sizes[rest], sizes[i]))
        some = rest[hit]
        if len(some):
            mark[own] = True
            lengths = sizes[some]
            ends = np.cumsum(lengths)
            at = np.arange(ends[-1]) + np.repeat(starts[some] - (ends - lengths), lengths)
            both = np.add.reduceat(mark[flat[at]], ends - lengths, dtype=np.int64)
            mark[own] = False
            hit[hit] = den * both >= num * (sizes[i] + lengths - both)
        return hit

    return spanning(len(sets), near)


def confirmed_links(df: DataFrame, clusters: DataFrame, words: int, num: int, den: int, key: str, text: str) -> DataFrame:
    """Spanning links that hold on full sets, within each candidate cluster ``(rep, component, n_shingles)``."""
    kind = clusters.schema["rep"].dataType.simpleString()
    size = clusters.groupBy("component").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    placed = clusters.join(size, "component").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    texts = df.select(F.col(key).alias("rep"), F.col(text).alias("__text")).join(placed, "rep")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    texts = texts.select("rep", "__text", "component", "blocks", "block")

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingle_set(t or "", words).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, pa.binary()), *[batch.column(k) for k in (2, 3, 4)]],
                ["rep", "shingles", "component", "blocks", "block"])

    sets = texts.mapInArrow(make, f"rep {kind}, shingles binary, component {kind}, blocks int, block int")
    sets = sets.withColumn("other", other).select(
        "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rep", "shingles")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            own = [np.frombuffer(s, np.uint64) for s in group.column(4).to_pylist()]
            if len(own) > 1:
                a, b = linked(own, num, den)
                reps = group.column(3).combine_chunks()
                yield pa.RecordBatch.from_arrays([reps.take(pa.array(a, pa.int64())), reps.take(pa.array(b, pa.int64()))], ["a", "b"])

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sets.repartition(parts, "component", "i", "j").sortWithinPartitions("component", "i", "j", "rep")
    return dealt.mapInArrow(run, f"a {kind}, b {kind}")


def near_duplicates(df: DataFrame, words: int = 5, num: int = 80, den: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_shingles, component_id, kept)``: which texts have similarity of at least ``num / den``, directly or by others.

    ``component_id`` is the smallest key reachable, a text's own if it has no
    words; ``kept`` marks the text that has it. Null texts count as empty.
    A key with several texts has a result for each, and repeated rows give repeated results.
    Rows without a key take no part and get a null component and ``kept`` false.
    """
    r = distance_bound(num, den)
    signed, _ = written(signatures(df, words, key, text), "signatures")
    valid = signed.where(F.col("digest").isNotNull() & F.col(key).isNotNull())
    classes, _ = written(valid.groupBy("digest").agg(
        F.min(key).alias("rep"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles")), "classes")

    keys, _ = written(index_keys(classes, r), "keys")
    shared = keys.groupBy("index").agg(F.count("*").alias("n"), F.min("rep").alias("least")).where("n > 1")
    members, _ = written(keys.join(shared, "index"), "members")
    few = members.where(F.col("n") <= MAX_BUCKET).join(classes.select("rep", "signature"), "rep")
    many = members.where(F.col("n") > MAX_BUCKET).where("rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b"))
    candidates = components(bucket_links(few, r).union(many))

    sizes = classes.select("rep", "n_shingles")
    clusters = candidates.withColumnRenamed("node", "rep").join(sizes, "rep").select("rep", "component", "n_shingles")
    groups = components(confirmed_links(df, clusters, words, num, den, key, text))
    of_class = classes.select("digest", "rep").join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("__component"))
    joined = signed.join(of_class, "digest", "left")
    component = F.when(F.col("n_shingles") == 0, F.col(key)).otherwise(F.col("__component"))
    component = F.when(F.col(key).isNotNull(), component)
    return joined.select(key, "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
