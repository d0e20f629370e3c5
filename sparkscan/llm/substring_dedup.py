"""Repeated passages by compacting a sparse de Bruijn graph, and texts without them.

A window is ``width`` consecutive words; it is repeated if its words also start
somewhere else. Token k-mers (``SEED`` words) are the edges of the graph, but only
the sampled ones: the least hash of each window's k-mers, so that every window holds
one and equal windows hold the same one at the same place. The consecutive
windows that share a sampled k-mer are a piece: a path already compacted by the task
that reads the text, about ten windows in one row.

1. Pieces ``(seed, digest)`` are emitted with their source coordinates; seeds that
   occur once are dropped. Texts are not shuffled for this.
2. A seed found in one piece only, twice or more, does not branch: all windows of the
   piece are repeated. So they are for any piece that occurs twice.
3. Where a seed branches (several pieces), one source of each piece is read back and
   its windows are compared one by one: a window is repeated if two pieces hold it, or
   one that occurs twice. This verifies what lies at the ends of long copies.
4. Joins of consecutive pieces give the links of the graph. A link between a piece with
   one successor and a piece with one predecessor does not branch, and such links are
   compacted to paths: one row for a long copied passage, with its source coordinates.
5. Spans (paths, and the verified windows beside them) are joined to the texts once.

A frequent passage is counted by partial sums, and joins are between written tables, so
Spark splits them where a piece occurs very often.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHashes, mixed, text_slices
from .components import removed, written

WIDTH = 35
# Words of a sampled k-mer: a power of two.
SEED = 8
# A piece has at most ``width - SEED + 1`` windows, which must be bits of a BIGINT.
MAX_WIDTH = 62 + SEED
HASHES = WordHashes()
# Windows a task hands on at a time.
HELD_WINDOWS = 100_000
PIECE = "at int, n int, seed bigint, digest bigint"


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def row_key(key: str, text: str) -> Column:
    """Sixteen bytes for a row's key and text: equal rows share them."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    named = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")
    return F.unhex(F.md5(F.concat(named, F.lit(b":"), body)))


def sampled(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of a text's word hashes: first window, number of windows, and the hash of the k-mer they share.

    The sampled k-mer of a window is the one with the least hash, the leftmost of equal ones.
    """
    grams, size = h, 1
    while size < SEED:
        grams = mixed(grams[:-size], grams[size:])
        size *= 2
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span, have = width - SEED + 1, 1
    while have < span:
        step = min(have, span - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    owner = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1])
    counts = np.diff(np.append(starts, len(owner)))
    return starts, counts, grams[owner[starts]]


def pieces(df: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """``(key, at, n, seed, digest)``: the windows ``at .. at + n - 1`` of a row share the seed; the digest is of all their words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for keys, texts in text_slices(batches):
            parts, rows, digests = [], [], []
            for i, t in enumerate(texts):
                words = words_of(t)
                if len(words) < width:
                    continue
                h = HASHES.of(words)
                starts, counts, seeds = sampled(h, width)
                view = memoryview(h.tobytes())
                ends = (starts + counts + (width - 1)) * 8
                digests += [digest(view[a:b]) for a, b in zip((starts * 8).tolist(), ends.tolist())]
                parts.append((starts, counts, seeds))
                rows.append(np.full(len(starts), i))
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(np.concatenate(rows))),
                     pa.array(np.concatenate([p[0] for p in parts]).astype(np.int32)),
                     pa.array(np.concatenate([p[1] for p in parts]).astype(np.int32)),
                     pa.array(np.concatenate([p[2] for p in parts]).view(np.int64)),
                     pa.array(np.array(digests, np.uint64).view(np.int64))],
                    ["key", "at", "n", "seed", "digest"])

    return df.select(row_key(key, text).alias("key"), F.col(f"`{text}`").alias("text")).mapInArrow(run, f"key binary, {PIECE}")


def windows(df: DataFrame, wanted: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """``(seed, window, digest, bit, whole)`` for every window of the wanted pieces, read at their sources; bit ``i`` is a piece's window ``i``.

    ``wanted`` is ``(key, pieces)``, the pieces of a text as an array; a window is named by the digest of its words.
    """

    names = ["seed", "window", "digest", "bit", "whole"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for i in range(batch.num_rows):
                h = HASHES.of(words_of(batch.column(0)[i].as_py()))
                view = memoryview(h.tobytes())
                asked = batch.column(1).slice(i, 1).flatten()
                at, n = asked.field("at").to_numpy(), asked.field("n").to_numpy()
                which = np.repeat(np.arange(len(at)), n)
                place = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
                first = ((at[which] + place) * 8).tolist()
                found = np.array([digest(view[a:a + width * 8]) for a in first], np.uint64)
                take = pa.array(which)
                held.append(pa.RecordBatch.from_arrays(
                    [asked.field("seed").take(take), pa.array(found.view(np.int64)), asked.field("digest").take(take),
                     pa.array(np.int64(1) << place), asked.field("whole").take(take)], names))
                if sum(map(len, held)) >= HELD_WINDOWS:
                    yield pa.concat_batches(held)
                    held = []
        if held:
            yield pa.concat_batches(held)

    texts = df.select(row_key(key, text).alias("key"), F.col(f"`{text}`").alias("text"))
    return texts.join(wanted, "key").select("text", "pieces").mapInArrow(
        run, "seed bigint, window bigint, digest bigint, bit bigint, whole boolean")


def repeated_pieces(df: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """``(key, at, n, seed, digest, copies, mask)``: the pieces with a repeated window; bit ``i`` of ``mask`` is window ``at + i``.

    ``mask`` is null for pieces that occur twice or more, all of whose windows are repeated.
    """
    spark = df.sparkSession
    made, at_made = written(pieces(df, width, key, text), "pieces")
    seeds, at_seeds = written(made.groupBy("seed").agg(
        F.count("*").alias("occurs"), (F.min("digest") < F.max("digest")).alias("branches")).where("occurs > 1").drop("occurs"), "seeds")
    found, at_found = written(made.join(seeds, "seed"), "places")
    removed(spark, at_made)

    # a piece of a seed that does not branch occurs as often as its seed
    several = found.where("branches").groupBy("seed", "digest").agg(
        F.count("*").alias("copies"), F.min(F.struct("key", "at", "n")).alias("source"))
    several, at_several = written(several, "branches")
    single = several.groupBy("seed").agg(F.min("copies").alias("least")).where("least = 1").select("seed")
    single, at_single = written(single, "open")
    wanted = several.join(single, "seed").groupBy("source.key").agg(F.collect_list(F.struct(
        F.col("source.at").alias("at"), F.col("source.n").alias("n"), "seed", "digest", (F.col("copies") > 1).alias("whole"))).alias("pieces"))
    asked, at_asked = written(windows(df, wanted, width, key, text), "windows")
    same, at_same = written(asked.groupBy("seed", "window").agg(
        ((F.min("digest") < F.max("digest")) | F.max("whole")).alias("repeated")).where("repeated").drop("repeated"), "same")
    masks = asked.where("not whole").join(same, ["seed", "window"]).groupBy("seed", "digest").agg(
        F.bit_or("bit").alias("mask"))
    status = several.join(masks, ["seed", "digest"], "left").where("copies > 1 or mask is not null").select("seed", "digest", "copies", "mask")
    status, at_status = written(status, "status")

    plain = found.where("not branches").select("key", "at", "n", "seed", "digest", F.lit(None).cast("bigint").alias("mask"))
    partly = found.where("branches").join(status, ["seed", "digest"]).select(
        "key", "at", "n", "seed", "digest", F.when(F.col("copies") == 1, F.col("mask")).alias("mask"))
    # equal rows share a key, and so their pieces
    result, _ = written(plain.unionByName(partly).distinct(), "repeated")
    for path in (at_seeds, at_found, at_several, at_single, at_asked, at_same, at_status):
        removed(spark, path)
    return result


def repeated_paths(places: DataFrame) -> DataFrame:
    """``(key, at, n, seed, digest, mask)``: wholly repeated pieces compacted along links that do not branch.

    A row is a path in one text: ``n`` windows from ``at`` on, named by its first piece. Texts that run along the same
    links have the same path. Partly repeated pieces are left as they are.
    """
    spark = places.sparkSession
    whole = places.where("mask is null").select("key", "at", "n", F.struct("seed", "digest").alias("piece"))
    in_text = Window.partitionBy("key").orderBy("at")
    beside = F.lag(F.struct("piece", (F.col("at") + F.col("n")).alias("end"))).over(in_text)
    walks, at_walks = written(whole.withColumn("beside", beside).select(
        "key", "at", "n", "piece", F.when(F.col("beside.end") == F.col("at"), F.col("beside.piece")).alias("last")), "walks")
    links = walks.where("last is not null").groupBy("last", "piece").agg(F.count("*").alias("texts"))
    links, at_links = written(links, "links")
    ahead = links.groupBy("last").agg(F.count("*").alias("n")).where("n = 1").select("last")
    behind = links.groupBy("piece").agg(F.count("*").alias("n")).where("n = 1").select("piece")
    straight, at_straight = written(links.join(ahead, "last").join(behind, "piece").select("last", "piece", F.lit(True).alias("goes_on")), "straight")
    joined = walks.join(straight, ["last", "piece"], "left")
    path = F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(in_text.rowsBetween(Window.unboundedPreceding, 0))
    paths = joined.withColumn("path", path).groupBy("key", "path").agg(
        F.min(F.struct("at", "piece")).alias("first"), F.sum("n").cast("int").alias("n"))
    paths = paths.select("key", "first.at", "n", "first.piece.seed", "first.piece.digest", F.lit(None).cast("bigint").alias("mask"))
    result, _ = written(paths.unionByName(places.where("mask is not null").select(*paths.columns)), "paths")
    for at in (at_walks, at_links, at_straight):
        removed(spark, at)
    return result


def covered(n_words: int, at: np.ndarray, n: np.ndarray, masks: list[int | None], width: int) -> np.ndarray:
    """Which words lie in a repeated window."""
    steps = np.zeros(n_words + 1, np.int64)
    for a, k, mask in zip(at.tolist(), n.tolist(), masks):
        if mask is None:
            steps[a] += 1
            steps[a + k + width - 1] -= 1
        else:
            for i in range(k):
                if mask >> i & 1:
                    steps[a + i] += 1
                    steps[a + i + width] -= 1
    return np.cumsum(steps[:-1]) > 0


def without_repeats(
    df: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text", kept_text: bool = False,
) -> DataFrame:
    """``(key, n_words, n_removed, kept_sha256[, kept])``: each row's text without the words of repeated windows.

    Words lie between ASCII white space and are taken as they are. Kept words are joined by a blank; ``kept`` is that
    text. A null text has no words; a text of fewer than ``width`` words has no window and is kept. Rows with equal
    texts, repeated rows among them, are copies of each other. Rows without a key are scanned like others. An empty
    table gives no rows, and other columns are left out.
    """
    if not 2 * SEED <= width <= MAX_WIDTH:
        raise ValueError(f"windows of {2 * SEED} to {MAX_WIDTH} words, not {width}")
    spark = df.sparkSession
    places = repeated_pieces(df, width, key, text)
    spans, _ = written(repeated_paths(places).groupBy("key").agg(F.collect_list(F.struct("at", "n", "mask")).alias("spans")), "spans")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, gone, kept = [], [], []
            for t, spans in zip(batch.column(1), batch.column(2)):
                words = words_of(t.as_py() or "")
                counts.append(len(words))
                if spans.is_valid:
                    own = spans.values
                    out = covered(len(words), own.field("at").to_numpy(), own.field("n").to_numpy(), own.field("mask").to_pylist(), width)
                    gone.append(int(out.sum()))
                    words = [words[i] for i in np.flatnonzero(~out).tolist()]
                else:
                    gone.append(0)
                kept.append(b" ".join(words))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()),
                       pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
            names = [key, "n_words", "n_removed", "kept_sha256"]
            if kept_text:
                columns.append(pa.array([k.decode("utf-8", "surrogatepass") for k in kept]))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"), row_key(key, text).alias("key"))
    kind = df.schema[key].dataType.simpleString()
    more = ", kept string" if kept_text else ""
    return rows.join(spans, "key", "left").select("id", "text", "spans").mapInArrow(
        run, f"`{key}` {kind}, n_words bigint, n_removed bigint, kept_sha256 string{more}")
