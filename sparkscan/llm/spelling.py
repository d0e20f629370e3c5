"""Spelling variants: words one edit apart, by dynamic programming along sorted lists.

Counting comes first: occurrences are added up in each task before they are
shuffled, so a frequent word is no hot key, and all that follows works on the
vocabulary of words with enough occurrences.

Two words one edit apart have a first place where they differ. Each word is
listed under everything but one region of it: a pair whose first difference lies in
the region shares the rest, hence the list. The region is half the word at first;
lists over ``MAX_LIST`` are dealt anew with regions of half the size, down to one code
point, where a list holds no more words than the alphabet has letters. A pair is taken
from the one list in whose region its first difference lies, so it is found once.

In a list, words are sorted and read one after another, each against all words of the
list at once. Rows of the edit matrix, a band of three cells, are kept for every
depth; the next word reuses the rows of the prefix it shares with the one before
(their LCP). Words that are further than one edit from a prefix leave at its depth, and
where none is left all words with that prefix are skipped.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_slices
from .components import removed, written

# What a word is made of, and which words are looked at.
RUNS = "[A-Za-zÀ-ÿ]"
CHANGED = 199
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
# Words in one list; larger ones are dealt anew.
MAX_LIST = 20_000
# Words a task counts before it hands them on.
HELD_WORDS = 500_000
FAR = np.uint8(9)


def occurrences(df: DataFrame, key: str, text: str, min_length: int = MIN_LENGTH) -> DataFrame:
    """``(word, n)``: partial counts of the words of at least ``min_length`` code points.

    A run whose crc32 with its row's key is divisible by ``CHANGED`` loses the code point the contract names. A row
    without a key counts with an empty one.
    """
    # a shorter run stays too short when a code point goes
    runs = re.compile(f"{RUNS}{{{min_length},}}")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return made

        for keys, texts in text_slices(batches):
            for k, t in zip(keys.to_pylist(), texts):
                # lower() of bytes changes A-Z alone
                lowered = t.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                start = zlib.crc32(b":" if k is None else f"{k}:".encode())
                for word, n in Counter(runs.findall(lowered)).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % CHANGED == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    held[word] += n
            if len(held) >= HELD_WORDS:
                yield out()
        if held:
            yield out()

    return df.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(run, "word string, n bigint")


def vocabulary(df: DataFrame, key: str, text: str, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of the words that occur at least ``min_count`` times; written."""
    counted = occurrences(df, key, text).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return written(counted, "vocabulary")[0]


LIST = ("size", "a", "b", "rest")


def _rest() -> Column:
    """A word without region ``[a, b)``: what words of ``size`` code points, or one more, share if they first differ in it."""
    return F.concat(F.left("word", F.col("a")), F.lit("|"), F.right("word", F.greatest(F.col("size") - F.col("b"), F.lit(0))))


def listed(words: DataFrame) -> DataFrame:
    """Every word under each of its lists: ``(size, a, b, rest, word, n)``.

    ``size`` is the length of the shorter word of the pairs looked for, so a word is listed for its own length and for
    the one below. A first difference lies at one of ``size + 1`` places; ``[a, b)`` is one half of them.
    """
    n = F.length("word")
    sized = words.select("word", "n", F.explode(F.array(n, n - 1)).alias("size")).where(F.col("size") >= MIN_LENGTH)
    middle = F.floor(F.col("size") / 2).cast("int")
    both = F.array(F.struct(F.lit(0).alias("a"), middle.alias("b")), F.struct(middle.alias("a"), (F.col("size") + 1).alias("b")))
    return sized.select("word", "n", "size", F.inline(both)).select(*LIST[:3], _rest().alias("rest"), "word", "n")


def dealt_anew(lists: DataFrame) -> DataFrame:
    """The same words under lists with regions of half the size."""
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    both = F.array(F.struct(F.col("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b")))
    halves = lists.select("word", "n", "size", F.inline(both))
    return halves.select(*LIST[:3], _rest().alias("rest"), "word", "n")


def near_in_list(words: list[str], size: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(i, j)`` of indexes of sorted words one edit apart whose shorter word has ``size`` code points and whose
    first difference lies in ``[a, b)``. All words share their first ``a`` code points.

    Word ``j`` is read code point by code point against all words at once; ``D[d][e]`` is the distance of its first ``d``
    code points from the first ``e`` of another, for ``e`` from ``d - 1`` to ``d + 1``.
    """
    count = len(words)
    lengths = np.array([len(w) for w in words])
    width = size + 4
    codes = np.zeros((count, width), np.int32)
    for i, w in enumerate(words):
        codes[i, :len(w)] = np.frombuffer(w.encode("utf-32-le"), np.int32)
    # how many code points a word shares with the one before
    differ = codes[1:] != codes[:-1]
    shared = np.append(0, differ.argmax(1))
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    # for each depth from a on: the words still within one edit, and their three cells
    rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = [(
        np.arange(count), np.full(count, 1, np.uint8) if a else np.full(count, FAR), np.zeros(count, np.uint8), np.ones(count, np.uint8))]
    j = 0
    skip = None
    while j < count:
        if skip is not None:
            # all that share the prefix no word is near to
            while j < count and shared[j] > skip:
                j += 1
            skip = None
            if j == count:
                break
        own, n = codes[j], int(lengths[j])
        # the smallest LCP since the word whose rows are held is that of the prefix they still stand for
        del rows[max(1, int(shared[j]) - a + 1):]
        for d in range(a + len(rows) - 1, n):
            alive, lo, mid, hi = rows[-1]
            c = own[d]
            before = codes[alive, d - 1] if d else np.full(len(alive), -1)
            new_lo = np.minimum(lo + (before != c), mid + 1) if d else mid + np.uint8(1)
            new_mid = np.minimum(np.minimum(mid + (codes[alive, d] != c), hi + 1), new_lo + 1)
            new_hi = np.minimum(hi + (codes[alive, d + 1] != c), new_mid + 1)
            near = np.minimum(np.minimum(new_lo, new_mid), new_hi) <= 1
            rows.append((alive[near], new_lo[near].astype(np.uint8), new_mid[near].astype(np.uint8), new_hi[near].astype(np.uint8)))
            if not near.any():
                skip = d
                break
        else:
            alive, *cells = rows[-1]
            by = lengths[alive] - n
            for shift, cell in zip((-1, 0, 1), cells):
                hit = alive[(by == shift) & (cell == 1)]
                if len(hit) and min(n, n + shift) == size:
                    place = (codes[hit] != own).argmax(1)
                    hit = hit[(place >= a) & (place < b)]
                    left.append(np.full(len(hit), j))
                    right.append(hit)
        j += 1
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def near_words(lists: DataFrame) -> DataFrame:
    """``(word, n_near, best)`` for the words of each list that have near ones there; ``best`` is ``(-n, word)`` of the best of them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for group in batch.to_pylist():
                members = sorted((m["word"], m["n"]) for m in group["words"])
                words, counts = [m[0] for m in members], np.array([m[1] for m in members])
                at, near = near_in_list(words, group["size"], group["a"], group["b"])
                if not len(at):
                    continue
                # sorted words: the smallest of equal counts is the one with the smallest index
                order = np.lexsort((near, -counts[near], at))
                at, near = at[order], near[order]
                first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                out[0].extend(words[i] for i in at[first].tolist())
                out[1].extend(np.diff(np.append(first, len(at))).tolist())
                out[2].extend((-counts[near[first]]).tolist())
                out[3].extend(words[i] for i in near[first].tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())],
                ["word", "n_near", "minus", "best"])

    return lists.mapInArrow(run, "word string, n_near bigint, minus bigint, best string")


def neighbours(words: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """``(word, n_near, minus, best)`` of all words ``(word, n)`` with a near one: how many, and the best by count, then code points."""
    spark = words.sparkSession
    found, paths = None, []

    def kept(df: DataFrame, label: str) -> DataFrame:
        made, path = written(df, label)
        paths.append(path)
        return made

    lists = kept(listed(words), "lists")
    while True:
        sizes = kept(lists.groupBy(*LIST).agg(F.count("*").alias("words")).where("words > 1"), "sizes")
        # a region of one place can't be halved; its list is bounded by the alphabet
        ready = (F.col("words") <= max_list) | (F.col("b") - F.col("a") <= 1)
        whole = lists.join(sizes.where(ready), list(LIST)).groupBy(*LIST).agg(F.collect_list(F.struct("word", "n")).alias("words"))
        part = kept(near_words(whole), "near")
        found = part if found is None else found.unionByName(part)
        large = sizes.where(~ready).select(*LIST)
        if large.isEmpty():
            break
        lists = kept(dealt_anew(lists.join(large, list(LIST), "left_semi")), "lists")
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("minus", "best")).alias("m"))
    result, _ = written(best.select("word", "n_near", "m.minus", "m.best"), "neighbours")
    for path in paths:
        removed(spark, path)
    return result


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of links ``(word, form)``: the last form reached. Every round halves what is left of a chain.

    A form occurs ``RATIO`` times as often as its word, so chains are as short as the logarithm of the largest count.
    """
    spark = forms.sparkSession
    now, path = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved, new = written(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        removed(spark, path)
        path = new
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def spelling_variants(df: DataFrame, key: str = "doc_id", text: str = "text", max_list: int = MAX_LIST) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``: every word, its most frequent near word if that is much more frequent, and where forms lead.

    Words are runs of letters, A-Z in lower case, of at least ``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences;
    two are near if one inserted, deleted or replaced code point makes them equal. A null text has no words; repeated
    rows count each time. Without words there are no rows.
    """
    words = vocabulary(df, key, text)
    near = neighbours(words, max_list)
    known = words.join(near, "word", "left")
    frequent = -F.col("minus") >= RATIO * F.col("n")
    known, _ = written(known.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(frequent, F.col("best")).alias("form"), F.when(frequent, -F.col("minus")).alias("form_n")), "forms")
    last = roots(known.where("form is not null").select("word", "form"))
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
