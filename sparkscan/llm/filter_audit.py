"""Filter interaction audit: contractions of a contingency tensor.

Every document fails or passes each of a few filters, so a part of the corpus
is fully described by the counts of its ``2 ** k`` outcomes: a tensor with one
axis of length 2 (pass, fail) for each filter. Whatever order the filters are
applied in, a step's figures are that tensor contracted with one vector an axis:
``pass`` for the filters applied before, ``pass`` or ``fail`` for the step's own,
``all`` for those still to come. The texts are read once, for any number of orders.

Spark makes the tensors: outcomes of a text come from column expressions, and
whether an equal text has a smaller key from the least key of each text's
digest. Rows are counted by key and digest before they are joined, and joined on
both, so neither a group of many copies nor a key with many rows is a hot task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import permutations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES
from .components import removed, written

# The axes of a tensor; orders and rows grow with the factorial of their number.
MAX_FILTERS = 6
# Parts whose tensors are contracted together.
PART_BLOCK = 128
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
MEASURES = ("n", "good", "toxic")
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


class Filters(NamedTuple):
    """Columns measured on column ``text`` (never null) and, by letter, when those fail a filter."""

    measures: dict[str, Column]
    failures: dict[str, Column]


def text_filters() -> Filters:
    """Filters A to D: length, repetition, capitals, signs."""
    body = F.col("text")
    words = F.array_remove(F.split(body, SPACES), "")
    measures = {
        "words": F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")))[0],
        "capitals": F.octet_length(F.regexp_replace(body, "[^A-Z]+", "")),
        "chars": F.length(body),
        "signs": body.rlike(r"[#$%&*|]"),
    }
    n, distinct = F.col("words.n"), F.col("words.distinct")
    return Filters(measures, {
        "A": n < 100,
        "B": 100 * distinct.cast("bigint") < 80 * n.cast("bigint"),
        "C": 100 * F.col("capitals").cast("bigint") > 10 * F.col("chars").cast("bigint"),
        "D": F.col("signs"),
    })


def _code(failures: dict[str, Column]) -> Column:
    code = F.lit(0)
    for k, failed in enumerate(failures.values()):
        code = code + F.when(failed, 1 << k).otherwise(0)
    return code.cast("int")


def outcomes(
    df: DataFrame, labels: DataFrame, filters: Filters, *, key: str = "doc_id", text: str = "text", part: str = "lang",
) -> DataFrame:
    """Documents of each outcome: ``(part, code, n, good, toxic)``, at most ``2 ** (filters + 1)`` rows a part.

    Bit ``k`` of ``code`` says that filter ``k`` of ``filters`` fails; the bit after them that the text equals that of a
    smaller key. A null text is empty and equals an empty one; a null part is the empty string. Rows of one key and
    text are as many documents, none of which is smaller than another. A row without a key has no smaller one and no
    label. A key is good or toxic if any of its label rows says so. An empty table has no outcomes.
    """
    spark = df.sparkSession
    last = 1 << len(filters.failures)
    rows = df.select(
        F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    rows = rows.select("id", "part", digest, *[m.alias(n) for n, m in filters.measures.items()])
    rows = rows.select("id", "part", "digest", _code(filters.failures).alias("code"))
    # both tables below are read from it, so texts are read once
    rows, at_rows = written(rows.groupBy("id", "part", "digest", "code").agg(F.count("*").alias("n")), "outcomes")
    first = rows.where(F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    marks = labels.select(F.col(f"`{key}`").alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    marks = marks.where(F.col("id").isNotNull() & (F.col("good") | F.col("toxic"))).groupBy("id").agg(
        F.max(F.coalesce("good", F.lit(False))).alias("good"), F.max(F.coalesce("toxic", F.lit(False))).alias("toxic"))
    marks, at_marks = written(marks, "marks")
    copied = F.col("id").isNotNull() & F.col("first").isNull()
    known = rows.join(first, ["digest", "id"], "left").select(
        "id", "part", "n", (F.col("code") + F.when(copied, last).otherwise(0)).alias("code"))
    # what a key's rows have in common is counted before its labels are looked up
    known = known.groupBy("id", "part", "code").agg(F.sum("n").alias("n")).join(marks, "id", "left")
    tally = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    found, _ = written(known.groupBy("part", "code").agg(F.sum("n").alias("n"), tally("good"), tally("toxic")), "tensors")
    removed(spark, at_rows)
    removed(spark, at_marks)
    return found


@lru_cache(maxsize=4)
def selectors(filters: str) -> tuple[list[tuple[str, int]], dict[str, list[np.ndarray]], np.ndarray]:
    """Every (order, step), the vectors each figure's contraction takes along each axis, and the filter of each step."""
    steps, own = [], []
    kinds: dict[str, list[list[tuple[int, int]]]] = {k: [] for k in ("kept", "removed", "failing", "unique")}
    for order in permutations(range(len(filters))):
        name = "".join(filters[k] for k in order)
        for at, this in enumerate(order):
            before = set(order[:at])
            steps.append((name, at + 1))
            own.append(this)
            axes = range(len(filters))
            kinds["kept"].append([PASS if k in before or k == this else ALL for k in axes])
            kinds["removed"].append([FAIL if k == this else PASS if k in before else ALL for k in axes])
            kinds["failing"].append([FAIL if k == this else ALL for k in axes])
            kinds["unique"].append([FAIL if k == this else PASS for k in axes])
    vectors = {k: [np.array([row[a] for row in rows], np.int64) for a in range(len(filters))] for k, rows in kinds.items()}
    return steps, vectors, np.array(own)


def contracted(tensors: np.ndarray, vectors: list[np.ndarray]) -> np.ndarray:
    """``tensors[part, measure, 2, ..., 2]`` with one vector an axis for every step: ``[part, measure, step]``."""
    axes = "abcdefgh"[:len(vectors)]
    # one axis after another, the last first: each step's partial result only gets smaller
    found = np.einsum(f"pm{axes},s{axes[-1]}->pms{axes[:-1]}", tensors, vectors[-1])
    for k in range(len(vectors) - 2, -1, -1):
        found = np.einsum(f"pms{axes[:k + 1]},s{axes[k]}->pms{axes[:k]}", found, vectors[k])
    return found


def figures(tensors: np.ndarray, filters: str) -> dict[str, np.ndarray]:
    """The figures of all steps, each ``[part, step]``, of count tensors ``[part, measure, 2, ..., 2]``."""
    _, vectors, own = selectors(filters)
    gone = contracted(tensors, vectors["removed"])
    counts = tensors[:, :1]
    failing = contracted(counts, vectors["failing"])[:, 0]
    share = np.stack([gone[:, 0, own == k].sum(1) for k in range(len(filters))], 1)
    return {
        "kept": contracted(counts, vectors["kept"])[:, 0],
        "removed": gone[:, 0],
        "redundant": failing - gone[:, 0],
        "unique_fails": contracted(counts, vectors["unique"])[:, 0],
        "good_lost": gone[:, 1],
        "toxic_lost": gone[:, 2],
        "shapley": share[:, own],
    }


def audit(counts: DataFrame, filters: str) -> DataFrame:
    """Figures of every part, order and step from outcome counts ``(part, code, n, good, toxic)``.

    ``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``; ``filters``
    has one letter for each bit of ``code``. A part is one row of at most ``2 ** len(filters)`` counts. No counts, no rows.
    """
    if not 1 <= len(filters) <= MAX_FILTERS or len(set(filters)) != len(filters):
        raise ValueError(f"one to {MAX_FILTERS} filters of different letters, not {filters!r}")
    width = 1 << len(filters)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = selectors(filters)[0]
        orders, numbers = [s[0] for s in steps], np.array([s[1] for s in steps], np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, PART_BLOCK):
                piece = batch.slice(at, PART_BLOCK)
                # bit 0 of a code is the first filter, so the last axis varies slowest
                flat = np.zeros((piece.num_rows, len(MEASURES), width), np.int64)
                for p, cells in enumerate(piece.column(1).to_pylist()):
                    for c in cells:
                        flat[p, :, c["code"]] = [c[m] for m in MEASURES]
                tensors = flat.reshape(-1, len(MEASURES), *[2] * len(filters))
                tensors = tensors.transpose(0, 1, *range(len(filters) + 1, 1, -1))
                found = figures(tensors, filters)
                parts = piece.column(0).take(pa.array(np.repeat(np.arange(piece.num_rows), len(steps))))
                yield pa.RecordBatch.from_arrays(
                    [parts, pa.array(orders * piece.num_rows), pa.array(np.tile(numbers, piece.num_rows)),
                     *[pa.array(found[f].reshape(-1)) for f in FIGURES]],
                    ["part", "filter_order", "step", *FIGURES])

    cells = counts.groupBy("part").agg(F.collect_list(F.struct("code", *MEASURES)).alias("cells"))
    return cells.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{f} bigint" for f in FIGURES))


def filter_audit(df: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Filters A to D of ``text_filters`` and E, equal to a smaller key's text, in all 120 orders: see ``outcomes`` and ``audit``."""
    filters = text_filters()
    return audit(outcomes(df, labels, filters, key=key, text=text, part=part), "".join(filters.failures) + "E")
