"""Operators on match events: limits, suppression, handlers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .scan import apply_horizon, event_arrays

ORDER = ("to", "pattern_id", "from")


def _first(matches: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    # rank <= n lets Spark keep n rows per key and task before the shuffle, so a
    # haystack with very many events does not reach one task whole
    at = Window.partitionBy(*keys).orderBy(*[c for c in ORDER if c not in keys])
    return matches.withColumn("__n", F.row_number().over(at)).where(F.col("__n") <= n).drop("__n")


def terminate(matches: DataFrame, after: int = 1, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Events up to the one at which the handler stops the haystack's scan."""
    return _first(matches, keys, after)


def skip_rule(matches: DataFrame, after: int = 1, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Events up to the one at which the handler goes on with the next rule."""
    return _first(matches, [*keys, "pattern_id"], after)


def single_match(matches: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One event per rule id: the earliest end. Partial aggregation keeps one row per key and task."""
    least = F.min(F.struct(F.col("to"), F.col("from"))).alias("m")
    return matches.groupBy(*keys, "pattern_id").agg(least).select(*keys, "pattern_id", F.col("m.from"), F.col("m.to"))


def within(
    matches: DataFrame, *, min_offset: int | None = None, max_offset: int | None = None, min_length: int | None = None
) -> DataFrame:
    """Extended constraints on events that already exist (starts must be known for ``min_length``)."""
    out = matches
    if min_offset is not None:
        out = out.where(F.col("to") >= min_offset)
    if max_offset is not None:
        out = out.where(F.col("to") <= max_offset)
    if min_length is not None:
        out = out.where(F.col("to") - F.col("from") >= min_length)
    return out


Handler = Callable[[pd.DataFrame], pd.Series]
# What a handler may answer.
SKIP, TERMINATE = "skip", "terminate"
EVENT_COLUMNS = ("pattern_id", "from", "to")
# A handler is asked about so many events at once, and the rest of a haystack.
HANDLED = 1 << 17


def _first_places(rows: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """For each event, the place of the first hit of its row group, or a place after all; groups are numbered."""
    places = np.full(rows.max() + 1 if len(rows) else 0, len(rows), np.int64)
    np.minimum.at(places, rows[hit], np.flatnonzero(hit))
    return places[rows]


def handled_scan(
    df: DataFrame, rules, handler: Handler, *, payload: str = "text", keys: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Scan with a handler that answers continue / skip / terminate for every event: ``(keys, pattern_id, from, to)``.

    A haystack's events come as one array in order; the handler is asked once for
    many whole haystacks, with ``(pattern_id, from, to)``, and a haystack's events end
    at its first terminate, a rule's at its first skip. Events stay Arrow and numpy
    arrays. One pass over the haystacks: nothing is written, shuffled or joined.
    """
    found = event_arrays(df, rules, payload=payload, keys=keys)
    names = list(keys)
    fields = [found.schema[k] for k in names] + [
        T.StructField("pattern_id", T.IntegerType()), T.StructField("from", T.LongType()), T.StructField("to", T.LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(batch.column("events").value_lengths().to_numpy(zero_copy_only=False))
            for part in _parts(batch, ends):
                listed = part.column("events")
                rows = np.repeat(np.arange(part.num_rows), listed.value_lengths().to_numpy(zero_copy_only=False))
                flat = listed.flatten()
                events = pd.DataFrame({c: flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in EVENT_COLUMNS})
                answers = np.asarray(handler(events), object)
                at = np.arange(len(events))
                rule = pd.DataFrame({"row": rows, "rule": events["pattern_id"]}).groupby(["row", "rule"]).ngroup().to_numpy()
                kept = (at <= _first_places(rows, answers == TERMINATE)) & (at <= _first_places(rule, answers == SKIP))
                own = pa.array(rows[kept])
                yield pa.RecordBatch.from_arrays(
                    [part.column(k).take(own) for k in names] + [flat.field(c).filter(pa.array(kept)) for c in EVENT_COLUMNS],
                    names=[*names, *EVENT_COLUMNS])

    return found.mapInArrow(run, T.StructType(fields))


def _parts(batch: pa.RecordBatch, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A batch in parts of whole haystacks, with about ``HANDLED`` events each, so that memory is that of a part; ``ends`` counts events up to each haystack."""
    cuts = np.flatnonzero(np.diff(ends // HANDLED)) + 1
    for first, last in zip([0, *cuts], [*cuts, batch.num_rows]):
        if last > first:
            yield batch.slice(first, last - first)


def handle_matches(matches: DataFrame, action: Column, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Apply a per-event handler that answers continue / skip / terminate.

    Each event is kept when no earlier event of its haystack answered terminate
    and no earlier event of its rule answered skip. Events and answers are
    written to the shared folder once, so the haystacks are scanned and the
    handler is asked once; the first such answers, a row per haystack and rule,
    are joined back to them.
    """
    marked = stored(matches.withColumn("__action", action), "handled")
    marked = marked.withColumn("__at", F.struct(*[F.col(c) for c in ORDER]))
    first = marked.groupBy(*keys, "pattern_id").agg(
        F.min(F.when(F.col("__action") == "terminate", F.col("__at"))).alias("__stop"),
        F.min(F.when(F.col("__action") == "skip", F.col("__at"))).alias("__skip"))
    first = first.withColumn("__stop", F.min("__stop").over(Window.partitionBy(*keys)))
    first = first.where(F.col("__stop").isNotNull() | F.col("__skip").isNotNull())
    return (
        marked.join(first, [*keys, "pattern_id"], "left")
        .where(F.col("__stop").isNull() | (F.col("__at") <= F.col("__stop")))
        .where(F.col("__skip").isNull() | (F.col("__at") <= F.col("__skip")))
        .select(*matches.columns)
    )


__all__ = ["apply_horizon", "handle_matches", "handled_scan", "single_match", "skip_rule", "terminate", "within"]
