"""Live streams: Structured Streaming with keyed state.

The stateful operator only remembers where each stream is and its last bytes,
and hands on every new chunk with that context. Matching is done after it by
the same column expressions as in batch, spread over all tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions import spans as S
from ..operators.rules import horizon_bytes
from ..operators.scan import _Plan, segment_events, split_rules
from ..functions.regex import RuleError
from .batch import CLOSE, RESET, RESTORE, _as_characters, _context, _in_runs

# workers need the two processors below, not an installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Bytes by which rules that look right are reported late: one whole character of context.
HOLD = 8
# Chunks handed on at a time; a stream with very many is never held whole.
YIELD = 256

STITCHED = T.StructType(
    [
        T.StructField("stream_id", T.LongType()),
        T.StructField("epoch", T.LongType()),
        T.StructField("closing", T.BooleanType()),
        T.StructField("base", T.LongType()),
        T.StructField("lo", T.LongType()),
        T.StructField("hi", T.LongType()),
        T.StructField("bytes", T.BinaryType()),
    ]
)
_CARRY = T.StructType(
    [
        T.StructField("next_seq", T.LongType()),
        T.StructField("epoch", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("tail", T.BinaryType()),
    ]
)
_WAITING = T.StructType(
    [
        T.StructField("payload", T.BinaryType()),
        T.StructField("control", T.StringType()),
        T.StructField("offset", T.LongType()),
    ]
)
_SEQ = T.StructType([T.StructField("seq", T.LongType())])


class Stitcher(StatefulProcessor):
    """Put each chunk behind the last bytes of its stream.

    Chunks are taken in ``seq`` order from 0; one that arrives early waits in
    state until the gap before it is filled.
    """

    def __init__(self, keep: int, covers: list[bytes]):
        self.keep, self.covers = keep, covers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.carry = handle.getValueState("carry", _CARRY)
        self.waiting = handle.getMapState("waiting", _SEQ, _WAITING)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for offset, tail in zip(initialState["offset"], initialState["tail"]):
            self.carry.update((0, 0, int(offset), bytes(tail)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        saved = self.carry.get()
        self.next, self.epoch, self.offset, self.tail = saved if saved is not None else (0, 0, 0, b"")
        self.tail = bytes(self.tail)
        self.closed = False
        for batch in rows:
            out: list[tuple] = []
            batch = batch.sort_values("seq")
            for seq, payload, control, offset in zip(batch["seq"], batch["payload"], batch["control"], batch["offset"]):
                seq = int(seq)
                row = (payload if payload is not None else b"", control, None if pd.isna(offset) else int(offset))
                if seq == self.next:
                    self._take(key[0], row, out)
                elif seq > self.next:
                    self.waiting.updateValue((seq,), row)
                if len(out) >= YIELD:
                    yield pd.DataFrame(out, columns=STITCHED.names)
                    out = []
            while self.waiting.exists() and self.waiting.containsKey((self.next,)):
                at = (self.next,)
                row = self.waiting.getValue(at)
                self.waiting.removeKey(at)
                self._take(key[0], row, out)
                if len(out) >= YIELD:
                    yield pd.DataFrame(out, columns=STITCHED.names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=STITCHED.names)
        if self.closed and not self.waiting.exists():
            self.carry.clear()
        else:
            self.carry.update((self.next, self.epoch, self.offset, self.tail))

    def _take(self, stream_id, row, out: list) -> None:
        payload, control, offset = row
        payload = bytes(payload)
        self.next += 1
        self.closed = control == CLOSE
        if control in (RESET, CLOSE, RESTORE):
            out.append(self._segment(stream_id, True, b""))
            self.epoch += 1
            self.offset, self.tail = 0, b""
            if control == RESTORE:
                self.offset = len(payload) if offset is None else offset
                self.tail = self._kept(payload)
            return
        if payload:
            out.append(self._segment(stream_id, False, payload))
            self.offset += len(payload)
            self.tail = self._kept(self.tail + payload)

    def _kept(self, data: bytes) -> bytes:
        """What a later match can hold: the last bytes, and the run of a rule's characters that may go on."""
        at = max(0, len(data) - self.keep)
        for cover in self.covers:
            # rules that look right report up to HOLD bytes late
            for late in range(min(HOLD, len(data)) + 1):
                at = min(at, max(0, len(data[:len(data) - late].rstrip(cover)) - 1))
        return data[at:]

    def _segment(self, stream_id, closing: bool, payload: bytes) -> tuple:
        base = self.offset - len(self.tail)
        return (stream_id, self.epoch, closing, base, self.offset, self.offset + len(payload), self.tail + payload)

    def close(self) -> None:
        pass


class FirstOnly(StatefulProcessor):
    """Single match over a stream's life: the earliest end seen is the only event. Other rules' events pass.

    A row without an end says that the life is over; its state goes, so a stream that is opened again reports again.
    """

    def __init__(self, once: list[int]):
        self.once = once

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.done = handle.getValueState("done", T.StructType([T.StructField("to", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best, ended = None, False
        for batch in rows:
            if key[2] not in self.once:
                yield pd.DataFrame({"stream_id": key[0], "epoch": key[1], "pattern_id": key[2], "start": batch["start"], "end": batch["end"]})
                continue
            ended = ended or bool(batch["end"].isna().any())
            for start, end in batch[["start", "end"]].dropna().itertuples(index=False):
                if best is None or (end, start) < best:
                    best = (int(end), int(start))
        known = self.done.exists()
        if best is not None and not known:
            yield pd.DataFrame([(key[0], key[1], key[2], best[1], best[0])], columns=FIRST.names)
        if ended:
            if known:
                self.done.clear()
        elif best is not None and not known:
            self.done.update((best[0],))

    def close(self) -> None:
        pass


# ``from`` is a Python keyword and does not survive as a row field name
FIRST = T.StructType(
    [
        T.StructField("stream_id", T.LongType()),
        T.StructField("epoch", T.LongType()),
        T.StructField("pattern_id", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _cover_bytes(spark: SparkSession, plan: _Plan) -> bytes:
    """The bytes a match may hold, asked of the JVM's engine once for each."""
    own = spark.sparkContext._jvm.java.util.regex.Pattern.compile(plan.p.flags + plan.p.cover)
    return bytes(b for b in range(256) if own.matcher(chr(b)).matches())


def live_scan(chunks: DataFrame, rules, *, tasks: int | None = None, states: DataFrame | None = None) -> DataFrame:
    """Streaming matches ``(stream_id, epoch, pattern_id, from, to)`` of a streaming chunk table.

    ``chunks`` has ``(stream_id, seq, payload, control)`` with ``seq`` counting
    from 0; control is NULL, ``reset``, ``close`` or ``restore`` (with ``offset``).
    Matches at the end of data are reported by close and reset; a close frees the
    stream's state. Rules without a length bound keep the run of characters a
    match can go on from; they are refused where that may be any byte, as are
    combinations. Starts further back than the rule set's horizon are reported as -1.
    Streams in ``states``, a table as ``carry(..., cut=False)`` saves it, go on from
    there, with chunks that count from 0; rules must not look to the right, since
    ends at the saved position are not held back.
    """
    plain, combos = split_rules(rules)
    if combos:
        raise RuleError("combinations are evaluated on whole haystacks", combos[0].rule.ord)
    horizon = horizon_bytes(plain)
    plans = [_Plan(r, horizon=horizon, cut=False) for r in plain if "Q" not in r.flags]
    once = sorted({p.rule.pattern_id for p in plans if p.first_only})
    if any(p.rule.pattern_id in once and not p.first_only for p in plans):
        raise RuleError("rules of one id must all be single-match, or none", plans[0].rule.ord)
    runs = [p for p in plans if _in_runs(p)]
    keep = _context([p for p in plans if p not in runs]) + HOLD
    covers = [_cover_bytes(chunks.sparkSession, p) for p in runs]
    names = set(chunks.columns)
    rows = chunks.select(
        F.col("stream_id").cast("bigint").alias("stream_id"), F.col("seq").cast("bigint").alias("seq"),
        F.col("payload").cast("binary").alias("payload"),
        (F.col("control") if "control" in names else F.lit(None)).cast("string").alias("control"),
        (F.col("offset") if "offset" in names else F.lit(None)).cast("bigint").alias("offset"),
    )
    stitched = rows.groupBy("stream_id").transformWithStateInPandas(
        statefulProcessor=Stitcher(keep, covers), outputStructType=STITCHED, outputMode="Append", timeMode="None",
        initialState=None if states is None else _saved(states, plans).groupBy("stream_id"))
    # state follows the stream id; the regex work after it need not, so a busy stream is spread out
    work = stitched.repartition(tasks or int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    matched = work.select("stream_id", "epoch", F.inline(_events(plans, once)))
    if not once:
        return matched
    renamed = matched.withColumnsRenamed({"from": "start", "to": "end"})
    first = renamed.groupBy("stream_id", "epoch", "pattern_id").transformWithStateInPandas(
        statefulProcessor=FirstOnly(once), outputStructType=FIRST, outputMode="Append", timeMode="None")
    return first.withColumnsRenamed({"start": "from", "end": "to"})


def _saved(states: DataFrame, plans: list[_Plan]) -> DataFrame:
    late = [p for p in plans if p.p.looks_right]
    if late:
        raise RuleError("a rule that looks to the right cannot go on from a saved state", late[0].rule.ord)
    return states.select(F.col("stream_id").cast("bigint").alias("stream_id"), "offset", "tail")


def _events(plans: list[_Plan], once: list[int]):
    text = F.decode("bytes", "ISO-8859-1")
    zero = F.lit(0).cast("bigint")

    def on(lo, hi, group: list[_Plan], open_end: bool):
        raw = [p for p in group if not p.rule.utf8]
        utf = [p for p in group if p.rule.utf8]

        def both(seg):
            parts = [segment_events(seg, raw, open_end)] if raw else []
            if utf:
                parts.append(S.let(_as_characters(seg), lambda c: segment_events(c, utf, open_end)))
            return F.concat(*parts) if parts else S.no_events()

        return S.let(S.segment(F.col("base"), lo, hi, text), both)

    settled = [p for p in plans if not p.p.looks_right]
    waiting = [p for p in plans if p.p.looks_right]
    late = F.greatest(F.col("lo") - HOLD, zero)
    while_open = F.concat(on(F.col("lo"), F.col("hi"), settled, True), on(late, F.greatest(F.col("hi") - HOLD, zero), waiting, True))
    at_close = on(late, F.col("hi"), waiting, False)
    if once:
        # tells the state of single matches that the life is over
        over = F.array(*[F.struct(F.lit(i).alias("pattern_id"), F.lit(None).alias("from"), F.lit(None).alias("to")) for i in once])
        at_close = F.concat(at_close, over.cast(S.EVENT))
    return F.when(F.col("closing"), at_close).otherwise(while_open)
