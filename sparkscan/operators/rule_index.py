"""Large rule sets as data: the texts rules need are searched together and lead to the rules.

Rules of a bounded width that need a text are asked only around its places: a pass over
the bytes finds every place of every needed text, whatever their number, and hands
on the pieces of text in which a rule that needs it can end. Pieces are joined to the
rules' patterns and confirmed. Of other rules, those whose needed text a block holds
are made pairs with the block; rules that need no text (without case, or of classes
alone) are paired with every block.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import asdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import spans as S
from ..functions.cuts import CUT, Cut, cut_events
from ..functions.regex import MAX_LOOKBEHIND, RIGHT_CONTEXT, alternation, quote
from ..functions.tabled import TABLED, Tabled, tabled_events

# Bytes of patterns up to which a rule table is sent to all tasks; a larger one is joined by shuffling the pairs.
SENT_BYTES = 16 << 20
# A text is looked up by its first bytes, the largest number of these that it has.
HEADS = (1, 2, 4, 8)
# Bits of the map that turns most places away before they are looked up.
MAP_BITS = 20
ODD = np.uint64(0x9E3779B97F4A7C15)
# Bytes searched at a time, places looked at together, and bytes of pieces handed on together: those of a rule follow each
# other, so that its pattern is compiled once.
CHUNK = 1 << 16
PLACES = 1 << 17
TOGETHER = 1 << 23
PIECE = T.StructType([
    T.StructField("__rule", T.IntegerType()), T.StructField("__base", T.LongType()), T.StructField("__lo", T.LongType()),
    T.StructField("__hi", T.LongType()), T.StructField("__text", T.BinaryType())])


def longest_at(texts) -> str:
    """Look-ahead capturing the longest text that starts at a position; first characters turn most positions away."""
    first = "".join(quote(c) for c in sorted({t[0] for t in texts}))
    return f"(?d)(?=[{first}])(?=({alternation(texts)}))"


def _members(texts: dict[str, list[int]]) -> Column:
    """From the longest text found at a position to the rules that need it or a text it begins with; one constant."""
    found = {}
    for text in texts:
        found[text] = [i for n in range(1, len(text) + 1) for i in texts.get(text[:n], ())]
    return F.from_json(F.lit(json.dumps(found)), "map<string,array<int>>")


def wanted_rules(text: Column, needed: list[str]) -> Column:
    """Positions in the list of those rules whose needed text the block holds: ``array<int>``."""
    texts: dict[str, list[int]] = {}
    for i, t in enumerate(needed):
        if t:
            texts.setdefault(t, []).append(i)
    always = F.from_json(F.lit(json.dumps([i for i, t in enumerate(needed) if not t])), "array<int>")
    if not texts:
        return always
    pattern = longest_at(texts)
    members = _members(texts)
    # a text within a longer one that starts before it is found at its own position
    hits = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
    named = F.flatten(F.transform(hits, lambda h: F.element_at(members, h)))
    return F.concat(always, F.when(F.rlike(text, F.lit(pattern)), F.array_distinct(named)).otherwise(F.array().cast("array<int>")))


def indexed_events(
    df: DataFrame, view: Column, utf8: bool, rules: list[Tabled] | list[Cut], keys: Sequence[str], block: int,
) -> DataFrame:
    """``(keys, pattern_id, from, to)`` of many rules of one kind."""
    ways: dict[bool, list] = {}
    for r in rules:
        ways.setdefault(isinstance(r, Tabled) and r.near, []).append(r)
    return reduce(DataFrame.unionByName, [
        (_events_at_places if near else _events_of_blocks)(df, view, utf8, group, keys, block) for near, group in ways.items()])


def _table(df: DataFrame, rules: list[Tabled] | list[Cut]) -> DataFrame:
    """The rules as rows ``(__rule, r)``, to be joined."""
    rows = [(i, json.dumps(asdict(r))) for i, r in enumerate(rules)]
    table = df.sparkSession.createDataFrame(rows, "__rule int, json string")
    table = table.select("__rule", F.from_json("json", CUT if isinstance(rules[0], Cut) else TABLED).alias("r"))
    return F.broadcast(table) if sum(len(j) for _, j in rows) <= SENT_BYTES else table


def _events_of_blocks(
    df: DataFrame, view: Column, utf8: bool, rules: list[Tabled] | list[Cut], keys: Sequence[str], block: int,
) -> DataFrame:
    """Each rule is evaluated on every block that holds the text it needs."""
    cuts = isinstance(rules[0], Cut)
    left = 0 if cuts else max(r.width for r in rules) + 1
    pieces = S.whole(view, utf8) if cuts else S.segments(view, utf8, max(block, left), left)
    blocks = df.select(*keys, F.explode(pieces).alias("s"))
    pairs = blocks.select(*keys, "s", F.explode(wanted_rules(F.col("s.text"), [r.needed for r in rules])).alias("__rule"))
    events = cut_events if cuts else tabled_events
    return pairs.join(_table(df, rules), "__rule").select(*keys, F.inline(events(F.col("s"), F.col("r"), utf8)))


def _events_at_places(df: DataFrame, view: Column, utf8: bool, rules: list[Tabled], keys: Sequence[str], block: int) -> DataFrame:
    """Each rule is evaluated around the places of the text it needs; a plain text's places are its events."""
    data = view.cast("binary") if utf8 else F.encode(view, "ISO-8859-1")
    read = df.select(*keys, data.alias("__data"))
    pieces = read.mapInArrow(
        _piece_finder([(r.needed.encode("utf-8" if utf8 else "latin-1"), r.width, r.plain) for r in rules], utf8, block),
        T.StructType([*read.drop("__data").schema.fields, *PIECE.fields]))
    text = F.col("__text").cast("string") if utf8 else S.byte_view(F.col("__text"))
    pieces = pieces.select(*keys, "__rule", S.segment(F.col("__base"), F.col("__lo"), F.col("__hi"), text).alias("s"))
    s, r = F.col("s"), F.col("r")
    event = F.struct(
        r["pattern_id"].cast("int").alias("pattern_id"), F.when(r["report_som"], s["lo"]).otherwise(F.lit(0)).cast("bigint").alias("from"),
        s["hi"].alias("to"))
    found = F.when(r["plain"], F.array(event)).otherwise(tabled_events(s, r, utf8))
    return pieces.join(_table(df, rules), "__rule").select(*keys, F.inline(found))


class Texts:
    """Plain texts, looked up together at every place of a buffer: by their first bytes, then whole."""

    def __init__(self, texts: list[bytes]):
        self.heads = []
        for size in HEADS:
            group = {t: i for i, t in enumerate(texts) if size <= len(t) and (len(t) < 2 * size or size == HEADS[-1])}
            if not group:
                continue
            known = np.zeros(1 << MAP_BITS, bool)
            known[self._slot(np.array([self._number(t[:size]) for t in group], np.uint64))] = True
            by_length: dict[int, list[tuple[bytes, int]]] = {}
            for t, i in group.items():
                by_length.setdefault(len(t), []).append((t, i))
            short, long = [], []
            for n, pairs in by_length.items():
                if n <= HEADS[-1]:
                    numbers, ids = zip(*sorted((self._number(t), i) for t, i in pairs))
                    short.append((n, np.array(numbers, np.uint64), np.array(ids)))
                else:
                    begun = np.array(sorted({self._number(t[:size]) for t, _ in pairs}), np.uint64)
                    long.append((n, begun, dict(pairs)))
            self.heads.append((size, known, short, long))

    @staticmethod
    def _number(text: bytes) -> int:
        return int.from_bytes(text, "little")

    @staticmethod
    def _slot(numbers: np.ndarray) -> np.ndarray:
        return (numbers * ODD) >> np.uint64(64 - MAP_BITS)

    @staticmethod
    def _place(wanted: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Where the numbers stand in the sorted ones; -1 if they don't."""
        k = np.minimum(np.searchsorted(wanted, numbers), len(wanted) - 1)
        return np.where(wanted[k] == numbers, k, -1)

    def find(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the bytes and the number of the text at each, all that overlap among them."""
        padded = np.concatenate([data, np.zeros(HEADS[-1], np.uint8)])
        raw = data.tobytes()
        places, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        # the number made of the bytes that begin at every place
        number_at = lambda size: np.ndarray(len(data), f"<u{size}", padded, 0, (1,))
        for size, known, short, long in self.heads:
            at = np.flatnonzero(known[self._slot(number_at(size).astype(np.uint64))])
            eight = number_at(HEADS[-1])[at]
            for n, wanted, ids in short:
                k = self._place(wanted, eight & np.uint64((1 << 8 * n) - 1))
                found = (k >= 0) & (at <= len(data) - n)  # not in the padding
                places.append(at[found])
                numbers.append(ids[k[found]])
            for n, begun, ids in long:
                begins = at[self._place(begun, eight) >= 0]
                found = np.array([ids.get(raw[p:p + n], -1) for p in begins.tolist()], np.int64)
                places.append(begins[found >= 0])
                numbers.append(found[found >= 0])
        return np.concatenate(places), np.concatenate(numbers)


def _ranges(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts`` a run of its index, and the numbers from 0 in the run."""
    index = np.repeat(np.arange(len(counts)), counts)
    return index, np.arange(len(index)) - np.repeat(np.cumsum(counts) - counts, counts)


def _piece_finder(rules: list[tuple[bytes, int, bool]], utf8: bool, block: int):
    """Function from rows of bytes to the pieces in which a rule ``(needed text, width, plain)`` may end.

    A match holds the text its rule needs, so it ends no more than the rule's width after a place of it (where only ends are
    asked for, no more than a look-behind's). Those ends, of places near each other together, are a piece's range
    ``(lo, hi]``; the characters that a match and its assertions can depend on come along. The places of a plain text are handed on as ``(from, to)``, without text.
    """
    texts = sorted({t for t, _, _ in rules})
    number = {t: i for i, t in enumerate(texts)}
    needs = np.array([number[t] for t, _, _ in rules])
    by_text = np.argsort(needs, kind="stable")
    # characters as bytes
    wide = 4 if utf8 else 1
    size = np.array([len(t) for t, _, _ in rules])
    reach = np.array([min(w, MAX_LOOKBEHIND) for _, w, _ in rules]) * wide
    plain = np.array([p for _, _, p in rules])

    def pieces(data: np.ndarray, ends: np.ndarray, a: int, b: int, index: Texts) -> Iterator[tuple[np.ndarray, ...]]:
        """Rules, rows and ranges of the ends in ``(a, b]`` of the rows' bytes, which are one buffer; a bounded number of rules at a time."""
        start = max(a - int(reach.max()), 0)
        at, text = index.find(data[start:b])
        order = np.lexsort((at, text))
        at = at[order] + start
        n = np.bincount(text, minlength=len(texts))
        begin = np.cumsum(n) - n
        live = by_text[n[needs[by_text]] > 0]
        total = np.cumsum(n[needs[live]])
        for some in np.split(live, np.flatnonzero(np.diff(total // PLACES)) + 1):
            of, k = _ranges(n[needs[some]])
            yield ranges_of(some[of], at[begin[needs[some]][of] + k], ends, a, b)

    def ranges_of(rule: np.ndarray, at: np.ndarray, ends: np.ndarray, a: int, b: int) -> tuple[np.ndarray, ...]:
        """Ranges from places in order, rule after rule."""
        row = np.searchsorted(ends, at, "right")
        inside = at + size[rule] <= np.minimum(ends[row], b)
        rule, at, row = rule[inside], at[inside], row[inside]
        # the first end of a place and the last; ranges that touch are one, a plain text's are one by one
        lo, hi = at + size[rule] - 1, np.minimum(at + reach[rule], ends[row])
        hi = np.where(plain[rule], lo + 1, hi)
        new = np.ones(len(rule), bool)
        new[1:] = (rule[1:] != rule[:-1]) | (row[1:] != row[:-1]) | (lo[1:] > hi[:-1]) | plain[rule[1:]]
        heads = np.flatnonzero(new)
        last = np.append(heads[1:], len(rule))[:len(heads)] - 1
        rule, row, lo, hi = rule[heads], row[heads], np.maximum(lo[heads], a), np.minimum(hi[last], b)
        some = lo < hi
        rule, row, lo, hi = rule[some], row[some], lo[some], hi[some]
        of, k = _ranges(-((lo - hi) // block))
        rule, row, lo, hi = rule[of], row[of], lo[of] + k * block, np.minimum(hi[of], lo[of] + (k + 1) * block)
        return rule, row, lo, hi

    def batch_of(batch: pa.RecordBatch, data: np.ndarray, begins: np.ndarray, ends: np.ndarray, parts: list) -> pa.RecordBatch:
        rule, row, lo, hi = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(rule, kind="stable")
        rule, row, lo, hi = rule[order], row[order], lo[order], hi[order]
        direct = plain[rule]
        start = np.maximum(lo - reach[rule] - 2 * wide, begins[row])
        stop = np.minimum(hi + RIGHT_CONTEXT * wide, ends[row])
        if utf8:
            for _ in range(wide - 1):  # whole characters
                start += (start < stop) & (data[np.minimum(start, len(data) - 1)] & 0xC0 == 0x80)
                stop -= (stop < ends[row]) & (data[np.minimum(stop, len(data) - 1)] & 0xC0 == 0x80)
        length = np.where(direct, 0, stop - start)
        of, k = _ranges(length)
        offsets = np.append(0, np.cumsum(length)).astype(np.int32)
        text = pa.Array.from_buffers(pa.binary(), len(rule), [None, pa.py_buffer(offsets), pa.py_buffer(data[start[of] + k])])
        base, origin = np.where(direct, 0, start - begins[row]), begins[row]
        lo = np.where(direct, hi - size[rule], lo)
        return pa.RecordBatch.from_arrays(
            [*(c.take(pa.array(row)) for c in batch.columns[:-1]), pa.array(rule, pa.int32()), pa.array(base, pa.int64()),
             pa.array(lo - origin, pa.int64()), pa.array(hi - origin, pa.int64()), text],
            [*batch.schema.names[:-1], *PIECE.names])

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Texts(texts)
        for batch in batches:
            column = batch.column(batch.num_columns - 1).cast(pa.large_binary()).fill_null(b"")
            if not batch.num_rows:
                continue
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
            begins, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
            data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
            parts, n = [], 0
            for a in range(0, len(data), CHUNK):
                for part in pieces(data, ends, a, min(a + CHUNK, len(data)), index):
                    parts.append(part)
                    rule, _, lo, hi = part
                    n += int((hi - lo + 2 * reach[rule]).sum()) + 32 * len(rule)
                    if n >= TOGETHER:
                        yield batch_of(batch, data, begins, ends, parts)
                        parts, n = [], 0
            if n:
                yield batch_of(batch, data, begins, ends, parts)

    return find
