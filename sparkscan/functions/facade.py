"""Regex helpers on columns: match tests, find, split, segments.

Matches are leftmost-first and non-overlapping; offsets are bytes of the UTF-8
text. Every helper is a built-in expression, usable in select, where or SQL plans.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import spans as S
from .regex import Prepared, RuleError, prepare

MATCH = "struct<from:bigint,to:bigint,text:string>"


class Regex:
    """A compiled expression with the usual options; texts are UTF-8."""

    def __init__(
        self, expression: str, *, case_insensitive: bool = False, multi_line: bool = False,
        dot_matches_new_line: bool = False, unicode: bool = False,
    ):
        flags = {"8"}
        flags |= {"i"} if case_insensitive else set()
        flags |= {"m"} if multi_line else set()
        flags |= {"s"} if dot_matches_new_line else set()
        flags |= {"W"} if unicode else set()
        self.expression = expression
        self.p: Prepared = prepare(expression, flags, kind="pcre")
        if self.p.min_width == 0:
            raise RuleError("pattern matches empty buffer")

    def is_match(self, text: Column) -> Column:
        return S.gate(text, self.p)

    def _matches(self, text: Column) -> Column:
        return S.matches(text, self.p.java, True, matching=S.gate(text, self.p))

    def find(self, text: Column) -> Column:
        """First match or NULL. Both expressions stop at it; the rest of the text is not searched."""
        java = self.p.java

        def first(v: Column) -> Column:
            def placed(m: Column) -> Column:
                start, found = m["start"], m["found"]
                return self._cut(text, start, start + F.octet_length(found))

            both = F.struct(
                F.octet_length(F.split(v, java, 2)[0]).alias("start"), F.regexp_extract(v, java, 0).alias("found"))
            return F.when(S.gate(v, self.p), S.let(both, placed))

        return S.let(S.char_view(text), first)

    def find_iter(self, text: Column) -> Column:
        """All matches. Their texts are those of the view; only where it has stand-ins for markers they are cut from the column."""
        both = F.struct(
            S.let(S.char_view(text), self._matches).alias("ms"), F.when(S.has_marks(text), text.cast("binary")).alias("raw"))

        def placed(b: Column) -> Column:
            return F.transform(b["ms"], lambda m: self._placed(
                m["from"], m["to"], F.when(b["raw"].isNull(), m["text"]).otherwise(self._piece(b["raw"], m["from"], m["to"]))))

        return S.let(both, placed)

    @staticmethod
    def _piece(raw: Column, start: Column, end: Column) -> Column:
        """A range of the text's bytes as text. ``raw`` is the bytes themselves: a cast here would copy them for every match."""
        return F.substring(raw, start.cast("int") + 1, (end - start).cast("int")).cast("string")

    @staticmethod
    def _placed(start: Column, end: Column, text: Column) -> Column:
        return F.struct(start.cast("bigint").alias("from"), end.cast("bigint").alias("to"), text.alias("text"))

    def _cut(self, text: Column, start: Column, end: Column) -> Column:
        """A match with its text as it is in the column, whatever stands in for markers in the view."""
        return self._placed(start, end, self._piece(text.cast("binary"), start, end))

    def split(self, text: Column) -> Column:
        return F.split(text, self.p.java, -1)

    def splitn(self, text: Column, limit: int) -> Column:
        if limit == 0:
            return F.array().cast("array<string>")
        return F.split(text, self.p.java, limit)

    def segments(self, text: Column) -> Column:
        """Alternating match / reject ranges that cover the text, without empty ones."""

        def part(kind: str, start: Column, end: Column) -> Column:
            return F.struct(F.lit(kind).alias("kind"), start.cast("bigint").alias("from"), end.cast("bigint").alias("to"))

        def cover(s: Column) -> Column:
            ms, n = s["ms"], s["n"]
            ends = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(ms, lambda m: m["to"]))
            pairs = S.let(ends, lambda es: F.flatten(F.transform(ms, lambda m, i: F.array(
                part("reject", es[i], m["from"]), part("match", m["from"], m["to"])))))
            last = F.when(F.size(ms) > 0, F.element_at(F.transform(ms, lambda m: m["to"]), F.greatest(F.size(ms), F.lit(1)))).otherwise(0)
            return F.filter(F.concat(pairs, F.array(part("reject", last, n))), lambda p: p["to"] > p["from"])

        def build(v: Column) -> Column:
            return S.let(F.struct(self._matches(v).alias("ms"), F.octet_length(v).alias("n")), cover)

        both = F.struct(S.let(S.char_view(text), build).alias("parts"), text.cast("binary").alias("raw"))
        return S.let(both, lambda b: F.transform(b["parts"], lambda p: F.struct(
            p["kind"], p["from"], p["to"], self._piece(b["raw"], p["from"], p["to"]).alias("text"))))


def start(match: Column) -> Column:
    return match["from"]


def end(match: Column) -> Column:
    return match["to"]


def span(match: Column) -> Column:
    return F.struct(match["from"], match["to"])


def as_str(match: Column) -> Column:
    return match["text"]
