"""Rules with a bounded width as rows: one expression evaluates any of them.

Patterns and widths are data, so a plan is as large for two thousand rules as for
two. The JVM's engine keeps a pattern compiled as long as the next row has the same.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import spans as S
from .regex import RIGHT_CONTEXT, Prepared, overlaps_itself, quote


@dataclass(frozen=True)
class Tabled:
    """A rule whose ends are found by marking a block; see ``spans.mark_ends`` and ``spans.matched_before``."""

    pattern_id: int
    som: bool
    report_som: bool
    needed: str
    ends: str
    ends_to: str
    size: int  # bytes of every match, if that is one number; else -1
    width: int
    before: list[str]  # the rule up to 0, 1 or 2 characters before the end of a piece
    looks_right: bool
    near: bool  # needs a text, and a match depends on no more than its width and a character to each side
    plain: bool  # is the text it needs, without constraints
    min_offset: int
    max_offset: int
    min_length: int


COLUMNS = {f.name: {"str": "string", "int": "bigint", "bool": "boolean", "list[str]": "array<string>"}[str(f.type)] for f in fields(Tabled)}
TABLED = "struct<" + ",".join(f"{n}:{t}" for n, t in COLUMNS.items()) + ">"


def encodable(text: str, utf8: bool) -> bool:
    try:
        text.encode("utf-8" if utf8 else "latin-1")
    except UnicodeEncodeError:
        return False
    return True


def tabled(pattern_id: int, p: Prepared, ext: dict, width: int, *, som: bool, report_som: bool, utf8: bool) -> Tabled:
    plain = p.literal and not overlaps_itself(p.literal)
    body = p.java[len(p.flags):]
    needed = p.literal or p.needed
    # marks make a Unicode word border depend on all marks before it; a character the view can't hold is never found
    near = bool(needed) and not ("U" in p.flags and p.looks_left) and encodable(needed, utf8)
    return Tabled(
        pattern_id=pattern_id, som=som, report_som=report_som, needed=needed,
        ends=p.flags + quote(p.literal) if plain else p.behind(p.ends), ends_to=("$0" if plain else "") + S.MARK,
        size=-1 if (size := S.fixed_bytes(p, utf8)) is None else size, width=width,
        before=[f"{p.flags}(?:{body})" + (f"(?=[\\s\\S]{{{k}}}\\z)" if k else "\\z") for k in range(RIGHT_CONTEXT + 1)],
        looks_right=p.looks_right, near=near, plain=bool(p.literal) and not any(v is not None for v in ext.values()), min_offset=ext.get("min_offset") or 0,
        max_offset=-1 if ext.get("max_offset") is None else ext["max_offset"], min_length=ext.get("min_length") or 0)


def tabled_events(s: Column, r: Column, utf8: bool) -> Column:
    """Events of one rule, given as data, on a segment: ``array<struct<pattern_id,from,to>>``."""
    text, base, lo, hi = s["text"], s["base"], s["lo"], s["hi"]

    def event(q: Column) -> Column:
        start = F.greatest(q["c"] - (r["width"] + 1), F.lit(0))
        after = F.length(text) - q["c"]
        k = F.when(~r["looks_right"], F.lit(0)).when(after >= RIGHT_CONTEXT, F.lit(RIGHT_CONTEXT)).when(after == 1, F.lit(1)).otherwise(F.lit(0))
        cut = F.substring(text, (start + 1).cast("int"), (q["c"] - start + k).cast("int"))
        found = F.call_function("regexp_extract", cut, r["before"][k], F.lit(0))
        end = base + q["b"]
        n = F.when(r["size"] >= 0, r["size"]).otherwise(S.byte_length(found, utf8))
        return F.struct(end.alias("to"), F.when(r["som"], end - n).otherwise(F.lit(0)).cast("bigint").alias("from"))

    marked = F.regexp_replace(text, r["ends"], r["ends_to"])
    ends = S.let(marked, lambda m: F.when(m.contains(S.MARK), S.points(m, utf8)))
    inside = F.filter(ends, lambda q: (base + q["b"] > lo) & (base + q["b"] <= hi) & (base + q["b"] >= r["min_offset"])
                      & ((r["max_offset"] < 0) | (base + q["b"] <= r["max_offset"])))
    long = F.filter(F.transform(inside, event), lambda e: e["to"] - e["from"] >= r["min_length"])
    return F.transform(long, lambda e: F.struct(
        r["pattern_id"].cast("int").alias("pattern_id"),
        F.when(r["report_som"], e["from"]).otherwise(F.lit(0)).cast("bigint").alias("from"), e["to"].alias("to")))


def constant(rows: list, kind: str) -> Column:
    """Dataclass rows as one literal of an array type."""
    return F.from_json(F.lit(json.dumps([asdict(r) for r in rows])), f"array<{kind}>")
