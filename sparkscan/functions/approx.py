"""Approximate literals: edit and Hamming distance.

A window within distance k of a literal cut into k+1 pieces contains at least
one piece unchanged. The pieces are found exactly by one regex pass; only the
few windows around such a hit are compared, so no window is missed and the cost
follows the hits, not the text length.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import ASCII_FOLD, RuleError, alternation
from .spans import CLOSE, MARK, _event, let, no_events, running


def _pieces(literal: str, k: int) -> list[tuple[int, str]]:
    if k >= len(literal):
        raise RuleError("the distance must be smaller than the literal")
    cuts = [i * len(literal) // (k + 1) for i in range(k + 2)]
    return [(a, literal[a:b]) for a, b in zip(cuts, cuts[1:])]


def _piece_hits(text: Column, piece: str, caseless: bool) -> Column:
    """0-based character positions of every occurrence, overlapping ones included."""
    marked = F.regexp_replace(text, F.lit(f"(?={alternation([piece], caseless)})".replace("(?=(?i)", "(?i)(?=")), F.lit(MARK))
    return let(
        F.split(marked, MARK, -1),
        lambda parts: running(F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), F.length)),
    )


def _differences(window: Column, literal: str) -> Column:
    chars = F.array(*[F.lit(c) for c in literal])
    return F.aggregate(
        F.zip_with(F.split(window, ""), chars, lambda a, b: (a != b).cast("int")), F.lit(0), lambda n, d: n + d
    )


def approx_events(
    text: Column, base: Column, lo: Column, hi: Column, literal: str, pattern_id: int,
    *, edit: int | None, hamming: int | None, caseless: bool, som: bool,
) -> Column:
    """Events in the byte view. With ``som`` the leftmost start of each end is reported."""
    k = edit if edit else hamming or 0
    size = len(literal)
    # the byte view holds bytes, so only ASCII letters have a case
    target = literal.translate(ASCII_FOLD) if caseless else literal
    fold = (lambda c: F.translate(c, ascii_uppercase, ascii_lowercase)) if caseless else (lambda c: c)
    n = F.length(text)
    pieces = _pieces(literal, k)

    def window(start: Column, end: Column) -> Column:
        return F.struct(start.cast("bigint").alias("s"), end.cast("bigint").alias("e"))

    # edits before the piece move the start, edits after it the end: together at most k
    shifts = [(0, 0)] if not edit else [(a, c) for a in range(-k, k + 1) for c in range(-k, k + 1) if abs(a) + abs(c) <= k]
    moves = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(c).alias("c")) for a, c in shifts])

    def around(at: int, piece: str) -> Column:
        """Close windows around each hit, compared inside one cut of the text."""

        def near(p: Column) -> Column:
            first = F.greatest(p - at - k, F.lit(0).cast("bigint"))
            cut = fold(F.substring(text, first.cast("int") + 1, F.lit(size + 4 * k)))
            return let(F.struct(first.alias("first"), cut.alias("cut")), lambda c: F.filter(
                F.transform(moves, lambda m: window(p - at + m["a"], p - at + size + m["c"])),
                lambda w: close(w, c)))

        return F.flatten(F.transform(_piece_hits(text, piece, caseless), near))

    def close(w: Column, c: Column) -> Column:
        piece = F.substring(c["cut"], (w["s"] - c["first"]).cast("int") + 1, (w["e"] - w["s"]).cast("int"))
        inside = (w["s"] >= 0) & (w["e"] <= n) & (w["e"] > w["s"]) & (base + w["e"] > lo) & (base + w["e"] <= hi)
        alike = F.levenshtein(piece, F.lit(target), k) >= 0 if edit else _differences(piece, target) <= k
        return inside & alike

    windows = F.array_distinct(F.concat(*[around(at, piece) for at, piece in pieces]))

    def events(ws: Column) -> Column:
        ends = F.array_distinct(F.transform(ws, lambda w: w["e"]))
        if not som:
            return F.transform(ends, lambda e: _event(pattern_id, F.lit(0), base + e))
        return F.transform(ends, lambda e: _event(
            pattern_id, base + F.array_min(F.transform(F.filter(ws, lambda w: w["e"] == e), lambda w: w["s"])), base + e))

    some_piece = alternation([p for _, p in pieces], caseless)
    return F.when(text.rlike(some_piece), let(windows, events)).otherwise(no_events())
