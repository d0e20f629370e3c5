"""Rules with one unbounded class repeat, cut there: ``A C* B`` with bounded ``A`` and ``B``.

A match begins with a match of ``A`` (a head), runs on through characters of the
class ``C`` and ends with a match of ``B``. So in a stretch of ``C`` characters only
the first head counts: every ``B`` that begins in the rest of the stretch ends a
match, and the leftmost start is the first head's. Ends are found by marking, once a
stretch, and nothing is confirmed on all the text before it.

A cut is a row of patterns and widths. The column expressions that evaluate it
take that row as data, so a plan does not grow with the number of rules, and they
need no more than a bounded context around a block and the first head of the
stretch a block begins in.

Where ``A`` or ``B`` vary in width, ends near a stretch's first head, and ends beyond the
stretch, are confirmed with the rule itself on a bounded piece of text.
"""

from __future__ import annotations

import json
import re
import re._constants as rc
from dataclasses import asdict, dataclass, fields

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import spans as S
from .regex import (
    FLAG_LETTERS, MAX_LOOKBEHIND, NOT_BETWEEN_HALVES, RIGHT_CONTEXT, WHOLE_CHARACTERS, RuleError, _atom, _Emitter, _item_width,
    _longest_text, _parse, _shortest_lead, _walk, _width, overlaps_itself, quote,
)

# Makes look-behinds before it count whole characters.
WHOLE = WHOLE_CHARACTERS.removesuffix(NOT_BETWEEN_HALVES)


@dataclass(frozen=True)
class Cut:
    """A rule ``A C* B``; patterns are for ``java.util.regex``, widths in characters of the view."""

    pattern_id: int
    som: bool  # starts are needed
    report_som: bool
    once: bool  # the first event of a text is the only one
    needed: str  # text every match contains; the same for A and B alone
    head_needed: str
    tail_needed: str
    head: str  # every end of A; empty if A is
    head_inside: str  # the same where text before the piece is left out
    head_to: str  # what such an end is replaced by
    stretch: str  # from a head on, through the class
    live: str  # the same, and whether a B may begin in it; those where none does are matched without a tag
    live_to: str  # what that is replaced by
    tail: str  # every end of B
    tail_open: str
    full: str  # the rule, up to the end of a piece
    reach: str  # C* B over a whole piece
    start: str  # what comes before an A that ends no more than ``slack`` before the end of a piece
    run: str  # characters of the class a piece begins with
    head_width: int  # of A, if it has one width; else -1
    tail_width: int
    head_most: int
    tail_most: int
    slack: int  # how much narrower than the widest A may be
    edge: int  # ends up to here after a first head are confirmed, if starts vary
    peek: int  # 1 if the character before a stretch matters to B
    beyond: int  # characters after a stretch that matter to B
    min_offset: int
    max_offset: int
    min_length: int

    back: int  # bytes before a block at which the stretch it begins in is known
    context: int  # bytes needed on either side of a block


COLUMNS = {f.name: {"str": "string", "int": "bigint", "bool": "boolean"}[str(f.type)] for f in fields(Cut)}
CUT = "struct<" + ",".join(f"{n}:{t}" for n, t in COLUMNS.items()) + ">"


class NotCut(Exception):
    """The rule has no single unbounded class repeat."""


class _Marked(_Emitter):
    """Spells a necessary condition for a part of a rule in a text where marks may stand between characters."""

    MARKED = "\\x{fdd0}?"

    def item(self, op, av) -> str:
        text = super().item(op, av)
        return f"(?:{self.MARKED}{text})" if op is rc.ANY or _atom(op, av) is not None else text

    def assertion(self, av) -> str:
        if av is rc.AT_END:
            return f"(?={self.MARKED}(?:\\n|\\z))" if self.flags & re.MULTILINE else f"(?=(?:{self.MARKED}\\n)?{self.MARKED}\\z)"
        return f"(?={self.MARKED}\\z)" if av is rc.AT_END_STRING else ""


def _one_class(body) -> list | None:
    """The items of a repeat's body if it is one character."""
    items = list(body)
    while len(items) == 1 and items[0][0] is rc.SUBPATTERN and not (items[0][1][1] or items[0][1][2]):
        items = list(items[0][1][3])
    if len(items) == 1 and (items[0][0] is rc.ANY or _atom(*items[0]) is not None):
        return items
    return None


def _sequence(items) -> list:
    """The items as one sequence in which an unbounded item is the ``{0,}`` of one character."""
    out: list = []
    for op, av in items:
        if _item_width(op, av)[1] is not None:
            out.append((op, av))
        elif op is rc.SUBPATTERN and not (av[1] or av[2]):
            out += _sequence(av[3])
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and av[1] is rc.MAXREPEAT and (one := _one_class(av[2])):
            if av[0]:
                out += one if av[0] == 1 else [(rc.MAX_REPEAT, (av[0], av[0], one))]
            out.append((rc.MAX_REPEAT, (0, rc.MAXREPEAT, one)))
        else:
            raise NotCut
    return out


def cut_of(rule, som: bool, report_som: bool) -> Cut | None:
    """The rule as a cut; ``None`` if it is not of that form and must be searched otherwise.

    Without ``som`` optional repeats a match begins with are left out: some match ends where the rule's do either way.
    """
    if rule.kind != "regex" or rule.flags & {"V", "C"}:
        return None
    tree, bits = _parse(rule.expression, rule.flags)
    items = list(tree)
    if not _width(items)[0]:
        return None
    try:
        return _cut(_sequence(items if som else _shortest_lead(items)), bits, rule, som, report_som)
    except (NotCut, RuleError):
        return None


def _cut(items: list, bits: int, rule, som: bool, report_som: bool) -> Cut:
    at = [k for k, item in enumerate(items) if _item_width(*item)[1] is None]
    if len(at) != 1:
        raise NotCut
    head, one, tail = items[:at[0]], items[at[0]][1][2], items[at[0] + 1:]
    (head_least, head_most), (tail_least, tail_most) = _width(head), _width(tail)
    if max(head_most, tail_most) > MAX_LOOKBEHIND:
        raise NotCut
    utf8, unicode = "8" in rule.flags, "W" in rule.flags
    fixed = head_least == head_most, tail_least == tail_most
    looks = any(op is rc.AT for op, _ in _walk(items))
    if looks and not all(fixed):
        raise NotCut  # a piece of text would not show what stands around it
    letters = "d" + "".join(c for f, c in FLAG_LETTERS if bits & f)
    letters += ("u" if utf8 and bits & re.IGNORECASE else "") + ("U" if unicode else "")
    flags = f"(?{letters})"
    guard = WHOLE_CHARACTERS if utf8 else ""

    def emit(part, *, bounded: bool = True, open_end: bool = False) -> str:
        return _Emitter(capture=False, unicode=unicode, open_end=open_end, bounded=bounded, flags=bits).seq(part)

    def ends(body: str) -> str:
        return f"{flags}(?<=(?:{body})){guard}"

    single = emit(one)
    cls = ("[\\s\\S]" if bits & re.DOTALL else "[^\\n]") if single == "." else single if single.startswith("[") else f"[{single}]"
    text = "".join(chr(av) for _, av in head) if not bits & re.IGNORECASE and all(op is rc.LITERAL for op, _ in head) else ""
    plain = bool(text) and not overlaps_itself(text)
    slack = head_most - head_least
    # marks of heads may stand between any two characters of the context
    left = 2 * (head_most + 1) + 1
    # one group, since a group set in a look-behind stays set where the rest fails
    beyond = tail_most + RIGHT_CONTEXT if tail_most or looks else 0
    before = f"(?<=([\\s\\S]{{{left}}}|\\A[\\s\\S]{{0,{left - 1}}}))" if looks or som and (utf8 or slack) else "()"
    after = f"(?=([\\s\\S]{{0,{2 * beyond}}})){WHOLE if utf8 else ''}"
    reached = _Marked(capture=False, unicode=unicode, open_end=False, bounded=True, flags=bits).seq(tail)
    run = f"\\x{{fdd0}}[{cls}\\x{{fdd0}}]*+" if head else f"(?<!{cls}){NOT_BETWEEN_HALVES if utf8 else ''}{cls}*+"
    at_start = "(?=\\x{fdd0})" if head else f"(?<!{cls})"
    wide = 4 if utf8 else 1
    edge = slack + 2 * tail_most + 1 if slack else 0
    back = (edge + tail_most + 2 * RIGHT_CONTEXT + 4) * wide
    needed = (lambda part: "") if bits & re.IGNORECASE else (lambda part: _longest_text(part, bits))
    ext = rule.ext
    return Cut(
        pattern_id=rule.pattern_id, som=som, report_som=report_som, once="H" in rule.flags, needed=needed(items), head_needed=needed(head), tail_needed=needed(tail),
        head=(flags + quote(text) if plain else ends(emit(head))) if head else "",
        head_inside=(flags + quote(text) if plain else ends(("[\\s\\S]" if looks else "") + f"(?:{emit(head)})")) if head else "", head_to=("$0" if plain else "") + S.MARK,
        # what turns most places away stands before what is captured at a place
        stretch=f"{flags}{at_start}{before}{run}{after}",
        # a stretch without a B is matched whole as well, so that its other heads are not tried
        live=(f"{flags}{at_start}(?:(?=\\x{{fdd0}}[{cls}\\x{{fdd0}}]*?(?:{reached})){before}(\\x{{fdd0}})[{cls}\\x{{fdd0}}]*+{after}|{run})" if head
              else f"{flags}{at_start}(?={cls}*?(?:{reached})){before}{run}{after}"),
        live_to=f"{S.CLOSE}$2{S.OPEN}$1{S.OPEN}$0{S.OPEN}$3{S.OPEN}" if head else f"{S.CLOSE}{S.MARK}{S.OPEN}$1{S.OPEN}$0{S.OPEN}$2{S.OPEN}",
        tail=ends(emit(tail)) if tail else guard, tail_open=ends(emit(tail, open_end=True)) if tail else guard,
        full=f"{flags}(?:{emit(items, bounded=False)})\\z", reach=f"{flags}\\A{cls}*?(?:{emit(tail)})\\z",
        start=f"{flags}\\A[\\s\\S]*?(?=(?:{emit(head)})[\\s\\S]{{0,{slack}}}\\z)", run=f"{flags}\\A{cls}*+",
        head_width=head_least if fixed[0] else -1, tail_width=tail_least if fixed[1] else -1, head_most=head_most, tail_most=tail_most,
        slack=slack, edge=edge, back=back, context=back + (head_most + slack + 2) * wide, peek=int(looks), beyond=beyond,
        min_offset=ext.get("min_offset") or 0, max_offset=-1 if ext.get("max_offset") is None else ext["max_offset"],
        min_length=ext.get("min_length") or 0,
    )


def cut_rows(found: list[Cut]) -> Column:
    """Cuts as one constant, so that a plan does not grow with them."""
    return F.from_json(F.lit(json.dumps([asdict(c) for c in found])), f"array<{CUT}>")


def _clean(text: Column) -> Column:
    return F.replace(text, F.lit(S.MARK), F.lit(""))


# A stretch without a tag, as ``live_to`` leaves it.
_DEAD = f"{S.CLOSE}{S.OPEN}[^{S.OPEN}]*+{S.OPEN}([^{S.OPEN}]*+){S.OPEN}{S.OPEN}"


def stretches(text: Column, r: Column, utf8: bool, inside: Column | None = None, every: bool = True) -> Column:
    """Stretches from a first head on: byte offset in the text, what stands to the left, the stretch, what follows.

    ``inside`` tells whether the text goes on to the left, so that nothing begins at its first character. Without ``every``
    the stretches in which no match can end, since no B begins in them, are left out; they cost no more than their text.
    """
    head = r["head"] if inside is None else F.when(inside, r["head_inside"]).otherwise(r["head"])
    marked = F.when(r["head"] != "", F.regexp_replace(text, head, r["head_to"])).otherwise(text)
    if every:
        cut = F.regexp_replace(marked, r["stretch"], F.lit(f"{S.CLOSE}{S.OPEN}$1{S.OPEN}$0{S.OPEN}$2{S.OPEN}"))
    else:
        cut = F.regexp_replace(F.regexp_replace(marked, r["live"], r["live_to"]), F.lit(_DEAD), F.lit("$1"))

    def lay_out(parts: Column) -> Column:
        found = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: F.split(_clean(x), S.OPEN, -1))

        def place(found: Column) -> Column:
            steps = F.concat(
                F.array(S.byte_length(_clean(parts[0]), utf8)),
                F.transform(found, lambda p: S.byte_length(p[2], utf8) + S.byte_length(p[4], utf8)))
            return S.let(S.running(steps), lambda at: F.transform(found, lambda p, i: F.struct(
                at[i].alias("at"), p[1].alias("left"), p[2].alias("body"), p[3].alias("after"))))

        return S.let(found, place)

    return S.let(F.split(cut, S.CLOSE, -1), lay_out)


def _extract(text: Column, pattern: Column) -> Column:
    return F.call_function("regexp_extract", text, pattern, F.lit(0))


def _start(st: Column, r: Column, utf8: bool) -> Column:
    """Leftmost start, as a byte offset, of the heads that end up to ``slack`` after the stretch's first one does; 0 if none is needed."""
    fixed = F.octet_length(F.right(st["left"], r["head_width"].cast("int"))) if utf8 else r["head_width"]
    window = F.concat(st["left"], F.left(st["body"], r["slack"].cast("int")))
    skipped = _extract(window, r["start"])
    varied = st["at"] - S.byte_length(st["left"], utf8) + S.byte_length(skipped, utf8)
    return F.when(~r["som"], F.lit(0)).when(r["head_width"] >= 0, st["at"] - fixed).otherwise(varied).cast("bigint")


def _ends(st: Column, r: Column, tail: Column, utf8: bool) -> Column:
    """Events ``(to, from)`` of one stretch, in bytes of the text; ``st.sure`` says that all its matches begin at ``st.start``."""

    def on(v: Column) -> Column:
        n, piece, peek = F.length(st["body"]), v["piece"], F.length(v["peek"])

        def confirmed(q: Column) -> Column:
            c = (q["c"] - peek).cast("int")
            end = st["at"] + q["b"] - S.byte_length(v["peek"], utf8)
            # beyond the stretch: B must begin in it
            skip = F.greatest(n - r["tail_most"].cast("int"), F.lit(0))
            rest = F.substring(piece, peek + skip + 1, c - skip)
            reached = F.when(c <= n, F.lit(True)).when(r["tail_width"] >= 0, c - r["tail_width"] <= n).otherwise(F.rlike(rest, r["reach"]))
            # the whole rule, near a head whose start varies
            near = ~st["sure"] & ((c <= r["edge"]) | (n <= r["edge"]))
            whole = _extract(F.concat(st["left"], F.left(piece, c)), r["full"])
            own = F.when(near, S.byte_length(whole, utf8))
            first = F.coalesce(end - own, st["start"])
            return F.struct(end.cast("bigint").alias("to"), first.cast("bigint").alias("from"), F.coalesce(own > 0, reached).alias("valid"))

        marked = F.regexp_replace(piece, tail, F.lit(S.MARK))
        ends = F.filter(S.points(marked, utf8), lambda q: q["c"] >= F.greatest(r["tail_width"], F.lit(0)) + peek)
        return F.filter(F.transform(ends, confirmed), lambda e: e["valid"])

    peek = F.right(st["left"], r["peek"].cast("int"))
    piece = F.concat(peek, st["body"], F.left(st["after"], r["beyond"].cast("int")))
    return S.let(F.struct(piece.alias("piece"), peek.alias("peek")), on)


def _one_an_end(events: Column) -> Column:
    """One event an end, the one that starts first; ends ascend."""
    return S.let(F.array_sort(events), lambda es: F.filter(es, lambda e, i: (i == 0) | (e["to"] != F.get(es, i - 1)["to"])))


def cut_events(
    s: Column, r: Column, utf8: bool, open_end: Column | None = None, first: Column | None = None, start: Column | None = None,
) -> Column:
    """Events of one cut on a segment: ``array<struct<pattern_id,from,to>>``.

    ``open_end`` says that data may follow the segment. For a block of a stream, ``first`` and ``start`` are the byte offsets of
    the first head, and of its leftmost start, of the stretch that holds the character ``back`` bytes before the block; NULL if
    there is none.
    """
    text, base, lo, hi = s["text"], s["base"], s["lo"], s["hi"]
    tail = r["tail"] if open_end is None else F.when(open_end, r["tail_open"]).otherwise(r["tail"])
    sure = ~r["som"] | (r["head_width"] >= 0)

    def known(sts: Column) -> Column:
        """The stretches with their starts; that of a stretch that comes in from before the block is given."""
        here = lambda found: F.transform(found, lambda st: F.struct(
            st["at"].alias("at"), st["left"].alias("left"), st["body"].alias("body"), st["after"].alias("after"),
            _start(st, r, utf8).alias("start"), sure.alias("sure")))
        if first is None:
            return here(sts)

        def coming_in(v: Column) -> Column:
            own = F.struct(
                v["at"].cast("bigint").alias("at"), F.lit("").alias("left"), v["body"].alias("body"),
                F.substring(v["rest"], F.length(v["body"]) + 1, r["beyond"].cast("int")).alias("after"),
                F.when(r["som"], start - base).otherwise(F.lit(0)).cast("bigint").alias("start"), F.lit(True).alias("sure"))
            after = v["at"] + S.byte_length(v["body"], utf8)
            later = F.filter(sts, lambda x: first.isNull() | (x["at"] > after))
            return F.concat(F.filter(F.array(own), lambda _: first.isNotNull()), here(later))

        def view(rest: Column) -> Column:
            at = S.byte_length(text, utf8) - S.byte_length(rest, utf8)
            return F.struct(at.alias("at"), rest.alias("rest"), _extract(rest, r["run"]).alias("body"))

        rest = F.when(first.isNotNull(), from_byte(text, lo - r["back"] - base, utf8)).otherwise(F.lit(""))
        return S.let(S.let(rest, view), coming_in)

    sts = S.let(stretches(text, r, utf8, None if first is None else base > 0, every=False), known)
    placed = F.transform(F.flatten(F.transform(sts, lambda st: _ends(st, r, tail, utf8))), lambda e: F.struct(
        (base + e["to"]).alias("to"), F.when(r["som"], base + e["from"]).otherwise(F.lit(0)).cast("bigint").alias("from")))
    inside = F.filter(placed, lambda e: (e["to"] > lo) & (e["to"] <= hi) & (e["to"] >= r["min_offset"])
                      & ((r["max_offset"] < 0) | (e["to"] <= r["max_offset"])))
    long = F.filter(_one_an_end(inside), lambda e: e["to"] - e["from"] >= r["min_length"])
    events = F.transform(long, lambda e: F.struct(
        r["pattern_id"].cast("int").alias("pattern_id"),
        F.when(r["report_som"], e["from"]).otherwise(F.lit(0)).cast("bigint").alias("from"), e["to"].alias("to")))
    return S.let(events, lambda es: F.slice(es, F.lit(1), F.when(r["once"], F.lit(1)).otherwise(F.size(es))))


def from_byte(text: Column, at: Column, utf8: bool) -> Column:
    """The text from a byte on; a character that begins before it is left out."""
    if not utf8:
        return F.substring(text, (at + 1).cast("int"), F.length(text))
    view = F.decode(F.substring(text.cast("binary"), (at + 1).cast("int"), F.octet_length(text)), "ISO-8859-1")
    return S.as_text(F.regexp_replace(view, "\\A[\\x{80}-\\x{bf}]{1,3}", ""), False)


def block_state(s: Column, stop: Column, r: Column, utf8: bool) -> Column:
    """What a block does to the stretch it begins in: ``struct<passes,first,start>``.

    The block is moved back by ``back`` bytes, so that all a match needs on either side is in its context; ``stop`` is where
    the block's data end. ``passes`` says that the stretch goes on through all of it; ``first`` and ``start`` are those of its
    first head whose stretch goes on beyond it, NULL if there is none.
    """
    text, base = s["text"], s["base"]
    lo, end = s["lo"] - r["back"], stop - r["back"]
    # a few bytes more, for a character that is cut at the beginning: if they break the stretch, none comes in
    skip = F.greatest(lo - base - (4 if utf8 else 0), F.lit(0))

    def passing(t: Column) -> Column:
        def on(body: Column) -> Column:
            rest = S.byte_length(t, utf8) - S.byte_length(body, utf8)
            return (rest == 0) | (base + S.byte_length(text, utf8) - rest >= end)

        return S.let(_extract(t, r["run"]), on)

    def own(sts: Column) -> Column:
        last = F.filter(sts, lambda st: (base + st["at"] <= end) & (base + st["at"] > lo)
                        & (base + st["at"] + S.byte_length(st["body"], utf8) >= end))
        return S.let(F.get(last, F.lit(0)), lambda st: F.struct(
            S.let(from_byte(text, skip, utf8), passing).alias("passes"),
            (base + st["at"]).cast("bigint").alias("first"), (base + _start(st, r, utf8)).cast("bigint").alias("start")))

    nothing = F.array().cast("array<struct<at:bigint,left:string,body:string,after:string>>")
    heads = F.when(text.contains(r["head_needed"]), stretches(text, r, utf8, base > 0)).otherwise(nothing)
    return S.let(heads, own)
