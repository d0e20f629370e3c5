"""Column expressions that turn a text and a prepared rule into match offsets.

Every match position is found by writing marker characters into the text with
one ``regexp_replace`` and adding up the lengths of the pieces in between, so
the regex work is the JVM's and the number of events does not matter to it.

Two views of a haystack exist. The byte view holds one character per byte
(ISO-8859-1), so character positions are byte offsets; the character view is
the UTF-8 text itself and positions are converted by ``octet_length``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import MAX_LOOKBEHIND, RIGHT_CONTEXT, Prepared, overlaps_itself, quote

# Unicode noncharacters, which interchanged text does not contain.
MARK = "\ufdd0"
CLOSE = "\ufdd1"
OPEN = "\ufdd4"
STAND_IN = "\ufdd2\ufdd3\ufdd5"
MARK_BYTES = 3

EVENT = "array<struct<pattern_id:int,from:bigint,to:bigint>>"
PREFIX_GROUP = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def byte_view(payload: Column) -> Column:
    return F.decode(payload.cast("binary"), "ISO-8859-1")


def has_marks(text: Column) -> Column:
    return text.contains(MARK) | text.contains(CLOSE) | text.contains(OPEN)


def char_view(text: Column) -> Column:
    """The text, with the markers (never found in interchanged text) made harmless."""
    return F.when(has_marks(text), F.translate(text, MARK + CLOSE + OPEN, STAND_IN)).otherwise(text)


def view_of(payload: Column, utf8: bool) -> Column:
    return char_view(payload.cast("string")) if utf8 else byte_view(payload)


def byte_length(piece: Column, utf8: bool) -> Column:
    return F.octet_length(piece) if utf8 else F.length(piece)


def running(lengths: Column) -> Column:
    """Inclusive running sums of an int array.

    Long arrays are folded in groups of their square root, because each step of
    a fold copies the array built so far.
    """

    def rest(xs: Column) -> Column:
        return F.slice(xs, F.lit(2), F.greatest(F.size(xs) - 1, F.lit(0)))

    def fold(xs: Column, start: Column, finish=None) -> Column:
        return F.aggregate(
            xs, F.array(start), lambda a, x: F.array_append(a, F.element_at(a, -1) + x.cast("bigint")), finish
        )

    def grouped(xs: Column) -> Column:
        groups = let(F.ceil(F.sqrt(F.size(xs))).cast("int"), lambda n: F.transform(
            F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / n).cast("int")),
            lambda g: F.slice(xs, g * n + 1, n),
        ))
        return F.aggregate(
            groups,
            F.array(F.array(F.lit(0).cast("bigint"))),
            lambda a, g: F.array_append(a, fold(g, F.element_at(F.element_at(a, -1), -1))),
            lambda a: F.flatten(F.transform(rest(a), rest)),
        )

    zero = F.lit(0).cast("bigint")
    return let(
        lengths,
        lambda xs: F.when(F.size(xs) <= PREFIX_GROUP, fold(xs, zero, rest)).otherwise(grouped(xs)),
    )


def points(marked: Column, utf8: bool) -> Column:
    """Positions of the markers: ``array<struct<c,b>>`` in characters and in bytes."""

    def place(parts: Column) -> Column:
        gaps = F.slice(parts, F.lit(1), F.size(parts) - 1)
        cs = running(F.transform(gaps, F.length))
        if not utf8:
            return F.transform(cs, lambda c: F.struct(c.alias("c"), c.alias("b")))
        bs = running(F.transform(gaps, F.octet_length))
        return F.transform(
            F.arrays_zip(cs.alias("c"), bs.alias("b")),
            lambda z: F.struct(z.getField("c").alias("c"), z.getField("b").alias("b")),
        )

    return let(F.split(marked, MARK, -1), place)


def mark_ends(text: Column, p: Prepared, open_end: bool = False) -> Column:
    """The text with a marker at every offset where the (bounded) rule can end."""
    if p.literal and not overlaps_itself(p.literal):
        return F.regexp_replace(text, F.lit(p.flags + quote(p.literal)), F.lit("$0" + MARK))
    body = p.ends_open if open_end else p.ends
    return F.regexp_replace(text, F.lit(p.behind(body)), F.lit(MARK))


def gate(text: Column, p: Prepared) -> Column:
    """Whether the rule matches somewhere: a byte search for text it needs, then its shortest form."""
    if p.literal:
        return text.contains(p.literal)
    found = text.rlike(p.exists)
    return text.contains(p.needed) & found if p.needed else found


def matched_before(text: Column, c: Column, p: Prepared, open_end: bool, width: int | None) -> Column:
    """Text of the longest match that ends exactly at character ``c`` ('' when there is none)."""
    body = (p.java_open if open_end else p.java)[len(p.flags):]
    start = F.lit(0).cast("bigint") if width is None else F.greatest(c - (width + 1), F.lit(0).cast("bigint"))

    def with_context(k: int) -> Column:
        cut = F.substring(text, start.cast("int") + 1, (c - start).cast("int") + k)
        stop = "\\z" if k == 0 else f"(?=[\\s\\S]{{{k}}}\\z)"
        return F.regexp_extract(cut, f"{p.flags}(?:{body}){stop}", 0)

    if not p.looks_right:
        return with_context(0)
    after = F.length(text) - c
    return (
        F.when(after >= RIGHT_CONTEXT, with_context(RIGHT_CONTEXT))
        .when(after == 1, with_context(1))
        .otherwise(with_context(0))
    )


def needs_history(p: Prepared, som: bool, allow_empty: bool = False) -> bool:
    """Whether the rule must see the text from its beginning rather than a bounded window."""
    if p.ends is None or allow_empty:
        return True
    return som and (p.max_width is None or p.max_width > MAX_LOOKBEHIND)


def fixed_bytes(p: Prepared, utf8: bool) -> int | None:
    if p.literal:
        return len(p.literal.encode("utf-8")) if utf8 else len(p.literal)
    return p.max_width if p.min_width == p.max_width and not utf8 else None


def _event(pattern_id: int, start: Column, end: Column) -> Column:
    return F.struct(
        F.lit(pattern_id).cast("int").alias("pattern_id"),
        start.cast("bigint").alias("from"),
        end.cast("bigint").alias("to"),
    )


def no_events() -> Column:
    return F.array().cast(EVENT)


def mark_points(text: Column, rules: list[Prepared], utf8: bool, open_end: bool = False) -> Column:
    """End positions of several bounded rules: one array of points per rule, NULL where the rule does not match."""
    marked = [F.when(gate(text, p), mark_ends(text, p, open_end)) for p in rules]
    return F.transform(F.array(*marked), lambda m: points(m, utf8))


def window_events(
    ends: Column, text: Column, base: Column, lo: Column, hi: Column, p: Prepared, pattern_id: int,
    *, som: bool, utf8: bool, open_end: bool = False,
) -> Column:
    """Events of a bounded rule whose end lies in ``(lo, hi]``, from its points.

    ``base`` is the byte offset of the text's first character; the text outside
    ``(lo, hi]`` is context only.
    """
    fixed = fixed_bytes(p, utf8)
    zero = F.lit(0).cast("bigint")

    def event(q: Column) -> Column:
        end = base + q["b"]
        if not som:
            return _event(pattern_id, zero, end)
        if fixed is not None:
            return _event(pattern_id, end - fixed, end)
        found = matched_before(text, q["c"], p, open_end, p.max_width)
        return _event(pattern_id, end - byte_length(found, utf8), end)

    inside = F.filter(ends, lambda q: (base + q["b"] > lo) & (base + q["b"] <= hi))
    return F.coalesce(F.transform(inside, event), no_events())


def _runs(text: Column, p: Prepared, tail: str, utf8: bool) -> Column:
    """Stretches of the text a match cannot leave: ``array<struct<text,c,b,lo,hi>>``.

    Every match consists of characters of the rule's cover class only, so it
    lies inside one maximal run of them. Each run keeps a character of the text
    to its left and two to its right for assertions.
    """

    def run(t: Column, c: Column, b: Column, lo: Column, hi: Column) -> Column:
        return F.struct(t.alias("text"), c.cast("bigint").alias("c"), b.cast("bigint").alias("b"),
                        lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi"))

    if p.cover is None:
        return F.array(run(text, F.lit(0), F.lit(0), F.lit(0), F.length(text)))
    # only runs that hold an end of the rule's tail are cut out; the others stay in the gaps
    one_run = f"{p.flags}(?={p.cover})(?<!{p.cover})(?={p.cover}*?(?:{tail})){p.cover}++{p.guard}"
    marked = F.regexp_replace(text, F.lit(one_run), F.lit(f"{MARK}$0{CLOSE}"))

    def lay_out(parts: Column) -> Column:
        runs = F.transform(parts, lambda x: F.substring_index(x, CLOSE, 1))
        gaps = F.transform(parts, lambda x: F.substring_index(x, CLOSE, -1))

        def place(rs: Column, gs: Column, cs: Column, bs: Column) -> Column:
            # parts[0] is the text before the first run: it holds a gap and no run
            def one(i: Column) -> Column:
                left = F.right(gs[i - 1], F.lit(1))
                right = F.left(F.concat(gs[i], F.coalesce(F.get(rs, i + 1), F.lit(""))), F.lit(RIGHT_CONTEXT))
                n = F.length(left)
                return run(
                    F.concat(left, rs[i], right), cs[i - 1] - n, bs[i - 1] - byte_length(left, utf8),
                    n, n + F.length(rs[i]),
                )

            return F.transform(F.sequence(F.lit(1), F.size(rs) - 1), one)

        # a part without CLOSE is the leading gap: both halves of substring_index return it whole
        def build(rg: Column) -> Column:
            rs, gs = rg["r"], rg["g"]
            lens = F.transform(F.arrays_zip(rs.alias("r"), gs.alias("g")), lambda z: F.concat(z["r"], z["g"]))
            cs = running(F.transform(lens, F.length))
            if not utf8:
                return let(cs, lambda c: place(rs, gs, c, c))
            bs = running(F.transform(lens, F.octet_length))
            return let(F.struct(cs.alias("c"), bs.alias("b")), lambda s: place(rs, gs, s["c"], s["b"]))

        halves = F.struct(
            F.concat(F.array(F.lit("")), F.slice(runs, F.lit(2), F.greatest(F.size(runs) - 1, F.lit(0)))).alias("r"),
            gaps.alias("g"),
        )
        return F.when(F.size(parts) > 1, let(halves, build)).otherwise(
            F.array().cast("array<struct<text:string,c:bigint,b:bigint,lo:bigint,hi:bigint>>")
        )

    return let(F.split(marked, MARK, -1), lay_out)


def history_events(
    text: Column, base: Column, lo: Column, hi: Column, p: Prepared, pattern_id: int,
    *, som: bool, utf8: bool, open_end: bool = False, allow_empty: bool = False,
) -> Column:
    """Events of a rule without a useful width bound, exact over the whole ``text``.

    Inside each run the ends of the rule's bounded tail are candidates, and each
    one is confirmed with the rule itself on the text up to it.
    """
    tail = p.tail_open if open_end else p.tail

    def in_run(r: Column) -> Column:
        marked = F.regexp_replace(r["text"], F.lit(p.behind(tail)), F.lit(MARK))

        def confirm(q: Column) -> Column:
            found = matched_before(r["text"], q["c"], p, open_end, None)
            n = byte_length(found, utf8)
            return F.struct(
                n.cast("bigint").alias("n"), (r["b"] + q["b"]).alias("b")
            )

        candidates = F.filter(points(marked, utf8), lambda q: (q["c"] > r["lo"]) & (q["c"] <= r["hi"]))
        return F.filter(F.transform(candidates, confirm), lambda e: e["n"] > 0)

    runs = F.filter(_runs(text, p, tail, utf8), lambda r: r["text"].rlike(p.java))
    inside = F.filter(F.flatten(F.transform(runs, in_run)), lambda e: (base + e["b"] > lo) & (base + e["b"] <= hi))
    start = (lambda e: base + e["b"] - e["n"]) if som else (lambda e: F.lit(0))
    events = F.transform(inside, lambda e: _event(pattern_id, start(e), base + e["b"]))
    if not allow_empty:
        return F.when(gate(text, p), events).otherwise(no_events())
    # The rule also matches empty, so it ends at every offset; where it does not
    # match text, the match starts where it ends.
    none = F.array().cast("array<bigint>")

    def between(es: Column) -> Column:
        """Offsets at which no match of text ends, as one range for each gap between those."""
        last = F.least(hi, base + F.length(text))

        def gaps(at: Column) -> Column:
            def gap(b: Column, i: Column) -> Column:
                first = F.when(i == 0, lo).otherwise(F.get(at, i - 1)) + 1
                return F.when(b > first, F.sequence(first, b - 1)).otherwise(none)

            return F.flatten(F.transform(at, gap))

        ends = F.array_append(F.array_sort(F.transform(es, lambda e: e["to"])), F.greatest(last, lo) + 1)
        return let(ends, gaps)

    if utf8:
        every = points(F.regexp_replace(text, F.lit(p.behind("[\\s\\S]")), F.lit(MARK)), utf8)
        every = F.filter(F.transform(every, lambda q: base + q["b"]), lambda b: (b > lo) & (b <= hi))
    else:
        every = between(F.array().cast(EVENT))
    if not som:
        return let(every, lambda bs: _each(pattern_id, F.array_repeat(F.lit(0).cast("bigint"), F.size(bs)), bs))
    rest = (lambda es: F.array_except(every, F.transform(es, lambda e: e["to"]))) if utf8 else between
    return let(events, lambda es: F.concat(es, let(rest(es), lambda bs: _each(pattern_id, bs, bs))))


def _each(pattern_id: int, starts: Column, ends: Column) -> Column:
    """Events from arrays of starts and ends, made without an evaluated step for each."""
    ids = F.array_repeat(F.lit(pattern_id).cast("int"), F.size(ends))
    return F.arrays_zip(ids.alias("pattern_id"), starts.alias("from"), ends.alias("to"))


SEGMENT = "struct<base:bigint,lo:bigint,hi:bigint,text:string>"


def segment(base: Column, lo: Column, hi: Column, text: Column) -> Column:
    return F.struct(base.cast("bigint").alias("base"), lo.cast("bigint").alias("lo"),
                    hi.cast("bigint").alias("hi"), text.alias("text"))


def segments(view: Column, utf8: bool, block: int, left: int) -> Column:
    """Cut a view into blocks with context: ``array<struct<base,lo,hi,text>>``.

    Blocks are cut by one linear regex pass; ``left`` characters of the block
    before and two of the block after come along. ``(lo, hi]`` is the range of
    end offsets that belong to the block and ``base`` the offset of the first
    character of ``text``, all in bytes of the haystack.
    """

    def cut(v: Column) -> Column:
        pieces = F.regexp_extract_all(v, F.lit(f"[\\s\\S]{{1,{block}}}"), F.lit(0))

        def with_context(ps: Column) -> Column:
            def build(es: Column) -> Column:
                def one(x: Column, i: Column) -> Column:
                    before = F.when(i > 0, F.right(F.get(ps, i - 1), F.lit(left))).otherwise(F.lit(""))
                    after = F.coalesce(F.left(F.get(ps, i + 1), F.lit(RIGHT_CONTEXT)), F.lit(""))
                    lo = es[i] - byte_length(x, utf8)
                    return segment(lo - byte_length(before, utf8), lo, es[i], F.concat(before, x, after))

                return F.transform(ps, one)

            return let(running(F.transform(ps, lambda x: byte_length(x, utf8))), build)

        whole_text = F.array(segment(F.lit(0), F.lit(0), byte_length(v, utf8), v))
        return F.when(F.octet_length(v) <= block, whole_text).otherwise(let(pieces, with_context))

    return let(view, cut)


def whole(view: Column, utf8: bool) -> Column:
    zero = F.lit(0)
    return let(view, lambda v: F.array(segment(zero, zero, byte_length(v, utf8), v)))


def text_between(seg_text: Column, base: Column, start: Column, end: Column, utf8: bool) -> Column:
    """Bytes ``[start, end)`` of the haystack as text, taken from a segment that holds them."""
    at, n = (start - base).cast("int") + 1, (end - start).cast("int")
    if utf8:
        return F.substring(seg_text.cast("binary"), at, n).cast("string")
    return as_text(F.substring(seg_text, at, n), utf8)


def as_text(piece: Column, utf8: bool) -> Column:
    """A piece of a view as ordinary text."""
    return piece if utf8 else F.decode(F.encode(piece, "ISO-8859-1"), "UTF-8")


def matches(view: Column, java: str, utf8: bool, groups: int = 0, matching: Column | None = None) -> Column:
    """Leftmost, greedy, non-overlapping matches with byte offsets.

    ``array<struct<from,to,text,caps>>``; ``caps`` holds the text of captures 1..groups.
    ``matching`` tells whether there is a match at all.
    """
    matching = view.rlike(java) if matching is None else matching
    caps = "".join(f"{CLOSE}${g}" for g in range(1, groups + 1))
    marked = F.regexp_replace(view, F.lit(java), F.lit(f"{MARK}$0{caps}{CLOSE}"))

    def lay_out(parts: Column) -> Column:
        def fields(x: Column) -> Column:
            bits = F.split(x, CLOSE, -1)
            return let(bits, lambda b: F.struct(
                b[0].alias("text"), F.slice(b, F.lit(2), F.lit(groups)).alias("caps"),
                F.element_at(b, -1).alias("gap")))

        def place(ms: Column) -> Column:
            # before match k come the head, and match + gap of every earlier one
            steps = F.concat(
                F.array(byte_length(parts[0], utf8)),
                F.transform(ms, lambda m: byte_length(m["text"], utf8) + byte_length(m["gap"], utf8)),
            )
            return let(running(steps), lambda at: F.transform(ms, lambda m, i: F.struct(
                at[i].alias("from"), (at[i] + byte_length(m["text"], utf8)).alias("to"),
                m["text"].alias("text"), m["caps"].alias("caps"))))

        tail = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
        return let(F.transform(tail, fields), place)

    none = F.array().cast("array<struct<from:bigint,to:bigint,text:string,caps:array<string>>>")
    return F.when(matching, let(F.split(marked, MARK, -1), lay_out)).otherwise(none)
