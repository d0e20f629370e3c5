"""Scan operators: haystacks x rules -> match events.

``scan`` is one narrow pass: each row is cut into blocks, every rule becomes an
expression over the block, and the events are exploded. There is no shuffle, no
UDF and no per-rule re-read of the table. Large rule sets go through ``rule_index``.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import spans as S
from ..functions.approx import approx_events
from ..functions.cuts import CUT, Cut, cut_events, cut_of, cut_rows
from ..functions.tabled import Tabled, tabled
from ..functions.regex import MAX_LOOKBEHIND, RuleError, alternation, captures, quote
from .rule_index import indexed_events
from .phrases import phrase_scan
from .rules import EXT_KEYS, MAX_RULES, Rule, check_rules, rule_list

BLOCK = 4096
# More plain texts than these are searched as a set.
LITERAL_SET = 32
# More rules of other kinds than these are looked up by the text they need.
RULE_SET = 16
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class _Plan:
    """How one rule is evaluated on a segment."""

    def __init__(self, rule: Rule, force_som: bool = False, horizon: int | None = None, cut: bool = True):
        self.rule = rule
        # of the whole rule set
        self.horizon = horizon
        ext = rule.ext
        self.edit, self.hamming = ext.get("edit_distance"), ext.get("hamming_distance")
        self.report_som = "L" in rule.flags or force_som
        self.som = self.report_som or bool(ext.get("min_length"))
        self.allow_empty = False
        self.cut: Cut | None = None
        self.first_only = "H" in rule.flags
        if self.edit or self.hamming:
            if rule.utf8:
                raise RuleError("approximate matching works on bytes, not UTF-8 characters", rule.ord)
            p = rule.prepared()
            if p.plain is None:
                raise RuleError("approximate matching needs a literal rule", rule.ord)
            self.literal = p.plain
            self.p, self.history = p, False
            self.width = len(self.literal) + (self.edit or 0)
            return
        self.p = rule.prepared()
        self.allow_empty = "V" in rule.flags and self.p.min_width == 0
        self.history = S.needs_history(self.p, self.som, self.allow_empty)
        self.width = self.p.max_width if self.p.max_width is not None else MAX_LOOKBEHIND
        if cut and self.unbounded:
            self.cut = cut_of(rule, self.som, self.report_som)

    @property
    def unbounded(self) -> bool:
        """Whether a match may be longer than any number of characters."""
        return self.history and self.p.max_width is None

    def tabled(self) -> Tabled:
        return tabled(self.rule.pattern_id, self.p, self.rule.ext, self.width, som=self.som, report_som=self.report_som, utf8=self.rule.utf8)

    @property
    def far(self) -> bool:
        """Whether a start the rule reports may lie beyond the horizon."""
        if self.horizon is None or not self.report_som:
            return False
        return self.p.max_width is None or self.width * (4 if self.rule.utf8 else 1) > self.horizon

    @property
    def marked(self) -> bool:
        """Whether the rule's ends are found by markers on the whole segment."""
        return not (self.history or self.edit or self.hamming)

    def events(self, s: Column, open_end: bool = False, ends: Column | None = None) -> Column:
        """Events on a segment; ``ends`` are the rule's points if it is a marked one."""
        r = self.rule
        text, base, lo, hi = s["text"], s["base"], s["lo"], s["hi"]
        ext = r.ext
        if self.edit or self.hamming:
            found = approx_events(text, base, lo, hi, self.literal, r.pattern_id, edit=self.edit,
                                  hamming=self.hamming, caseless="i" in self.p.flags, som=self.som)
        elif self.cut:
            return F.when(text.contains(self.cut.needed), cut_events(s, cut_rows([self.cut])[0], r.utf8, F.lit(open_end))).otherwise(S.no_events())
        elif self.history:
            found = S.history_events(text, base, lo, hi, self.p, r.pattern_id, som=self.som, utf8=r.utf8,
                                     open_end=open_end, allow_empty=self.allow_empty)
        else:
            found = S.window_events(ends, text, base, lo, hi, self.p, r.pattern_id, som=self.som, utf8=r.utf8,
                                    open_end=open_end)
        if ext.get("max_offset") is not None:
            # a segment that starts beyond the bound is not searched at all
            found = F.when(base < ext["max_offset"], found).otherwise(S.no_events())
            found = F.filter(found, lambda e: e["to"] <= ext["max_offset"])
        if ext.get("min_offset"):
            found = F.when(hi >= ext["min_offset"], found).otherwise(S.no_events())
            found = F.filter(found, lambda e: e["to"] >= ext["min_offset"])
        if ext.get("min_length"):
            found = F.filter(found, lambda e: e["to"] - e["from"] >= ext["min_length"])
            if not self.report_som:
                found = F.transform(found, lambda e: S._event(r.pattern_id, F.lit(0), e["to"]))
        if self.far:
            found = F.transform(found, lambda e: S._event(
                r.pattern_id, F.when(e["to"] - e["from"] > self.horizon, F.lit(-1)).otherwise(e["from"]), e["to"]))
        return found


def first_event(events: Column) -> Column:
    """The event with the smallest end (then start), as an array of at most one."""
    least = F.array_min(F.transform(events, lambda e: F.struct(e["to"], e["from"], e["pattern_id"])))
    return S.let(least, lambda m: F.when(m.isNull(), S.no_events()).otherwise(
        F.array(F.struct(m["pattern_id"], m["from"], m["to"]))))


def _by_id(plans: list[_Plan]) -> dict[int, list[_Plan]]:
    out: dict[int, list[_Plan]] = {}
    for plan in plans:
        out.setdefault(plan.rule.pattern_id, []).append(plan)
    return out


def rule_arrays(s: Column, plans: list[_Plan], open_end: bool, body) -> Column:
    """``body(arrays)`` over one event array per rule; points of all marked rules are found together."""
    marked = [p for p in plans if p.marked]

    def arrays(ends: Column | None) -> list[Column]:
        at = {id(p): ends[k] for k, p in enumerate(marked)} if ends is not None else {}
        return [p.events(s, open_end, at.get(id(p))) for p in plans]

    if not marked:
        return body(arrays(None))
    found = S.mark_points(s["text"], [p.p for p in marked], marked[0].rule.utf8, open_end)
    return S.let(found, lambda ends: body(arrays(ends)))


def segment_events(s: Column, plans: list[_Plan], open_end: bool = False) -> Column:
    """Events of several rules on one segment; single-match rules give one event per id."""

    def together(arrays: list[Column]) -> Column:
        out = [a for p, a in zip(plans, arrays) if not p.first_only]
        once: dict[int, list[Column]] = {}
        for p, a in zip(plans, arrays):
            if p.first_only:
                once.setdefault(p.rule.pattern_id, []).append(a)
        out += [first_event(F.concat(*group)) for group in once.values()]
        return F.concat(*out)

    return rule_arrays(s, plans, open_end, together) if plans else S.no_events()


class Combination:
    """Boolean logic over other rules' ids: ``!`` before ``&`` before ``|``, and parentheses."""

    def __init__(self, rule: Rule):
        self.rule = rule
        text = rule.expression
        if not re.fullmatch(r"[\d\s()!&|]+", text):
            raise RuleError(f"cannot read combination {text!r}", rule.ord)
        text = re.sub(r"\d+", lambda m: f" _{m[0]} ", text)
        text = text.replace("!", " not ").replace("&", " and ").replace("|", " or ")
        try:
            self.tree = ast.parse(text.strip(), mode="eval").body
        except SyntaxError as e:
            raise RuleError(f"cannot read combination {rule.expression!r}", rule.ord) from e
        self.ids: set[int] = set()
        self.positive: set[int] = set()
        self._walk(self.tree, True)

    def _walk(self, node, positive: bool) -> None:
        if isinstance(node, ast.Name):
            self.ids.add(int(node.id[1:]))
            if positive:
                self.positive.add(int(node.id[1:]))
        elif isinstance(node, ast.UnaryOp):
            self._walk(node.operand, not positive)
        elif isinstance(node, ast.BoolOp):
            for v in node.values:
                self._walk(v, positive)
        else:
            raise RuleError(f"cannot read combination {self.rule.expression!r}", self.rule.ord)

    def holds(self, first_end: dict[int, Column]) -> Column:
        def build(node) -> Column:
            if isinstance(node, ast.Name):
                return first_end[int(node.id[1:])].isNotNull()
            if isinstance(node, ast.UnaryOp):
                return ~build(node.operand)
            parts = [build(v) for v in node.values]
            out = parts[0]
            for p in parts[1:]:
                out = (out & p) if isinstance(node.op, ast.And) else (out | p)
            return out

        return build(self.tree)

    def end(self, first_end: dict[int, Column], length: Column) -> Column:
        """Largest first end among the satisfied positive rules; the length if there is none."""
        ends = [first_end[i] for i in sorted(self.positive)]
        last = F.greatest(*ends) if len(ends) > 1 else ends[0] if ends else F.lit(None)
        return F.coalesce(last, length).cast("bigint")


def split_rules(rules) -> tuple[list[Rule], list[Combination]]:
    every = rule_list(rules)
    check_rules(every)
    combos = [Combination(r) for r in every if "C" in r.flags]
    plain = [r for r in every if "C" not in r.flags]
    known = {r.pattern_id for r in plain}
    for c in combos:
        missing = c.ids - known
        if missing:
            raise RuleError(f"combination names unknown rule {min(missing)}", c.rule.ord)
    return plain, combos


def scan(
    df: DataFrame, rules, *, payload: str = "text", keys: Sequence[str] = ("doc_id",),
    block: int = BLOCK, with_text: bool = False, som: bool = False,
) -> DataFrame:
    """All ends of every rule in every row: ``(keys, pattern_id, from, to[, text])``.

    ``from`` is 0 unless the rule carries ``L`` (or ``som`` asks for starts).
    Flags, extended constraints, single match, combinations and quiet rules are
    all applied in the same pass. Starts are the true ones: a horizon is a matter
    of streams.
    """
    plain, combos = split_rules(rules)
    return _scan(df, plain, combos, payload, keys, block, with_text, som)


def _scan(
    df: DataFrame, plain: list[Rule], combos: list[Combination], payload: str, keys: Sequence[str],
    block: int, with_text: bool, som: bool,
) -> DataFrame:
    texts = _plain_texts(plain, combos) if not (with_text or som) else []
    if len(texts) > LITERAL_SET:
        # those the index of needed texts takes are found there, in one pass with other rules
        indexed = {id(r) for r in texts if (p := r.prepared()).literal and p.max_width <= MAX_LOOKBEHIND}
        texts = [r for r in texts if len(indexed) <= RULE_SET or id(r) not in indexed]
    else:
        texts = []
    if texts:
        # one pass for all of them; as expressions of their own they would make the plan grow with their number
        found = literal_scan(df, texts, payload=payload, keys=keys, block=block)
        set_apart = {id(r) for r in texts}
        rest = [r for r in plain if id(r) not in set_apart]
        return found.unionByName(_scan(df, rest, combos, payload, keys, block, False, False)) if rest or combos else found
    plans = [_Plan(r, som) for r in plain if "Q" not in r.flags]
    many = _many(plans) if not with_text else []
    if many:
        looked_up = {id(p) for p in many}
        rest = [p.rule for p in plans if id(p) not in looked_up]
        parts = [
            indexed_events(df, S.view_of(F.col(payload), u), u, [p.cut or p.tabled() for p in group], keys, block)
            for u in (False, True) for c in (False, True)
            if (group := [p for p in many if p.rule.utf8 == u and bool(p.cut) == c])]
        if rest or combos:
            # combinations look at the rules they name, quiet ones among them
            named = set().union(*[c.ids for c in combos]) if combos else set()
            quiet = [replace(r, flags=r.flags | {"Q"}) for r in plain if r not in rest and r.pattern_id in named]
            parts.append(_scan(df, [*rest, *quiet], combos, payload, keys, block, False, som))
        return reduce(DataFrame.unionByName, parts)
    # cuts are data of one expression; of single-match rules, those that share no id
    shared = {i for i, group in _by_id(plans).items() if len(group) > 1}
    cut_plans = {u: [p for p in plans if p.rule.utf8 == u and p.cut and not (p.first_only and p.rule.pattern_id in shared)] for u in (False, True)}
    plans = [p for p in plans if p not in cut_plans[p.rule.utf8]]
    block_plans = {u: [p for p in plans if p.rule.utf8 == u and not p.history and not p.first_only] for u in (False, True)}
    whole_plans = {u: [p for p in plans if p.rule.utf8 == u and (p.history or p.first_only)] for u in (False, True)}
    loud = [c for c in combos if "Q" not in c.rule.flags]
    if with_text and any(not p.som for p in [*plans, *cut_plans[False], *cut_plans[True]]):
        raise RuleError("matched text needs start offsets: set L on every rule")

    kinds: list[tuple[Column, object]] = []
    rule_column = F.lit(None).cast(CUT)
    for u in (False, True):
        view = S.view_of(F.col(payload), u)
        if block_plans[u]:
            left = max(p.width for p in block_plans[u]) + 1
            kinds.append((S.segments(view, u, max(block, left), left), (u, block_plans[u])))
        if whole_plans[u]:
            kinds.append((S.whole(view, u), (u, whole_plans[u])))
        if cut_plans[u]:
            kinds.append((S.whole(view, u), (u, [p.cut for p in cut_plans[u]])))
    if loud:
        kinds.append((S.whole(S.view_of(F.col(payload), False), False), None))

    def piece(k: int, s: Column, rule: Column) -> Column:
        return F.struct(
            F.lit(k).alias("kind"), s["base"].alias("base"), s["lo"].alias("lo"), s["hi"].alias("hi"),
            s["text"].alias("text"), *([rule.alias("rule")] if any(cut_plans.values()) else []))

    def tagged(k: int, segs: Column) -> Column:
        spec = kinds[k][1]
        if spec and isinstance(spec[1][0], Cut):
            # one piece for each rule whose text the row has
            return S.let(segs[0], lambda s: F.transform(
                F.filter(cut_rows(spec[1]), lambda r: s["text"].contains(r["needed"])), lambda r: piece(k, s, r)))
        return F.transform(segs, lambda s: piece(k, s, rule_column))

    if not kinds:
        raise RuleError("no rule reports anything")
    pieces = [tagged(k, segs) for k, (segs, _) in enumerate(kinds)]
    cut = df.select(*keys, F.explode(F.concat(*pieces) if len(pieces) > 1 else pieces[0]).alias("s"))
    s = F.col("s")
    out: Column | None = None
    for k, (_, spec) in enumerate(kinds):
        if spec is None:
            events = _combination_events(s, plain, loud)
            utf8 = False
        else:
            utf8, group = spec
            events = cut_events(s, s["rule"], utf8) if isinstance(group[0], Cut) else segment_events(s, group)
        if with_text:
            events = F.transform(events, lambda e: F.struct(
                e["pattern_id"], e["from"], e["to"],
                S.text_between(s["text"], s["base"], e["from"], e["to"], utf8).alias("text")))
        if len(kinds) == 1:
            out = events
        else:
            out = F.when(s["kind"] == k, events) if out is None else out.when(s["kind"] == k, events)
    return cut.select(*keys, F.inline(out))


def event_arrays(df: DataFrame, rules, *, payload: str = "text", keys: Sequence[str] = ("doc_id",), block: int = BLOCK) -> DataFrame:
    """A haystack's events as one array in the order they are found: ``(keys, events)``, ``array<struct<to,pattern_id,from>>``.

    A narrow pass: nothing is shuffled, and a row without events is left out.
    """
    plain, combos = split_rules(rules)
    plans = [_Plan(r) for r in plain if "Q" not in r.flags]
    parts = []
    for u in (False, True):
        view = S.view_of(F.col(payload), u)
        bounded = [p for p in plans if p.rule.utf8 == u and not p.history and not p.first_only]
        whole = [p for p in plans if p.rule.utf8 == u and p not in bounded]
        if bounded:
            left = max(p.width for p in bounded) + 1
            parts.append(F.flatten(F.transform(S.segments(view, u, max(block, left), left), lambda s: segment_events(s, bounded))))
        if whole:
            parts.append(S.let(S.whole(view, u)[0], lambda s: segment_events(s, whole)))
    if combos:
        parts.append(S.let(S.whole(S.view_of(F.col(payload), False), False)[0], lambda s: _combination_events(s, plain, combos)))
    events = F.transform(F.concat(*parts), lambda e: F.struct(e["to"], e["pattern_id"], e["from"]))
    return df.select(*keys, F.array_sort(events).alias("events")).where(F.size("events") > 0)


def _many(plans: list[_Plan]) -> list[_Plan]:
    """The rules to look up by the text they need, if there are so many that they should not be expressions of their own."""
    found = [p for p in plans if (p.marked or p.cut) and not p.first_only]
    return found if len(found) > RULE_SET else []


def apply_horizon(matches: DataFrame, horizon: int | None, ids: Sequence[int] | None = None) -> DataFrame:
    """Start offsets further back than the horizon are reported as -1; ``ids`` names the rules that report starts."""
    if horizon is None:
        return matches
    far = F.col("to") - F.col("from") > horizon
    if ids is not None:
        far = far & F.col("pattern_id").isin(list(ids))
    return matches.withColumn("from", F.when(far, F.lit(-1).cast("bigint")).otherwise(F.col("from")))


def _plain_texts(plain: list[Rule], combos: list[Combination]) -> list[Rule]:
    """Rules that are plain text and need nothing but their occurrences."""
    used = set().union(*[c.ids for c in combos]) if combos else set()
    return [r for r in plain
            if not r.ext and not r.flags & {"H", "Q", "V"} and r.pattern_id not in used and r.prepared().plain]


def _combination_events(s: Column, plain: list[Rule], combos: list[Combination]) -> Column:
    """Combination events of a whole text: first end per sub-rule, then plain boolean columns."""
    needed = sorted(set().union(*[c.ids for c in combos]))
    groups = _by_id([_Plan(r) for r in plain if r.pattern_id in needed])
    ends = lambda plans: F.array_min(F.transform(_events_any_view(plans, s), lambda e: e["to"]))
    firsts = F.struct(*[ends(groups[i]).alias(f"r{i}") for i in needed])

    def build(f: Column) -> Column:
        first_end = {i: f[f"r{i}"] for i in needed}
        rows = [
            F.when(c.holds(first_end), F.array(S._event(c.rule.pattern_id, F.lit(0), c.end(first_end, s["hi"]))))
            .otherwise(S.no_events())
            for c in combos
        ]
        return F.concat(*rows)

    return S.let(firsts, build)


def _events_any_view(plans: list[_Plan], s: Column) -> Column:
    """Events on a whole byte-view segment, re-read as characters for UTF-8 rules."""
    raw = [p for p in plans if not p.rule.utf8]
    utf = [p for p in plans if p.rule.utf8]
    parts = [segment_events(s, raw)] if raw else []
    if utf:
        chars = S.whole(S.char_view(S.as_text(s["text"], False)), True)
        parts.append(S.let(chars[0], lambda c: segment_events(c, utf)))
    return F.concat(*parts)


def scan_one(df: DataFrame, expression: str, flags: str = "", **options) -> DataFrame:
    """A single expression on its own: its events carry id 0."""
    from .rules import single

    return scan(df, single(expression, flags), **options)


def vectored_scan(df: DataFrame, rules, *, payload: str = "chunks", **options) -> DataFrame:
    """Buffers of one row are one haystack: offsets run over all of them."""
    return scan(df.withColumn(payload, F.array_join(payload, "")), rules, payload=payload, **options)


def grep(df: DataFrame, expression: str, *, payload: str = "text", keys: Sequence[str] = ("doc_id",), flags: str = "") -> DataFrame:
    """Every match with its range and text; ``.`` spans lines and ``^``/``$`` match at them."""
    rule = Rule(0, 0, expression, frozenset("smL" + flags))
    return scan(df, [rule], payload=payload, keys=keys, with_text=True)


# --- literal sets -----------------------------------------------------------------------------


def _literal_groups(rules: list[Rule]) -> dict[tuple[bool, bool], dict[str, list[Rule]]]:
    groups: dict[tuple[bool, bool], dict[str, list[Rule]]] = {}
    for r in rules:
        text = r.prepared().plain
        if text is None:
            raise RuleError("not a literal", r.ord)
        caseless = "i" in r.flags
        if caseless:
            text = "".join(map(folded, text)) if r.utf8 else _ascii_lower(text)
        groups.setdefault((r.utf8, caseless), {}).setdefault(text, []).append(r)
    return groups


def folded(c: str) -> str:
    """One character as the JVM compares it without case: upper, then lower, never more than one character."""
    upper = c.upper()
    return (upper if len(upper) == 1 else c).lower()[0]


def _ascii_lower(text: str) -> str:
    return text.translate({ord(c): c.lower() for c in ASCII_UPPER})


def _one_pass(texts, utf8: bool, caseless: bool) -> str:
    """Look-ahead capturing the longest literal that starts at each position.

    The class of first characters turns most positions away before the
    alternation is tried.
    """
    flags = "(?d" + ("i" if caseless else "") + ("u" if utf8 and caseless else "") + ")"
    first = "".join(quote(c) for c in sorted({t[0] for t in texts}))
    return f"{flags}(?=[{first}])(?=({alternation(texts)}))"


def _folded(found: Column, utf8: bool, caseless: bool) -> Column:
    if not caseless:
        return found
    if not utf8:
        return F.translate(found, ASCII_UPPER, ASCII_UPPER.lower())

    def one(c: Column) -> Column:
        upper = F.upper(c)
        return F.left(F.lower(F.when(F.length(upper) == 1, upper).otherwise(c)), F.lit(1))

    return F.array_join(F.transform(F.split(found, ""), one), "")


def _members(df: DataFrame, texts: dict[str, list[Rule]]) -> DataFrame:
    """Lookup from the longest literal found at a position to every rule that starts there, with its length in characters."""
    rows = []
    for found in texts:
        for n in range(1, len(found) + 1):
            for r in texts.get(found[:n], ()):
                rows.append((found, r.pattern_id, n, "L" in r.flags))
    if len(rows) > 10 * MAX_RULES:
        raise RuleError("too many nested literals for one lookup")
    return df.sparkSession.createDataFrame(rows, "found string, pattern_id int, size int, som boolean")


def literal_scan(df: DataFrame, rules, *, payload: str = "text", keys: Sequence[str] = ("doc_id",), block: int = BLOCK) -> DataFrame:
    """All occurrences of a set of literals, found in one regex pass whatever their number.

    The pass captures the longest literal at each position; the shorter ones
    that start there are its prefixes and come from a small lookup, whose size
    is bounded by the rule set. A table of more rules than the driver takes is
    joined instead, as long as case matters and all report starts or none does.
    """
    if isinstance(rules, DataFrame) and rules.limit(MAX_RULES + 1).count() > MAX_RULES:
        return _joined_literals(df, rules, payload, keys)
    plain = rule_list(rules, "literal")
    if any(r.ext or r.flags & {"H", "Q", "C"} for r in plain):
        return scan(df, plain, payload=payload, keys=keys, block=block)
    out = None
    for (utf8, caseless), texts in _literal_groups(plain).items():
        left = max(map(len, texts)) + 1
        view = S.view_of(F.col(payload), utf8)
        cut = df.select(*keys, F.explode(S.segments(view, utf8, max(block, left), left)).alias("s"))
        pattern = _one_pass(texts, utf8, caseless)
        text = F.col("s.text")
        marked = F.regexp_replace(text, F.lit(pattern), F.lit(f"{S.MARK}$1{S.CLOSE}"))

        def lay_out(parts: Column) -> Column:
            hits = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: F.substring_index(x, S.CLOSE, 1))
            gaps = F.transform(parts, lambda x: S.byte_length(F.substring_index(x, S.CLOSE, -1), utf8))
            return S.let(S.running(gaps), lambda at: F.transform(hits, lambda h, i: F.struct(h.alias("found"), at[i].alias("at"))))

        placed = F.when(text.rlike(pattern), S.let(F.split(marked, S.MARK, -1), lay_out))
        hits = cut.select(*keys, "s.base", "s.lo", "s.hi", F.explode(placed).alias("h"))
        # sizes are those of the text found: without case, a letter may be written with more bytes than in the rule
        hits = hits.withColumns({"found": _folded(F.col("h.found"), utf8, caseless), "as_found": F.col("h.found")})
        start = F.col("base") + F.col("h.at")
        joined = hits.join(F.broadcast(_members(df, texts)), "found").select(
            *keys, "pattern_id", "lo", "hi",
            F.when(F.col("som"), start).otherwise(F.lit(0).cast("bigint")).alias("from"),
            (start + S.byte_length(F.left("as_found", F.col("size")), utf8)).alias("to"),
        )
        part = joined.where((F.col("to") > F.col("lo")) & (F.col("to") <= F.col("hi"))).drop("lo", "hi")
        out = part if out is None else out.unionByName(part)
    return out


def _joined_literals(df: DataFrame, rules: DataFrame, payload: str, keys: Sequence[str]) -> DataFrame:
    flags = F.coalesce(F.col("flags"), F.array().cast("array<string>"))
    other = (F.col("kind") != "literal") | F.exists(flags, lambda f: ~f.isin("L", "8"))
    for k in EXT_KEYS:
        other = other | F.col(f"ext.{k}").isNotNull()
    if not rules.where(other).isEmpty():
        raise RuleError(f"of more than {MAX_RULES} rules, all must be literals in which case matters, without constraints")
    # rows of a key are looked up together, so several columns are one struct
    one = F.struct(*keys)
    words = rules.select(F.coalesce("pattern_id", "ord").alias("pattern_id"), "expression", F.array_contains(flags, "L").alias("starts"))
    both = []
    for starts in (False, True):
        found = phrase_scan(df.select(F.to_json(one).alias("__key"), payload), words.where(F.col("starts") == starts), payload=payload, key="__key")
        at = F.col("from") if starts else F.lit(0).cast("bigint")
        both.append(found.select("__key", "pattern_id", at.alias("from"), "to"))
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return both[0].unionByName(both[1]).select(F.from_json("__key", schema).alias("k"), "pattern_id", "from", "to").select("k.*", "pattern_id", "from", "to")


def literal_counts(df: DataFrame, rules, *, payload: str = "text") -> DataFrame:
    """Occurrences per literal rule: ``(pattern_id, hits)``; rules without a hit report 0.

    Offsets are not needed, so found literals are counted as they come out of
    the pass (map-side) and only one row per literal and task is shuffled.
    """
    if isinstance(rules, DataFrame) and rules.limit(MAX_RULES + 1).count() > MAX_RULES:
        numbered = df.select(F.monotonically_increasing_id().alias("__row"), payload)
        found = _joined_literals(numbered, rules, payload, ["__row"]).groupBy("pattern_id").agg(F.count("*").alias("hits"))
        every = rules.select(F.coalesce("pattern_id", "ord").alias("pattern_id")).distinct()
        return every.join(found, "pattern_id", "left").fillna(0, ["hits"])
    plain = rule_list(rules, "literal")
    counts = None
    for (utf8, caseless), texts in _literal_groups(plain).items():
        view = S.view_of(F.col(payload), utf8)
        found = df.select(F.explode(F.regexp_extract_all(view, F.lit(_one_pass(texts, utf8, caseless)), F.lit(1))).alias("found"))
        per_text = found.groupBy(_folded(F.col("found"), utf8, caseless).alias("found")).agg(F.count("*").alias("n"))
        part = _members(df, texts).join(per_text, "found", "left").select("pattern_id", F.coalesce("n", F.lit(0)).alias("n"))
        counts = part if counts is None else counts.unionByName(part)
    return counts.groupBy("pattern_id").agg(F.sum("n").alias("hits"))


def hit_counts(df: DataFrame, rules, *, payload: str = "text") -> DataFrame:
    """Events and haystacks with an event per rule: ``(pattern_id, hits, docs)``.

    Rules whose ends can be marked are counted by the markers themselves: no
    offset is computed, nothing is exploded, and the whole table reduces to one
    row of sums per task. Other rules are counted per row from their events.
    """
    plain, combos = split_rules(rules)
    if combos:
        raise RuleError("combinations are counted from scan()", combos[0].rule.ord)
    plans = [_Plan(r) for r in plain if "Q" not in r.flags]
    every = df.sparkSession.createDataFrame([(i,) for i in _by_id(plans)], "pattern_id int")
    if _many(plans):
        numbered = df.select(F.monotonically_increasing_id().alias("__row"), payload)
        per_row = scan(numbered, plain, payload=payload, keys=("__row",)).groupBy("pattern_id", "__row").agg(F.count("*").alias("n"))
        found = per_row.groupBy("pattern_id").agg(F.sum("n").alias("hits"), F.count("*").alias("docs"))
        return every.join(found, "pattern_id", "left").fillna(0, ["hits", "docs"])
    views = {u: S.view_of(F.col(payload), u) for u in {p.rule.utf8 for p in plans}}
    base = df.select(*[v.alias(f"v{int(u)}") for u, v in views.items()])
    per_row = []
    for k, group in enumerate(_by_id(plans).values()):
        terms = []
        for p in group:
            text = F.col(f"v{int(p.rule.utf8)}")
            simple = not (p.rule.ext or p.first_only or p.history)
            if simple:
                added = F.octet_length(S.mark_ends(text, p.p)) - F.octet_length(text)
                terms.append(F.when(S.gate(text, p.p), added / S.MARK_BYTES).otherwise(F.lit(0)).cast("bigint"))
            else:
                events = S.let(S.whole(text, p.rule.utf8)[0], lambda s: segment_events(s, [p]))
                terms.append(F.size(events).cast("bigint"))
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        if len(group) > 1 and any(p.first_only for p in group):
            raise RuleError("single-match rules sharing an id are counted from scan()", group[0].rule.ord)
        per_row.append((group[0].rule.pattern_id, total.alias(f"n{k}")))
    rows = base.select(*[c for _, c in per_row])
    # only rules with hits leave the row; their sums are made map-side
    each = F.array(*[F.struct(F.lit(i).cast("int").alias("pattern_id"), F.col(f"n{k}").alias("n")) for k, (i, _) in enumerate(per_row)])
    found = rows.select(F.inline(F.filter(each, lambda e: e["n"] > 0)))
    found = found.groupBy("pattern_id").agg(F.sum("n").alias("hits"), F.count("*").alias("docs"))
    return every.join(found, "pattern_id", "left").fillna(0, ["hits", "docs"])


# --- leftmost, greedy, non-overlapping ----------------------------------------------------------


CAPTURES = "array<struct<group:int,active:boolean,from:bigint,to:bigint,text:string>>"


def pcre_scan(
    df: DataFrame, rules, *, payload: str = "text", keys: Sequence[str] = ("doc_id",),
    groups: bool = False,
) -> DataFrame:
    """Non-overlapping matches per rule: ``(keys, pattern_id, from, to[, captures])``."""
    plain = rule_list(rules, "pcre")
    arrays = []
    for r in plain:
        view = S.view_of(F.col(payload), r.utf8)
        found = _pcre_events(view, r, groups)
        if "H" in r.flags:
            found = F.slice(found, F.lit(1), F.lit(1))
        arrays.append(F.coalesce(found, F.array().cast(_pcre_type(groups))))
    events = F.concat(*arrays) if len(arrays) > 1 else arrays[0]
    return df.select(*keys, F.inline(events))


def _pcre_type(groups: bool) -> str:
    more = f",captures:{CAPTURES}" if groups else ""
    return f"array<struct<pattern_id:int,from:bigint,to:bigint{more}>>"


def _pcre_events(view: Column, r: Rule, groups: bool) -> Column:
    try:
        p = r.prepared()
        caps = captures(r.expression, r.flags) if groups else None
    except RuleError as e:
        raise RuleError(str(e), r.ord) from e
    matching = S.gate(view, p)
    if not groups:
        return F.transform(S.matches(view, p.java, r.utf8, matching=matching), lambda m: S._event(r.pattern_id, m["from"], m["to"]))

    def capture(m: Column, g: int) -> Column:
        text = m["caps"][caps.slots[g] - 1]
        active = (text != "") if caps.optional[g] else F.lit(True)
        if g in caps.before:
            start = m["from"]
            for slot in caps.before[g]:
                start = start + S.byte_length(m["caps"][slot - 1], r.utf8)
            end = start + S.byte_length(text, r.utf8)
        else:
            start = end = F.lit(None)
        return F.struct(
            F.lit(g).alias("group"), active.alias("active"),
            F.when(active, start).cast("bigint").alias("from"), F.when(active, end).cast("bigint").alias("to"),
            S.as_text(text, r.utf8).alias("text"))

    def event(m: Column) -> Column:
        whole = F.struct(F.lit(0).alias("group"), F.lit(True).alias("active"), m["from"].alias("from"),
                         m["to"].alias("to"), S.as_text(m["text"], r.utf8).alias("text"))
        listed = F.array(whole, *[capture(m, g) for g in sorted(caps.slots)]).cast(CAPTURES)
        return F.struct(F.lit(r.pattern_id).cast("int").alias("pattern_id"), m["from"].alias("from"),
                        m["to"].alias("to"), listed.alias("captures"))

    return F.transform(S.matches(view, caps.java, r.utf8, caps.count, matching), event)
