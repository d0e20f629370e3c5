"""Driver-side preparation of one rule expression for the JVM regex engine.

Python's own regex parser supplies the structure; this module only reads that
tree to (a) spell the expression for ``java.util.regex``, (b) learn how wide a
match can be, and (c) derive a bounded form that may stand in a look-behind.
Nothing here touches data.
"""

from __future__ import annotations

import re
import re._constants as rc
import re._parser as rp
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

# A rule wider than this many characters is not put in a look-behind.
MAX_LOOKBEHIND = 128
# Unrolled repeats may not blow the look-behind up beyond this many characters.
MAX_UNROLLED = 20_000
# The JVM works on UTF-16 halves. No position between two halves may match, and a
# character beyond the basic plane in the pattern (in a part that is always true)
# makes look-behinds count whole characters.
NOT_BETWEEN_HALVES = "(?![\\x{dc00}-\\x{dfff}])"
WHOLE_CHARACTERS = "(?!\U0001f600(?!))" + NOT_BETWEEN_HALVES
# Characters to the right of an end offset that an assertion can depend on.
RIGHT_CONTEXT = 2

# POSIX bracket names and the characters they stand for.
POSIX_CLASSES = {
    "alnum": "a-zA-Z0-9",
    "alpha": "a-zA-Z",
    "ascii": "\\x00-\\x7f",
    "blank": " \\t",
    "cntrl": "\\x00-\\x1f\\x7f",
    "digit": "0-9",
    "graph": "!-~",
    "lower": "a-z",
    "print": " -~",
    "punct": "!-/:-@\\[-`{-~",
    "space": "\\s",
    "upper": "A-Z",
    "word": "\\w",
    "xdigit": "0-9a-fA-F",
}

CATEGORIES = {
    rc.CATEGORY_DIGIT: "\\d",
    rc.CATEGORY_NOT_DIGIT: "\\D",
    rc.CATEGORY_SPACE: "\\s",
    rc.CATEGORY_NOT_SPACE: "\\S",
    rc.CATEGORY_WORD: "\\w",
    rc.CATEGORY_NOT_WORD: "\\W",
}

ASCII_FOLD = str.maketrans(ascii_uppercase, ascii_lowercase)
FLAG_LETTERS = ((re.IGNORECASE, "i"), (re.MULTILINE, "m"), (re.DOTALL, "s"))


class RuleError(ValueError):
    """A rule that cannot be used; ``ord`` is its position in the rule set."""

    def __init__(self, message: str, ord: int | None = None):
        super().__init__(message if ord is None else f"rule {ord}: {message}")
        self.ord = ord


@dataclass(frozen=True)
class Prepared:
    java: str  # whole rule with inline flags
    java_open: str  # same, but no assertion may hold because the data seen so far ends
    flags: str  # inline flag prefix alone
    min_width: int
    max_width: int | None  # None: unbounded
    looks_right: bool
    looks_left: bool
    ends: str | None  # bounded body whose matches end exactly where the rule's do
    ends_open: str | None
    tail: str  # bounded body; every end of the rule is an end of this
    tail_open: str
    cover: str | None  # class holding every character a match may contain; None: any
    plain: str | None  # the rule is this plain text, in its view
    literal: str | None  # same, and case matters
    groups: int
    guard: str  # keeps the JVM to whole characters; empty in the byte view
    exists: str  # matches somewhere exactly if the rule does, with the optional edges left out
    needed: str  # every match contains this text (empty if none is known or its case is free)

    def behind(self, body: str) -> str:
        """Pattern for the positions a match of ``body`` ends at."""
        return f"{self.flags}(?<=(?:{body})){self.guard}"


_SPELLING = re.compile(
    r"""\\Q(?P<quoted>.*?)(?:\\E|$) | \\x\{(?P<hex>[0-9a-fA-F]+)\} | \\(?P<esc>.)
      | \(\?<(?=[A-Za-z_]) | \[:(?P<neg>\^?)(?P<posix>[a-z]+):\]""",
    re.VERBOSE | re.DOTALL,
)


def _to_python(expression: str) -> str:
    """Spell PCRE constructs the way Python's parser reads them."""

    def one(m: re.Match) -> str:
        if m["quoted"] is not None:
            return re.escape(m["quoted"])
        if m["hex"] is not None:
            return re.escape(chr(int(m["hex"], 16)))
        if m["posix"] is not None:
            if m["neg"] or m["posix"] not in POSIX_CLASSES:
                raise RuleError(f"unsupported class {m.group()}")
            return POSIX_CLASSES[m["posix"]]
        if m["esc"] is not None:
            e = m["esc"]
            if e in "RKCXGE":
                raise RuleError(f"unsupported construct \\{e}")
            return {"z": "\\Z", "Z": "(?-m:$)", "h": "[ \\t]", "e": "\\x1b"}.get(e, m.group())
        return "(?P<"

    return _SPELLING.sub(one, expression)


def quote(text: str) -> str:
    """Characters of ``text`` without any regex meaning."""
    return "".join(_char(ord(c)) for c in text)


def _char(code: int) -> str:
    c = chr(code)
    if c == "_" or (c.isascii() and c.isalnum()):
        return c
    return f"\\x{{{code:x}}}"


def _class_item(op, av) -> str:
    if op is rc.LITERAL:
        return _char(av)
    if op is rc.RANGE:
        return f"{_char(av[0])}-{_char(av[1])}"
    if op is rc.CATEGORY:
        return CATEGORIES[av]
    raise RuleError(f"unsupported class member {op}")


def _atom(op, av) -> str | None:
    """One-character items, as they are spelled both alone and inside a class."""
    if op is rc.LITERAL:
        return _char(av)
    if op is rc.NOT_LITERAL:
        return f"[^{_char(av)}]"
    if op is rc.IN:
        negated = bool(av) and av[0][0] is rc.NEGATE
        body = "".join(_class_item(o, a) for o, a in (av[1:] if negated else av))
        return f"[{'^' if negated else ''}{body}]"
    return None


class _Emitter:
    def __init__(self, *, capture: bool, unicode: bool, open_end: bool, bounded: bool, flags: int):
        self.capture = capture
        self.unicode = unicode
        self.open_end = open_end
        self.bounded = bounded
        self.flags = flags

    def seq(self, items) -> str:
        return "".join(self.item(op, av) for op, av in items)

    def item(self, op, av) -> str:
        atom = _atom(op, av)
        if atom is not None:
            return atom
        if op is rc.ANY:
            return "."
        if op is rc.AT:
            return self.assertion(av)
        if op is rc.BRANCH:
            return "(?:" + "|".join(self.seq(b) for b in av[1]) + ")"
        if op is rc.SUBPATTERN:
            return self.group(av)
        if op in (rc.MAX_REPEAT, rc.MIN_REPEAT, rc.POSSESSIVE_REPEAT):
            return self.repeat(op, av)
        if op in (rc.ASSERT, rc.ASSERT_NOT):
            direction, body = av
            sign = "=" if op is rc.ASSERT else "!"
            return f"(?{'<' if direction < 0 else ''}{sign}{self.seq(body)})"
        if op is rc.GROUPREF:
            return f"(?:\\{av})"
        if op is rc.ATOMIC_GROUP:
            return f"(?>{self.seq(av)})"
        if op is rc.FAILURE:
            return "(?!)"
        raise RuleError(f"unsupported construct {op}")

    def assertion(self, av) -> str:
        if av is rc.AT_BEGINNING:
            return "^"
        if av is rc.AT_BEGINNING_STRING:
            return "\\A"
        if av is rc.AT_END:
            if self.open_end:
                return "(?=\\n)" if self.flags & re.MULTILINE else "(?!)"
            return "$"
        if av is rc.AT_END_STRING:
            return "(?!)" if self.open_end else "\\z"
        word = self.unicode
        if av is rc.AT_BOUNDARY:
            if self.open_end:
                return "(?:(?<=\\w)(?=\\W)|(?<!\\w)(?=\\w))"
            return "\\b" if word else "(?:(?<=\\w)(?!\\w)|(?<!\\w)(?=\\w))"
        if av is rc.AT_NON_BOUNDARY:
            if self.open_end:
                return "(?:(?<=\\w)(?=\\w)|(?<!\\w)(?=\\W))"
            return "\\B" if word else "(?:(?<=\\w)(?=\\w)|(?<!\\w)(?!\\w))"
        raise RuleError(f"unsupported assertion {av}")

    def group(self, av) -> str:
        number, add, drop, body = av
        saved = self.flags
        self.flags = (self.flags | add) & ~drop
        inner = self.seq(body)
        self.flags = saved
        if number is not None and self.capture:
            return f"({inner})"
        on = "".join(c for f, c in FLAG_LETTERS if add & f)
        off = "".join(c for f, c in FLAG_LETTERS if drop & f)
        return f"(?{on}{'-' + off if off else ''}:{inner})"

    def repeat(self, op, av) -> str:
        lo, hi, body = av
        one = self.seq(body)
        single = len(body) == 1 and (_atom(*body[0]) is not None or body[0][0] is rc.ANY)
        if self.bounded and not single:
            return self.unrolled(f"(?:{one})", lo, hi)
        if not single and not (len(body) == 1 and body[0][0] is rc.SUBPATTERN):
            one = f"(?:{one})"
        lazy = {rc.MIN_REPEAT: "?", rc.POSSESSIVE_REPEAT: "+"}.get(op, "")
        top = "" if hi is rc.MAXREPEAT else str(hi)
        count = {(0, ""): "*", (1, ""): "+", (0, "1"): "?"}.get((lo, top))
        if count is None:
            count = f"{{{lo}}}" if str(lo) == top else f"{{{lo},{top}}}"
        return one + count + lazy

    def unrolled(self, one: str, lo: int, hi: int) -> str:
        if len(one) * hi > MAX_UNROLLED:
            raise RuleError("too large to unroll")
        text = ""
        for _ in range(hi - lo):
            text = f"(?:{one}{text})?"
        return one * lo + text


def _width(items) -> tuple[int, int | None]:
    lo, hi = 0, 0
    for op, av in items:
        a, b = _item_width(op, av)
        lo += a
        hi = None if hi is None or b is None else hi + b
    return lo, hi


def _item_width(op, av) -> tuple[int, int | None]:
    if op in (rc.LITERAL, rc.NOT_LITERAL, rc.IN, rc.ANY):
        return 1, 1
    if op is rc.BRANCH:
        widths = [_width(b) for b in av[1]]
        tops = [b for _, b in widths]
        return min(a for a, _ in widths), None if None in tops else max(tops)
    if op is rc.SUBPATTERN:
        return _width(av[3])
    if op is rc.ATOMIC_GROUP:
        return _width(av)
    if op in (rc.MAX_REPEAT, rc.MIN_REPEAT, rc.POSSESSIVE_REPEAT):
        a, b = _width(av[2])
        if b == 0 or av[1] == 0:
            return 0, 0
        return a * av[0], None if b is None or av[1] is rc.MAXREPEAT else b * av[1]
    if op is rc.GROUPREF:
        return 0, None
    return 0, 0


def _walk(items):
    for op, av in items:
        yield op, av
        if op is rc.BRANCH:
            for b in av[1]:
                yield from _walk(b)
        elif op is rc.SUBPATTERN:
            yield from _walk(av[3])
        elif op is rc.ATOMIC_GROUP:
            yield from _walk(av)
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT, rc.POSSESSIVE_REPEAT):
            yield from _walk(av[2])
        elif op in (rc.ASSERT, rc.ASSERT_NOT):
            yield from _walk(av[1])


def _shortest_lead(items) -> list:
    """Drop the optional iterations a match starts with.

    If a match of ``X{2,}Y`` ends somewhere, so does a match of ``XXY``: the set
    of end offsets is unchanged and the leading repeat no longer needs a bound.
    """
    out = list(items)
    while out:
        op, av = out[0]
        if op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
            lo, hi, body = av
            if lo == 0:
                out.pop(0)
                continue
            out[0] = (op, (lo, lo, body))
            if lo == 1:
                out[0:1] = _shortest_lead(body)
        elif op is rc.SUBPATTERN:
            number, add, drop, body = av
            out[0] = (op, (number, add, drop, _shortest_lead(body)))
        elif op is rc.BRANCH:
            out[0] = (op, (av[0], [_shortest_lead(b) for b in av[1]]))
        break
    return out


def _shortest_end(items) -> list:
    """Drop the optional iterations a match ends with: some match exists either way."""
    out = list(items)
    while out:
        op, av = out[-1]
        if op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
            lo, hi, body = av
            if lo == 0:
                out.pop()
                continue
            out[-1] = (op, (lo, lo, body))
        elif op is rc.SUBPATTERN:
            number, add, drop, body = av
            out[-1] = (op, (number, add, drop, _shortest_end(body)))
        break
    return out


def _bounded_tail(items) -> list:
    """Longest bounded end of the sequence: a necessary condition at each end offset."""
    tail: list = []
    for op, av in reversed(list(items)):
        lo, hi = _item_width(op, av)
        if hi is not None and (_width(tail)[1] or 0) + hi <= MAX_LOOKBEHIND:
            tail.insert(0, (op, av))
            continue
        if op is rc.SUBPATTERN and not (av[1] or av[2]):
            tail = _bounded_tail(av[3]) + tail
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and av[0] >= 1:
            tail = _bounded_tail(av[2]) + tail
        break
    return tail


def _cover(items, flags: int) -> str | None:
    members = []
    for op, av in _walk(items):
        if op is rc.ANY:
            if flags & re.DOTALL:
                return None
            members.append("[^\\n]")
        elif op is rc.SUBPATTERN and (av[1] or av[2]):
            return None
        else:
            atom = _atom(op, av)
            if atom is not None:
                members.append(atom)
    return "[" + "".join(dict.fromkeys(members)) + "]" if members else None


ALL_ENDS_REJECTS = {
    rc.ASSERT: "zero-width assertions are not supported",
    rc.ASSERT_NOT: "zero-width assertions are not supported",
    rc.GROUPREF: "back-references are not supported",
    rc.GROUPREF_EXISTS: "conditional references are not supported",
    rc.ATOMIC_GROUP: "atomic groups are not supported",
    rc.POSSESSIVE_REPEAT: "possessive quantifiers are not supported",
}


def as_bytes_view(text: str) -> str:
    """One character per UTF-8 byte."""
    return text.encode("utf-8").decode("latin-1")


def _parse(expression: str, flags: frozenset[str]):
    base = 0
    for letter, bit in (("i", re.IGNORECASE), ("m", re.MULTILINE), ("s", re.DOTALL)):
        if letter in flags:
            base |= bit
    source = expression if "8" in flags else as_bytes_view(expression)
    try:
        tree = rp.parse(_to_python(source), base)
    except (re.error, OverflowError) as e:
        raise RuleError(str(e)) from e
    return tree, tree.state.flags


def prepare(expression: str, flags=(), *, kind: str = "regex") -> Prepared:
    """Everything the scan operators need to know about one rule."""
    flags = frozenset(flags)
    if kind == "literal":
        text = expression if "8" in flags else as_bytes_view(expression)
        if not text:
            raise RuleError("pattern matches empty buffer")
        tree = rp.parse(re.escape(text), re.IGNORECASE if "i" in flags else 0)
        bits = tree.state.flags
    else:
        tree, bits = _parse(expression, flags)
    unicode = "W" in flags
    letters = "d" + "".join(c for f, c in FLAG_LETTERS if bits & f)
    letters += "u" if "8" in flags and bits & re.IGNORECASE else ""
    letters += "U" if unicode else ""
    prefix = f"(?{letters})"
    items = list(tree)
    lo, hi = _width(items)
    ops = list(_walk(items))

    if kind != "pcre":
        for op, _ in ops:
            if op in ALL_ENDS_REJECTS:
                raise RuleError(ALL_ENDS_REJECTS[op])
        if lo == 0 and "V" not in flags:
            raise RuleError("pattern matches empty buffer; allow-empty is not set")

    def emit(part, *, open_end=False, bounded=False, capture=False) -> str:
        return _Emitter(
            capture=capture, unicode=unicode, open_end=open_end, bounded=bounded, flags=bits
        ).seq(part)

    ends = ends_open = None
    if kind != "pcre":
        lead = _shortest_lead(items)
        lead_hi = _width(lead)[1]
        if lead_hi is not None and 0 < lead_hi <= MAX_LOOKBEHIND and lo > 0:
            try:
                ends = emit(lead, bounded=True)
                ends_open = emit(lead, bounded=True, open_end=True)
            except RuleError:
                ends = ends_open = None
    tail = _bounded_tail(items) if kind != "pcre" else []
    try:
        tail_text, tail_open = emit(tail, bounded=True), emit(tail, bounded=True, open_end=True)
    except RuleError:
        tail, tail_text, tail_open = [], "", ""
    if not _width(tail)[0]:
        tail_text = tail_open = "[\\s\\S]"

    guard = WHOLE_CHARACTERS if "8" in flags else ""
    refers = any(op in (rc.GROUPREF, rc.GROUPREF_EXISTS) for op, _ in ops)
    shortest = items if refers or lo == 0 else _shortest_end(_shortest_lead(items))
    needed = "" if bits & re.IGNORECASE else _longest_text(items, bits)

    def whole(body: str) -> str:
        start = NOT_BETWEEN_HALVES if lo == 0 else ""
        return prefix + (f"{start}(?:{body}){guard}" if guard else body)

    right = {rc.AT_END, rc.AT_END_STRING, rc.AT_BOUNDARY, rc.AT_NON_BOUNDARY}
    ats = [av for op, av in ops if op is rc.AT]
    is_text = bool(items) and all(op is rc.LITERAL for op, _ in items)
    plain = "".join(chr(av) for _, av in items) if is_text else None
    return Prepared(
        java=whole(emit(items, capture=kind == "pcre")),
        java_open=whole(emit(items, open_end=True, capture=kind == "pcre")),
        flags=prefix,
        min_width=lo,
        max_width=hi,
        looks_right=any(av in right for av in ats),
        looks_left=bool(ats),
        ends=ends,
        ends_open=ends_open,
        tail=tail_text,
        tail_open=tail_open,
        cover=_cover(items, bits),
        plain=plain,
        literal=None if bits & re.IGNORECASE else plain,
        groups=tree.state.groups - 1,
        guard=guard,
        exists=whole(emit(shortest, capture=refers)),
        needed=needed if len(needed) > 1 or not needed.isalnum() else "",
    )


def overlaps_itself(text: str) -> bool:
    """Whether two occurrences of ``text`` can overlap."""
    return any(text.startswith(text[i:]) for i in range(1, len(text)))


def alternation(texts, caseless: bool = False) -> str:
    """Prefix-factored alternation of plain texts, longest first at every position.

    One such expression finds, at each position, the longest member starting
    there. ``caseless`` is about ASCII letters.
    """
    trie: dict = {}
    for text in texts:
        node = trie
        for c in text.translate(ASCII_FOLD) if caseless else text:
            node = node.setdefault(c, {})
        node[""] = {}

    def spell(node: dict) -> str:
        branches = [_char(ord(c)) + spell(child) for c, child in sorted(node.items()) if c]
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
        return f"(?:{body})?" if "" in node else body

    return ("(?i)" if caseless else "") + spell(trie)


@dataclass(frozen=True)
class Captures:
    """A capturing form of a rule from which every group's start can be added up."""

    java: str
    slots: dict[int, int]  # group number -> capture number holding its text
    before: dict[int, list[int]]  # group number -> captures that precede it in the match
    names: dict[int, str]
    optional: dict[int, bool]  # group may be left out of a match
    count: int  # captures in ``java``


def captures(expression: str, flags=()) -> Captures:
    """Capture every piece of the rule so that group offsets are sums of lengths.

    A group inside a repeat has no such decomposition: it gets a slot but no
    ``before`` list, and its offsets are reported as NULL.
    """
    flags = frozenset(flags)
    tree, bits = _parse(expression, flags)
    plain = prepare(expression, flags, kind="pcre")
    emitter = _Emitter(capture=True, unicode="W" in flags, open_end=False, bounded=False, flags=bits)
    slots: dict[int, int] = {}
    before: dict[int, list[int]] = {}
    optional: dict[int, bool] = {}
    counter = [0]

    def nested_groups(items) -> bool:
        return any(op is rc.SUBPATTERN and av[0] is not None for op, av in _walk(items))

    def fresh() -> int:
        counter[0] += 1
        return counter[0]

    def inline(items, opt) -> str:
        """Pieces whose inner groups keep text only."""
        text = ""
        for op, av in items:
            if op is rc.SUBPATTERN:
                number, add, drop, body = av
                if number is None:
                    on = "".join(c for f, c in FLAG_LETTERS if add & f)
                    off = "".join(c for f, c in FLAG_LETTERS if drop & f)
                    text += f"(?{on}{'-' + off if off else ''}:{inline(body, opt)})"
                else:
                    slots[number] = fresh()
                    optional[number] = opt
                    text += f"({inline(body, opt)})"
            elif op is rc.BRANCH:
                text += "(?:" + "|".join(inline(b, True) for b in av[1]) + ")"
            elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT, rc.POSSESSIVE_REPEAT) and nested_groups(av[2]):
                lo, hi, body = av
                top = "" if hi is rc.MAXREPEAT else str(hi)
                lazy = {rc.MIN_REPEAT: "?", rc.POSSESSIVE_REPEAT: "+"}.get(op, "")
                text += f"(?:{inline(body, opt or lo == 0)}){{{lo},{top}}}{lazy}"
            elif op is rc.GROUPREF:
                text += f"(?:\\{slots[av]})"
            elif op is rc.ATOMIC_GROUP:
                text += f"(?>{inline(av, opt)})"
            elif op in (rc.ASSERT, rc.ASSERT_NOT) and nested_groups(av[1]):
                sign = "=" if op is rc.ASSERT else "!"
                text += f"(?{'<' if av[0] < 0 else ''}{sign}{inline(av[1], True)})"
            else:
                text += emitter.item(op, av)
        return text

    def pieces(items, preceding: list[int], opt: bool) -> str:
        text = ""
        preceding = list(preceding)
        for op, av in items:
            if op in (rc.AT, rc.ASSERT, rc.ASSERT_NOT):
                text += inline([(op, av)], opt)
                continue
            slot = fresh()
            if op is rc.SUBPATTERN and av[0] is not None:
                slots[av[0]] = slot
                before[av[0]] = list(preceding)
                optional[av[0]] = opt
                text += f"({pieces(av[3], preceding, opt)})"
            elif op is rc.SUBPATTERN and not (av[1] or av[2]):
                text += f"({pieces(av[3], preceding, opt)})"
            elif op is rc.BRANCH:
                text += "(" + "|".join(pieces(b, preceding, True) for b in av[1]) + ")"
            elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and av[:2] == (0, 1):
                lazy = "?" if op is rc.MIN_REPEAT else ""
                text += f"((?:{pieces(av[2], preceding, True)})?{lazy})"
            else:
                text += f"({inline([(op, av)], opt)})"
            preceding.append(slot)
        return text

    start = NOT_BETWEEN_HALVES if plain.guard and plain.min_width == 0 else ""
    java = f"{plain.flags}{start}(?:{pieces(list(tree), [], False)}){plain.guard}"
    names = {number: name for name, number in tree.state.groupdict.items()}
    return Captures(java, slots, before, names, optional, counter[0])


def required_text(expression: str, flags=(), *, kind: str = "regex") -> tuple[str, bool]:
    """Longest plain text every match contains, and whether its case is free."""
    flags = frozenset(flags)
    if kind == "literal":
        return (expression if "8" in flags else as_bytes_view(expression)), "i" in flags
    tree, bits = _parse(expression, flags)
    return _longest_text(list(tree), bits), bool(bits & re.IGNORECASE)


def _longest_text(items, bits: int) -> str:
    runs = [""]

    def visit(part) -> None:
        for op, av in part:
            if op is rc.LITERAL and not (bits & re.IGNORECASE and av > 127):
                runs[-1] += chr(av)
            elif op is rc.AT:
                continue
            elif op is rc.SUBPATTERN and not (av[1] or av[2]):
                visit(av[3])
            elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and av[0] >= 1:
                # the first iteration follows what came before, the last one precedes what comes next
                visit(av[2])
                runs.append("")
                if len(av[2]) == 1 and av[2][0][0] is rc.LITERAL:
                    visit(av[2])
            else:
                runs.append("")

    visit(items)
    return max(runs, key=len)
