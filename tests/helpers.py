"""Brute force over every (start, end) with Python's own regex engine."""

import re


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def brute(expression, flags, text, utf8=None):
    """{end: leftmost start} of all non-empty matches, in bytes."""
    utf8 = "8" in flags if utf8 is None else utf8
    # letters of any alphabet have case in UTF-8 rules
    bits = 0 if "W" in flags or (utf8 and "i" in flags) else re.ASCII
    for letter, bit in (("i", re.I), ("m", re.M), ("s", re.S)):
        bits |= bit if letter in flags else 0
    view = text if utf8 else text.encode().decode("latin-1")
    source = expression if utf8 else expression.encode().decode("latin-1")
    at = (lambda k: len(view[:k].encode())) if utf8 else (lambda k: k)
    found = {}
    for end in range(1, len(view) + 1):
        rule = re.compile(f"(?:{source})(?=[\\s\\S]{{{len(view) - end}}}\\Z)", bits)
        for start in range(end):
            m = rule.match(view, start)
            if m and m.end() == end:
                found[at(end)] = at(start)
                break
    return found


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]
