"""Spelling variants against all pairs compared."""

import random
import re
import zlib
from collections import Counter

from sparkscan.llm import spelling

from .cases import documents, texts


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 199 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    forms, out = {}, {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * n else None
        out[w] = len(others)
    result = set()
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        result.add((w, forms[w], root, n, out[w], None if forms[w] is None else words[forms[w]]))
    return result


def rows_of(seed, n_words, letters, docs=40):
    """Words over few letters, so that many are near, with counts that make chains of forms."""
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 10))) for _ in range(n_words)]
    weights = [5 ** rng.randrange(0, 5) for _ in words]
    return [(i if i else None, " ".join(rng.choices(words, weights, k=400)) + rng.choice([" ", "\n12 "])) for i in range(docs)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, word string, n int")


def check(spark, rows, **options):
    found = spelling.spelling_variants(table(spark, rows), **options)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows)
    return got


def test_awkward_rows(spark):
    rows = texts()
    got = {tuple(r) for r in spelling.spelling_variants(documents(spark, rows)).collect()}
    assert got == plain(rows)
    assert spelling.spelling_variants(documents(spark).where("false")).count() == 0


def test_words_over_few_letters(spark):
    got = check(spark, rows_of(1, 700, "abé"))
    assert sum(r[1] is not None for r in got) > 20 and max(r[4] for r in got) > 3
    check(spark, rows_of(2, 400, "ABcÀÿ×"))


def test_chains_of_forms(spark):
    """Each form five times as frequent as its word, two edits from the next but one; the root is the last."""
    words = {"abcdef": 1600, "abcdxf": 300, "abydxf": 55, "abydxfz": 9, "qbydxfz": 9}
    text = " ".join(" ".join([w] * n) for w, n in words.items())
    got = {r[0]: r for r in check(spark, [(3, text)])}
    assert got["abydxfz"][1:3] == ("abydxf", "abcdef") and got["qbydxfz"][1] is None and got["abcdef"][1:3] == (None, "abcdef")


def test_large_lists_are_dealt_anew(spark):
    """Every list is too large at first; regions shrink to a single place, and no pair is lost or found twice."""
    check(spark, rows_of(4, 250, "xyß"), max_list=1)


def test_deleted_letters_repeated_rows_and_ties(spark):
    text = "abcdefg ABCDEFG abcdefh zabcdefg abcdef Abcdefgh "
    rows = [(7, text * 3)] * 4 + [(None, text * 5), (8, "x" * 3000 + " " + "x" * 2999 + " "), (8, "x" * 3000 + " " + "x" * 2999 + " ")] * 5
    check(spark, rows)


def test_pairs_of_a_list_are_those_with_their_first_difference_in_its_region():
    rng = random.Random(9)
    for a, b in ((0, 3), (3, 7), (2, 4), (6, 7), (0, 7)):
        stem = "".join(rng.choice("ab") for _ in range(a))
        tail = "".join(rng.choice("ab") for _ in range(max(0, 6 - b)))
        words = sorted({stem + "".join(rng.choice("ab") for _ in range(n - a - len(tail))) + tail for n in (6, 7) for _ in range(60)})
        found = set(zip(*[x.tolist() for x in spelling.near_in_list(words, 6, a, b)]))
        first = lambda x, y: next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        assert found == {(i, j) for i, x in enumerate(words) for j, y in enumerate(words)
                         if near(x, y) and min(len(x), len(y)) == 6 and a <= first(x, y) < b}
