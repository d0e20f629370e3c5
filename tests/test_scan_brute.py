"""Scans against brute force on random texts."""

import random
import re
import time

import pytest
import regex
from pyspark.sql import functions as F

from sparkscan import Regex, Rule, RuleError, hit_counts, literal_counts, literal_scan, pcre_scan, scan
from sparkscan.operators.joins import confirm, dictionary_hits, dictionary_pairs, matching_rules, prefilter
from sparkscan.functions import spans as S
from sparkscan.operators.phrases import phrase_scan
from sparkscan.operators.rules import rules_table
from sparkscan.operators.scan import RULE_SET, _Plan

from .helpers import brute, distance, rows

RULES = [
    ("a+", ""), ("ab?", ""), ("a.b", ""), ("a.*b", ""), ("a.*b", "s"), ("^a", ""), ("^a", "m"), ("a$", ""), ("a$", "m"),
    (r"\ba", ""), (r"a\b", ""), (r"\w+\b", ""), ("(?:ab|b)+c", ""), ("é", ""), ("é+a", ""), ("[^a]b", ""), ("A", "i"),
    ("(a|b ){2,3}", ""), (r"a[^b]+b\b", ""), ("a+b*", ""), ("aa", ""), (r"\Ba", ""), ("(a|bc)+$", "m"), ("c.b", ""), ("[^a]{2}b", ""), (".{2,3}a", "s"), ("a{2,}", ""),
    ("É", "i"), ("(?:a|ab)(?:c|bcd)?", ""), (" *a", ""), ("[[:alpha:]]b", ""), (r"\x62", ""), ("😀a?", ""),
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    some = ["".join(rng.choice("ab c\né😀B") for _ in range(rng.randint(0, 16))) for _ in range(40)]
    return some + ["", "a", "\n", "a\n", "ba\n\n", "ab" * 20]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").cache()


def posix(expression):
    return expression.replace("[:alpha:]", "a-zA-Z")


@pytest.mark.parametrize("utf8", [False, True])
@pytest.mark.parametrize("part", [0, 1, 2])
def test_all_ends_and_starts(docs, texts, utf8, part):
    chosen = [(i, e, f + ("8" if utf8 else "")) for i, (e, f) in enumerate(RULES) if i % 3 == part]
    with_start = scan(docs, [Rule(0, i, e, frozenset(f + "L")) for i, e, f in chosen], block=8)
    ends_only = scan(docs, [Rule(0, i, e, frozenset(f)) for i, e, f in chosen], block=8)
    starts, ends = set(), set()
    for k, text in enumerate(texts):
        for i, e, f in chosen:
            for end, start in brute(posix(e), f, text).items():
                starts.add((k, i, start, end))
                ends.add((k, i, 0, end))
    assert rows(with_start) == sorted(starts)
    assert rows(ends_only) == sorted(ends)


def test_single_match_is_the_first_end(docs, texts):
    got = rows(scan(docs, ["1:/a+b?/LH", "1:/b/LH", "2:/c/LH"]))
    want = []
    for k, text in enumerate(texts):
        for i, group in ((1, ["a+b?", "b"]), (2, ["c"])):
            events = [(end, start) for e in group for end, start in brute(e, "", text).items()]
            if events:
                want.append((k, i, min(events)[1], min(events)[0]))
    assert got == sorted(want)


def test_constraints(docs, texts):
    got = rows(scan(docs, ["/a+/L{min_offset=3,max_offset=9}", "/[ab]+/L{min_length=3}", "/[ab]+/{min_length=2}"]))
    want = []
    for k, text in enumerate(texts):
        want += [(k, 0, s, e) for e, s in brute("a+", "", text).items() if 3 <= e <= 9]
        want += [(k, 1, s, e) for e, s in brute("[ab]+", "", text).items() if e - s >= 3]
        want += [(k, 2, 0, e) for e, s in brute("[ab]+", "", text).items() if e - s >= 2]
    assert got == sorted(want)


def test_allow_empty(docs, texts):
    got = rows(scan(docs, ["/a*/VL", "/(ab)?/V"]))
    want = []
    for k, text in enumerate(texts):
        runs = brute("a+", "", text)
        for end in range(1, len(text.encode()) + 1):
            want += [(k, 0, runs.get(end, end), end), (k, 1, 0, end)]
    assert got == sorted(want)
    with pytest.raises(RuleError):
        scan(docs, ["/a*/"])


@pytest.mark.parametrize("kind, k", [("edit", 1), ("edit", 2), ("hamming", 1), ("hamming", 2)])
def test_approximate(spark, kind, k):
    rng = random.Random(k)
    texts = ["".join(rng.choice("abcdé") for _ in range(rng.randint(0, 14))) for _ in range(40)] + ["abcd", "xabXcdx"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rows(scan(df, [f"/abcd/L{{{kind}_distance={k}}}", f"/ABCD/i{{{kind}_distance={k}}}"], block=16))
    want = set()
    for n, text in enumerate(texts):
        view = text.encode().decode("latin-1")
        for e in range(1, len(view) + 1):
            sizes = range(4 - k, 5 + k) if kind == "edit" else [4]
            near = [
                s for s in range(e) if e - s in sizes
                and (distance(view[s:e], "abcd") if kind == "edit" else sum(x != y for x, y in zip(view[s:e], "abcd"))) <= k
            ]
            if near:
                want |= {(n, 0, min(near), e), (n, 1, 0, e)}
    assert got == sorted(want)


def test_non_overlapping(docs, texts):
    chosen = [("a+|b", ""), ("a*", ""), (r"\b", ""), ("(a)(b)?", ""), ("(?=b)", ""), (r"(.)\1", "")]
    got = rows(pcre_scan(docs, [Rule(0, i, e, frozenset("8"), "pcre") for i, (e, _) in enumerate(chosen)]))
    want = []
    for k, text in enumerate(texts):
        for i, (e, _) in enumerate(chosen):
            for m in re.compile(e, re.ASCII).finditer(text):
                want.append((k, i, len(text[:m.start()].encode()), len(text[:m.end()].encode())))
    assert got == sorted(want)


def test_find_iter_agrees_with_another_engine(docs, texts):
    for e in (r"\w+", "a.", "[^a]+b"):
        got = docs.select("doc_id", Regex(e).find_iter(F.col("text")).alias("m"), Regex(e).find(F.col("text")).alias("f")).collect()
        for r in got:
            want = [m.group() for m in re.compile(e, re.ASCII).finditer(texts[r.doc_id])]
            assert [m["text"] for m in r.m] == want
            assert (r.f["text"] if r.f else None) == (want[0] if want else None)


def test_literal_sets(spark, docs, texts):
    words = ["a", "ab", "ba", "aba", "é", "aa", "b c", "😀"]
    rules = [Rule(i, i, w, frozenset("L"), "literal") for i, w in enumerate(words)] + [Rule(8, 8, "AB", frozenset("iL"), "literal")]
    want = [
        (k, i, s, s + len(w.encode()))
        for k, t in enumerate(texts) for i, w in enumerate(words)
        for s in range(len(t.encode())) if t.encode()[s:].startswith(w.encode())
    ] + [(k, 8, s, s + 2) for k, t in enumerate(texts) for s in range(len(t.encode())) if t.encode()[s:s + 2].lower() == b"ab"]
    assert rows(literal_scan(docs, rules, block=8)) == sorted(want)
    assert rows(scan(docs, rules)) == sorted(want)
    counts = {i: sum(1 for w in want if w[1] == i) for i in range(9)}
    assert dict(rows(literal_counts(docs, rules))) == counts
    assert {r[0]: r[1] for r in rows(hit_counts(docs, rules))} == counts
    per_doc = {i: len({w[0] for w in want if w[1] == i}) for i in range(9)}
    assert {r[0]: r[2] for r in rows(hit_counts(docs, rules))} == per_doc


def test_literals_have_no_regex_meaning(spark):
    df = spark.createDataFrame([(1, "a.c abc (x)* \\d")], "doc_id long, text string")
    rules = [Rule(i, i, w, frozenset("L"), "literal") for i, w in enumerate(["a.c", "(x)*", "\\d"])]
    assert rows(literal_scan(df, rules)) == [(1, 0, 0, 3), (1, 1, 8, 12), (1, 2, 13, 15)]
    assert rows(scan(df, rules)) == [(1, 0, 0, 3), (1, 1, 8, 12), (1, 2, 13, 15)]


def test_counts_of_any_rule(docs):
    rules = ["/a+/", "/a.*b/", "/b/H", "/a+/{min_length=2}"]
    found = {}
    for k, i, _, _ in rows(scan(docs, rules)):
        found.setdefault(i, []).append(k)
    assert rows(hit_counts(docs, rules)) == [(i, len(found[i]), len(set(found[i]))) for i in range(4)]


def test_rules_without_hits_are_counted(docs):
    found = rows(hit_counts(docs, ["/a+/", "/zz/", "/b/"]))
    assert found[1] == (1, 0, 0) and found[0][1] > 0 and found[2][1] > 0


def test_case_of_letters_beyond_ascii(spark):
    """Letters whose cases differ in bytes, and sets of literals that agree with single rules."""
    df = spark.createDataFrame([(1, "a\u212ab"), (2, "a\u017fb"), (3, "xx ΣΟΦΟΣ yy"), (4, "STRASSE straße İi")], "doc_id long, text string")
    rules = [Rule(i, i, w, frozenset("i8L"), "literal") for i, w in enumerate(["k", "s", "σοφοσ", "straße", "kb"])]
    found = rows(literal_scan(df, rules))
    assert found == rows(scan(df, rules))
    assert {(1, 0, 1, 4), (1, 4, 1, 5), (2, 1, 1, 3), (3, 2, 3, 13)} <= set(found)
    counts = {r[0]: r[1] for r in rows(literal_counts(df, rules))}
    assert counts == {i: sum(r[1] == i for r in found) for i in range(5)}


def test_case_of_approximate_rules(spark):
    df = spark.createDataFrame([(1, "LICENCE"), (2, "xx ㉩abcdef yy"), (3, "xx éABCDEX")], "doc_id long, text string")
    assert rows(scan(df, "/(?i)license/L{edit_distance=1}")) == [(1, 0, 0, 7)] == rows(scan(df, "/license/iL{edit_distance=1}"))
    found = rows(scan(df, "/éabcdef/iL{edit_distance=1}"))
    assert found == [(2, 0, 4, 12), (3, 0, 3, 10), (3, 0, 3, 11)]  # byte C3 is not E3 in another case


def test_found_text_is_that_of_the_column(spark):
    text = "a\ufdd0b \ufdd1c"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = df.select(Regex("[^ ]+").find(F.col("text")).alias("f"), Regex("[^ ]+").find_iter(F.col("text")).alias("m")).first()
    assert r.f.text == "a\ufdd0b" and [m.text for m in r.m] == ["a\ufdd0b", "\ufdd1c"]


def test_horizon_of_the_rule_set(spark):
    df = spark.createDataFrame([(1, "a" + "x" * 70_000 + "b")], "doc_id long, text string")
    rule = lambda i, som: Rule(i, i, "a[^\n]*b", frozenset("L"), som=som)
    # a horizon is a matter of streams
    assert rows(scan(df, [rule(0, "small")])) == [(1, 0, 0, 70_002)]
    assert rows(scan(df, [rule(0, "small"), rule(1, "medium")])) == [(1, 0, 0, 70_002), (1, 1, 0, 70_002)]


@pytest.mark.parametrize("utf8", [False, True])
def test_large_rule_sets_are_looked_up(docs, texts, utf8):
    """All rules at once, several under one id: those that need text are found by it, the others tried everywhere."""
    flag = "8" if utf8 else ""
    chosen = [(i % 20, e, f + flag + ("L" if i % 4 else "")) for i, (e, f) in enumerate(RULES * 2)]
    assert sum(bool(_Plan(Rule(0, i, e, frozenset(f))).marked) for i, e, f in chosen) > RULE_SET
    want = sorted(
        (k, i, start if "L" in f else 0, end) for k, text in enumerate(texts) for i, e, f in chosen
        for end, start in brute(posix(e), f, text).items())
    rules = [Rule(0, i, e, frozenset(f)) for i, e, f in chosen]
    assert rows(scan(docs, rules, block=8)) == want
    found = {r[0]: (r[1], r[2]) for r in rows(hit_counts(docs, rules))}
    assert found == {i: (sum(w[1] == i for w in want), len({w[0] for w in want if w[1] == i})) for i in range(20)}


@pytest.mark.parametrize("utf8", [False, True])
def test_many_rules_joined_to_haystacks(docs, texts, utf8):
    rules = [Rule(0, i % 25, e, frozenset(f + ("8" if utf8 else ""))) for i, (e, f) in enumerate(RULES)]
    few = [matching_rules(docs, rules[k:k + 8]) for k in range(0, len(rules), 8)]
    want = {r for part in few for r in rows(part)}
    assert rows(matching_rules(docs, rules)) == sorted(want) and len(want) > 100


def test_large_rule_sets_beside_others(spark):
    df = spark.createDataFrame([(1, "word7 word77 test word8"), (2, "none"), (3, None)], "doc_id long, text string")
    rules = [Rule(k, k, f"word{k}[a-z]?", frozenset("L"), ext={"min_offset": 6} if k == 7 else {}) for k in range(40)]
    rules += [Rule(40, 40, "tes+t", frozenset("LH")), Rule(41, 41, "7 & 8 & !9", frozenset("C")), Rule(42, 42, "word8$", frozenset("LQ"))]
    assert rows(scan(df, rules)) == [(1, 7, 6, 11), (1, 8, 18, 23), (1, 40, 13, 17), (1, 41, 0, 23)]
    start = time.time()
    scan(df, [Rule(k, k, rf"w{k:04}[a-z]?\b", frozenset("L")) for k in range(2000)])._jdf.queryExecution().executedPlan()
    assert time.time() - start < 15, "a plan does not grow with the rules"


def test_phrases_of_any_length_and_number(spark):
    """Every substring of some texts and others beside them, overlapping, at the edges, in bytes and under several ids."""
    rng = random.Random(4)
    texts = [(k, "".join(rng.choice("ab é-\n") for _ in range(rng.randint(0, 90)))) for k in range(12)] + [(50, None), (51, "aaaaaaa"), (3, "ab")]
    literals = {"a", "aa", "aaa", "é", "é-", "zz", "never found, whatever its length may be"}
    for _, t in texts[:6]:
        for n in (1, 2, 3, 5, 8, 15, 16, 31, 33, 60):
            if len(t) >= n:
                at = rng.randint(0, len(t) - n)
                literals.add(t[at:at + n])
    words = [(i, w) for i, w in enumerate(sorted(literals))] + [(900, "aa"), (901, "")]
    want = []
    for k, t in texts:
        data = (t or "").encode()
        for i, w in words:
            w = w.encode()
            want += [(k, i, at, at + len(w)) for at in range(len(data)) if w and data.startswith(w, at)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = phrase_scan(df, spark.createDataFrame(words, "pattern_id int, expression string"))
    assert rows(got) == sorted(want)


def test_literal_tables_beyond_the_driver(spark, docs, monkeypatch):
    """The joined way gives what the driver's way gives."""
    literals = [Rule(0, i % 7, w, frozenset("L" if i % 3 else "") | frozenset("8" if i % 2 else ""), "literal") for i, w in enumerate(["a", "ab", "é", "b ", "cab", "zz", "\n", "aa", "b"])]
    table = rules_table(spark, literals)
    want, counts = rows(literal_scan(docs, table)), rows(literal_counts(docs, table))
    monkeypatch.setattr("sparkscan.operators.scan.MAX_RULES", 3)
    assert rows(literal_scan(docs, table)) == want and want
    assert rows(literal_counts(docs, table)) == counts
    with pytest.raises(RuleError, match="case matters"):
        literal_scan(docs, rules_table(spark, [*literals, Rule(0, 9, "x", frozenset("i"), "literal")]))


def test_literals_of_the_dictionary_are_tokens(spark):
    df = spark.createDataFrame([(1, "für x-ray für")], "doc_id long, text string")
    words = spark.createDataFrame([(0, "für")], "pattern_id int, expression string")
    assert rows(dictionary_hits(df, words)) == [(0, 2)] and rows(dictionary_pairs(df, words)) == [(1, 0, 2)]
    with pytest.raises(Exception, match="not one token"):
        dictionary_hits(df, spark.createDataFrame([(0, "x-ray")], words.schema)).collect()


def test_markers_in_the_text_are_only_text(spark):
    df = spark.createDataFrame([(1, "a﷐b﷑a")], "doc_id long, text string")
    assert rows(scan(df, ["/a/L8", "/b./L8", "/a/L"])) == [(1, 0, 0, 1), (1, 0, 8, 9), (1, 1, 4, 8), (1, 2, 0, 1), (1, 2, 8, 9)]
    assert rows(pcre_scan(df, ["/[ab]/8"])) == [(1, 0, 0, 1), (1, 0, 4, 5), (1, 0, 8, 9)]


def test_long_text_is_cut_without_loss(spark):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh \né") for _ in range(30_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    view = text.encode().decode("latin-1")
    got = rows(scan(df, ["/abc?/L", r"/\bab/L", "/[a-h]+h$/mL"], block=512))
    want = [(1, 0, m.start(), m.start() + n) for m in re.finditer("(?=ab)", view) for n in (2, 3) if n == 2 or view[m.start() + 2:m.start() + 3] == "c"]
    want += [(1, 1, m.start(), m.end()) for m in re.compile(r"\bab", re.A).finditer(view)]
    want += [(1, 2, m.start(), m.end()) for m in re.compile(r"[a-h]+h$", re.M).finditer(view)]
    assert got == sorted(want)


def test_dense_runs(spark):
    df = spark.createDataFrame([(1, "a" * 3000), (2, "b" * 5)], "doc_id long, text string")
    assert rows(scan(df, "/a/L")) == [(1, 0, i, i + 1) for i in range(3000)]
    assert pcre_scan(df, "/a/").count() == 3000


def test_combinations(spark):
    texts = ["ab", "ba1", "1", "c", "", "xaxxb"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rows(scan(df, ["1:/a/Q", "2:/b/Q", "3:/[0-9]/8Q", "10:/1 & 2 & !3/C", "11:/!(1|2)/C", "12:/1&2/CQ", "13:/3|1&!2/C"]))
    assert got == [(0, 10, 0, 2), (1, 13, 0, 3), (2, 11, 0, 1), (2, 13, 0, 1), (3, 11, 0, 1), (4, 11, 0, 0), (5, 10, 0, 5)]
    for bad in ("10:/1 &/C", "10:/9/C", "10:/1 + 2/C"):
        with pytest.raises(RuleError):
            scan(df, ["1:/a/", bad])


def test_prefilter_keeps_every_match(docs):
    for rule in ("/a+b c/", "/A?BA/i", "/é.a/", "/(ab)+c/", "/a|b/", "/b{2,}a/"):
        both = docs.select(prefilter(rule, F.col("text")).alias("p"), confirm(rule, F.col("text")).alias("c"))
        assert both.where("c AND NOT p").count() == 0


def test_pairs_and_dictionary(spark, docs, texts):
    pairs = rows(matching_rules(docs, ["1:/a b/", "2:/é/", "1:/c$/"]))
    want = {(k, 1) for k, t in enumerate(texts) if "a b" in t or re.search("c$", t)} | {(k, 2) for k, t in enumerate(texts) if "é" in t}
    assert pairs == sorted(want)
    literals = spark.createDataFrame([(1, "a"), (2, "ab"), (3, "a"), (4, "zz")], "pattern_id int, expression string")
    tokens = [(k, w) for k, t in enumerate(texts) for w in regex.findall(r"[\p{L}\p{M}\p{N}_]+", t)]
    hits = {i: sum(1 for _, w in tokens if w == e) for i, e in ((1, "a"), (2, "ab"), (3, "a"))}
    assert dict(rows(dictionary_hits(docs, literals))) == {i: n for i, n in hits.items() if n}
    by_doc = {}
    for k, w in tokens:
        for i, e in ((1, "a"), (2, "ab"), (3, "a")):
            if w == e:
                by_doc[k, i] = by_doc.get((k, i), 0) + 1
    assert rows(dictionary_pairs(docs, literals)) == sorted((k, i, n) for (k, i), n in by_doc.items())


def test_running_sums(spark):
    df = spark.createDataFrame([([i % 7 for i in range(n)],) for n in (0, 1, 64, 65, 200, 1000)], "x array<int>")
    for r in df.select("x", S.running(F.col("x")).alias("s")).collect():
        total, want = 0, []
        for v in r.x:
            total += v
            want.append(total)
        assert r.s == want
