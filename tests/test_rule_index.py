"""Rules of a large set are asked around the places of the text they need."""

import random
import time

import numpy as np
import pytest

from sparkscan import Rule, scan
from sparkscan.operators import rule_index

from .helpers import brute, rows


def test_a_rule_is_not_asked_on_all_text(spark):
    """Two thousand rules that each have a place in every few thousand bytes: time goes by the places."""
    words = [f"word{k:04}" for k in range(2000)]
    df = spark.createDataFrame([(k, " ".join(words)) for k in range(250)], "doc_id long, text string").repartition(8)
    scan(df, [Rule(k, k, f"x{k}[a-z]?", frozenset("L")) for k in range(20)]).count()
    rules = [Rule(k, k, [rf"\b{w}\b", f"{w}.{{0,30}}~"][k % 2], frozenset("L")) for k, w in enumerate(words)]
    began = time.time()
    assert scan(df, rules).count() == 250 * 1000
    assert time.time() - began < 20


@pytest.mark.parametrize("utf8", [False, True])
def test_places_near_each_other_and_across_pieces(spark, monkeypatch, utf8):
    monkeypatch.setattr(rule_index, "CHUNK", 7)
    monkeypatch.setattr(rule_index, "PLACES", 3)
    monkeypatch.setattr(rule_index, "TOGETHER", 200)
    rng = random.Random(5)
    texts = ["".join(rng.choice(["aa", "ab", "é", " ", "\n", "abcabcabc", "😀"]) for _ in range(rng.randint(0, 14))) for _ in range(25)]
    texts += [None, "", "aaaaaaaaaaaaaaaa", "abcabcabcabc\n", "éaa"]
    df = spark.createDataFrame([(None if k == 3 else k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    rules = [
        ("aa", ""), ("aaa", ""), ("aa[ab]?", ""), (r"\baa", ""), (r"aa\b", ""), ("^ab", ""), ("^ab", "m"), ("ab$", ""), ("ab$", "m"), ("abcabcabc", ""),
        ("abcabcabca?", ""), ("abcabcabcabc", ""), (".?aa.?", "s"), ("é", ""), ("é.?", ""), ("[^b]éa{1,2}", ""), (" {1,3}", ""), ("(?:aa|é ab)", ""),
        ("a+b+", ""), ("aa.{0,5}", ""), ("\n", ""), ("😀a?", ""), (r"\Bab\b", "W"), ("abc[[:alpha:]]{2}", ""), (r"\x{100}", ""), ("AB", "i"), ("aa", "")]
    chosen = [(k, e, f + ("8" if utf8 else "") + ("L" if k % 3 else "")) for k, (e, f) in enumerate(rules) if not (utf8 and "x{100}" in e)]
    want = sorted(
        (k, i, start if "L" in f else 0, end) for k, t in enumerate(texts) if t for i, e, f in chosen if "x{100}" not in e
        for end, start in brute(e.replace("[:alpha:]", "a-zA-Z"), f, t).items())
    got = [(3 if r[0] is None else r[0], *r[1:]) for r in scan(df, [Rule(0, i, e, frozenset(f)) for i, e, f in chosen], block=16).collect()]
    assert sorted(got) == want
    bounded = [Rule(0, i, e, frozenset(f), ext={"min_offset": 3, "max_offset": 9, "min_length": 2}) for i, e, f in chosen]
    starts = {(k, i, end): start for k, t in enumerate(texts) if t for i, e, f in chosen if "x{100}" not in e
              for end, start in brute(e.replace("[:alpha:]", "a-zA-Z"), f, t).items()}
    got = [(3 if r[0] is None else r[0], *r[1:]) for r in scan(df, bounded, block=16).collect()]
    assert sorted(got) == [w for w in want if 3 <= w[3] <= 9 and w[3] - starts[w[0], w[1], w[3]] >= 2]


def test_texts_of_all_lengths_are_found_together():
    rng = random.Random(6)
    data = bytes(rng.choice(b"ab\x00\xc3") for _ in range(3000))
    texts = sorted({data[p:p + n] for n in range(1, 30) for p in rng.sample(range(2900), 12)} | {b"zz", b"aaaaaaaaaaaaaaaz"})
    at, number = rule_index.Texts(texts).find(np.frombuffer(data, np.uint8))
    want = sorted((p, k) for k, t in enumerate(texts) for p in range(len(data)) if data.startswith(t, p))
    assert sorted(zip(at.tolist(), number.tolist())) == want
