"""Stretches of cut rules in which no match can end."""

import random

from pyspark.sql import functions as F

from sparkscan import Rule, RuleError, scan
from sparkscan.functions import spans as S
from sparkscan.functions.cuts import cut_of, cut_rows, stretches

from .helpers import brute, rows


def test_stretches_without_a_tail_cost_nothing(spark):
    """A stretch in which the rest of a rule can't begin is not laid out, and no event is lost by that."""
    text = "ee er eeer e. eer\nwords no end. ends.\n" + "word " * 500 + "last."
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    for source, flags, live in [("e+r", "L", 3), (r"\w+[.]$", "L", 1), (r"\w+[.]$", "mL", 2), (r"[a-z]*[.]", "L", 4), ("e+(r|[.]$)", "8L", 3), ("w.*t[.]", "sL", 1)]:
        rule = Rule(0, 0, source, frozenset(flags))
        cut = cut_of(rule, True, True)
        if cut is not None:
            view = S.view_of(F.col("text"), rule.utf8)
            laid = df.select(F.size(stretches(view, cut_rows([cut])[0], rule.utf8, every=False)).alias("n")).first()["n"]
            assert laid == live, source
        short = df.select("doc_id", F.left("text", F.lit(60)).alias("text"))
        want = sorted((1, 0, s, e) for e, s in brute(source, flags, text[:60]).items())
        assert rows(scan(short, [rule])) == want, source


def test_dead_stretches_against_brute_force(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab.c \né") for _ in range(rnd.randrange(1, 24))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for source in ["a+b", r"[ab]+[.]$", "a[abc]*(c|bc)", r"b\w*\b[.]", "(a|bc)[^.]*[.]a"]:
        for flags in ("L", "8mL"):
            want = sorted((k, 0, s, e) for k, t in enumerate(texts) for e, s in brute(source, flags, t).items())
            try:
                got = rows(scan(df, [Rule(0, 0, source, frozenset(flags))]))
            except RuleError:
                continue
            assert got == want, (source, flags)
