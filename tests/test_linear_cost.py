"""Work and memory that must not grow with a text's matches times its length, or with a batch."""

import time

import pandas as pd
from pyspark.sql import functions as F

from sparkscan import Regex, scan
from sparkscan.operators.control import HANDLED, handled_scan

from .helpers import brute, rows


def test_a_handler_is_asked_in_bounded_parts(spark):
    texts = ["a" * (HANDLED // 8)] * 40 + ["", None, "ba"]
    keyed = [(None if k == 3 else k, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(keyed, "doc_id long, text string").coalesce(1)

    def handler(events):
        if len(events) > HANDLED + HANDLED // 8:
            raise ValueError(f"{len(events)} events at once")
        return pd.Series("continue", index=events.index).where(events["to"] <= 3, "terminate")

    got = handled_scan(docs, ["/a/L"], handler)
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["bigint", "int", "bigint", "bigint"]
    counts = {r["doc_id"]: r["n"] for r in got.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {**{k: 4 for k in range(40) if k != 3}, None: 4, 42: 1}


def test_matches_of_a_long_text_do_not_copy_it(spark):
    n = 150_000
    df = spark.createDataFrame([("the é " * n,), ("a﷐ the",), (None,)], "text string")
    began = time.time()
    found = Regex("the|a.").find_iter(F.col("text"))
    sizes = df.select(F.size(found).alias("n"), F.get(found, F.lit(0))["text"].alias("first"), F.get(found, F.lit(n - 1))["to"].alias("last"))
    assert [tuple(r) for r in sizes.collect()] == [(n, "the", 7 * n - 4), (2, "a﷐", None), (0, None, None)]
    assert time.time() - began < 60


def test_empty_matches_are_ranges_between_matches(spark):
    texts = ["", "x", "axxbx", "é xx é", "xxxx", "ab", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = scan(df, ["/x*/VL"])
    want = sorted((k, 0, hits.get(e, e), e) for k, t in enumerate(texts) if t
                  for hits in [brute("x+", "L", t)] for e in range(1, len(t.encode()) + 1))
    assert rows(found) == want
    assert rows(scan(df, ["/x*/V"])) == sorted((k, i, 0, e) for k, i, _, e in want)
    assert "array_except" not in found._jdf.queryExecution().toString()
