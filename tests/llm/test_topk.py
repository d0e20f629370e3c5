import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkscan.llm import topk


def brute(rows, k, step):
    good = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q in {i: v for i, v in good if i % step == 0}.items():
        found = sorted((-sum(a * b for a, b in zip(q[1], v)), i) for i, v in good if i != q[0])[:k]
        out |= {(q[0], r + 1, i, -s) for r, (s, i) in enumerate(found)}
    return out


def found(df, k=5, step=50):
    return {tuple(r) for r in topk.top_k(df, F.col("vec_id") % step == 0, k).collect()}


def test_table_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert found(df) == brute([(r.vec_id, list(r.embedding)) for r in df.collect()], 5, 50)


@pytest.mark.parametrize("shard", [8192, 40])
def test_ties_copies_and_odd_rows(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "QUERY_ROWS", shard)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).round(2).tolist()) for i in range(300)]
    rows += [(i, [0.5, 0.5, 0.0, 0.0]) for i in range(300, 500)]
    rows += [(i, [0.0] * 4) for i in range(500, 520)]
    rows += [(520, None), (530, [1.0, None, 0.0, 0.0]), (540, [float("nan")] * 4), (550, [float("inf"), 0.0, 0.0, 0.0]), (560, []), (None, [1.0] * 4)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<float>, rank int, score string")
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert found(df, 5, 10) == brute(exact, 5, 10)


def test_few_and_no_rows(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert found(spark.createDataFrame([], schema)) == set()
    assert found(spark.createDataFrame([(0, [1.0])], schema)) == set()
    assert found(spark.createDataFrame([(0, [1.0]), (1, [-1.0])], schema)) == {(0, 1, 1, -65536)}
    assert found(spark.createDataFrame([(1, [1.0])], schema)) == set()
