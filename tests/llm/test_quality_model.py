import zlib

import numpy as np
from pyspark.sql import functions as F

from sparkscan.llm import quality_model, queries

from .cases import documents, texts

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = queries.op10_quality_model(spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality")
    got = out.join(labels, "doc_id").where("held_out").collect()
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in out.collect())
    good = [r.score for r in got if r.quality == 1]
    bad = [r.score for r in got if r.quality == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.98
    assert np.mean([(r.score >= 0.7) == (r.quality == 1) for r in got]) > 0.95
    assert out.count() == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out.collect())


def test_score_is_the_sparse_dot_product():
    rng = np.random.default_rng(2)
    weights = rng.normal(size=(1 << quality_model.BITS) + 1).astype(np.float32)
    for _, text in texts():
        at, value = quality_model.weighed(quality_model.features(text or ""))
        want = 1 / (1 + np.exp(-(float(weights[at].astype(float) @ value) + float(weights[-1]))))
        assert abs(quality_model.score_of(weights, text) - want) < 1e-4


def test_odd_rows(spark):
    df = documents(spark)
    labels = spark.createDataFrame(
        [(0, 1), (3, 0), (3, 1), (4, None), (9, 0), (None, 1), (999, 0)], "doc_id bigint, quality int")
    weights = quality_model.train(df, labels)
    again = quality_model.train(df.repartition(5), labels)
    assert (weights == again).all()
    out = df.select("doc_id", "text", quality_model.score(df, weights).alias("score")).collect()
    assert len(out) == len(texts()) and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if not (r.text or "").strip()}) == 1
    nothing = quality_model.train(df, labels.where(F.lit(False)))
    assert not nothing.any()
    none = documents(spark, [])
    assert not quality_model.train(none, labels).any() and none.select(quality_model.score(none, nothing)).collect() == []


def test_sample_is_bounded(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    some = quality_model.train(docs, labels, max_rows=40, epochs=1)
    assert some.any() and (some != quality_model.train(docs, labels, max_rows=80, epochs=1)).any()
