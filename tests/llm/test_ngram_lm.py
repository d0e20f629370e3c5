import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sparkscan.llm import ngram_lm
from sparkscan.llm.common import remainder

from .cases import documents, prose, texts


def plain(rows, held_out):
    """The model from dictionaries of strings."""
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    one, two = Counter(), Counter()
    for i, ws in tokens:
        if not held_out(i):
            for v, w in zip(["<s>", *ws], ws):
                one[w] += 1
                two[v, w] += 1
    contexts, total, follow = Counter(), Counter(), defaultdict(Counter)
    for (v, w), c in two.items():
        contexts[w] += 1
        total[v] += c
        follow[v][min(c, 3)] += 1

    def discount(counts):
        n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
        if not all(n):
            return [0, 0.5, 1.0, 1.5]
        y = n[0] / (n[0] + 2 * n[1])
        return [0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0), k) for k in (1, 2, 3)]

    d1, d2 = discount(contexts.values()), discount(two.values())
    n, v_, all_contexts = sum(one.values()), len(one), sum(contexts.values())

    def chance(v, w):
        low = 1 / (v_ + 1)
        if all_contexts:
            low = (contexts[w] - d1[min(contexts[w], 3)]) / all_contexts + sum(d1[min(c, 3)] for c in contexts.values()) / all_contexts * low
        if not total[v]:
            return low
        c = two[v, w]
        return (c - d2[min(c, 3)]) / total[v] + sum(d2[k] * m for k, m in follow[v].items()) / total[v] * low

    out = [(str(i), held_out(i), len(ws), sum(one[w] > 0 for w in ws), n,
            sum(math.log10((one[w] + 1) / (n + v_ + 1)) for w in ws),
            sum(math.log10(chance(v, w)) for v, w in zip(["<s>", *ws], ws))) for i, ws in tokens]
    return out, chance, one


def out_of(i):
    return i is None or zlib.crc32(str(i).encode()) % 7 == 2


def equal(got, want):
    assert len(got) == len(want)
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


@pytest.mark.parametrize("flush,shard", [(3_000_000, 8 << 20), (50, 3_000)])
def test_against_dictionaries(spark, monkeypatch, flush, shard):
    monkeypatch.setattr(ngram_lm, "FLUSH_PAIRS", flush)
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", shard)
    rows = texts() + [(100 + k, prose(k, 60)) for k in range(60)]
    out = ngram_lm.learn_and_score(documents(spark, rows), remainder("doc_id", 7) != 2)
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    want, chance, one = plain(rows, out_of)
    equal([(str(r[0]), *r[1:]) for r in out.collect()], want)
    for context in ["<s>", b"the", b"never seen"]:  # with the unknown word, the chances of all words sum to 1
        assert sum(chance(context, w) for w in one) + chance(context, b"?") == pytest.approx(1)


def test_contexts_of_later_texts_are_spread(spark):
    rows = [(k, f"u{k} v{k}") for k in range(2_100)] + [(3_000 + k, f"hot w{k} " * 20) for k in range(200)]
    df = documents(spark, rows).select("doc_id", "text").orderBy("doc_id")
    hot = ngram_lm.tokens_of(["hot"])[0][0]
    found = ngram_lm.heavy_contexts(df, 8)
    assert hot in found and ngram_lm.BEGIN in found and len(found) < 4 * 8
    assert list(found) == sorted(found)


def test_nothing_to_learn_from(spark):
    rows = [(1, "a b"), (2, None)]
    out = ngram_lm.learn_and_score(documents(spark, rows), F.lit(False)).collect()
    equal([(str(r[0]), *r[1:]) for r in out], plain(rows, lambda i: True)[0])
    assert ngram_lm.learn_and_score(documents(spark, []), F.lit(True)).collect() == []


def test_held_out_documents_are_likelier_than_by_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = ngram_lm.learn_and_score(docs, remainder("doc_id", 7) != 2).where("held_out")
    got = out.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert got.s / got.n > got.b / got.n + 0.3


def test_folder_that_is_not_mounted(spark, monkeypatch):
    monkeypatch.setattr(ngram_lm, "fresh_path", lambda spark, label: f"hdfs://host/{label}")
    with pytest.raises(ValueError, match="mounted"):
        ngram_lm.train(documents(spark))
