import hashlib

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkscan.llm import token_counts
from sparkscan.llm.components import written

from .cases import documents, texts


def library(file):
    path = public_tokenizers.path(file)
    if file.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda t: len(model.encode(t))
    own = Tokenizer.from_file(path)
    return lambda t: len(own.encode(t, add_special_tokens=False).ids)


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_and_cache(spark, tmp_path, file):
    path, cache, count = public_tokenizers.path(file), str(tmp_path / "cache"), library(file)
    rows = texts()
    first = token_counts.token_counts(documents(spark, rows[:6]), path, cache, 10).collect()
    assert len(first) == 6
    held = spark.read.parquet(cache).count()
    out = token_counts.token_counts(documents(spark), path, cache, 10)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = sorted((str(i), len((t or "").encode()), count(t or ""), count(t or "") > 10) for i, t in rows)
    assert sorted((str(r.doc_id), *r[1:]) for r in out.collect()) == want
    cached = spark.read.parquet(cache)
    assert held < cached.count() == cached.select("digest").distinct().count()
    again = cached.count()
    assert sorted((str(r.doc_id), *r[1:]) for r in token_counts.token_counts(documents(spark), path, cache, 10).collect()) == want
    assert spark.read.parquet(cache).count() == again  # nothing was missing
    assert token_counts.token_counts(documents(spark, []), path, cache).collect() == []


def test_versions_do_not_mix(spark, tmp_path):
    cache = str(tmp_path / "cache")
    for file in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        count = library(file)
        got = token_counts.token_counts(documents(spark), public_tokenizers.path(file), cache).collect()
        assert sorted((str(r.doc_id), r.n_tokens) for r in got) == sorted((str(i), count(t or "")) for i, t in texts())


def test_a_lasting_cache_is_not_rewritten(spark, tmp_path, monkeypatch):
    """A batch against a cache a hundred times its size: no table of the run is larger than the batch, and few rows are appended."""
    path, cache, count = public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "cache"), library("byte_bpe_50k.json")
    version = token_counts.file_digest(path)
    batch = [(i, f"text number {i}") for i in range(20)]
    known = [(version, hashlib.sha256(t.encode()).hexdigest(), count(t)) for _, t in batch[:15]]
    spark.createDataFrame(known * 2, token_counts.CACHE).write.parquet(cache)
    spark.range(2000).select(
        F.lit(version).alias("tokenizer"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"), F.lit(1).cast("bigint").alias("n_tokens"),
    ).write.mode("append").parquet(cache)
    sizes = []

    def counted_written(df, label):
        made, at = written(df, label)
        sizes.append(made.count())
        return made, at

    monkeypatch.setattr(token_counts, "written", counted_written)
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in batch], "doc_id long, text string, digest string, n_tokens string")
    got = token_counts.token_counts(df, path, cache).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == [(i, count(t)) for i, t in batch]
    assert max(sizes) == 20 and spark.read.parquet(cache).count() == 2000 + 30 + 5
    token_counts.compacted(spark, cache, str(tmp_path / "compact"), 2)
    copy = spark.read.parquet(str(tmp_path / "compact"))
    assert copy.count() == 2000 + 20 and len(copy.inputFiles()) == 2
    assert sorted(map(tuple, token_counts.token_counts(df, path, str(tmp_path / "compact")).collect())) == sorted(map(tuple, got))
