"""Token counts through a cache of digests.

The cache is a table ``(tokenizer, digest, n_tokens)``: a digest of the vocabulary
file, a digest of the normalised content, the count. Texts are joined to it by
digest; of the contents that are missing, each is encoded once and appended.
Appending is safe to repeat: rows are true whichever job wrote them, and readers
take one row per digest. A run reads the cache and keeps what its own contents
need; it writes no more than what was missing. ``compacted`` makes a cache of many
small appends one of few files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Vocabulary, vocabulary
from .byte_ids import byte_vocabulary
from .common import text_slices
from .components import removed, written

LIMIT = 2048
CACHE = "tokenizer string, digest string, n_tokens bigint"


def file_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def normalised(text: Column, path: str) -> Column:
    """What the tokenizer sees: null is empty; where it drops white space, runs of it are one blank."""
    text = F.coalesce(text, F.lit(""))
    if path.endswith(".json") and vocabulary(path).suffix:
        text = F.regexp_replace(text, r"[ \t\n\r]{2,}|[\t\n\r]", " ")
    return text


def counted(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    if path.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda texts: [len(i) for i in model.encode(texts, num_threads=1)]
    else:
        own: Vocabulary = vocabulary(path)
        if not own.suffix and not own.lowers:
            own = byte_vocabulary(path)
        count = lambda texts: [len(i) // 4 for i in own.encode(texts)]
    for digests, texts in text_slices(batches):
        yield pa.RecordBatch.from_arrays([digests, pa.array(count(texts), pa.int64())], ["digest", "n_tokens"])


def token_counts(df: DataFrame, path: str, cache: str, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Count tokens of whole texts: ``(key, n_bytes, n_tokens, over_limit)``, one row per row.

    ``cache`` is a folder all executors share; it may hold counts already, of this
    or other tokenizers, and what was missing is appended before this returns.
    A null text is empty. Repeated texts are encoded once; other columns are left out. An empty table gives no rows and
    appends none.
    """
    spark = df.sparkSession
    version = file_digest(path)
    body = normalised(F.col(f"`{text}`"), path)
    digest = F.sha2(body.cast("binary"), 256).alias("digest")
    size = F.octet_length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("bigint")
    rows, _ = written(df.select(F.col(f"`{key}`").alias("__key"), size.alias("n_bytes"), digest), "rows")

    # of the cache, only what this run's contents ask for is kept
    own = rows.select("digest").distinct()
    known, at_known = written(cached(df, cache).where(F.col("tokenizer") == version).join(own, "digest", "left_semi").groupBy("digest").agg(
        F.max("n_tokens").alias("n_tokens")), "known")
    texts = df.select(digest, body.alias("__text"))
    missing = texts.join(known.select("digest"), "digest", "left_anti").groupBy("digest").agg(F.first("__text").alias("__text"))
    made, at_made = written(missing.mapInArrow(lambda b: counted(b, path), "digest string, n_tokens bigint"), "made")
    made.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)
    spark.catalog.refreshByPath(cache)

    # written, so that both sides of the join are shuffled for it and a digest that very many texts share is split
    counts, _ = written(known.unionByName(made), "counts")
    removed(spark, at_known)
    removed(spark, at_made)
    return rows.join(counts, "digest").select(
        F.col("__key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def compacted(spark: SparkSession, cache: str, to: str, files: int) -> None:
    """Write the counts of a cache to another folder: one row for each tokenizer and digest, in ``files`` files.

    The old folder stays as it is, so jobs that read it or append to it go on; what they append is missing from the copy,
    and is only encoded again.
    """
    rows = spark.read.schema(CACHE).parquet(cache).groupBy("tokenizer", "digest").agg(F.max("n_tokens").alias("n_tokens"))
    rows.repartition(files, "digest").sortWithinPartitions("tokenizer", "digest").write.parquet(to)


def exists(df: DataFrame, path: str) -> bool:
    jvm = df.sparkSession.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).exists(at)


def cached(df: DataFrame, path: str) -> DataFrame:
    reader = df.sparkSession.read.schema(CACHE)
    return reader.parquet(path) if exists(df, path) else df.sparkSession.createDataFrame([], CACHE)
