"""From raw documents to packed sequences: rules, classifier, near duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written
as Parquet and read again as the next stage's ``docs``. All stages but the last
return the columns of ``documents``, and work on every row the one before kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkscan.llm import near_dup, packing, quality_model, quality_rules
from sparkscan.llm.common import remainder, table
from sparkscan.llm.components import written
from sparkscan.llm.queries import BYTE_BPE, QUALITY_SCORE


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that no quality rule rejects, repeated ones included. Null and empty texts are rejected; an empty table stays empty."""
    return quality_rules.passing(docs)


def keep_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier scores 0.7 or more; it learns from a bounded sample of the labelled documents of ``sf_dir``.

    Repeated rows score alike; null texts count as empty; an empty table stays empty.
    """
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    weights = quality_model.train(table(spark, sf_dir, "documents"), labels)
    return docs.where(quality_model.score(docs, weights) >= QUALITY_SCORE)


def row_name(name: str) -> Column:
    """Bytes that name a row by its doc_id and text, and sort by doc_id; rows without one come last, by their text alone."""
    text = F.coalesce("text", F.lit(""))
    own = F.concat(F.lpad(F.hex(F.col("doc_id").cast("bigint")), 16, "0"), F.lpad(F.hex(F.xxhash64(text)), 16, "0"))
    return F.unhex(F.coalesce(own, F.concat(F.lit("F" * 16), F.md5(text.cast("binary"))))).alias(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar texts (five words, 0.8): that with the smallest doc_id.

    Rows count by doc_id and text, so a doc_id with several texts loses none that has no copy elsewhere; of equal rows one
    stays. Null texts count as empty; a row without words, and of each doc_id one, stays. An empty table stays empty.
    """
    name = "__row"
    while name in docs.columns:
        name += "_"
    rows = docs.select("*", row_name(name))
    kept = near_dup.near_duplicates(rows, 5, 80, 100, key=name).where("kept").select(name).distinct()
    return rows.dropDuplicates([name]).join(kept, name, "left_semi").select(*[f"`{c}`" for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents in sequences of 2048 tokens; repeated rows are documents of their own, null texts are empty."""
    return packing.pack(docs, public_tokenizers.path(BYTE_BPE))


STAGES = [
    ("quality_rules", keep_by_rules),
    ("quality_classifier", keep_by_classifier),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # classifier, near duplicates and tokenizer have no SQL; tests/llm has a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
