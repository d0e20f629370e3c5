"""Connected components of a table of links, by alternating stars.

Each round links every node's neighbours to the smallest one: first the larger
neighbours, then the smaller. Rounds end when the links no longer change; their
number grows with the logarithm of the longest chain. Every round is written to
the shared folder; groups are reduced to minima before they are joined back, so
a node with very many links is no hot task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path


def removed(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _star(links: DataFrame, larger: bool) -> tuple[DataFrame, str]:
    """Link each node ``a``'s neighbours to the least of ``a`` and its neighbours; written.

    The minima are written before they are joined, so that both sides of the join
    are shuffled for it and the links of a node with very many are split.
    """
    spark = links.sparkSession
    if larger:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least, at = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
    joined = both.join(least, "a")
    out = (joined.where("b > a") if larger else joined).select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not larger:
        out = out.union(least.select("a", F.col("m").alias("b")))
    result = written(out.where("a <> b").distinct(), "links")
    removed(spark, at)
    return result


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node that has a link ``(a, b)``; the component is its smallest node."""
    spark = links.sparkSession
    links, path = written(links.where("a <> b").distinct(), "links")
    state = None
    for _ in range(max_rounds):
        for larger in (True, False):
            links, new = _star(links, larger)
            removed(spark, path)
            path = new
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
