"""Rule profiles, ranking and ablation over what a scan found."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import group_ablation, rule_costs, rule_profile, rule_ranking
from ..operators.scan import scan
from .registry import QUERIES, documents, query
from .scan_queries import FREQUENT, _counts
from .sql import grown, spans, union


@query(f"""
SELECT pattern_id, min("to" - "from") AS min_width, max("to" - "from") AS max_width,
  bool_or("to" = strlen(text)) AS at_end, bool_and("to" = strlen(text)) AS only_at_end
FROM ({union(
    'SELECT doc_id, pattern_id, "from", "to" FROM (' + grown("[0-9]+", 0, 2, 4) + ')',
    'SELECT doc_id, pattern_id, "from", "to" FROM (' + spans("[0-9A-Za-z_]+[.]" + "$", 1) + ')',
    'SELECT doc_id, pattern_id, "from", "to" FROM (' + spans("(?i)licen[cs]es?", 2) + ')',
    'SELECT doc_id, pattern_id, "from", "to" - 1 FROM (' + spans("(?i)licen[cs]es", 2) + ')')})
JOIN documents USING (doc_id) GROUP BY pattern_id""", name="rule_profile")
def profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    found = scan(docs, ["/[0-9]{2,4}/L", r"/\w+[.]$/L", "/licen[cs]es?/iL"], keys=("doc_id", "n_bytes"))
    return rule_profile(found)


@query(f"""
WITH c AS (SELECT pattern_id, hits AS cost FROM ({_counts(FREQUENT)})),
 r AS (SELECT pattern_id, cost, row_number() OVER (ORDER BY cost DESC, pattern_id)::INT AS rank,
   count(*) OVER () AS n, sum(cost) OVER () AS base FROM c),
 g AS (SELECT *, ((rank - 1) // 3)::INT AS generation FROM r),
 s AS (SELECT generation, sum(sum(cost)) OVER (ORDER BY generation) AS cut FROM g GROUP BY generation)
SELECT pattern_id, cost, rank, generation, (base - cut)::BIGINT AS score, (base - cut) / base AS ratio
FROM g JOIN s USING (generation) WHERE generation < least(4, (n - 1) // 3)""", name="rule_ranking")
def ranking_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = QUERIES["multi_scan_counts"](spark, sf_dir).select("pattern_id", F.col("hits").alias("cost"))
    return rule_ranking(costs, factor=3, generations=4)


@query(f"""
WITH c AS (SELECT pattern_id, hits AS cost FROM ({_counts(FREQUENT)})),
 g AS (SELECT *, row_number() OVER (ORDER BY pattern_id * 7 % 11, pattern_id) AS i, count(*) OVER () AS n FROM c)
SELECT ((i * 4 - 1) // n)::INT AS group_no, count(*) AS rules, sum(cost)::BIGINT AS dropped,
  (sum(sum(cost)) OVER () - sum(cost))::BIGINT AS score, (sum(sum(cost)) OVER () - sum(cost)) / sum(sum(cost)) OVER () AS ratio
FROM g GROUP BY (i * 4 - 1) // n""")
def rule_group_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = QUERIES["multi_scan_counts"](spark, sf_dir).select("pattern_id", F.col("hits").alias("cost"))
    return group_ablation(costs, 3, F.col("pattern_id") * 7 % 11)


@query(f"""
WITH m AS (SELECT DISTINCT doc_id, pattern_id FROM ({union(
    *['SELECT doc_id, pattern_id FROM (' + spans(p, i) + ')' for i, p in enumerate(("tion", "(?i)license", "[0-9]+", "@"))])})),
 c AS (SELECT 'docs' AS criterion, pattern_id, count(*) AS cost FROM m GROUP BY pattern_id
   UNION ALL SELECT 'bytes', pattern_id, sum(strlen(text))::BIGINT FROM m JOIN documents USING (doc_id) GROUP BY pattern_id)
SELECT criterion, pattern_id, cost, (row_number() OVER w)::INT AS rank, (row_number() OVER w - 1)::INT AS generation,
  (sum(cost) OVER (PARTITION BY criterion) - sum(cost) OVER (w ROWS UNBOUNDED PRECEDING))::BIGINT AS score,
  (sum(cost) OVER (PARTITION BY criterion) - sum(cost) OVER (w ROWS UNBOUNDED PRECEDING)) / sum(cost) OVER (PARTITION BY criterion) AS ratio
FROM c WINDOW w AS (PARTITION BY criterion ORDER BY cost DESC, pattern_id) QUALIFY row_number() OVER w <= 3""")
def rule_ranking_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules ranked by the documents they match in, and by the bytes of those."""
    docs = documents(spark, sf_dir).withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    found = scan(docs, ["/tion/L", "/license/iL", "/[0-9]+/L", "/@/L"], keys=("doc_id", "n_bytes"))
    parts = [rule_ranking(rule_costs(found, by), generations=3).select(F.lit(by).alias("criterion"), "*") for by in ("docs", "bytes")]
    return parts[0].unionByName(parts[1])
