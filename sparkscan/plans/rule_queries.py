"""Rule tables: read, written, combined, and scanned with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rules import Rule, exclude_rules, rules_table, union_rules
from ..operators.scan import hit_counts
from ..session import fresh_path
from ..sources.documents import read_table
from ..sources.rule_files import format_rules, load_rules, load_snapshot, parse_rules, save_snapshot, store_rules
from .registry import documents, query
from .sql import lit

# Rule lines made of the part table: comments, bare, delimited, numbered and constrained lines.
PART_LINES = """CASE p_size % 5
  WHEN 0 THEN '# ' || p_name
  WHEN 1 THEN p_name
  WHEN 2 THEN '/' || p_name || '/i'
  WHEN 3 THEN (p_partkey + 7) || ':/' || p_name || '.*x/smL'
  ELSE (p_partkey + 9) || ':/a/' || p_name || '/H8{min_offset=' || p_size || ',max_offset=' || (p_size + 100) || '}' END"""


def part_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_size")
    return parts.select(F.col("p_partkey").alias("ord"), F.expr(PART_LINES).alias("line"))


@query("""
SELECT p_partkey::INT AS ord,
  (CASE p_size % 5 WHEN 3 THEN p_partkey + 7 WHEN 4 THEN p_partkey + 9 ELSE p_partkey END)::INT AS pattern_id,
  CASE p_size % 5 WHEN 3 THEN p_name || '.*x' WHEN 4 THEN 'a/' || p_name ELSE p_name END AS expression,
  CASE p_size % 5 WHEN 1 THEN '' WHEN 2 THEN 'i' WHEN 3 THEN 'msL' ELSE 'H8' END AS flags,
  CASE p_size % 5 WHEN 4 THEN p_size::BIGINT END AS min_offset,
  CASE p_size % 5 WHEN 4 THEN (p_size + 100)::BIGINT END AS max_offset
FROM part WHERE p_size % 5 <> 0""")
def rules_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = parse_rules(part_lines(spark, sf_dir))
    return rules.select("ord", "pattern_id", "expression", F.concat_ws("", "flags").alias("flags"),
                        F.col("ext.min_offset").alias("min_offset"), F.col("ext.max_offset").alias("max_offset"))


@query("""
SELECT c_custkey::INT AS ord,
  (CASE WHEN c_nationkey % 2 = 0 THEN c_custkey + 5 ELSE c_custkey END)::INT AS pattern_id,
  CASE WHEN c_nationkey % 2 = 0 THEN c_name ELSE c_mktsegment || ':' || c_name END AS expression,
  CASE WHEN c_nationkey % 2 = 0 THEN 'iH' ELSE '' END AS flags
FROM customer""")
def rules_load_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    line = F.expr("""CASE WHEN c_nationkey % 2 = 0 THEN (c_custkey + 5) || ':/' || c_name || '/iH'
                     ELSE c_mktsegment || ':' || c_name END""")
    rules = parse_rules(customers.select(F.col("c_custkey").alias("ord"), line.alias("line")), "literal")
    return rules.select("ord", "pattern_id", "expression", F.concat_ws("", "flags").alias("flags"))


@query("""
SELECT page_id::INT AS ord, (CASE WHEN page_id % 2 = 0 THEN page_id + 3 ELSE page_id END)::INT AS pattern_id,
  url AS expression, CASE WHEN page_id % 2 = 0 THEN 'i8W' ELSE '' END AS flags
FROM pages""")
def rules_load_pcre(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", "page_id", "url")
    line = F.expr("CASE WHEN page_id % 2 = 0 THEN (page_id + 3) || ':/' || url || '/i8W' ELSE url END")
    rules = parse_rules(pages.select(F.col("page_id").alias("ord"), line.alias("line")), "pcre")
    return rules.select("ord", "pattern_id", "expression", F.concat_ws("", "flags").alias("flags"))


@query("""
SELECT p_partkey::INT AS ord, CASE p_size % 5
  WHEN 1 THEN p_name
  WHEN 2 THEN '/' || p_name || '/i'
  WHEN 3 THEN (p_partkey + 7) || ':/' || p_name || '.*x/msL'
  ELSE (p_partkey + 9) || ':/a/' || p_name || '/H8{min_offset=' || p_size || ',max_offset=' || (p_size + 100) || '}' END AS line,
  true AS same
FROM part WHERE p_size % 5 <> 0""")
def rules_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = parse_rules(part_lines(spark, sf_dir))
    names = ("pattern_id", "expression", "flags", "ext")
    before = rules.withColumn("was", F.struct(*names))
    lines = format_rules(before, keep=("was",))
    again = parse_rules(lines.withColumn("kept", F.struct("was", "line")), keep=("kept",))
    return again.select("ord", "kept.line", (F.struct(*names) == F.col("kept.was")).alias("same"))


@query("""
SELECT (row_number() OVER (ORDER BY p_partkey) - 1)::INT AS ord,
  (CASE p_size % 5 WHEN 3 THEN p_partkey + 7 WHEN 4 THEN p_partkey + 9 ELSE p_partkey END)::INT AS pattern_id,
  CASE p_size % 5 WHEN 3 THEN p_name || '.*x' WHEN 4 THEN 'a/' || p_name ELSE p_name END AS expression,
  CASE p_size % 5 WHEN 1 THEN '' WHEN 2 THEN 'i' WHEN 3 THEN 'msL' ELSE 'H8' END AS flags
FROM part WHERE p_size % 5 <> 0""")
def rules_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules written as files and read again: positions are counted anew, ids are kept."""
    rules = parse_rules(part_lines(spark, sf_dir))
    path = fresh_path(spark, "rules")
    # ids are written where they differ from the position, so positions are moved away from them
    store_rules(rules.withColumn("ord", F.col("ord") + 1_000_000), path)
    again = load_rules(spark, path)
    return again.select("ord", "pattern_id", "expression", F.concat_ws("", "flags").alias("flags"))


WORDS = ["license", "http", "error", "tion", "with", "@", "192", "und der", "que", "the "]


def _counts_sql(words: dict[int, str]) -> str:
    values = ", ".join(f"({i}, {lit(w)})" for i, w in words.items())
    return f"""
SELECT w.id::INT AS pattern_id, sum((length(text) - length(replace(text, w.w, ''))) // length(w.w))::BIGINT AS hits,
  count(CASE WHEN contains(text, w.w) THEN 1 END) AS docs
FROM documents, (VALUES {values}) w(id, w) GROUP BY w.id"""


def word_rules(spark: SparkSession, words: list[str] = WORDS) -> DataFrame:
    return rules_table(spark, [Rule(i, i + 1, w) for i, w in enumerate(words)])


@query(_counts_sql({i + 1: w for i, w in enumerate(WORDS)}))
def rules_snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "rules")
    save_snapshot(word_rules(spark), path, version=1)
    return hit_counts(documents(spark, sf_dir), load_snapshot(spark, path, version=1))


@query(_counts_sql({i + 1: w for i, w in enumerate(WORDS) if i not in (2, 4)}))
def rules_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    excluded = spark.createDataFrame([(3,), (5,)], "pattern_id int")
    return hit_counts(documents(spark, sf_dir), exclude_rules(word_rules(spark), excluded))


@query(_counts_sql({**{i + 1: w for i, w in enumerate(WORDS)}, 50: "elle", 51: "aux"}))
def rules_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = rules_table(spark, [Rule(0, 50, "elle"), Rule(1, 51, "aux")])
    return hit_counts(documents(spark, sf_dir), union_rules(word_rules(spark), more))


@query(" UNION ALL ".join(
    f"SELECT '{kind}' AS input, * FROM ({_counts_sql(words)})"
    for kind, words in (("line", {7: "license"}), ("list", {0: "license", 1: "error"}), ("dict", {4: "http"}), ("table", {1: "license", 2: "http"}))
))
def rules_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    inputs = {
        "line": "7:/license/",
        "list": ["license", "# a comment", "/error/"],
        "dict": {"expression": "http", "pattern_id": 4},
        "table": word_rules(spark, WORDS[:2]),
    }
    out = None
    for kind, rules in inputs.items():
        part = hit_counts(docs, rules).select(F.lit(kind).alias("input"), "pattern_id", "hits", "docs")
        out = part if out is None else out.unionByName(part)
    return out
