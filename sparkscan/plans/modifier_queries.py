"""Flags, extended constraints, combinations, limits and handlers."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.control import apply_horizon, handled_scan, skip_rule, terminate
from ..operators.rules import Rule
from ..operators.scan import pcre_scan, scan
from ..streaming.batch import stream_scan
from .registry import conversations, documents, query
from .sql import BYTE_TEXT, STREAMS, events, grown, spans, union

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@query(union(events(spans("(?i)license", 0)), events(spans("license", 1))))
def flag_caseless(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir), ["/LICENSE/iL", "/license/L"])


@query(union(events(spans(r"(?s)\..[A-Z]", 0)), events(spans(r"\..[A-Z]", 1))))
def flag_dotall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir), [r"/\..[A-Z]/s8L", r"/\..[A-Z]/8L"])


@query(union(events(spans("(?m)^[A-Z]", 0)), events(spans(r"(?m)\.$", 1)), events(spans("^[A-Z]", 2))))
def flag_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir), ["/^[A-Z]/mL", r"/\.$/mL", "/^[A-Z]/L"])


# the first end of [0-9]+ is one digit into its first run
@query(f"""SELECT doc_id, pattern_id, "from", CASE WHEN pattern_id = 2 THEN "from" + 1 ELSE "to" END AS "to"
FROM ({union(events(spans("tion", 0)), events(spans("(?i)license", 1)), events(spans("[0-9]+", 2)))})
QUALIFY row_number() OVER (PARTITION BY doc_id, pattern_id ORDER BY "from") = 1""")
def flag_singlematch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir), ["/tion/HL", "/license/HiL", "/[0-9]+/HL"])


@query(f"""
SELECT d.doc_id, strlen(text)::BIGINT AS n, strlen(text)::BIGINT AS last_to, coalesce(s.x, 0)::BIGINT AS in_runs
FROM documents d LEFT JOIN (SELECT doc_id, sum("to" - "from") AS x FROM ({spans("x+")}) GROUP BY doc_id) s USING (doc_id)""")
def flag_allowempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir), ["/x*/VL"])
    return found.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.max("to").alias("last_to"), F.count(F.when(F.col("from") < F.col("to"), 1)).alias("in_runs"))


@query(union(events(spans("[éèü]", 0)), events(spans("é[a-z]", 1))))
def flag_utf8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir), ["/[éèü]/8L", "/é[a-z]/8L"])


@query(union(events(spans("\n[\\p{L}\\p{M}\\p{N}_]", 0)), events(spans("\n[0-9A-Za-z_]", 1))))
def flag_ucp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir), [r"/\n\w/8WL", r"/\n\w/8L"])


@query(events(spans("the", 0)) + ' WHERE "to" >= 100 AND "to" <= 2000')
def ext_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir), ["/the/L{min_offset=100,max_offset=2000}"])


@query(union(events(grown("[0-9]+", 0, 4)), events(grown("[0-9]+", 1, 6, som=False))))
def ext_min_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir), ["/[0-9]+/L{min_length=4}", "/[0-9]+/{min_length=6}"])


def _near(test: str, sizes: list[int]) -> str:
    """Every window of the given sizes at every position, compared with the literal.

    Positions are taken from pieces of 128 characters (each with the 16 that
    follow), because a substring far into a long text is slow to cut out. A
    window within two edits of "license" keeps one of its three parts, which is
    tested first.
    """
    return f"""
WITH t AS (SELECT doc_id, {BYTE_TEXT} AS t FROM documents),
 p AS MATERIALIZED (SELECT doc_id, b, substr(t, b + 1, 144) AS part FROM t, LATERAL (SELECT unnest(range(0, length(t), 128)) AS b)),
 w AS MATERIALIZED (SELECT doc_id, b + j AS i, n, substr(part, j + 1, n) AS w
  FROM p, LATERAL (SELECT unnest(range(0, least(128, length(part)))) AS j), (VALUES {', '.join(f'({n})' for n in sizes)}) v(n)
  WHERE j + n <= length(part) AND regexp_matches(substr(part, j + 1, n), 'li|cen|se'))
SELECT doc_id, 0::INT AS pattern_id, min(i)::BIGINT AS "from", (i + n)::BIGINT AS "to" FROM w WHERE {test} GROUP BY doc_id, i + n"""


@query(_near("levenshtein(w, 'license') <= 2", [5, 6, 7, 8, 9]))
def ext_edit_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir), ["/license/L{edit_distance=2}"])


@query(_near("hamming(w, 'license') <= 2", [7]))
def ext_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir), ["/license/L{hamming_distance=2}"])


COMBINATIONS = ["1:/license/iQ", "2:/[0-9]/Q", "3:/@/", "10:/1 & 2/C", "11:/!1 & (2 | !3)/C"]


def combination_events(source: str = "documents", key: str = "doc_id") -> str:
    first = lambda p, i: f"(SELECT min(\"to\") FROM ({spans(p, i, source=source, key=key)}) s WHERE s.{key} = d.{key}) AS r{i}"
    return f"""
WITH f AS (SELECT d.{key}, strlen(text) AS n, {first("(?i)license", 1)}, {first("[0-9]", 2)}, {first("@", 3)} FROM {source} d)
SELECT {key}, 10::INT AS pattern_id, 0::BIGINT AS "from", greatest(r1, r2)::BIGINT AS "to" FROM f WHERE r1 IS NOT NULL AND r2 IS NOT NULL
UNION ALL SELECT {key}, 11, 0, coalesce(r2, n) FROM f WHERE r1 IS NULL AND (r2 IS NOT NULL OR r3 IS NULL)
UNION ALL SELECT {key}, 3, 0, "to" FROM ({spans("@", 3, source=source, key=key)})"""


@query(combination_events())
def combination_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir), COMBINATIONS)


@query(combination_events(STREAMS, "stream_id"))
def stream_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combinations over whole conversations: the first end of each rule decides when a stream is closed."""
    return stream_scan(conversations(spark, sf_dir), COMBINATIONS)


@query(f"""SELECT stream_id, pattern_id, CASE WHEN "to" - "from" <= 8 THEN "from" ELSE -1 END::BIGINT AS "from", "to"
FROM ({spans("[0-9A-Za-z_]+[.]", source=STREAMS, key="stream_id")})""")
def som_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_horizon(stream_scan(conversations(spark, sf_dir), [r"/\w+[.]/L"]), 8)


SHELVES = "(SELECT doc_id // 32 AS stream_id, string_agg(text, '' ORDER BY doc_id) AS text FROM documents GROUP BY doc_id // 32)"


@query(union(
    f"""SELECT stream_id, pattern_id, CASE WHEN "to" <= 65536 THEN 0 ELSE -1 END::BIGINT AS "from", "to"
FROM ({spans(chr(10) + "[A-Z]", 0, source=SHELVES, key="stream_id")})""",
    events(spans("tion", 1, source=SHELVES, key="stream_id"), "stream_id")))
def stream_som_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, 32 to a stream, with a rule set of the small horizon and a match that goes on from each stream's start."""
    docs = documents(spark, sf_dir)
    chunks = docs.select(F.expr("doc_id div 32").alias("stream_id"), F.col("doc_id").alias("seq"), F.col("text").alias("payload"))
    return stream_scan(chunks, [Rule(0, 0, r"^[^\x02]*\n[A-Z]", frozenset("L"), som="small"), Rule(1, 1, "tion", frozenset("L"))])


TWO_RULES = union(events(spans("tion", 0)), events(spans("(?i)license", 1)), events(spans("e+r", 2)))


@query(f"""SELECT * FROM ({TWO_RULES}) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY "to", pattern_id, "from") <= 3""")
def control_terminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terminate(scan(documents(spark, sf_dir), ["/tion/L", "/license/iL", "/e+r/L"]), 3)


@query(f"""SELECT * FROM ({TWO_RULES}) QUALIFY row_number() OVER (PARTITION BY doc_id, pattern_id ORDER BY "to", "from") <= 2""")
def control_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skip_rule(scan(documents(spark, sf_dir), ["/tion/L", "/license/iL", "/e+r/L"]), 2)


def stop_late(events: pd.DataFrame) -> pd.Series:
    """Handler: leave rule 2 after offset 300, stop the haystack after offset 1000."""
    answer = pd.Series("continue", index=events.index)
    answer[(events["to"] > 300) & (events["pattern_id"] == 2)] = "skip"
    answer[events["to"] > 1000] = "terminate"
    return answer


@query(f"""
WITH m AS ({TWO_RULES}),
 a AS (SELECT *, CASE WHEN "to" > 1000 THEN 'terminate' WHEN "to" > 300 AND pattern_id = 2 THEN 'skip' ELSE 'continue' END AS act FROM m),
 b AS (SELECT *, count(CASE WHEN act = 'terminate' THEN 1 END) OVER (PARTITION BY doc_id ORDER BY "to", pattern_id, "from" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stops,
   count(CASE WHEN act = 'skip' THEN 1 END) OVER (PARTITION BY doc_id, pattern_id ORDER BY "to", "from" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS skips FROM a)
SELECT doc_id, pattern_id, "from", "to" FROM b WHERE stops = 0 AND skips = 0""")
def udf_match_handler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return handled_scan(documents(spark, sf_dir), ["/tion/L", "/license/iL", "/e+r/L"], stop_late)


@F.pandas_udf(T.StringType())
def initials(first: pd.Series, second: pd.Series) -> pd.Series:
    """Handler of captures: the initials of a pair of capitalised words."""
    return first.str[:1] + second.str[:1]


@query(f"""SELECT doc_id, "from", "to", substr(txt, 1, 1) || regexp_extract(txt, ' ([A-Z])', 1) AS initials
FROM ({spans("[A-Z][a-z]+ [A-Z][a-z]+")})""")
def udf_capture_handler(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pcre_scan(documents(spark, sf_dir), ["/([A-Z][a-z]+) ([A-Z][a-z]+)/"], groups=True)
    texts = initials(F.col("captures")[1]["text"], F.col("captures")[2]["text"])
    return found.select("doc_id", "from", "to", texts.alias("initials"))
