"""Scans of whole documents: all ends, starts, literals, non-overlapping, helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import facade
from ..functions.facade import Regex
from ..operators.joins import dictionary_hits, matching_rules, prefilter_candidates
from ..operators.phrases import phrase_scan
from ..operators.rules import EXT_TYPE, Rule
from ..operators.scan import grep, hit_counts, literal_scan, pcre_scan, scan, scan_one, vectored_scan
from ..sources.documents import read_table
from ..streaming.batch import chunks_of
from .registry import documents, query
from .sql import events, grown, lit, literal_ends, spans, unbounded_events, union

# The words of the flagship count.
FREQUENT = [
    "the", "of", "and", "tion", "that", "with", "license", "http", "error", "for",
    "was", "from", "this", "are", "und", "der", "les", "que", "@", "192.",
]


def _counts(words: list[str]) -> str:
    """Counts by what ``replace`` removes.

    A word that begins as it ends can overlap itself in that letter; with the
    letter doubled in the text its occurrences lie apart.
    """
    values = ", ".join(f"({i}, {lit(w)}, {lit(w[0] if w[0] == w[-1] and len(w) > 1 else '')})" for i, w in enumerate(words))
    return f"""
SELECT id::INT AS pattern_id, sum((length(t) - length(replace(t, w, ''))) // length(w))::BIGINT AS hits,
  count(CASE WHEN contains(t, w) THEN 1 END) AS docs
FROM (SELECT id, w, CASE WHEN twice = '' THEN text ELSE replace(text, twice, twice || twice) END AS t
  FROM documents, (VALUES {values}) v(id, w, twice)) GROUP BY id, w"""


@query(_counts(FREQUENT))
def multi_scan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hit_counts(documents(spark, sf_dir), [Rule(i, i, w, kind="literal") for i, w in enumerate(FREQUENT)])


def _ends(som: bool) -> str:
    # "that" may overlap itself in its t: find "tha", then look at the next byte
    that = f"""SELECT doc_id, 0::INT AS pattern_id, {'"from"' if som else '0::BIGINT'} AS "from", "to" + 1 AS "to"
      FROM ({spans("(?i)tha")}) JOIN documents USING (doc_id) WHERE encode(text)["to" + 1:"to" + 1] IN (encode('t'), encode('T'))"""
    return union(*[
        events(p) for p in (
            spans("(?i)th", 0, som=som), that, spans("(?i)this", 0, som=som),
            spans("e+r", 1, som=som), grown("[0-9]+", 2, 2, 4, som=som))
    ])


@query(_ends(False))
def block_scan_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir), ["/th(at|is)?/i", "/e+r/", "/[0-9]{2,4}/"])


@query(_ends(True))
def block_scan_som(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir), ["/th(at|is)?/iL", "/e+r/L", "/[0-9]{2,4}/L"])


# A head, a class that goes on without bound, a tail: across lines, within a line, in UTF-8, and of several widths.
UNBOUNDED = ["/http.*tion/sL", "/@.*[.]/L", "/é.*è/8sL", "/(the|and)[a-z ]*(ing|er)/L", "/http.*tion/s"]


@query(unbounded_events())
def block_unbounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir), UNBOUNDED)


@query(events(spans("(?i)licen[cs]e", 0, som=False)))
def scan_single_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_one(documents(spark, sf_dir), "7:/licen[cs]e/i")


LITERALS = ["the", "then", "@", "192.", "http://", "tion", "nation", "(c)"]


@query(union(*[events(literal_ends(w, i)) for i, w in enumerate(LITERALS)]), name="literal_scan")
def literal_scan_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [Rule(i, i, w, frozenset("L"), "literal") for i, w in enumerate(LITERALS)]
    return literal_scan(documents(spark, sf_dir), rules)


@query(union(*[events(spans(p, i)) for i, p in enumerate(["(?i)the", "(?i)license", "(?i)und"])]))
def literal_scan_caseless(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [Rule(i, i, w, frozenset("iL"), "literal") for i, w in enumerate(["the", "License", "UND"])]
    return literal_scan(documents(spark, sf_dir), rules)


@query(union(events(spans("tion", 0)), events(spans("e+r", 1))), name="vectored_scan")
def vectored_scan_buffers(spark: SparkSession, sf_dir: str) -> DataFrame:
    buffers = documents(spark, sf_dir).select("doc_id", F.regexp_extract_all("text", F.lit(r"[\s\S]{1,100}"), F.lit(0)).alias("chunks"))
    return vectored_scan(buffers, ["/tion/L", "/e+r/L"])


@query(union(events(spans(r"[0-9A-Za-z_]+@[0-9A-Za-z_.]+", 0)), events(spans(r"(?i)th(?:e|at|is)?", 1)), events(spans("[A-Z][a-z]*", 2))), name="pcre_scan")
def pcre_scan_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pcre_scan(documents(spark, sf_dir), [r"/\w+@[\w.]+/", "/th(e|at|is)?/i", "/[A-Z][a-z]*/"])


EMAIL = r"(?<user>[\w.]+)@([\w]+)(\.\w+)?"


@query(f"""
SELECT doc_id, pattern_id, "from", "to",
  regexp_extract(txt, '^([0-9A-Za-z_.]+)@', 1) AS user_text,
  "from" + strlen(regexp_extract(txt, '^([0-9A-Za-z_.]+)@', 1)) AS user_to,
  regexp_extract(txt, '@([0-9A-Za-z_]+)', 1) AS host,
  "from" + strlen(regexp_extract(txt, '^([0-9A-Za-z_.]+)@', 1)) + 1 AS host_from,
  strlen(regexp_extract(txt, '@[0-9A-Za-z_]+(\\.[0-9A-Za-z_]+)?', 1)) > 0 AS has_suffix
FROM ({spans(r"[0-9A-Za-z_.]+@[0-9A-Za-z_]+(?:\.[0-9A-Za-z_]+)?", 0)})""")
def pcre_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pcre_scan(documents(spark, sf_dir), [f"/{EMAIL}/"], groups=True)
    c = F.col("captures")
    return found.select(
        "doc_id", "pattern_id", "from", "to",
        c[1]["text"].alias("user_text"), c[1]["to"].alias("user_to"),
        c[2]["text"].alias("host"), c[2]["from"].alias("host_from"), c[3]["active"].alias("has_suffix"))


@query(f"""SELECT doc_id, "from", "to", txt AS text FROM ({spans(r"[0-9A-Za-z_.]+@[0-9A-Za-z_.]+", 0)})""")
def grep_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    # of all ends of a match, keep the longest per start: the text grep would show
    found = grep(documents(spark, sf_dir), r"[\w.]+@[\w.]+")
    best = found.groupBy("doc_id", "from").agg(F.max(F.struct("to", "text")).alias("m"))
    return best.select("doc_id", "from", "m.to", "m.text")


@query("SELECT doc_id FROM documents WHERE regexp_matches(text, '[0-9A-Za-z_.]+@[0-9A-Za-z_.]+\\.[0-9A-Za-z_]+')")
def filter_is_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).where(Regex(r"[\w.]+@[\w.]+\.\w+").is_match(F.col("text"))).select("doc_id")


LONG_WORD = r"\b\w{13}\b"


@query(f"""SELECT doc_id, "from", "to", txt AS text FROM ({spans(LONG_WORD)})
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY "to") = 1""")
def regex_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    # inline evaluates the expression once; a filter on its result would repeat it
    first = F.array_compact(F.array(Regex(LONG_WORD).find(F.col("text"))))
    return documents(spark, sf_dir).select("doc_id", F.inline(first))


@query(f"""SELECT doc_id, "from", "to", txt AS text FROM ({spans(LONG_WORD)})""")
def regex_find_iter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", F.inline(Regex(LONG_WORD).find_iter(F.col("text"))))


@query(f"""SELECT doc_id, "from" AS m_start, "to" AS m_end, "to" - "from" AS m_length, txt AS m_text
FROM ({spans("[A-Z][a-z]+ [A-Z][a-z]+")})""")
def match_accessors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = documents(spark, sf_dir).select("doc_id", F.explode(Regex("[A-Z][a-z]+ [A-Z][a-z]+").find_iter(F.col("text"))).alias("m"))
    m = F.col("m")
    span = facade.span(m)
    return found.select(
        "doc_id", facade.start(m).alias("m_start"), facade.end(m).alias("m_end"),
        (span["to"] - span["from"]).alias("m_length"), facade.as_str(m).alias("m_text"))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text")


@query("""
SELECT conv_id, turn, (generate_subscripts(p, 1) - 1)::INT AS pos, unnest(p) AS piece
FROM (SELECT conv_id, turn, string_split_regex(text, '[^0-9A-Za-z_]+') AS p FROM conversations)""")
def regex_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(spark, sf_dir).select("conv_id", "turn", F.posexplode(Regex(r"\W+").split(F.col("text"))).alias("pos", "piece"))


@query(f"""
WITH f AS (SELECT conv_id * 1000 + turn AS k, conv_id, turn, text FROM conversations),
 m AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY "to") AS rn FROM ({spans("[^0-9A-Za-z_]+", source="f", key="k")})),
 cuts AS (SELECT f.conv_id, f.turn, f.text, a."from" AS f1, a."to" AS t1, b."from" AS f2, b."to" AS t2
  FROM f LEFT JOIN m a ON f.k = a.k AND a.rn = 1 LEFT JOIN m b ON f.k = b.k AND b.rn = 2)
SELECT conv_id, turn, p.pos::INT AS pos, p.piece AS piece FROM (
  SELECT conv_id, turn, unnest(CASE
    WHEN f1 IS NULL THEN [{{'pos': 0, 'piece': text}}]
    WHEN f2 IS NULL THEN [{{'pos': 0, 'piece': decode(encode(text)[:f1])}}, {{'pos': 1, 'piece': decode(encode(text)[t1 + 1:])}}]
    ELSE [{{'pos': 0, 'piece': decode(encode(text)[:f1])}}, {{'pos': 1, 'piece': decode(encode(text)[t1 + 1:f2])}},
          {{'pos': 2, 'piece': decode(encode(text)[t2 + 1:])}}] END) AS p FROM cuts)""")
def regex_splitn(spark: SparkSession, sf_dir: str) -> DataFrame:
    rx = Regex(r"\W+")
    text = F.col("text")
    none = _turns(spark, sf_dir).select("conv_id", "turn", F.posexplode(rx.splitn(text, 0)).alias("pos", "piece"))
    three = _turns(spark, sf_dir).select("conv_id", "turn", F.posexplode(rx.splitn(text, 3)).alias("pos", "piece"))
    return three.unionByName(none)


@query(f"""
WITH m AS (SELECT doc_id, "from" AS f, "to" AS t, lag("to", 1, 0) OVER (PARTITION BY doc_id ORDER BY "to") AS p FROM ({spans("[0-9]+")})),
 n AS (SELECT doc_id, strlen(text) AS n, text FROM documents),
 s AS (SELECT doc_id, 'match' AS kind, f, t FROM m
  UNION ALL SELECT doc_id, 'reject', p, f FROM m
  UNION ALL SELECT n.doc_id, 'reject', coalesce(max(m.t), 0), n.n FROM n LEFT JOIN m USING (doc_id) GROUP BY n.doc_id, n.n)
SELECT s.doc_id, (row_number() OVER (PARTITION BY s.doc_id ORDER BY f) - 1)::INT AS seg_no, kind, f::BIGINT AS "from", t::BIGINT AS "to",
  strlen(decode(encode(n.text)[f + 1:t]))::BIGINT AS size, md5(decode(encode(n.text)[f + 1:t])) AS digest
FROM s JOIN n USING (doc_id) WHERE t > f""")
def segment_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = documents(spark, sf_dir).select("doc_id", F.posexplode(Regex("[0-9]+").segments(F.col("text"))).alias("seg_no", "s"))
    text = F.col("s.text")
    return parts.select(
        "doc_id", "seg_no", "s.kind", "s.from", "s.to", F.octet_length(text).cast("bigint").alias("size"), F.md5(text.cast("binary")).alias("digest"))


@query(f"""SELECT 'i' AS opt, doc_id, count(*) AS n FROM ({spans("(?i)the")}) GROUP BY doc_id
UNION ALL SELECT 'm', doc_id, count(*) FROM ({spans("(?m)^[A-Z]")}) GROUP BY doc_id
UNION ALL SELECT 's', doc_id, count(*) FROM ({spans("(?s)[.].[A-Z]")}) GROUP BY doc_id
UNION ALL SELECT 'u', doc_id, count(*) FROM ({spans("[\\p{L}\\p{M}\\p{N}_]+")}) GROUP BY doc_id""")
def facade_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "i": Regex("the", case_insensitive=True), "m": Regex("^[A-Z]", multi_line=True),
        "s": Regex("[.].[A-Z]", dot_matches_new_line=True), "u": Regex(r"\w+", unicode=True),
    }
    sizes = F.array(*[
        F.struct(F.lit(k).alias("opt"), F.size(rx.find_iter(F.col("text"))).cast("bigint").alias("n")) for k, rx in rules.items()
    ])
    return documents(spark, sf_dir).select("doc_id", F.inline(sizes)).where("n > 0").select("opt", "doc_id", "n")


@query("""
SELECT doc_id AS stream_id, i::BIGINT AS seq, octet_length(p)::BIGINT AS n_bytes, md5(p) AS digest FROM (
  SELECT doc_id, i, encode(text)[i * 4096 + 1:(i + 1) * 4096] AS p
  FROM documents, LATERAL (SELECT unnest(range(0, (strlen(text) + 4095) // 4096)) AS i))""")
def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = chunks_of(documents(spark, sf_dir))
    return chunks.select("stream_id", "seq", F.octet_length("payload").cast("bigint").alias("n_bytes"), F.md5("payload").alias("digest"))


RULES = {1: "(?i)license", 2: "[0-9]{1,3}([.][0-9]{1,3}){3}", 3: "[0-9A-Za-z_.]+@[0-9A-Za-z_]+", 4: "the [a-z]+ing", 5: "(?i)copyright"}


@query("""
WITH r AS (SELECT p_name, (row_number() OVER (ORDER BY p_name) - 1)::INT AS pattern_id FROM (SELECT DISTINCT p_name FROM part))
SELECT p.p_partkey AS doc_id, pattern_id, (strpos(p.p_name, r.p_name) - 1)::BIGINT AS "from",
  (strpos(p.p_name, r.p_name) - 1 + strlen(r.p_name))::BIGINT AS "to"
FROM part p JOIN r ON contains(p.p_name, r.p_name)""")
def multi_scan_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All part names as rules, searched in all part names."""
    parts = read_table(spark, sf_dir, "part", "p_partkey", "p_name")
    names = parts.select(F.col("p_name").alias("expression")).distinct()
    numbered = names.withColumn("ord", F.row_number().over(Window.orderBy("expression")) - 1)  # a row per rule
    rules = numbered.select(
        "ord", F.col("ord").alias("pattern_id"), F.lit("literal").alias("kind"), "expression",
        F.array(F.lit("L")).alias("flags"), F.lit(None).cast(EXT_TYPE).alias("ext"), F.lit(None).cast("string").alias("som"))
    return scan(parts.select(F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("text")), rules)


@query(r"""
WITH r AS (
  SELECT (item_id * 1000 + i - 1)::INT AS id, w FROM (
    SELECT item_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
    FROM (SELECT item_id, regexp_extract_all(text, '[a-z]{6,}') AS ws FROM benchmark))),
 runs AS (SELECT doc_id, "from" AS s, txt FROM (""" + spans("[a-z]{6,}") + r""")),
 p AS (
  SELECT txt, w, unnest(list_filter(range(0, len(txt) - len(w) + 1), lambda i: txt[i + 1:i + len(w)] = w)) AS i
  FROM (SELECT DISTINCT txt FROM runs) JOIN (SELECT DISTINCT w FROM r) ON contains(txt, w)),
 h AS (SELECT doc_id, w, encode(text) AS b, len(w) AS n, s + i AS i FROM runs JOIN p USING (txt) JOIN documents USING (doc_id)),
 e AS (SELECT doc_id, id, i, n, b[i:i] AS before, b[i + n + 1:i + n + 1] AS after FROM h JOIN r USING (w))
SELECT doc_id, id AS pattern_id, i::BIGINT AS "from", (i + n)::BIGINT AS "to" FROM e
WHERE id % 3 < 2 OR NOT regexp_matches(decode(CASE WHEN before < encode(chr(127)) THEN before ELSE encode(' ') END), '[0-9A-Za-z_]')
  AND NOT regexp_matches(decode(CASE WHEN after < encode(chr(127)) THEN after ELSE encode(' ') END), '[0-9A-Za-z_]')
UNION ALL SELECT doc_id, id, i, i + n + 1 FROM e WHERE id % 3 = 1 AND after BETWEEN encode('a') AND encode('z') AND octet_length(after) = 1""")
def scan_rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule for each long word of each benchmark passage, in three spellings, searched in all documents."""
    words = F.posexplode(F.regexp_extract_all("text", F.lit("[a-z]{6,}"), F.lit(0)))
    items = read_table(spark, sf_dir, "benchmark", "item_id", "text").select("item_id", words.alias("i", "w"))
    number = (F.col("item_id") * 1000 + F.col("i")).cast("int")
    kind = number % 3
    rules = items.select(
        number.alias("ord"), number.alias("pattern_id"), F.lit("regex").alias("kind"),
        F.when(kind == 0, F.col("w")).when(kind == 1, F.concat("w", F.lit("[a-z]?"))).otherwise(F.concat(F.lit("\\b"), "w", F.lit("\\b"))).alias("expression"),
        F.array(F.lit("L")).alias("flags"), F.lit(None).cast(EXT_TYPE).alias("ext"), F.lit(None).cast("string").alias("som"))
    return scan(documents(spark, sf_dir), rules)


@query("""
WITH l AS (
  SELECT (item_id * 1000 + i - 1)::INT AS id, w FROM (
    SELECT item_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
    FROM (SELECT item_id, regexp_extract_all(text, '[A-Z][^.]+[.]') AS ws FROM benchmark))),
 h AS (
  SELECT doc_id, w, strlen(w) AS n, unnest(list_filter(range(0, strlen(text) - strlen(w) + 1), lambda i: b[i + 1:i + strlen(w)] = encode(w))) AS i
  FROM (SELECT doc_id, text, encode(text) AS b FROM documents) JOIN (SELECT DISTINCT w FROM l) ON contains(text, w))
SELECT doc_id, id AS pattern_id, i::BIGINT AS "from", (i + n)::BIGINT AS "to" FROM h JOIN l USING (w)""")
def phrase_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of every benchmark passage, wherever documents repeat it."""
    items = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    sentences = F.posexplode(F.regexp_extract_all("text", F.lit("[A-Z][^.]+[.]"), F.lit(0))).alias("i", "expression")
    literals = items.select("item_id", sentences).select((F.col("item_id") * 1000 + F.col("i")).cast("int").alias("pattern_id"), "expression")
    return phrase_scan(documents(spark, sf_dir), literals)


@query(f"""SELECT doc_id, r.id::INT AS pattern_id FROM documents, (VALUES {', '.join(f'({i}, {lit(p)})' for i, p in RULES.items())}) r(id, p)
WHERE regexp_matches(text, r.p)""")
def join_docs_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching_rules(documents(spark, sf_dir), [Rule(k, i, p) for k, (i, p) in enumerate(RULES.items())])


@query("""
WITH t AS (SELECT w AS token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[\\p{L}\\p{M}\\p{N}_]+')) AS w FROM documents) GROUP BY w),
 l AS (SELECT DISTINCT item_id::INT AS pattern_id, unnest(regexp_extract_all(text, '[\\p{L}\\p{M}\\p{N}_]+')) AS token FROM benchmark)
SELECT pattern_id, sum(n)::BIGINT AS hits FROM l JOIN t USING (token) GROUP BY pattern_id""")
def join_tokens_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    words = F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[\\p{L}\\p{M}\\p{N}_]+"), F.lit(0))))
    literals = items.select(F.col("item_id").cast("int").alias("pattern_id"), words.alias("expression"))
    return dictionary_hits(documents(spark, sf_dir), literals)


@query("""SELECT doc_id, regexp_matches(text, '[a-z]+@[a-z.]+\\.com') AS confirmed FROM documents WHERE contains(text, '.com')""",
       name="prefilter_candidates")
def prefilter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefilter_candidates(documents(spark, sf_dir), r"/[a-z]+@[a-z.]+\.com/P")
